"""Approximate nearest neighbours: NN-descent builds a graph, greedy search answers queries.

Vectors are reduced to unit length.  The graph starts from a few random partitions: each
takes the signs of random projections as a key, and the rows of a key, dealt into blocks of
bounded size, are compared with each other.  NN-descent then improves it in rounds: the
neighbours of a node, forward and backward, are likely neighbours of each other.  Spark joins
the edges with the vectors of their ends, gathers them per node in blocks of bounded size,
and a task compares a block's vectors and proposes, for each, the few that beat its present
neighbours; proposals are aggregated to the K best.  Rounds end when few edges change.

Queries are answered by greedy search: the pool of a query starts with its own place in the
graph (or with random nodes for vectors that are not in it), its unvisited best are expanded
by a join with the graph, new vectors are compared, and the best POOL stay, until nothing new
enters.  A step is one write whose new vectors are gathered by one shuffle of ids, and the write
itself counts the pools still open.  At last the scores of the pool are computed in double precision from the original
vectors.

Searching uses vectors in half precision; reported scores come from the original ones.  Every row is indexed.  Recall is
measured against brute force in the tests and the README.  Blocks bound what a task holds:
a hub with very many backward edges is dealt into several blocks, not cut.

Equal vectors are one node with their smallest ids, so however many there are, the smallest
answer, and they crowd no pool.

Defined results: rows whose vector is null, zero, or has a null or non-finite component, or
whose length is not that of most rows, take no part; very large and very small vectors do;
equal vectors are separate candidates; ties go to the smaller id (a null id last); rows that repeat an id are separate candidates too, except that no
row with the query's id answers it; fewer candidates than k give fewer rows; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from spendframe.llm.common import materialize, release

#: Neighbours per node; first partitions up to FEW_BITS bits of a key, and by how much each further
#: bit multiplies them; rows of their blocks, proposals per row; rows of a block in a round,
#: proposals per row of a block, share of changed edges that ends the rounds.
K = 20
PARTITIONS = 24
FEW_BITS = 5
GROWTH = 1.2
CELL = 2048
START = 8
BLOCK = 256
PROPOSALS = 8
SETTLED = 0.02
#: Search: nodes kept per query, expanded per step.
POOL = 96
EXPAND = 8


def usable(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    df = table.select(F.col(id_col).alias("vec_id"), v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("v", lambda x: x != 0))
    sizes = df.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return df.where(F.size("v") == (sizes[0].d if sizes else 0)).select(
        "vec_id", F.transform("v", lambda x: x + F.lit(0.0)).alias("v"))


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(node, v, ids, s, u): the different vectors of ``rows``, numbered, with their k + 1 smallest
    ids and how many rows have each (k at most): more can answer no query.  s is v scaled by
    a power of two, so that no length over- or underflows; u has unit length, packed (half
    precision)."""
    counted = rows.groupBy("v", "vec_id").agg(F.count("*").alias("c"))
    least = Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"))
    few = counted.withColumn("r", F.row_number().over(least)).where(F.col("r") <= k + 1)
    nodes = few.groupBy("v").agg(F.collect_list(F.struct("vec_id", F.least("c", F.lit(k)).alias("c"))).alias("ids")).select(
        F.monotonically_increasing_id().alias("node"), "v", "ids")
    kinds = nodes.schema["ids"].dataType.simpleString()

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1)
                x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
                u = (x / np.sqrt((x * x).sum(axis=1, keepdims=True))).astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(x), pa.list_(pa.float64())), pa.array([r.tobytes() for r in u], pa.binary())],
                    names=["node", "v", "ids", "s", "u"])

    return materialize(nodes.mapInArrow(
        pack, f"node bigint, v array<double>, ids {kinds}, s array<double>, u binary"), "nn-vectors")


def _unit(column) -> np.ndarray:
    """Rows of packed vectors."""
    return _rows(column.to_pylist())


def _rows(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), np.float16).reshape(len(rows), -1).astype(np.float32) if rows else np.zeros(
        (0, 1), np.float32)


def _best(sims: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest similarities above its floor."""
    k = min(k, sims.shape[1])
    cols = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(sims)), k)
    cols = cols.ravel()
    good = sims[rows, cols] > floor[rows]
    return rows[good], cols[good]


_EDGE = "node bigint, nbr bigint, sim float"


def _compare_blocks(blocks: DataFrame, most: int) -> DataFrame:
    """Proposed edges, ``most`` per row, from rows (key, node, u, floor) gathered by ``key``."""
    def run(table):
        nodes, first = np.unique(table.column("node").to_numpy(), return_index=True)
        u = _unit(table.column("u"))[first]
        floor = table.column("floor").to_numpy()[first]
        found = []
        for i in range(0, len(nodes), 4 * BLOCK):     # keys share rows by a hash: a block can be larger
            sims = u[i:i + 4 * BLOCK] @ u.T
            sims[np.arange(len(sims)), np.arange(i, i + len(sims))] = -9
            rows, cols = _best(sims, most, floor[i:i + 4 * BLOCK])
            found.append((nodes[i + rows], nodes[cols], sims[rows, cols]))
        parts = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
        return pa.table({"node": pa.array(parts[0], pa.int64()), "nbr": pa.array(parts[1], pa.int64()),
                         "sim": pa.array(parts[2], pa.float32())})

    return blocks.groupBy("key").applyInArrow(run, _EDGE)


def _keep(edges: DataFrame, k: int) -> DataFrame:
    """The k best neighbours of each node (ties to the smaller node), as arrays in order."""
    unique = edges.groupBy("node", "nbr").agg(F.max("sim").alias("sim"))
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("sim")).alias("far"), "nbr"))), 1, k)
    return unique.groupBy("node").agg(best.alias("best")).select(
        "node", "best", F.when(F.size("best") >= k, -F.get("best", F.lit(k - 1))["far"]).otherwise(
            F.lit(-2.0)).cast("float").alias("floor"))


def _edges(graph: DataFrame) -> DataFrame:
    return graph.select("node", F.explode("best").alias("b")).select(
        "node", F.col("b.nbr").alias("nbr"), (-F.col("b.far")).alias("sim"))


def _partitions(bits: int) -> int:
    """How many first partitions: neighbours meet in one less often the more bits its keys have."""
    return int(np.ceil(PARTITIONS * GROWTH ** max(0, bits - FEW_BITS)))


def _start(vectors: DataFrame, n: int, k: int, seed: int) -> DataFrame:
    """First edges from random partitions."""
    some = vectors.select("u").first()
    dims = len(some.u) // 2 if some else 1
    bits = max(0, int(np.ceil(np.log2(max(1, n / CELL)))))
    planes = np.random.default_rng(seed).normal(size=(_partitions(bits), bits, dims)).astype(np.float32)
    shared = vectors.sparkSession.sparkContext.broadcast(planes)

    def keyed(batches):
        for batch in batches:
            u = _unit(batch.column(1))
            for p, plane in enumerate(shared.value):
                sign = (u @ plane.T > 0) if bits else np.zeros((len(u), 0), bool)
                key = sign @ (1 << np.arange(bits, dtype=np.int64)) if bits else np.zeros(len(u), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key * len(shared.value) + p), batch.column(0), batch.column(1)], names=["key", "node", "u"])

    rows = vectors.select("node", "u").mapInArrow(keyed, "key bigint, node bigint, u binary")
    counts = rows.groupBy("key").count().withColumnRenamed("count", "c")
    blocks = rows.join(counts, "key").select(
        F.xxhash64("key", F.pmod(F.xxhash64("node"), F.ceil(F.col("c") / CELL))).alias("key"), "node", "u",
        F.lit(-2.0).cast("float").alias("floor"))
    return _compare_blocks(blocks, START)


def build(vectors: DataFrame, k: int = K, rounds: int | None = None, seed: int = 5) -> DataFrame:
    """The graph (node, best, floor) of ``usable`` vectors.  Neighbours only get nearer, so the
    rounds end by themselves; ``rounds`` ends them earlier."""
    n = vectors.count()
    graph = materialize(_keep(_start(vectors, n, k, seed), k), "nn-graph")
    for r in count() if rounds is None else range(rounds):
        edges = _edges(graph).select("node", "nbr")
        both = edges.union(edges.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))).distinct()
        degree = both.groupBy("node").agg(F.count("*").alias("c"))
        ends = vectors.select(F.col("node").alias("nbr"), "u").join(
            graph.select(F.col("node").alias("nbr"), "floor"), "nbr", "left")
        blocks = both.join(degree, "node").join(ends, "nbr").select(
            F.xxhash64("node", F.pmod(F.xxhash64("nbr", F.lit(r)), F.ceil(F.col("c") / BLOCK))).alias("key"),
            F.col("nbr").alias("node"), "u", F.coalesce("floor", F.lit(-2.0)).cast("float").alias("floor"))
        better = _keep(_edges(graph).union(_compare_blocks(blocks, PROPOSALS)), k)
        better = materialize(better, "nn-graph")
        old = _edges(graph).select("node", "nbr")
        total = better.agg(F.sum(F.size("best"))).first()[0] or 0
        changed = _edges(better).join(old, ["node", "nbr"], "left_anti").count()
        release(graph)
        graph = better
        if changed <= SETTLED * total:
            break
    return graph


def _sides(graph: DataFrame) -> DataFrame:
    """(node, nbrs): the neighbours of each node, forward and backward, BLOCK a row at most, so a
    hub with very many has several rows."""
    links = _edges(graph).select("node", "nbr")
    both = links.union(links.select(F.col("nbr").alias("node"), F.col("node").alias("nbr"))).distinct()
    place = F.row_number().over(Window.partitionBy("node").orderBy("nbr"))
    return both.withColumn("part", F.floor((place - 1) / BLOCK)).groupBy("node", "part").agg(
        F.collect_list("nbr").alias("nbrs")).select("node", "nbrs")


def search(vectors: DataFrame, graph: DataFrame, queries: DataFrame, k: int, pool: int = POOL,
           expand: int = EXPAND, steps: int | None = None) -> DataFrame:
    """(query, node) pools after greedy search, until every node of a pool is expanded or after ``steps``; ``queries`` are nodes of the graph (node, u).

    A step shuffles by node what the front reaches, with what the pools hold already, beside the
    vectors, and by query what is new: few stages, since the driver keeps account of each."""
    links = materialize(_sides(graph), "nn-links")
    asked = materialize(queries.select(F.col("node").alias("query"), F.col("u").alias("q")), "nn-queries")

    @F.pandas_udf("double")
    def far(u: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series(-(_rows(list(u)) * _rows(list(q))).sum(axis=1).astype(np.float64))

    # pool rows: (query, node, far, seen)
    state = asked.select("query", F.array(F.struct(
        F.lit(-2.0).alias("far"), F.col("query").alias("node"), F.lit(False).alias("seen"))).alias("pool"))
    state = materialize(state, "nn-pool")
    for _ in count() if steps is None else range(steps):
        fresh = F.slice(F.filter("pool", lambda p: ~p["seen"]), 1, expand)
        front = state.select("query", F.explode(fresh).alias("p")).select("query", F.col("p.node").alias("node"))
        reached = front.join(links, "node").select("query", F.explode("nbrs").alias("node"), F.lit(False).alias("known"))
        known = state.select("query", F.explode("pool.node").alias("node"), F.lit(True).alias("known"))
        # by node alone, so that the vectors' join needs no shuffle of its own
        new = reached.union(known).repartition("node").groupBy("query", "node").agg(
            F.max("known").alias("known")).where("NOT known").select("query", "node")
        scored = new.join(vectors.select("node", "u"), "node").join(asked, "query").select(
            "query", F.struct(far("u", "q").alias("far"), "node", F.lit(False).alias("seen")).alias("p"))
        came = scored.groupBy("query").agg(F.slice(F.sort_array(F.collect_list("p")), 1, pool).alias("came"))
        taken = F.transform("pool", lambda p: F.struct(
            p["far"].alias("far"), p["node"].alias("node"),
            (p["seen"] | F.array_contains(F.transform(fresh, lambda f: f["node"]), p["node"])).alias("seen")))
        merged = state.join(came, "query", "left").select("query", F.slice(F.sort_array(F.concat(
            taken, F.coalesce("came", F.expr("CAST(array() AS array<struct<far:double,node:bigint,seen:boolean>>)")))),
            1, pool + 1).alias("pool"))
        left = Observation()
        following = materialize(merged.observe(left, F.count_if(F.exists("pool", lambda p: ~p["seen"])).alias("open")), "nn-pool")
        release(state)
        state = following
        if not left.get["open"]:
            break
    release(links, asked)
    return state.select("query", F.explode("pool.node").alias("node")).where("query != node")


def nearest(table: DataFrame, k: int, is_query, id_col: str = "vec_id", vector_col: str = "embedding",
            degree: int = K, rounds: int | None = None, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row with ``is_query``."""
    rows = usable(table, id_col, vector_col)
    vectors = distinct_vectors(rows, k)
    graph = build(vectors, degree, rounds, seed)
    asked = materialize(rows.where(is_query).withColumn("row", F.monotonically_increasing_id()).join(
        vectors.select("v", "node"), "v").select("row", F.col("vec_id").alias("query_id"), "node"), "nn-asked")
    queries = vectors.join(asked.select("node").distinct(), "node", "left_semi")
    pools = search(vectors, graph, queries, k)
    # rows with the query's own vector are candidates too
    pools = pools.union(queries.select("node", F.col("node").alias("node2")))
    dot = F.aggregate(F.zip_with("q", "s", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    length = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda a, x: a + x * x))
    scored = pools.join(vectors.select("node", "s", "ids"), "node").join(
        vectors.select(F.col("node").alias("query"), F.col("s").alias("q")), "query").select(
        "query", "node", "ids", (dot / (length("q") * length("s"))).alias("score"))
    own = asked.withColumnRenamed("node", "query").join(scored, "query").select(
        "row", "query_id", "node", "score", F.explode("ids").alias("id")).where(
        ~F.col("id.vec_id").eqNullSafe(F.col("query_id")))
    every = own.select("row", "query_id", "node", "score", F.col("id.vec_id").alias("vec_id"),
                       F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("id.c"))).alias("copy"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "node", "copy"))
    return every.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
