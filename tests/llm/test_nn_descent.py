import numpy as np
from pyspark.sql import functions as F

from spendframe.llm import nn_descent as A
from spendframe.llm.common import read_table

CHECK = "/root/testdata/sf0.01"


def brute(rows, k, is_query):
    """{query id: [(id, score)]} in double precision."""
    ids = np.array([i for i, _ in rows])
    v = np.array([x for _, x in rows], float)
    norm = np.sqrt((v * v).sum(axis=1))
    out = {}
    for q in [i for i in range(len(ids)) if is_query(ids[i])]:
        s = (v @ v[q]) / (norm * norm[q])
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), s[i]) for i in order]
    return out


def recall(got, want, k):
    hit = sum(len({r.vec_id for r in got if r.query_id == q} & {i for i, _ in w}) for q, w in want.items())
    return hit / sum(len(w) for w in want.values())


def test_recall_and_scores(spark):
    table = read_table(spark, CHECK, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    want = brute(rows, 5, lambda i: i % 10 == 0)
    got = A.nearest(table, 5, F.col("vec_id") % 10 == 0).collect()
    assert recall(got, want, 5) >= 0.95
    exact = {q: dict(w) for q, w in want.items()}
    for r in got:
        if r.vec_id in exact[r.query_id]:
            assert abs(r.score - exact[r.query_id][r.vec_id]) < 1e-12
    for q in want:
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)


def test_several_blocks_and_hubs(spark):
    """Enough vectors for many blocks, with a dense crowd around one point."""
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(size=(1500, 16)), 0.05 * rng.normal(size=(700, 16)) + 1])
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    want = brute(rows, 5, lambda i: i % 50 == 0)
    assert recall(A.nearest(table, 5, F.col("vec_id") % 50 == 0).collect(), want, 5) >= 0.9


def test_goes_on_until_settled(spark, monkeypatch):
    """From a poor start: rounds until no edge changes, steps until no pool has a node to expand."""
    rng = np.random.default_rng(3)
    rows = [(i, x.tolist()) for i, x in enumerate(rng.normal(size=(600, 8)))]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(2)
    written, write = [], A.materialize

    def noted(df, name):
        written.append((name, write(df, name)))
        return written[-1][1]

    monkeypatch.setattr(A, "materialize", noted)
    for name, value in (("CELL", 16), ("PARTITIONS", 1), ("START", 2), ("SETTLED", 0)):
        monkeypatch.setattr(A, name, value)
    got = A.nearest(table, 5, F.col("vec_id") % 50 == 0)
    assert [n for n, _ in written].count("nn-graph") > 4
    assert [df for n, df in written if n == "nn-pool"][-1].where(F.exists("pool", lambda p: ~p["seen"])).isEmpty()
    assert recall(got.collect(), brute(rows, 5, lambda i: i % 50 == 0), 5) >= 0.95
    assert A._partitions(11) > A._partitions(5)


def test_unusable_and_repeated_vectors(spark):
    rows = [(0, [1.0, 0.0], "x"), (1, None, "x"), (2, [0.0, 0.0], "x"), (3, [None, 1.0], "x"), (4, [float("nan"), 1.0], "x"),
            (5, [1.0, 0.1], "x"), (6, [1.0, 0.1], "x"), (7, [-1.0, 0.0], "x"), (5, [1.0, 0.1], "x"), (8, [], "x"),
            (0, [1.0, 0.0], "x"), (9, [float("inf"), 1.0], "x")]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, node string")
    got = A.nearest(table, 5, F.col("vec_id") == 0).collect()
    assert {r.query_id for r in got} == {0}
    ids = [r.vec_id for r in sorted(got, key=lambda r: r["rank"])]
    assert sorted(ids) == sorted([5, 5, 6, 7] * 2)
    few = A.nearest(table.where("vec_id IN (5, 7)"), 5, F.col("vec_id") == 7).collect()
    assert [r.vec_id for r in few] == [5, 5]
    assert A.nearest(table.where("false"), 5, F.col("vec_id") == 0).count() == 0
    assert A.nearest(table.where("vec_id = 7"), 5, F.col("vec_id") == 7).count() == 0


def test_ties_among_many_equal_vectors(spark):
    """Of 300 equal vectors, stored by falling id, the smallest ids answer; so they do beside a
    repeated id and behind a nearer vector."""
    rows = [(i, [0.6, 0.8]) for i in range(300, 0, -1)] + [(1000 + i, [float(i), 1.0]) for i in range(40)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = A.nearest(table, 5, F.col("vec_id") % 50 == 0).collect()
    by_query = {q: [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == q] for q in {r.query_id for r in got}}
    assert all(by_query[q] == [1, 2, 3, 4, 5] for q in (50, 100, 300)) and len(by_query) == 7
    repeated = spark.createDataFrame([(50, [1.0, 0.0])] * 9 + [(i, [1.0, 0.0]) for i in (60, 51, 52, 53)] + [(7, [0.9, 0.1])] * 2,
                                     "vec_id bigint, embedding array<double>")
    got = A.nearest(repeated, 5, F.col("vec_id") == 50).collect()
    assert sorted((r["rank"], r.vec_id) for r in got) == sorted([(1, 51), (2, 52), (3, 53), (4, 60), (5, 7)] * 9)


def test_very_large_and_small_vectors(spark):
    rows = [(0, [1e-200, 1e-200]), (1, [1e200, 1e200]), (2, [-1e200, 1e-200]), (3, [3e-310, 1e-310])]
    got = A.nearest(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 5, F.col("vec_id") == 0).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [1, 3, 2]
    assert abs(got[0].score - 1) < 1e-12


def test_a_step_has_few_shuffles_and_hubs_several_rows(spark, monkeypatch):
    """The driver keeps account of every stage of every step, so a step has few of them."""
    hub = spark.range(700).select(F.col("id").alias("node"), F.array(F.struct(
        F.lit(-0.5).alias("far"), F.lit(1000).cast("bigint").alias("nbr"))).alias("best"))
    sides = A._sides(hub).collect()
    assert max(len(r.nbrs) for r in sides) <= A.BLOCK
    assert sorted(n for r in sides if r.node == 1000 for n in r.nbrs) == list(range(700))
    rng = np.random.default_rng(6)
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(rng.normal(size=(60, 8)))], "vec_id bigint, embedding array<double>")
    vectors = A.distinct_vectors(A.usable(table), 5)
    graph, shuffles, write = A.build(vectors, rounds=0), [], A.materialize

    def noted(df, name):
        if name == "nn-pool":
            shuffles.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name)

    monkeypatch.setattr(A, "materialize", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        A.search(vectors, graph, vectors.where("node % 3 = 0"), 5, steps=1)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert max(shuffles) <= 8
