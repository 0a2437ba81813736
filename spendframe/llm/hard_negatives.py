"""Hard-negative mining by bounds along spanning trees of anchors.

Each anchor's positives are its nearest rows of the same label by integer inner product; for each
positive, the nearest rows of other labels whose score lies in a window below the positive's.

Spanning trees.  Anchors are placed by their nearest of a few pivots, so that a tree's anchors
(ANCHORS at most, about) are near each other, and each tree spans its anchors and the zero
vector, whose scores are known to be zero.  An edge has the distance of its ends.  An anchor hangs
from the zero vector when no other anchor is nearer to it than that, where a bound by the parent
would say no more than the lengths do.

Bounds.  For an anchor a below p, the score of a candidate x lies within |a - p| * |x| of its
score at p (or of the bounds known there).  Down each tree, only candidates whose bounds reach the
best so far (positives) or overlap a window (negatives) are rescored; the rest keep bounds, which
widen from edge to edge.  Children of the zero vector are scored against all candidates
by one matrix product.  Smaller subtrees go first, so few bounds are held at once.

Spark deals the candidates into blocks of ROWS and sends each block past each tree: a stated set
of anchors against all rows, in cells of bounded size.  A cell returns the few best of each anchor
(and window), and the best of all cells are taken by a ranking that Spark prunes before it
shuffles.  First the positives, then, with their scores, the negatives.

Pivots are PIVOTS anchors, those of least hash; they only decide which anchors share a tree.

Defined results: rows with a null label, a null vector, or a null or non-finite component take
no part, nor do rows with a component so large that a score could pass 64 bits (2^28 for 64
components); vectors meet only those of their length; rows that repeat an id are rows of
their own; a null id is no anchor and orders last among ties; an anchor without a positive, or a
positive without a negative in its window, gives no row; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendframe.llm.common import materialize

#: Anchors of a tree and candidates of a block, about; pivots that place the anchors.
ANCHORS = 2048
ROWS = 8192
PIVOTS = 256
#: Positives per anchor, negatives per positive, and the window in hundredths of the positive's score.
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90

#: Stands for a null id: after every other.
LAST = (1 << 63) - 1


def quantised(table: DataFrame, scale: int = 256, id_col: str = "vec_id", label_col: str = "label",
              vector_col: str = "embedding") -> DataFrame:
    """(node, id, label, dim, x): rows that take part, numbered; each component is the floor of
    ``scale`` times it, packed as 64-bit integers."""
    v = F.col(vector_col).cast("array<double>")
    df = table.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(LAST)).alias("id"),
                      F.col(label_col).cast("bigint").alias("label"), v.alias("v")).where(
        F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    dim = F.size("v")
    most = F.pow(F.lit(2.0), F.floor((62 - F.ceil(F.log2(dim))) / 2))
    df = df.where(F.forall("v", lambda c: F.abs(c) * scale < most)).select(
        F.monotonically_increasing_id().alias("node"), "id", "label", dim.alias("dim"),
        F.transform("v", lambda c: F.floor(c * scale)).alias("x"))

    def pack(batches):
        for batch in batches:
            x = batch.column(4)
            values = x.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(batch.column(3).to_numpy())
            rows = [values[e - d:e].tobytes() for d, e in zip(batch.column(3).to_pylist(), ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(rows, pa.binary())],
                                             names=["node", "id", "label", "dim", "x"])

    return materialize(df.mapInArrow(pack, "node bigint, id bigint, label bigint, dim int, x binary"), "negatives-rows")


def _integers(column) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.int64).reshape(len(rows), -1)


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(parent, edge length) of each row in a least spanning tree of the rows and the zero vector,
    which is parent -1."""
    v = x.astype(np.float64)
    edge = np.sqrt((v * v).sum(axis=1))
    parent = np.full(len(v), -1)
    waiting = edge.copy()
    for _ in range(len(v)):
        i = int(np.argmin(waiting))
        waiting[i] = np.inf
        away = np.sqrt(((v - v[i]) ** 2).sum(axis=1))
        nearer = (away < edge) & (waiting < np.inf)
        edge[nearer], parent[nearer] = away[nearer], i
        waiting[nearer] = away[nearer]
    return parent, edge


def _trees(anchors: DataFrame) -> DataFrame:
    """``anchors`` with (tree, place, parent, edge): the tree each belongs to, its number in it,
    its parent's number (-1: the zero vector) and how far that is."""
    pivots = [(r.dim, np.frombuffer(r.x, np.int64).astype(np.float64)) for r in anchors.orderBy(
        F.xxhash64("node"), "node").select("dim", "x").limit(PIVOTS).collect()]
    by_dim: dict[int, np.ndarray] = {d: np.array([p for e, p in pivots if e == d]) for d, _ in pivots}

    def nearest(batches):
        for batch in batches:
            found = []
            for d, x in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist()):
                p = by_dim.get(d)
                found.append(0 if p is None else int(np.argmin(((p - np.frombuffer(x, np.int64)) ** 2).sum(axis=1))))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.int32())],
                                             names=[*batch.schema.names, "pivot"])

    base = "node bigint, id bigint, label bigint, dim int, x binary"
    placed = anchors.select("node", "id", "label", "dim", "x").mapInArrow(nearest, base + ", pivot int")
    counts = placed.groupBy("dim", "pivot").agg(F.count("*").alias("c"))
    before = F.sum("c").over(Window.partitionBy("dim").orderBy("pivot")) - F.col("c")
    dealt = placed.join(counts.withColumn("before", before), ["dim", "pivot"]).withColumn(
        "tree", F.floor((F.col("before") + F.pmod(F.xxhash64("node"), F.col("c"))) / ANCHORS).cast("int"))

    def grow(table):
        parent, edge = spanning_tree(_integers(table.column("x")))
        return pa.table({**{c: table.column(c) for c in ("node", "id", "label", "dim", "x", "tree")},
                         "place": pa.array(np.arange(len(parent), dtype=np.int32)),
                         "parent": pa.array(parent.astype(np.int32)), "edge": pa.array(edge)})

    return materialize(dealt.drop("c", "before", "pivot").groupBy("dim", "tree").applyInArrow(
        grow, base + ", tree int, place int, parent int, edge double"), "negatives-trees")


class _Cell:
    """Scores and bounds of one tree's anchors against one block of candidates."""

    def __init__(self, anchors: pa.Table, rows: pa.Table):
        self.anchors = anchors.sort_by("place")
        rows = rows.sort_by([("id", "ascending"), ("node", "ascending")])     # so ties are in order
        self.a, self.x = _integers(self.anchors.column("x")), _integers(rows.column("x"))
        self.node, self.id = rows.column("node").to_numpy(), rows.column("id").to_numpy()
        self.label = rows.column("label").to_numpy()
        self.own, self.own_label = self.anchors.column("node").to_numpy(), self.anchors.column("label").to_numpy()
        most = float(np.abs(self.a).max(initial=0)) * float(np.abs(self.x).max(initial=0)) * self.x.shape[1]
        if most < 2**53:                     # products and sums are exact in doubles, which are faster
            self.a, self.x = self.a.astype(np.float64), self.x.astype(np.float64)
        floats = self.x.astype(np.float64, copy=False)
        self.length = np.sqrt((floats * floats).sum(axis=1)) * (1 + 1e-9) + 1e-9
        self.rescored = 0

    def run(self, reach, take) -> None:
        """Down the tree.  ``reach(i, low, high)`` gives the places of candidates that bounds do not
        rule out for anchor i (scores are rounded up and down by the bounds), ``take(i, places,
        scores)`` gets their scores."""
        parent, edge = (self.anchors.column(c).to_numpy() for c in ("parent", "edge"))
        children: dict[int, list[int]] = {}
        for i, p in enumerate(parent.tolist()):
            children.setdefault(p, []).append(i)
        size = np.ones(len(parent), int)
        order, todo = [], list(children.get(-1, []))
        while todo:
            order.append(i := todo.pop())
            todo += children.get(i, [])
        for i in reversed(order):
            if parent[i] >= 0:
                size[parent[i]] += size[i]
        every = np.arange(len(self.x))
        first = children.get(-1, [])
        for k in range(0, len(first), 128):
            chunk = first[k:k + 128]
            scores = self.a[chunk] @ self.x.T
            for i, s in zip(chunk, scores):
                take(i, every, s)
                s = s.astype(np.float64, copy=False)
                waiting = [(c, s, s) for c in sorted(children.get(i, []), key=lambda c: -size[c])]
                while waiting:
                    c, low, high = waiting.pop()
                    away = edge[c] * (1 + 1e-9) * self.length + 1e-6
                    low, high = low - away, high + away
                    places = reach(c, low, high)
                    own = self.x[places] @ self.a[c]
                    self.rescored += len(places)
                    take(c, places, own)
                    if c in children:
                        low[places] = high[places] = own
                        waiting += [(d, low, high) for d in sorted(children[c], key=lambda d: -size[d])]


def _best(places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k largest scores, ties in the order of places (which ascend)."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= least
        places, scores = places[keep], scores[keep]
    order = np.argsort(-scores, kind="stable")[:k]
    return places[order], scores[order]


def _positive_cell(anchors: pa.Table, rows: pa.Table, k: int) -> tuple[pa.Table, int]:
    cell = _Cell(anchors, rows)
    same = {label: np.flatnonzero(cell.label == label) for label in np.unique(cell.own_label)}
    found = []

    def others(i, places):
        return places[cell.node[places] != cell.own[i]]

    def reach(i, low, high):
        own = others(i, same[cell.own_label[i]])
        if len(own) > k:
            own = own[high[own] >= np.partition(low[own], len(own) - k)[len(own) - k]]
        return own

    def take(i, places, scores):
        if len(places) == len(cell.x):
            places = others(i, same[cell.own_label[i]])
            scores = scores[places]
        found.append((i, *_best(places, scores, k)))

    if len(cell.x) and len(cell.a):
        cell.run(reach, take)
    return _answers(cell, [(i, p, s, None) for i, p, s in found]), cell.rescored


def _negative_cell(anchors: pa.Table, rows: pa.Table, k: int, low: int, high: int) -> tuple[pa.Table, int]:
    cell = _Cell(anchors, rows)
    # each positive's score and its window: low * score <= 100 * s <= high * score
    windows = [sorted({(int(p), -(-low * int(p) // 100), high * int(p) // 100) for p in w or ()})
               for w in cell.anchors.column("scores").to_pylist()]
    windows = [[w for w in of if w[1] <= w[2]] for of in windows]
    least = [min((w[1] for w in of), default=1) for of in windows]
    most = [max((w[2] for w in of), default=0) for of in windows]
    other = {label: cell.label != label for label in np.unique(cell.own_label)}
    found = []

    def reach(i, lo, hi):
        return np.flatnonzero(other[cell.own_label[i]] & (hi >= least[i]) & (lo <= most[i])) if windows[i] else \
            np.zeros(0, np.int64)

    def take(i, places, scores):
        if not windows[i]:
            return
        inside = (scores >= least[i]) & (scores <= most[i])
        if len(places) == len(cell.x):
            inside &= other[cell.own_label[i]][places]
        places, scores = places[inside], scores[inside]
        for score, lo, hi in windows[i]:
            of = (scores >= lo) & (scores <= hi)
            found.append((i, *_best(places[of], scores[of], k), score))

    if len(cell.x) and len(cell.a):
        cell.run(reach, take)
    return _answers(cell, found), cell.rescored


_ANSWER = "anchor bigint, node bigint, id bigint, score bigint, positive bigint"


def _answers(cell: _Cell, found: list) -> pa.Table:
    n = [len(p) for _, p, _, _ in found]
    places = np.concatenate([p for _, p, _, _ in found]) if found else np.zeros(0, np.int64)
    scores = np.concatenate([s for _, _, s, _ in found]) if found else np.zeros(0)
    return pa.table({
        "anchor": pa.array(np.repeat(cell.own[[i for i, _, _, _ in found]], n) if found else places, pa.int64()),
        "node": pa.array(cell.node[places], pa.int64()), "id": pa.array(cell.id[places], pa.int64()),
        "score": pa.array(scores.astype(np.int64)),
        "positive": pa.array([w for (_, _, _, w), c in zip(found, n) for _ in range(c)], pa.int64())})


def _cells(trees: DataFrame, rows: DataFrame, run) -> DataFrame:
    """``run(anchors, candidates)`` over each tree and block of candidates of its length."""
    blocks = rows.groupBy("dim").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("blocks"))
    grown = trees.groupBy("dim").agg((F.max("tree") + 1).alias("trees"))
    sizes = blocks.join(grown, "dim")
    left = trees.join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = rows.join(sizes, "dim").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn(
        "tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
    drop = ("blocks", "trees")
    return left.drop(*drop).groupBy("dim", "tree", "block").cogroup(
        right.drop(*drop).groupBy("dim", "tree", "block")).applyInArrow(run, _ANSWER)


def _first(answers: DataFrame, keys: list[str], k: int) -> DataFrame:
    inside = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "node")
    return answers.withColumn("rank", F.row_number().over(inside)).where(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives
    of the rows of ``quantised`` with ``is_anchor`` (a condition on ``id``)."""
    trees = _trees(rows.where(is_anchor & (F.col("id") != LAST)))
    near = _cells(trees, rows, lambda a, x: _positive_cell(a, x, positives)[0])
    chosen = materialize(_first(near, ["anchor"], positives).select(
        "anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive")), "negatives-positives")
    scores = chosen.groupBy("anchor").agg(F.collect_set("positive").alias("scores"))
    asked = trees.join(scores.withColumnRenamed("anchor", "node"), "node", "left")
    far = _cells(asked, rows, lambda a, x: _negative_cell(a, x, negatives, low, high)[0])
    best = _first(far, ["anchor", "positive"], negatives)
    ids = trees.select(F.col("node").alias("anchor"), F.col("id").alias("anchor_id"))
    named = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return best.join(chosen, ["anchor", "positive"]).join(ids, "anchor").select(
        "anchor_id", named("positive_id").alias("positive_id"), "rank", named("id").alias("negative_id"),
        F.col("positive").alias("positive_score"), F.col("score").alias("negative_score"))
