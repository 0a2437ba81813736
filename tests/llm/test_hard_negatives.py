import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendframe.llm import hard_negatives as H


def brute(rows, anchors, k=5, m=10, low=30, high=90, scale=256):
    """Every answer of anchors (a set of places) by scoring all pairs of usable rows (id, label, vector)."""
    use = [(i, r) for i, r in enumerate(rows) if r[1] is not None and r[2] is not None
           and all(c is not None and np.isfinite(c) for c in r[2])]
    v = {i: [int(np.floor(scale * np.float64(c))) for c in r[2]] for i, r in use}
    out = []
    for a, (aid, label, _) in use:
        if a not in anchors:
            continue
        s = sorted((-sum(x * y for x, y in zip(v[a], v[i])), r[0], i, r[1]) for i, r in use if i != a)
        for p in [x for x in s if x[3] == label][:k]:
            score = -p[0]
            negatives = [x for x in s if x[3] != label and low * score <= -100 * x[0] <= high * score][:m]
            out += [(aid, p[1], r, x[1], score, -x[0]) for r, x in enumerate(negatives, 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score)
                  for r in df.collect())


DDL = "vec_id bigint, label int, embedding array<double>"


def crowds(seed, n=900, dim=8):
    """Vectors in crowds of near and equal copies, so trees have edges that bound, and ties."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = centres[rng.integers(0, 12, n)] + 0.03 * rng.normal(size=(n, dim)) * (rng.random((n, 1)) < 0.8)
    return [(int(i), int(l), x.tolist()) for i, l, x in zip(rng.permutation(n), rng.integers(0, 4, n), v)]


@pytest.mark.parametrize("anchors, block", [(2048, 8192), (16, 100)])
def test_against_all_pairs(spark, monkeypatch, anchors, block):
    monkeypatch.setattr(H, "ANCHORS", anchors)
    monkeypatch.setattr(H, "ROWS", block)
    monkeypatch.setattr(H, "PIVOTS", 7)
    rows = crowds(anchors)
    table = spark.createDataFrame(rows, DDL).repartition(5)
    got = rows_of(H.mine(H.quantised(table), F.col("id") % 10 == 0))
    assert got == brute(rows, {i for i, r in enumerate(rows) if r[0] % 10 == 0}) and len(got) > 500


def test_bounds_rule_out_candidates():
    """Cells give all answers while most candidates of anchors in crowds are not scored again."""
    rows = crowds(4, 1500)
    x = np.floor(256 * np.array([r[2] for r in rows])).astype(np.int64)
    table = pa.table({"node": pa.array(range(len(x))), "id": pa.array([r[0] for r in rows]),
                      "label": pa.array([r[1] for r in rows]), "x": pa.array([v.tobytes() for v in x], pa.binary())})
    asked = np.array([i for i, r in enumerate(rows) if r[0] % 5 == 0])
    parent, edge = H.spanning_tree(x[asked])
    own = table.take(pa.array(asked)).append_column("place", pa.array(np.arange(len(asked), dtype=np.int32))).append_column(
        "parent", pa.array(parent.astype(np.int32))).append_column("edge", pa.array(edge))
    below = int((parent >= 0).sum())
    assert below > len(asked) / 2
    answers, rescored = H._positive_cell(own, table, 5)
    assert answers.num_rows == 5 * len(asked) and rescored < 0.2 * below * len(x)
    near = {}
    for r in answers.to_pylist():
        near.setdefault(r["anchor"], set()).add(r["score"])
    _, rescored = H._negative_cell(own.append_column("scores", pa.array(
        [sorted(near[a]) for a in own.column("node").to_pylist()])), table, 10, 30, 90)
    assert rescored < 0.8 * below * len(x)


def test_spanning_tree_is_least():
    rng = np.random.default_rng(1)
    x = rng.integers(-9, 9, (40, 3))
    parent, edge = H.spanning_tree(x)
    full = np.vstack([x, np.zeros(3, int)]).astype(float)
    d = np.sqrt(((full[:, None] - full[None]) ** 2).sum(axis=2))
    inside, total = {40}, 0.0
    while len(inside) < 41:
        w, j = min((d[i, j], j) for i in inside for j in range(41) if j not in inside)
        inside.add(j)
        total += w
    assert abs(edge.sum() - total) < 1e-9
    assert all(abs(edge[i] - d[i, p if p >= 0 else 40]) < 1e-12 for i, p in enumerate(parent))


def test_large_components_are_exact(spark):
    rows = [(i, i % 2, [float((i * 7919) % 9973) * 100, float(i), 1e6 - i]) for i in range(60)]
    table = spark.createDataFrame(rows, DDL)
    got = rows_of(H.mine(H.quantised(table), F.col("id") % 10 == 0))
    assert got == brute(rows, {i for i in range(60) if i % 10 == 0}) and got


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, 1, [1.0, 0.5]), (1, None, [1.0, 0.5]), (2, 1, None), (3, 1, [None, 1.0]), (4, 2, [nan, 1.0]),
            (5, 2, [0.5, 0.5]), (5, 2, [0.5, 0.5]), (6, 1, [0.9, 0.4]), (0, 1, [1.0, 0.5]), (7, 2, [inf, 0.0]),
            (8, 2, [0.0, 0.0]), (9, 3, [0.5, 0.2])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], DDL + ", node string, tree int")
    got = rows_of(H.mine(H.quantised(table), F.col("id") == 0))
    assert got == brute(rows, {0, 8}) and got
    more = rows + [(10, 1, [1.0, 0.5, 0.1]), (11, 1, []), (12, 1, [1e300, 0.0]), (None, 2, [0.5, 0.25])]
    got = H.mine(H.quantised(spark.createDataFrame(more, DDL)), F.col("id") == 0).collect()
    assert {r.negative_id for r in got} == {5, 9, None}
    none = spark.createDataFrame([], DDL)
    assert H.mine(H.quantised(none), F.col("id") == 0).collect() == []
    assert H.mine(H.quantised(table.where("vec_id = 5")), F.col("id") == 0).collect() == []
