import re

import pytest

from spendframe.llm import mixing as M
from spendframe.llm.common import read_table

from .conftest import AWKWARD, SMALL


def fill(sizes):
    """Shares by weight with caps, the excess reshared until none is above."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in capped]
        left = total - sum(3 * sizes[s] for s in capped)
        target = {s: 3 * sizes[s] if s in capped else left * weight[s] / sum(weight[x] for x in open_) for s in names}
        above = {s for s in open_ if target[s] > 3 * sizes[s]}
        if not above:
            return target
        capped |= above


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 1000, "c": 500}, {"a": 1, "b": 2, None: 500, "z": 3}, {"x": 7}, {"a": 0, "b": 10},
    {f"s{i:02d}": (i * 37) % 101 for i in range(20)}])
def test_targets_against_resharing(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    want = fill(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert got[s] == pytest.approx(want[s], abs=1e-6)


def test_mix_meets_targets_and_reruns_agree(spark):
    docs = read_table(spark, SMALL, "documents", "doc_id", "text", "source")
    rows = M.mix(docs).collect()
    assert len(rows) == docs.count()
    again = {(r.doc_id, r.copies) for r in M.mix(docs.repartition(5)).collect()}
    assert {(r.doc_id, r.copies) for r in rows} == again
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r.size for r in own)
        assert all(0 <= r.copies <= 3 and r.taken == r.size * r.copies for r in own)
        assert own[0].source_size == sum(r.size for r in own)


def test_many_equal_documents_leave_one_fraction(spark):
    df = spark.range(5000).selectExpr("id AS doc_id", "if(id % 10 = 0, 'a', 'b') AS source", "20L AS size")
    t = M.source_targets(df)
    got = M.pivotal_copies(df, t).groupBy("source").sum("copies").collect()
    want = {r.source: r.target / 20 for r in t.collect()}
    for r in got:
        assert abs(r[1] - want[r.source]) < 1


def test_expected_copies_are_the_fraction(spark):
    df = spark.range(60).selectExpr("id AS doc_id", "if(id < 20, 'a', 'b') AS source", "10 + id % 7 AS size").cache()
    t = M.source_targets(df).cache()
    n, total = 30, 0
    for seed in range(n):
        total += M.pivotal_copies(df, t, seed=100 + seed).where("doc_id = 3").first().copies
    r = t.where("source = 'a'").first()
    assert abs(total / n - r.target / r.source_size) < 0.35


def test_awkward_rows(awkward, no_rows):
    rows = M.mix(awkward).collect()
    assert len(rows) == len(AWKWARD)
    sizes = {r.doc_id: r.size for r in rows}
    for i, t in AWKWARD:
        assert sizes[i] == len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert M.mix(no_rows).count() == 0


def test_clashing_columns_come_back_unchanged(spark, no_rows):
    from spendframe.llm import fuzzy_lines, mixing
    rows = [(i, f"word {i} of a line\nanother {i} line", f"s{i % 2}", i, -i, f"k{i}", "c", 9) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, _size int, size int, key string, row string, gone int")
    held = {r[0]: tuple(r) for r in rows}
    assert all(tuple(r) == held[r.doc_id] for r in mixing.mixed(docs).collect())
    assert all((*r[:1], *r[2:]) == (*held[r.doc_id][:1], *held[r.doc_id][2:]) for r in fuzzy_lines.deduplicated(docs).collect())
    assert mixing.mixed(no_rows).collect() == [] and fuzzy_lines.deduplicated(no_rows).collect() == []
