import re
from collections import Counter

from spendframe.llm import quality_ledger as Q
from spendframe.llm.common import read_table

from .conftest import AWKWARD, SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(grams)
    places = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines),
            len(lines) - len(set(lines)), len(places))


def rows_of(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines,
                   r.n_repeat_words) for r in df.collect())


def test_measurements_against_brute_force(spark, awkward):
    got = rows_of(Q.ledger(awkward))
    assert got == sorted((i is None, i or 0, *brute(t)) for i, t in AWKWARD)
    docs = read_table(spark, SMALL, "documents", "doc_id", "text")
    assert rows_of(Q.ledger(docs)) == sorted((False, r.doc_id, *brute(r.text)) for r in docs.collect())


def test_second_sort_alone_gives_the_same(spark, awkward, monkeypatch):
    want = rows_of(Q.ledger(awkward))
    monkeypatch.setattr(Q, "PLACE_BITS", 3)
    assert rows_of(Q.ledger(awkward)) == want


def test_policies_and_ablations_need_only_the_ledger(spark):
    led = spark.createDataFrame([(1, 0), (2, 1), (3, 3), (4, 4), (5, 5), (6, 0)], "doc_id int, fail_bits bigint")
    assert {r.doc_id for r in Q.apply_policy(led, "base").where("kept").collect()} == {1, 4, 6}
    assert {r.doc_id for r in Q.apply_policy(led, "v1").where("kept").collect()} == {1, 6}
    got = {r.rule: (r.failed, r.failed_alone, r.kept_without) for r in Q.ablations(led, "v1").collect()}
    assert got["few_words"] == (3, 1, 3)
    assert got["repeated_windows"] == (1, 0, 2)
    assert got["symbol_ratio"] == (2, 1, 3)
    assert got["long_words"] == (0, 0, 2)


def test_empty_table(no_rows):
    assert Q.ledger(no_rows).count() == 0
    assert Q.ablations(Q.ledger(no_rows), "v1").count() == 0
