import random
import re
import zlib
from collections import Counter

import pytest

from spendframe.llm import spelling as S
from spendframe.llm.common import read_table

from .conftest import SMALL


def words_of(rows, slips=97):
    out = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            out[run[:h % len(run)] + run[h % len(run) + 1:] if h % slips == 0 else run] += 1
    return {w: n for w, n in out.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words):
    """(word, form, root, n, n_near, form_n) of each word, by comparing all pairs."""
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def rows_of(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_documents_against_all_pairs(spark):
    docs = read_table(spark, SMALL, "documents").limit(40)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fixed = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(S.variants(fixed)) == brute(words_of(rows))


@pytest.mark.parametrize("common, crowd", [(1, 4), (5, 512), (10**6, 3)])
def test_all_edits_under_any_dictionary(spark, monkeypatch, common, crowd):
    """Words over few letters with every kind of edit: long lists, repeated grams, edits at the
    ends; the dictionary and the blocks may not change the result."""
    monkeypatch.setattr(S, "COMMON", common)
    monkeypatch.setattr(S, "CROWD", crowd)
    monkeypatch.setattr(S, "MOST_PRUNED", 40 if common == 1 else 1 << 18)
    rng = random.Random(common)
    words = {"aaaaa", "aaaaaa", "aaaaaaa", "ababab", "babab", "äääääb", "ääääb"}
    while len(words) < 250:
        w = "".join(rng.choice("abé") for _ in range(rng.randint(5, 9)))
        words.add(w)
        i = rng.randrange(len(w))
        words.update(x for x in (w[:i] + w[i + 1:], w[:i] + "c" + w[i + 1:], w[:i] + "a" + w[i:], w + "b") if len(x) > 4)
    counts = {w: rng.choice([3, 4, 6, 13, 50]) for w in words}
    table = spark.createDataFrame(sorted(counts.items()), "word string, n bigint")
    got = {(r.a, r.b) for r in S.near_pairs(table).collect()}
    assert got == {(a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) < 2 and one_edit(a, b)}
    forms = S.with_forms(table, S.near_pairs(table))
    found = {r.word: (r.form, r.n_near, r.form_n) for r in forms.collect()}
    want = {w: (f, near, m) for w, f, _, _, near, m in brute(counts)}
    assert found == want
    roots = {r.word: r.root for r in S.roots(forms).collect()}
    assert roots == {w: r for w, f, r, *_ in brute(counts) if f is not None}


def test_long_chain_of_forms(spark):
    """Each word one edit and twice the count from the next."""
    chain = ["a" * k + "zzzzz" for k in range(12)]
    table = spark.createDataFrame([(w, 3 * 2**k) for k, w in enumerate(chain)], "word string, n bigint")
    forms = S.with_forms(table, S.near_pairs(table))
    assert {r.root for r in S.roots(forms).collect()} == {chain[-1]}


def test_slips_and_counts(spark):
    rows = [(i, "Wonder wonder WONDER Étude1Étude_Étude ab") for i in range(400)]
    got = S.variants(spark.createDataFrame(rows, "doc_id bigint, text string"))
    want = words_of(rows)
    assert rows_of(got) == brute(want) and any(len(w) == 5 and w != "Étude" for w in want)


def test_awkward_rows(spark, awkward, no_rows):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert rows_of(S.variants(awkward)) == brute(words_of(rows))
    assert S.variants(no_rows).collect() == []
    clash = spark.createDataFrame([(1, "alpha alpha alpha alphb alphb alphb", "w", 3, "k")],
                                  "doc_id bigint, text string, word string, n int, key string")
    assert rows_of(S.variants(clash)) == [("alpha", None, "alpha", 3, 1, None), ("alphb", None, "alphb", 3, 1, None)]
