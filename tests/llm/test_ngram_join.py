import random
import re

import pytest

from spendframe.llm import ngram_join as N
from spendframe.llm.common import components, read_table

from .conftest import AWKWARD, SMALL


def shingles(text, k=5):
    folded = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", folded)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(rows, threshold=80):
    """(doc_id, set size, class) of every row, by comparing all pairs."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and i is not None and j is not None:
                both = len(s & t)
                if 100 * both >= threshold * (len(s) + len(t) - both):
                    x, y = find(i), find(j)
                    parent[max(x, y)] = min(x, y)
    return sorted((i is None, i or 0, len(s), None if i is None else find(i)) for i, s in sets)


def rows_of(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.n_shingles, r.component_id) for r in df.collect())


def test_documents_against_all_pairs(spark):
    docs = read_table(spark, SMALL, "documents")
    assert rows_of(N.classes(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", range(4))
def test_chains_and_groups_against_all_pairs(spark, seed):
    """Chains of small edits, so that classes hang together only link by link, over texts
    that also share passages without being similar."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(3))
    passage = [word() for _ in range(25)]
    rows = []
    for _ in range(6):
        w = [word() for _ in range(rng.randint(8, 60))] + passage * rng.randint(0, 1)
        for _ in range(rng.randint(1, 9)):
            rows.append((len(rows), " ".join(w)))
            for _ in range(rng.randint(0, 2)):
                w[rng.randrange(len(w))] = word()
            if rng.random() < 0.3:
                w = w[:-1] + [word(), word()]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert rows_of(N.classes(df)) == brute(rows)


def test_representatives_keep_one_of_each_class(spark, awkward):
    kept = N.representatives(awkward)
    assert kept.columns == awkward.columns
    classes = {c for _, _, _, c in brute(AWKWARD)}
    ids = [r.doc_id for r in kept.collect()]
    assert set(ids) == classes and ids.count(1) == 2


def test_awkward_rows(awkward, no_rows):
    assert rows_of(N.classes(awkward)) == brute(AWKWARD)
    assert N.classes(no_rows).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(200, 260)] + [(7, k) for k in range(20, 60)] + [
        (rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)] + [(1, 1), (None, 3)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"), "test").collect()
    assert {r.node: r.root for r in got} == {x: find(x) for x in parent} and len(got) == len(parent)
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "test").count() == 0


def test_long_texts_exactly_at_the_threshold(spark):
    """Two texts of 180,000 shingles that share 160,000 are exactly 80 of 100: one class; one shared
    shingle less is two.  Halves of the hashes alone would err here."""
    words = [f"w{i}" for i in range(200_010)]
    rows = [(1, " ".join(words[:180_004])), (2, " ".join(words[20_000:200_004])),
            (3, " ".join(f"v{i}" for i in range(180_004))), (4, " ".join(f"v{i}" for i in range(20_001, 200_005)))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.classes(docs).collect()}
    assert got == {1: (180_000, 1), 2: (180_000, 1), 3: (180_000, 3), 4: (180_000, 4)}


def test_clashing_column_names(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text, "a", 1, 2), (2, text, "b", 3, 4), (3, "x y", "c", 5, 6)],
                                 "doc_id bigint, text string, _id string, kept_id int, th int")
    assert sorted(N.representatives(docs).collect()) == [(1, text, "a", 1, 2), (3, "x y", "c", 5, 6)]
