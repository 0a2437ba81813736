import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from spendframe.llm import suffix_dedup as S
from spendframe.llm.common import read_table

from .conftest import AWKWARD, SMALL


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha of the rest) of each text."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(t[i:i + length] for t in raw for i in range(len(t) - length + 1))
    out = []
    for t in raw:
        gone = np.zeros(len(t) + 2, bool)
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                gone[i + 1:i + 1 + length] = True
        keep = bytes(b for b, g in zip(t, gone[1:-1]) if not g)
        out.append((len(t), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum()), hashlib.sha256(keep).hexdigest()))
    return out


def made_texts(seed):
    rng = random.Random(seed)
    alphabet = rng.choice(["ab", "abcé", "abcdefghijklmnopqrstuvwxyz ü"])
    base = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 300))) for _ in range(4)]
    texts = []
    for _ in range(30):
        t = ""
        for _ in range(rng.randint(1, 4)):
            b = rng.choice(base)
            i = rng.randint(0, len(b))
            t += b[i:rng.randint(i, len(b))] * rng.choice([1, 1, 1, 3])
            if rng.random() < 0.3:
                t += rng.choice(alphabet) * rng.choice([1, 2, 60])
        texts.append(t)
    return texts + texts[:3] + [None, ""]


def rows_of(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("seed,most", [(1, 50_000), (2, 50_000), (3, 50_000), (4, 2), (5, 1)])
def test_against_brute_force(spark, seed, most):
    """``most`` of 1 or 2 sends most cores through the counted windows of hot cores."""
    texts = made_texts(seed)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    got = rows_of(S.dedup(df, length=20, gram=5, chunk=6, most=most))
    assert got == sorted((i, *b) for i, b in enumerate(brute(texts, 20)))


def test_documents_with_production_parameters(spark):
    rows = read_table(spark, SMALL, "documents", "doc_id", "text").collect()
    want = brute([r.text for r in rows], S.LENGTH)
    got = rows_of(S.dedup(read_table(spark, SMALL, "documents")))
    assert got == sorted((r.doc_id, *w) for r, w in zip(rows, want))
    assert sum(g[2] for g in got)


def test_awkward_rows(spark, awkward, no_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
                 for r in S.dedup(awkward).collect())
    want = brute([t for _, t in AWKWARD], S.LENGTH)
    assert got == sorted((i is None, i or 0, *w) for (i, _), w in zip(AWKWARD, want))
    assert S.dedup(no_rows).count() == 0
