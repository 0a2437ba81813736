import hashlib
import random
import re

from spendframe.llm import pii_bootstrap as P
from spendframe.llm.common import read_table

from .conftest import AWKWARD, SMALL


def brute(text):
    """The base forms as plain patterns, found from the left."""
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c in "0123456789"]
        luhn = sum(x if i % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for i, x in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and luhn % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def test_base_forms_against_plain_patterns():
    rng = random.Random(1)
    pieces = ["a@b.c", "x.y@d-e.fr", "@", ".", "..", "1.2.3.4", "256.1.1.1", "255.255.0.1", "4111111111111111",
              "4111 1111-1111 1111", "+1 (650) 555-0100", "+", "-", " ", "7", "00", "é", "_", "A%", "3782822463100057"]
    for _ in range(6000):
        t = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 9)))
        assert P.base_spans(t) == brute(t), t


def test_long_runs_take_linear_time():
    for t in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "+" * 300_000, "a@" * 150_000, "1 " * 150_000):
        P.base_spans(t)


def test_documents(spark):
    docs = read_table(spark, SMALL, "documents", "doc_id", "text")
    want = {r.doc_id: brute(r.text) for r in docs.collect()}
    for r in P.find(docs).collect():
        base = [(s.start, s.kind, s.end) for s in r.base]
        assert base == want[r.doc_id]
        assert set(base) <= {(s.start, s.kind, s.end) for s in r.spans}


def test_contexts_find_unseen_identifiers(spark):
    """Phone numbers without a plus stand after the words of those with one; order numbers
    stand elsewhere."""
    rng = random.Random(3)
    n = lambda k: "".join(rng.choice("123456789") for _ in range(k))
    rows = [(i, f"please call me on +1 650 55{n(5)} today") for i in range(30)]
    rows += [(100 + i, f"please call me on 0650{n(7)} today") for i in range(3)]
    rows += [(200 + i, f"the order number {n(9)} was sent") for i in range(30)]
    got = {r.doc_id: [s.kind for s in r.spans] for r in
           P.find(spark.createDataFrame(rows, "doc_id bigint, text string"), least_confidence=0.85).collect()}
    assert all(got[i] == [3] for i in range(30))
    assert all(got[i] == [4] for i in range(100, 103))
    assert all(got[i] == [] for i in range(200, 230))


def test_awkward_rows(awkward, no_rows):
    got = sorted((r.doc_id is None, r.doc_id or 0, len(r.spans)) for r in P.find(awkward).collect())
    assert got == sorted((i is None, i or 0, len(brute(t))) for i, t in AWKWARD)
    assert P.find(no_rows).count() == 0


def test_span_text(spark):
    df = P.find(spark.createDataFrame([(1, "ü a@b.c 1.2.3.4")], "doc_id bigint, text string"))
    r = df.select(P.as_text("base").alias("t"), P.count_of("base", "ip").alias("n")).first()
    assert r.t == "email:2:7,ip:8:15" and r.n == 1
    assert hashlib.sha256(r.t.encode()).hexdigest()
