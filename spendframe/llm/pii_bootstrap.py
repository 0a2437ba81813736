"""Personal data by fixed forms and by bootstrapped contexts.

Base entities (email, ip, card, phone) are found by their forms in every whole text.  They are
also the seeds of a bootstrap: the words around a seed, and the key it is assigned to, are its
lexical patterns.  Tokens with many digits that are no base entity are candidates, and have
patterns of their own.  Patterns and instances make a bipartite graph, which Spark scores in
rounds: a pattern's confidence is the mean score of its distinct instances, an instance's
score is one (seed) or the noisy-or of its patterns' confidences.  Candidates in a pattern
with enough seeds and a high confidence are reported as kind ``ctx``; base spans stay.

One pass reads the texts and leaves only spans and hashes; the graph rounds work on those.
Scoring aggregates by pattern and by instance, so a word that stands before a third of all
numbers is combined before the shuffle.  Accepted patterns are joined, not broadcast.

Defined results: null and empty texts have no spans; repeated rows have equal spans; rows of
one id with different texts are told apart by a hash of the text; null ids are kept; an empty
table gives an empty result; other columns are ignored.  All forms are matched in time linear
in the text, so one very long run of digits or letters costs no more than other text.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.llm import kernels
from spendframe.llm.common import materialize, release

#: Kinds in order; ``ctx`` is the kind of spans that the bootstrap adds.
KINDS = ("email", "ip", "card", "phone", "ctx")
ROUNDS = 3
#: A candidate has so many digits; a pattern is accepted with so many distinct seeds and such a confidence.
CANDIDATE_DIGITS = 6
LEAST_SEEDS = 5
LEAST_CONFIDENCE = 0.9

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# a later start inside a run of digits cannot match where the run's first digit did not
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
KEY = re.compile(r"([A-Za-z_]{2,30})\s?[:=]\s?[\"']?$")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost, non-overlapping: each @ with the run of local characters before it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            out.append((start, found.end()))
            last = found.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) in code points, by start and kind."""
    out = [(s, 0, e) for s, e in emails(text)] if "@" in text else []
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and _luhn(digits):
                out.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def _hash(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def patterns_of(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns of a span: words before, words on both sides, the key it is given to."""
    before = text[max(0, start - 80):start]
    left, right = before.lower().split()[-2:], text[end:end + 40].lower().split()[:1]
    out = []
    if left:
        out.append(f"before {left[-1]}")
    if len(left) == 2:
        out.append(f"before2 {left[0]} {left[1]}")
    if left and right:
        out.append(f"around {left[-1]} {right[0]}")
    key = KEY.search(before)
    if key:
        out.append(f"key {key.group(1).lower()}")
    return out


def _candidates(buffer: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(document, start, end) in bytes of words with CANDIDATE_DIGITS digits or more."""
    start, end, doc = kernels.word_spans(buffer, offsets)
    digits = np.zeros(len(buffer) + 1, np.int32)
    np.cumsum((buffer >= 48) & (buffer <= 57), out=digits[1:])
    hit = np.flatnonzero(digits[end] - digits[start] >= CANDIDATE_DIGITS)
    return [(int(doc[i]), int(start[i]), int(end[i])) for i in hit]


_SPAN = "struct<start:bigint,kind:int,end:bigint>"
_LINKED = f"struct<span:{_SPAN},instance:bigint,seed:boolean,patterns:array<bigint>>"


def _scan(rows: DataFrame) -> DataFrame:
    """(doc_id, th, base spans, linked): base spans of every row, and every seed or candidate
    with the hashes of its text and its patterns."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    span_type = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    linked_type = pa.struct([("span", span_type), ("instance", pa.int64()), ("seed", pa.bool_()),
                             ("patterns", pa.list_(pa.int64()))])

    def run(batches):
        for batch in batches:
            for part, buffer, offsets in kernels.slices(batch, "text"):
                texts = [t or "" for t in part.column(1).to_pylist()]
                found = [base_spans(t) for t in texts]
                linked: list[list] = [[] for _ in texts]
                for t, spans, out in zip(texts, found, linked):
                    for s, k, e in spans:
                        out.append(((s, k, e), _hash(t[s:e]), True, [_hash(p) for p in patterns_of(t, s, e)]))
                for d, a, b in _candidates(buffer, offsets):
                    first = offsets[d]
                    s = len(buffer[first:a].tobytes().decode())
                    token = buffer[a:b].tobytes().decode()
                    cut = re.match(r"[A-Za-z_]{2,30}[:=][\"']?", token)
                    lead = cut.end() if cut else len(token) - len(token.lstrip("\"'([{<"))
                    s, e = s + lead, s + len(token.rstrip("\"'.,;:!?)]}>"))
                    if e > s and not any(s < y and x < e for x, _, y in found[d]):
                        t = texts[d]
                        linked[d].append(((s, 4, e), _hash(t[s:e]), False, [_hash(p) for p in patterns_of(t, s, e)]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2),
                     pa.array([[dict(zip(("start", "kind", "end"), x)) for x in f] for f in found], pa.list_(span_type)),
                     pa.array([[{"span": dict(zip(("start", "kind", "end"), x)), "instance": i, "seed": y, "patterns": p}
                                for x, i, y, p in out] for out in linked], pa.list_(linked_type))],
                    names=["doc_id", "th", "base", "linked"])

    return rows.select("doc_id", "text", "th").mapInArrow(
        run, f"doc_id {kind}, th bigint, base array<{_SPAN}>, linked array<{_LINKED}>")


def confident_patterns(edges: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS,
                       least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """(pattern, confidence) of accepted patterns from ``edges(pattern, instance, seed)``."""
    edges = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    seeds = edges.groupBy("instance").agg(F.max("seed").alias("is_seed"))
    edges = materialize(edges.select("pattern", "instance").join(seeds, "instance"), "pii-edges")
    scores = edges.select("instance", F.col("is_seed").cast("double").alias("score")).distinct()
    for k in range(rounds):
        scored = materialize(edges.join(scores, "instance").groupBy("pattern").agg(
            F.avg("score").alias("confidence"), F.sum(F.col("is_seed").cast("int")).alias("seeds")), "pii-patterns")
        if k + 1 < rounds:
            doubt = F.sum(F.log1p(-F.least("confidence", F.lit(1 - 1e-9))))
            use = F.col("seeds") >= least_seeds
            scores = edges.join(scored.where(use), "pattern", "left").groupBy("instance", "is_seed").agg(
                F.coalesce(doubt, F.lit(0.0)).alias("doubt")).select(
                "instance", F.when(F.col("is_seed"), F.lit(1.0)).otherwise(1 - F.exp("doubt")).alias("score"))
    release(edges)
    return scored.where((F.col("seeds") >= least_seeds) & (F.col("confidence") >= least_confidence)).select(
        "pattern", "confidence")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS,
         least_seeds: int = LEAST_SEEDS, least_confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (start, kind, end), end exclusive."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("th"))
    scanned = materialize(_scan(rows), "pii-scan")
    linked = scanned.select("doc_id", "th", F.explode("linked").alias("x"))
    accepted = confident_patterns(linked.select(
        F.explode("x.patterns").alias("pattern"), F.col("x.instance").alias("instance"), F.col("x.seed").alias("seed")),
        rounds, least_seeds, least_confidence)
    found = (linked.where("NOT x.seed").select("doc_id", "th", F.col("x.span").alias("span"),
                                               F.explode("x.patterns").alias("pattern"))
             .join(accepted, "pattern").groupBy("doc_id", "th").agg(F.collect_set("span").alias("added"))
             .select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), "added"))
    return scanned.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select(
        "doc_id", "base", F.sort_array(F.concat("base", F.coalesce("added", F.expr(
            f"CAST(array() AS array<{_SPAN}>)")))).alias("spans"))


def as_text(spans: str):
    """``kind:start:end`` joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_of(spans: str, kind: str):
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
