"""Removal of long repeated substrings by merging suffix orders of all shards.

A byte goes if it lies in a string of LENGTH bytes that also starts anywhere else, in the same
text or another.  Sorting every suffix of the corpus would cost many times the input in
shuffle, and merging whole Burrows-Wheeler transforms byte by byte would cost LENGTH passes
over it, so the merge is confined to the suffixes that can matter:

1. Every window of LENGTH bytes picks one anchor, the GRAM bytes of smallest hash inside it
   (winnowing).  Equal windows pick equal anchors at equal places, so windows whose anchor occurs
   once in the corpus are settled by one aggregation over anchors.
2. For repeated anchors, the windows around one are taken in chunks of CHUNK starts.  All
   windows of a chunk share a core of LENGTH - CHUNK + 1 bytes; two can be equal only if their
   cores are, so the hash of the core is the key on which Spark deals out the work.
3. The rows of one core, from all shards, are suffixes in one interval of the merged suffix
   array.  Their order by the bytes after the core is the first interleave; the byte before each
   is its BWT symbol.  One step of *interleave refinement* moves every suffix one byte to the
   left: a stable sort by BWT symbol inside each interval, which splits intervals and never
   compares suffixes again.  Longest common prefixes of neighbours are carried along (only
   neighbours that a split has brought together are compared anew).  After d steps an interval
   holds suffixes with d equal bytes before the core; neighbours whose common prefix fills the
   window up to LENGTH bytes are a repeated interval.

A core with more than MOST_ROWS different rows is not held in one task: its windows are
hashed one by one and counted by an aggregation (exact as well).  Repetition with a short
period inside a text is settled in place, so it does not multiply anchors.  Texts that are
equal as a whole are one text with a count.

Nothing but aggregations, joins and one window by core key moves data; all are on hashes of
content or of texts, which no source or group of copies can make hot: copies collapse.

Defined results: null counts as an empty text; texts shorter than LENGTH lose nothing; repeated
rows are copies of each other, so all their bytes go (if LENGTH or more); null ids are kept;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendframe.llm import kernels
from spendframe.llm.common import materialize

LENGTH = 400
GRAM = 50
CHUNK = 88
#: Rows of one core that a task merges; and rows that it gathers (of several cores) at least.
MOST_ROWS = 50_000
GATHER = 20_000
#: A byte that no UTF-8 text holds, for places before and after a text.
PAD = 0xFF

_U = np.uint64


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w neighbours, from running minima of blocks of w."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    blocks = np.full(-(-len(x) // w) * w, np.iinfo(x.dtype).max, x.dtype)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1: w - 1 + n])


def anchors(buffer: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Anchors of a batch: (hash, document, place, first window, last window), places and
    windows from the start of the document, and (document, start, stop) of byte ranges that
    repeat with a short period, whose windows are left out except for the last period."""
    none = tuple(np.zeros(0, t) for t in (_U, *[np.int64] * 4)), tuple(np.zeros(0, np.int64) for _ in range(3))
    if len(buffer) < length:
        return none
    of = kernels.RangeHash(buffer, 11)
    at = np.arange(len(buffer) - gram + 1)
    h = of(at, at + gram)
    bits = _U(int(len(buffer)).bit_length())
    low = (_U(1) << bits) - _U(1)
    least = _sliding_min((h & ~low) | at.astype(_U), length - gram + 1)
    size = np.diff(offsets)
    count = np.maximum(size - length + 1, 0)
    doc = np.repeat(np.arange(len(size)), count)
    if not len(doc):
        return none
    start = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count) + offsets[doc]
    place = (least[start] & low).astype(np.int64)
    change = np.flatnonzero((place[1:] != place[:-1]) | (doc[1:] != doc[:-1])) + 1
    first = np.concatenate([[0], change])
    last = np.concatenate([change, [len(doc)]]) - 1
    where, owner, lo, hi = place[first], doc[first], start[first], start[last]
    value = h[where]
    # the same anchor again before the next one of another kind: compare windows one period on
    again = np.flatnonzero((value[1:] == value[:-1]) & (owner[1:] == owner[:-1]))
    period = where[again + 1] - where[again]
    runs = hi[again] - lo[again] + 1
    i = np.repeat(lo[again], runs) + np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    p = np.repeat(period, runs)
    fits = i + p + length <= offsets[np.repeat(owner[again], runs) + 1]
    same = np.zeros(len(i), bool)
    same[fits] = of(i[fits], i[fits] + length) == of(i[fits] + p[fits], i[fits] + p[fits] + length)
    left = np.where(same, np.iinfo(np.int64).max, i)
    right = np.where(same, -1, i)
    if len(again):
        begin = np.cumsum(runs) - runs
        lo[again], hi[again] = np.minimum.reduceat(left, begin), np.maximum.reduceat(right, begin)
    keep = hi >= lo
    base = offsets[owner]
    spans = (np.repeat(owner[again], runs)[same], i[same], i[same] + p[same] + length)
    spans = _joined(*spans)
    return ((value[keep], owner[keep], (where - base)[keep], (lo - base)[keep], (hi - base)[keep]),
            (spans[0], spans[1] - offsets[spans[0]], spans[2] - offsets[spans[0]]))


def _joined(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping and touching ranges of a document as one range."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    # running maximum of stops that restarts with each document
    shift = doc * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + shift) - shift
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1])
    at = np.flatnonzero(fresh)
    return doc[at], start[at], reach[np.append(at[1:], len(doc)) - 1]


def contexts(text: np.ndarray, place: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int = LENGTH, chunk: int = CHUNK):
    """Chunks of windows around anchors of one text: (key1, key2, start of the chunk's first
    window, first and last valid window in it, bytes before the core, bytes after it)."""
    d_low, d_high = place - hi, place - lo            # distance of the anchor from window starts
    c_low, c_high = d_low // chunk, d_high // chunk
    n = c_high - c_low + 1
    of = np.repeat(np.arange(len(place)), n)
    c = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + c_low[of]
    begin = place[of] - c * chunk - chunk + 1
    j_low = np.maximum(lo[of] - begin, 0)
    j_high = np.minimum(hi[of] - begin, chunk - 1)
    core, after = begin + chunk - 1, begin + length
    k1 = kernels.RangeHash(text, 12)(core, after) ^ c.astype(_U)
    k2 = kernels.RangeHash(text, 13)(core, after)
    around = np.full(len(text) + 2 * chunk, PAD, np.uint8)
    around[chunk:chunk + len(text)] = text
    step = np.arange(chunk - 1)
    before = around[(begin + chunk)[:, None] + step]
    behind = around[(after + chunk)[:, None] + step]
    return k1, k2, begin, j_low, j_high, before, behind


def refine(group: np.ndarray, before: np.ndarray, behind: np.ndarray, j_low: np.ndarray, j_high: np.ndarray) -> np.ndarray:
    """covered[row, j]: the window that starts j bytes into the row's chunk has an equal in its
    group.  ``group`` ascends; rows of a group share the core."""
    n, side = behind.shape
    covered = np.zeros((n, side + 1), bool)
    wide = np.zeros((n, -(-side // 8) * 8), np.uint8)
    wide[:, :side] = behind
    keys = wide.view(">u8").astype(_U)
    order = np.lexsort([*keys.T[::-1], group])

    def common(x, y):
        unequal = behind[x] != behind[y]
        first = unequal.argmax(axis=1)
        return np.where(unequal[np.arange(len(x)), first], first, side)

    interval = group[order]
    prefix = np.zeros(n, np.int64)                    # with the row before, in bytes after the core
    if n > 1:
        prefix[1:] = common(order[:-1], order[1:])
    for d in range(side + 1):
        j = side - d
        same = np.zeros(len(order) + 1, bool)
        same[1:-1] = interval[1:] == interval[:-1]
        alive = (same[:-1] | same[1:]) & (j_low[order] <= j)
        if not alive.all():
            at = np.flatnonzero(alive)
            if not len(at):
                break
            # a row that leaves keeps its share of the common prefix between those that stay
            prefix = np.minimum.reduceat(prefix[:at[-1] + 1], np.concatenate([[0], at[:-1] + 1]))
            order, interval = order[at], interval[at]
            same = np.zeros(len(order) + 1, bool)
            same[1:-1] = interval[1:] == interval[:-1]
        near = np.zeros(len(order) + 1, bool)
        near[:-1] = same[:-1] & (prefix >= j)
        covered[order, j] = (near[:-1] | near[1:]) & (j_high[order] >= j)
        if d == side:
            break
        symbol = before[order, side - 1 - d]          # the BWT column
        if not ((symbol[1:] != symbol[:-1]) & same[1:-1]).any():
            continue
        moved = np.lexsort((symbol, interval))        # stable: the interleave inside an interval stays
        order, symbol = order[moved], symbol[moved]
        split = np.ones(len(order), bool)
        split[1:] = (interval[moved][1:] != interval[moved][:-1]) | (symbol[1:] != symbol[:-1])
        prefix = prefix[moved]
        met = np.flatnonzero(~split[1:] & (moved[1:] != moved[:-1] + 1)) + 1
        prefix[met] = common(order[met - 1], order[met])
        interval = np.cumsum(split)
    return covered


def _ranges(covered: np.ndarray, begin: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, stop) of the byte ranges that runs of covered windows span."""
    edge = np.zeros((len(covered), covered.shape[1] + 2), np.int8)
    edge[:, 1:-1] = covered
    step = np.diff(edge, axis=1)
    row, first = np.nonzero(step == 1)
    _, last = np.nonzero(step == -1)
    return row, begin[row] + first, begin[row] + last - 1 + length


_ANCHOR = "a bigint, t1 bigint, t2 bigint, place int, lo int, hi int, stop int"
_CONTEXT = "k1 bigint, k2 bigint, t1 bigint, t2 bigint, begin int, lo int, hi int, before binary, behind binary"
_RANGE = "t1 bigint, t2 bigint, start int, stop int, w1 bigint, w2 bigint"


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("t1"),
                       F.xxhash64(text, F.lit(1)).alias("t2"))


def _find_anchors(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows (a, t1, t2, place, lo, hi, null) of anchors, and (any, t1, t2, start, null, null,
    stop) of ranges already settled inside a text."""
    def run(batches):
        for batch in batches:
            for part, buffer, offsets in kernels.slices(batch, "text"):
                (value, doc, place, lo, hi), (owner, start, stop) = anchors(buffer, offsets, length, gram)
                t1, t2 = part.column(1), part.column(2)
                n, m = len(doc), len(owner)
                both = pa.array(np.concatenate([doc, owner]))
                i32 = lambda *x: pa.concat_arrays([pa.array(y, pa.int32()) if y is not None else pa.nulls(k, pa.int32())
                                                   for y, k in zip(x, (n, m))])
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([pa.array(value.view(np.int64)), t1.take(pa.array(owner)).cast(pa.int64())]),
                     t1.take(both), t2.take(both), i32(place, start), i32(lo, None), i32(hi, None), i32(None, stop)],
                    names=["a", "t1", "t2", "place", "lo", "hi", "stop"])

    return texts.where(F.octet_length("text") >= length).select("text", "t1", "t2").mapInArrow(run, _ANCHOR)


def _find_contexts(texts: DataFrame, length: int, chunk: int) -> DataFrame:
    def run(batches):
        names = [f.split()[0] for f in _CONTEXT.split(", ")]
        for batch in batches:
            for i in range(batch.num_rows):
                text = np.frombuffer(batch.column(0)[i].as_buffer(), np.uint8)
                spots = np.array([(s["place"], s["lo"], s["hi"]) for s in batch.column(3)[i].as_py()], np.int64)
                k1, k2, begin, lo, hi, before, behind = contexts(text, *spots.T, length, chunk)
                n = len(k1)
                size = pa.array(np.arange(0, (n + 1) * (chunk - 1), chunk - 1, dtype=np.int32)).buffers()[1]
                blob = lambda x: pa.Array.from_buffers(pa.binary(), n, [None, size, pa.py_buffer(x.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k1.view(np.int64)), pa.array(k2.view(np.int64)),
                     batch.column(1).take(pa.array(np.full(n, i))), batch.column(2).take(pa.array(np.full(n, i))),
                     *[pa.array(x, pa.int32()) for x in (begin, lo, hi)], blob(before), blob(behind)], names=names)

    return texts.select("text", "t1", "t2", "spots").mapInArrow(run, _CONTEXT)


def _merge(rows: DataFrame, length: int, chunk: int, most: int) -> DataFrame:
    """Byte ranges (t1, t2, start, stop) of covered windows, from context rows that come
    sorted by core with ``n``, the rows of the core; of cores above ``most``, one row per
    window with its hash (w1, w2)."""
    side = chunk - 1

    def matrix(column):
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        data = np.frombuffer(column.buffers()[2], np.uint8)
        first = np.frombuffer(column.buffers()[1], np.int32)[column.offset]
        return data[first:first + len(column) * side].reshape(len(column), side)

    def settle(table):
        col = lambda c: table.column(c).to_numpy()
        k1, k2, lo, hi, begin = (col(c) for c in ("k1", "k2", "lo", "hi", "begin"))
        before, behind = matrix(table.column("before")), matrix(table.column("behind"))
        large = col("n") > most
        group = np.zeros(len(k1), np.int64)
        group[1:] = np.cumsum((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))
        out = []
        few = np.flatnonzero(~large)
        if len(few):
            covered = refine(group[few], before[few], behind[few], lo[few], hi[few])
            row, start, stop = _ranges(covered, begin[few], length)
            out.append((few[row], start, stop, None, None))
        for at in np.array_split(np.flatnonzero(large), -(-int(large.sum()) // 4096) or 1):
            if not len(at):
                continue
            line = np.concatenate([before[at], behind[at]], axis=1)
            flat = np.ascontiguousarray(line).ravel()
            j = np.arange(chunk)
            row, shift = np.nonzero((j >= lo[at][:, None]) & (j <= hi[at][:, None]))
            first = row * 2 * side + shift
            w1 = kernels.RangeHash(flat, 14)(first, first + side) ^ k1[at][row].view(_U) ^ (shift.astype(_U) << _U(40))
            w2 = kernels.RangeHash(flat, 15)(first, first + side) ^ k2[at][row].view(_U)
            start = begin[at][row] + shift
            out.append((at[row], start, start + length, w1, w2))
        for row, start, stop, w1, w2 in out:
            empty = pa.nulls(len(row), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [table.column("t1").take(pa.array(row)).combine_chunks(), table.column("t2").take(pa.array(row)).combine_chunks(),
                 pa.array(start, pa.int32()), pa.array(stop, pa.int32()),
                 empty if w1 is None else pa.array(w1.view(np.int64)),
                 empty if w2 is None else pa.array(w2.view(np.int64))],
                names=["t1", "t2", "start", "stop", "w1", "w2"])

    def run(batches):
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            n += batch.num_rows
            if n < GATHER:
                continue
            table = pa.Table.from_batches(held)
            k1, k2, count = (table.column(c).to_numpy() for c in ("k1", "k2", "n"))
            # whole cores go; the last one stays, unless its windows are counted one by one
            cut = len(k1)
            if count[-1] <= most:
                cut = int(np.flatnonzero((k1 != k1[-1]) | (k2 != k2[-1]))[-1] + 1) if (k1 != k1[-1]).any() or (
                    k2 != k2[-1]).any() else 0
            if cut:
                yield from settle(table.slice(0, cut))
                rest = table.slice(cut)
                held, n = rest.to_batches(), rest.num_rows
        if n:
            yield from settle(pa.Table.from_batches(held))

    return rows.mapInArrow(run, _RANGE)


def _keep(texts: DataFrame) -> DataFrame:
    """(t1, t2, n_removed, n_spans, kept_sha256) of texts with the ranges that go."""
    def run(batches):
        for batch in batches:
            removed, spans, sha = [], [], []
            for text, ranges in zip(batch.column(0), batch.column(3)):
                raw = memoryview(text.as_buffer())
                r = np.array([(x["start"], x["stop"]) for x in ranges.as_py()], np.int64)
                _, start, stop = _joined(np.zeros(len(r), np.int64), r[:, 0], r[:, 1])
                digest, at = hashlib.sha256(), 0
                for a, b in zip(start.tolist(), stop.tolist()):
                    digest.update(raw[at:a])
                    at = b
                digest.update(raw[at:])
                removed.append(int((stop - start).sum()))
                spans.append(len(start))
                sha.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(sha, pa.string())], names=["t1", "t2", "n_removed", "n_spans", "kept_sha256"])

    return texts.select("text", "t1", "t2", "ranges").mapInArrow(
        run, "t1 bigint, t2 bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def removed_ranges(texts: DataFrame, first_rows: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK,
                   most: int = MOST_ROWS) -> DataFrame:
    """(t1, t2, start, stop): byte ranges of texts that go, not yet joined."""
    spot, own_anchor = F.struct("t1", "t2", "place"), Window.partitionBy("a")
    found = (_find_anchors(texts, length, gram)
             .withColumn("x", F.min(spot).over(own_anchor)).withColumn("y", F.max(spot).over(own_anchor))
             .where("stop IS NOT NULL OR x != y").drop("x", "y"))
    found = materialize(found, "suffix-anchors")
    settled = found.where("stop IS NOT NULL").select("t1", "t2", F.col("place").alias("start"), "stop")
    lists = found.where("stop IS NULL").groupBy("t1", "t2").agg(
        F.collect_set(F.struct("place", "lo", "hi")).alias("spots"))
    lists = lists.join(first_rows, ["t1", "t2"]).select(
        "spots", F.col("t1").alias("_1"), F.col("t2").alias("_2"), F.col("first").alias("_first"))
    own = (F.col("t1") == F.col("_1")) & (F.col("t2") == F.col("_2")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    rows = _find_contexts(texts.join(lists, own).select("text", "t1", "t2", "spots"), length, chunk)
    rows = rows.withColumn("n", F.count("*").over(Window.partitionBy("k1", "k2"))).where("n > 1")
    merged = materialize(_merge(rows, length, chunk, most), "suffix-ranges")
    counted = merged.where("w1 IS NOT NULL")
    same = counted.groupBy("w1", "w2").agg(F.min(F.struct("t1", "t2", "start")).alias("x"),
                                           F.max(F.struct("t1", "t2", "start")).alias("y")).where("x != y")
    out = merged.where("w1 IS NULL").select("t1", "t2", "start", "stop").union(settled)
    if not counted.isEmpty():
        out = out.union(counted.join(same.select("w1", "w2"), ["w1", "w2"], "left_semi").select(
            "t1", "t2", "start", "stop"))
    return out


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
          chunk: int = CHUNK, most: int = MOST_ROWS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, copies) of every row of ``docs``."""
    texts = _texts(docs, id_col, text_col)
    rows = materialize(texts.select("doc_id", "t1", "t2", F.octet_length("text").cast("bigint").alias("n_bytes"),
                                    F.sha2("text", 256).alias("sha")), "suffix-rows")
    first = rows.where(F.col("n_bytes") >= length).groupBy("t1", "t2").agg(
        F.min("doc_id").alias("first"), F.count("*").alias("copies"))
    first = materialize(first, "suffix-first")
    ranges = removed_ranges(texts, first.select("t1", "t2", "first"), length, gram, chunk, most)
    per_text = ranges.groupBy("t1", "t2").agg(F.collect_set(F.struct("start", "stop")).alias("ranges")).join(
        first.where("copies = 1"), ["t1", "t2"]).select(
        "ranges", F.col("t1").alias("_1"), F.col("t2").alias("_2"), F.col("first").alias("_first"))
    own = (F.col("t1") == F.col("_1")) & (F.col("t2") == F.col("_2")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    kept = _keep(texts.where(F.octet_length("text") >= length).join(per_text, own).select("text", "t1", "t2", "ranges"))
    kept = materialize(kept, "suffix-kept")
    whole = F.coalesce(F.col("copies"), F.lit(1)) > 1
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.join(first.select("t1", "t2", "copies"), ["t1", "t2"], "left").join(kept, ["t1", "t2"], "left").select(
        "doc_id", "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(nothing)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        F.coalesce("copies", F.lit(1)).alias("copies"))
