"""N-gram Jaccard self-join: classes of documents linked by word-shingle similarity.

Exact: two documents link when 100 * |A and B| >= 80 * |A or B| over their distinct five-word
shingles.  The join is an inverted index over prefixes.  Shingles are ordered from rare to
frequent; if two sets are that similar, they share a shingle among the first n - ceil(0.8 n)
+ 1 of each, so only those are indexed.  Two relations between sets save work:

* Skipping in the index lists: a list is cut into blocks by set size, and an entry knows its
  place in its set.  A pair can still reach the needed overlap only if both sets have enough
  shingles left from their places on, so whole blocks and pairs are passed over.
* Answers from a highly similar set: in each block the first set is the leader and is
  verified against the others.  Jaccard distance is a metric, so what the leader's answers
  say bounds every other pair: two sets whose distances from the leader differ by more than
  the threshold cannot link, and sets already linked through leaders need no pair.  Only pairs
  that neither rule decides are verified in the second round.

Equal sets are merged before anything is indexed, so a hot group of exact copies is one set.
The order of shingles comes from a count table of fixed size (any fixed order is correct; it
only makes lists short), which is
broadcast, as is a bitmap of fixed size that tells candidates from texts to pass over.  Pairs, components and sets stay
distributed.

Defined results: null, empty or wordless text has the empty set, which is linked with
nothing; a text of fewer than five words has its whole sequence as its one shingle; ties go
to the smaller id; repeated rows share one set and one class; a row with a null id takes no
part in links and has a null class; other columns are ignored; an empty table gives an empty
result.  Ids are whole numbers.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendframe.llm import kernels
from spendframe.llm.common import components, materialize, release, unused

WORDS = 5
#: Similarity threshold in hundredths.
THRESHOLD = 80
#: Counters of the frequency table (fixed size, 2 bytes each at the end).
COUNTERS = 1 << 23
#: Shingles by which an overlap counted from halves of hashes may be off in any case.
SLACK = 3
#: Cells of the filter on wanted texts (fixed size, one bit each).
BITS = 1 << 23

_BY_ROW = "doc_id bigint, th bigint, n bigint, k1 bigint, k2 bigint, part int, counts binary"


def _prefix(n: np.ndarray, threshold: int) -> np.ndarray:
    return np.where(n > 0, n - -(-n * threshold // 100) + 1, 0)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("th"))


def _describe(rows: DataFrame, words: int) -> DataFrame:
    """One row per document (set size and a 128-bit key of its set), and per task the counts
    of its shingles in COUNTERS counters, in parts."""
    def run(batches):
        counts = np.zeros(COUNTERS, np.uint8)        # of one task, up to 255
        names = ["doc_id", "th", "n", "k1", "k2", "part", "counts"]
        kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
        for batch in batches:
            for part, buffer, offsets in kernels.slices(batch, "text"):
                h, bounds = kernels.shingle_sets(buffer, offsets, words)
                cells, times = np.unique(h & np.uint64(COUNTERS - 1), return_counts=True)
                counts[cells] = np.minimum(counts[cells] + times, 255)
                n = np.diff(bounds)
                k1 = kernels.segment_sums(kernels._mixed(h ^ np.uint64(0x1234567)), bounds)
                k2 = kernels.segment_sums(kernels._mixed(h + np.uint64(0x7654321)), bounds)
                empty = pa.nulls(len(n))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n.astype(np.int64)), _signed(k1), _signed(k2),
                     empty.cast(pa.int32()), empty.cast(pa.binary())], names=names)
        if counts.any():
            step = COUNTERS // 64
            nulls = pa.nulls(64, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nulls] * 5 + [pa.array(np.arange(64), pa.int32()),
                               pa.array([zlib.compress(counts[i * step:(i + 1) * step].tobytes(), 1) for i in range(64)], kinds[6])],
                names=names)

    return rows.select("doc_id", "text", "th").mapInArrow(run, _BY_ROW)


def _frequencies(described: DataFrame) -> np.ndarray:
    """The summed count table: added up per part on the executors, COUNTERS numbers here."""
    def add(key, table):
        total = np.zeros(COUNTERS // 64, np.uint32)
        for b in table.column("counts").to_pylist():
            total += np.frombuffer(zlib.decompress(b), np.uint8)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "counts": pa.array([zlib.compress(np.minimum(total, 0xFFFF).astype(np.uint16).tobytes(), 1)],
                                            pa.binary())})

    parts = (described.where("part IS NOT NULL").select("part", "counts")
             .groupBy("part").applyInArrow(add, "part int, counts binary").collect())
    out = np.zeros(COUNTERS, np.uint16)
    for p in parts:
        step = COUNTERS // 64
        out[p.part * step:(p.part + 1) * step] = np.frombuffer(zlib.decompress(p.counts), np.uint16)
    return out


def _entries(rows: DataFrame, counts: np.ndarray, words: int, threshold: int) -> DataFrame:
    """Index entries (token, k1, n, place) of every document's prefix.  Sets go by half of
    their key here: two that share it are candidates of each other at worst."""
    table = rows.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        frequency = table.value
        for batch in batches:
            for _, buffer, offsets in kernels.slices(batch, "text"):
                h, bounds = kernels.shingle_sets(buffer, offsets, words)
                n = np.diff(bounds)
                k1 = kernels.segment_sums(kernels._mixed(h ^ np.uint64(0x1234567)), bounds)
                rank = frequency[h & np.uint64(COUNTERS - 1)]
                prefix = _prefix(n, threshold)
                at = np.repeat(np.arange(len(n)), prefix)
                place = np.arange(len(at)) - np.repeat(np.cumsum(prefix) - prefix, prefix)
                tokens = np.empty(len(at), np.uint64)
                i = 0
                for a, b, p in zip(bounds[:-1], bounds[1:], prefix):
                    if p:
                        tokens[i:i + p] = h[a:b][np.argsort(rank[a:b], kind="stable")[:p]]
                        i += p
                yield pa.RecordBatch.from_arrays(
                    [_signed(tokens), _signed(k1[at]), pa.array((n[at].astype(np.int64) << 32) | place)],
                    names=["token", "k1", "at"])

    return rows.select("text").mapInArrow(run, "token bigint, k1 bigint, at bigint")


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Which of BITS cells the keys (column ``th``) fall into: a filter of fixed size that lets
    through every key, and few others while there are fewer keys than cells."""
    def fill(key, table):
        bits = np.zeros(BITS // 64, np.uint8)
        bits[table.column("cell").to_numpy()] = 1
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()),
                         "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

    cell = F.col("th").bitwiseAND(F.lit(BITS - 1))
    parts = keys.select((cell % 64).cast("int").alias("part"), F.floor(cell / 64).alias("cell")).distinct().groupBy(
        "part").applyInArrow(fill, "part int, bits binary").collect()
    out = np.zeros((64, BITS // 64), np.uint8)
    for p in parts:
        out[p.part] = np.unpackbits(np.frombuffer(p.bits, np.uint8))
    return np.packbits(out.T.ravel())


def _sets(rows: DataFrame, words: int, wanted: DataFrame, whole: bool = False) -> DataFrame:
    """(node, tokens) of the wanted (node, node_th): upper halves of the shingle hashes, or
    ``whole`` ones.  Texts that no wanted hash can belong to are passed over before anything is
    computed or sent."""
    bits = rows.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(F.col("node_th").alias("th"))))

    def run(batches):
        known = np.unpackbits(bits.value)
        for batch in batches:
            th = batch.column(2).to_numpy()
            batch = batch.filter(pa.array(known[th & (BITS - 1)] == 1))
            for part, buffer, offsets in kernels.slices(batch, "text"):
                h, bounds = kernels.shingle_sets(buffer, offsets, words)
                tokens = _signed(h) if whole else pa.array((h >> np.uint64(32)).astype(np.uint32).view(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), tokens)],
                    names=["node", "node_th", "tokens"])

    found = rows.where("doc_id IS NOT NULL").select("text", F.col("doc_id").alias("node"), F.coalesce(
        "th", F.lit(0)).alias("node_th")).mapInArrow(
        run, f"node bigint, node_th bigint, tokens array<{'bigint' if whole else 'int'}>")
    return found.join(wanted, ["node", "node_th"], "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Overlap of every pair (a, b): (a, b, n_a, n_b, both).  Sizes are exact; the overlap is
    as exact as the tokens of ``sets`` are."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    return pairs.join(right, "b").join(left, "a").select(
        "a", "b", F.size("ta").alias("n_a"), F.size("tb").alias("n_b"),
        F.size(F.array_intersect("ta", "tb")).alias("both"))


def _settled(counted: DataFrame, rows: DataFrame, words: int, texts_of: DataFrame, threshold: int, name: str) -> DataFrame:
    """``counted`` (from halves of the hashes), in which pairs whose overlap stands so near the
    threshold that equal halves of different shingles could decide are counted by whole hashes.
    Of n shingles in both sets about n^2 / 2^33 share a half by chance; SLACK and eight standard
    deviations are added to that."""
    n = (F.col("n_a") + F.col("n_b")).cast("double")
    chance = n * n / float(1 << 33)
    off = F.abs((100 + threshold) * F.col("both") - threshold * n)      # 0 at the threshold
    near = counted.where(off <= (100 + threshold) * (SLACK + chance + 8 * F.sqrt(chance))).select("a", "b")
    if near.isEmpty():
        return counted
    near = materialize(near, "ngram-near")
    sets = materialize(_sets(rows, words, _ends(near).join(texts_of, "node"), whole=True), "ngram-sets")
    out = materialize(counted.join(near, ["a", "b"], "left_anti").union(_verified(near, sets)), name)
    for used in (near, sets, counted):
        release(used)
    return out


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()


def _linked(threshold: int):
    return F.expr(f"100L * both >= {threshold}L * (n_a + n_b - both)")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
            threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) of every row of ``docs``; th is the hash of the
    row's text, which tells rows of one id apart."""
    rows = _rows(docs, id_col, text_col)
    described = materialize(_describe(rows, words), "ngram-rows")
    per_row = described.where("part IS NULL").select("doc_id", "th", "n", "k1", "k2")
    nodes = materialize(per_row.where("n > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "th")).alias("first")).select(
        "k1", "k2", F.col("first.doc_id").alias("node"), F.col("first.th").alias("node_th")), "ngram-nodes")

    # lists of two sets or more; the block is the set size on a scale of the threshold
    of_token = Window.partitionBy("token")
    entries = (_entries(rows, _frequencies(described), words, threshold)
               .withColumn("lo", F.min("k1").over(of_token)).withColumn("hi", F.max("k1").over(of_token))
               .where("lo != hi").select("token", "k1", F.shiftright("at", 32).cast("int").alias("n"),
                                         F.col("at").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("place")).distinct())
    block = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / threshold))).cast("int")
    lists = materialize(entries.join(nodes.select("k1", "node"), "k1").select(
        "token", "node", "n", "place", block.alias("block")), "ngram-lists")

    # round one: every set of a block against its leader, and leaders of neighbouring blocks;
    # the place of the first common shingle bounds the overlap that a pair can still have
    lead = F.min(F.struct("node", "n", "place"))
    leaders = lists.groupBy("token", "block").agg(lead.alias("lead"))
    led = lists.join(leaders, ["token", "block"]).withColumn("leader", F.col("lead.node"))
    reach = lambda n, place, m: f"{100 + threshold}L * ({n} - {place}) >= {threshold}L * ({n} + {m})"
    within = led.where("node != leader").where(reach("n", "place", "lead.n")).where(
        reach("lead.n", "lead.place", "n")).select(F.col("leader").alias("a"), F.col("node").alias("b"))
    above = leaders.select("token", (F.col("block") - 1).alias("block"), F.col("lead").alias("next"))
    between = leaders.join(above, ["token", "block"]).where("lead.node != next.node").where(
        reach("lead.n", "lead.place", "next.n")).where(reach("next.n", "next.place", "lead.n")).select(
        F.least("lead.node", "next.node").alias("a"), F.greatest("lead.node", "next.node").alias("b"))
    pairs = materialize(within.union(between).distinct(), "ngram-pairs")
    texts_of = nodes.select("node", "node_th")
    wanted = _ends(pairs).join(texts_of, "node")
    sets = materialize(_sets(rows, words, wanted), "ngram-sets")
    first = materialize(_verified(pairs, sets), "ngram-first")
    first = _settled(first, rows, words, texts_of, threshold, "ngram-first")
    links = first.where(_linked(threshold)).select("a", "b")
    joined = components(links, "ngram")

    # round two: pairs of one list in different classes that the leaders leave open
    distance = first.select(F.col("a").alias("leader"), F.col("b").alias("node"),
                            (1 - F.col("both") / (F.col("n_a") + F.col("n_b") - F.col("both"))).alias("d"))
    open_rows = led.drop("lead").join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = open_rows.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where(
        "lo != hi").select("token")
    open_rows = open_rows.join(several, "token", "left_semi").join(distance, ["leader", "node"], "left").withColumn(
        "d", F.when(F.col("leader") == F.col("node"), F.lit(0.0)).otherwise(F.col("d")))
    x = open_rows.select("token", *[F.col(c).alias(f"x_{c}") for c in ("node", "n", "place", "block", "root", "d")])
    y = open_rows.select("token", *[F.col(c).alias(f"y_{c}") for c in ("node", "n", "place", "block", "root", "d")])
    most = (100 - threshold) / 100 + 1e-9
    possible = F.expr(f"""x_node < y_node AND x_root != y_root
        AND {100 + threshold}L * (x_n - x_place) >= {threshold}L * (x_n + y_n)
        AND {100 + threshold}L * (y_n - y_place) >= {threshold}L * (x_n + y_n)
        AND (x_block != y_block OR coalesce(abs(x_d - y_d) <= {most}, true))""")
    undecided = x.join(y, "token").where(possible).select(
        F.col("x_node").alias("a"), F.col("y_node").alias("b")).distinct()
    undecided = materialize(undecided.join(first.select("a", "b"), ["a", "b"], "left_anti"), "ngram-undecided")
    final = joined
    if not undecided.isEmpty():
        # sets that round one had no use for
        more = _ends(undecided).join(sets.select("node"), "node", "left_anti").join(texts_of, "node")
        every = sets.union(materialize(_sets(rows, words, more), "ngram-sets"))
        second = materialize(_verified(undecided, every), "ngram-second")
        second = _settled(second, rows, words, texts_of, threshold, "ngram-second")
        more_links = second.where(_linked(threshold)).select("a", "b")
        if not more_links.isEmpty():
            final = components(links.union(more_links), "ngram")

    roots = nodes.join(final, "node", "left").select(
        "k1", "k2", F.coalesce("root", "node").alias("component"))
    out = per_row.join(roots, ["k1", "k2"], "left").select(
        "doc_id", "th", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(
            F.col("doc_id")).alias("component_id"))
    out = materialize(out, "ngram-out")
    for used in (sets, lists, pairs, first, undecided):
        release(used)
    return out


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS,
                    threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id.  Rows with the
    empty set or a null id stay; rows that repeat the kept id and text stay with it."""
    own_id, own_th = unused(docs, "kept_id"), unused(docs, "kept_th")
    kept = classes(docs, id_col, text_col, words, threshold).where(
        "doc_id IS NULL OR n_shingles = 0 OR component_id = doc_id").select(
        F.col("doc_id").alias(own_id), F.coalesce("th", F.lit(0)).alias(own_th)).distinct()
    own = F.col(id_col).cast("bigint").eqNullSafe(F.col(own_id)) & (
        F.coalesce(F.xxhash64(text_col), F.lit(0)) == F.col(own_th))
    return docs.join(kept, own, "left_semi")
