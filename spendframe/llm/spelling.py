"""Spelling variant grouping over a variable-length gram index.

Words are the counted runs of letters of all documents.  Two are near if one inserted, deleted
or replaced code point tells them apart; a word points to its near word of largest count if that
is much more frequent, and following the pointers gives its root.

Gram dictionary.  A word stands between two marks, and every place of it but the last begins
grams of SHORTEST to LONGEST characters.  A gram that many words hold is too frequent to be
worth a list of its own, so it is pruned and its extensions take its place.  Pruned are the
MOST_PRUNED most frequent grams at most, and only those more than COMMON words hold: a table of
bounded size, which every task gets.

Decomposition.  At each place a word has one gram, the shortest one that is not pruned, or the
longest one there is (LONGEST characters, or up to the end mark).  What it is depends on its own
characters only, so an edit changes just the grams that cover its place.

Bound.  The affected-gram bound of a word is the largest number of its grams that cover one
place.  Two near words share all grams but the affected ones; with a word's grams in one order,
rarest first, the first bound + 1 of both words hold a common one (a word has five characters, so
six grams, and the bound is LONGEST at most).  Only those are indexed.

Merging.  An unaffected gram has the edit on one side of it, and on its other side the two words
are equal up to their ends.  So each entry stands in two lists, by the gram with all before it
and by the gram with all after it.  Lists of more than CROWD words are dealt into blocks, and
blocks meet in pairs.  Pairs that meet are compared by a mask of which letters a word has an odd
number of times (an edit changes two bits at most) and then verified by edit distance.

Tasks reduce documents to word counts before anything is shuffled (a frequent word is one row of a
task); everything after works on the vocabulary.  Roots are found by pointer doubling: counts
at least double along pointers, so chains are short and never close.

Defined results: a null or empty text has no words; a null id is written as nothing in the keyed
hash of `counted`; rows that repeat count again; a word with no near word has a null form
and is its own root; equal counts go to the smaller word in code-point order; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.llm.common import materialize, release

SHORTEST, LONGEST = 2, 5
#: Words that may hold a gram before it can be pruned; grams that can be; words of a list's block.
COMMON = 64
MOST_PRUNED = 1 << 18
CROWD = 512
#: Words: least code points and occurrences; how many times as frequent a form must be.
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
#: Marks before and after a word: characters no word holds.
BEGIN, END = "\x02", "\x03"
#: One in so many (document, run) pairs loses a character, see `counted`.
SLIPS = 97
#: Counts held by a task before it passes them on; characters of a text taken at once.
HELD = 1 << 17
PIECE = 1 << 20

RUN = re.compile("[a-z\u00C0-\u00FF]+")
OTHER = re.compile("[^a-z\u00C0-\u00FF]")
FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _runs(text: str) -> Counter:
    """How often each run of letters occurs in ``text``, A-Z lower-cased."""
    text, start, out = text.encode().translate(FOLD).decode(), 0, Counter()
    while start < len(text):
        cut = OTHER.search(text, start + PIECE)
        end = cut.start() if cut else len(text)
        out.update(RUN.findall(text, start, end))
        start = end
    return out


def _passed_on(counts: Iterator[Counter]) -> Iterator[pa.RecordBatch]:
    """(key, c) batches of counts that are added up as far as HELD allows."""
    held: Counter = Counter()
    for own in counts:
        held.update(own)
        if len(held) > HELD:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                             names=["key", "c"])
            held = Counter()
    yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
                                     names=["key", "c"])


def counted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: int = SLIPS) -> DataFrame:
    """(word, n): lower-cased runs of letters of ``docs`` that are long and frequent enough.

    Where ``slips`` divides the crc32 of ``<id>:<run>``, the run loses the character at that hash
    modulo its length."""
    def words(batches):
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                before, own = zlib.crc32(f"{key or ''}:".encode()), Counter()
                for run, n in _runs(text or "").items():
                    h = zlib.crc32(run.encode(), before)
                    own[run if h % slips else run[:h % len(run)] + run[h % len(run) + 1:]] += n
                yield Counter({w: n for w, n in own.items() if len(w) >= LEAST_LENGTH})

    rows = docs.select(F.col(id_col).cast("string"), F.col(text_col))
    found = rows.mapInArrow(lambda batches: _passed_on(words(batches)), "key string, c bigint")
    return found.groupBy(F.col("key").alias("word")).agg(F.sum("c").alias("n")).where(F.col("n") >= LEAST_COUNT)


def pruned_grams(words: DataFrame) -> dict[str, int]:
    """Counts of the grams that are too frequent for lists of their own, MOST_PRUNED at most."""
    def grams(batches):
        for batch in batches:
            own: Counter = Counter()
            for word in batch.column(0).to_pylist():
                s = BEGIN + word + END
                for p in range(len(s) - 1):
                    own.update([s[p:q] for q in range(p + SHORTEST, min(p + LONGEST, len(s)) + 1)])
            yield own

    counts = words.select("word").mapInArrow(lambda batches: _passed_on(grams(batches)), "key string, c bigint")
    frequent = counts.groupBy("key").agg(F.sum("c").alias("c")).where(F.col("c") > COMMON)
    return {r.key: r.c for r in frequent.orderBy(F.desc("c"), "key").limit(MOST_PRUNED).collect()}


def decomposed(word: str, pruned: dict[str, int]) -> list[tuple[int, str, int]]:
    """(count if pruned, gram, place) of each place of a word with its marks, rarest first."""
    s, out = BEGIN + word + END, []
    for p in range(len(s) - 1):
        for q in range(p + SHORTEST, min(p + LONGEST, len(s)) + 1):
            gram = s[p:q]
            if gram not in pruned:
                break
        out.append((pruned.get(gram, 0), gram, p))
    return sorted(out)


def affected(grams: list[tuple[int, str, int]]) -> int:
    """The largest number of grams that cover one place."""
    cover = [0] * (len(grams) + 1)
    for _, gram, p in grams:
        for i in range(p, p + len(gram)):
            cover[i] += 1
    return max(cover)


def _odd_letters(word: str) -> int:
    mask = 0
    for c in word:
        mask ^= 1 << ord(c) % 61
    return mask


def index_entries(words: DataFrame) -> DataFrame:
    """(word, mask, key): the two lists of each of a word's first grams."""
    pruned = words.sparkSession.sparkContext.broadcast(pruned_grams(words))

    def listed(batches):
        for batch in batches:
            rows, keys = [], []
            for word in batch.column(0).to_pylist():
                grams, s = decomposed(word, pruned.value), BEGIN + word + END
                mask = _odd_letters(word)
                for _, gram, p in grams[:affected(grams) + 1]:
                    keys += [f"<{len(gram)}{s[:p + len(gram)]}", f">{len(gram)}{s[p:]}"]
                    rows += [(word, mask)] * 2
            yield pa.RecordBatch.from_arrays([
                pa.array([w for w, _ in rows], pa.string()), pa.array([m for _, m in rows], pa.int64()),
                pa.array(keys, pa.string())], names=["word", "mask", "key"])

    return words.select("word").mapInArrow(listed, "word string, mask bigint, key string").select(
        "word", "mask", F.xxhash64("key").alias("key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, b), a < b: the words of ``words`` that one edit tells apart."""
    entries = materialize(index_entries(words), "spelling-entries")
    lists = entries.groupBy("key").agg(F.ceil(F.count("*") / CROWD).cast("int").alias("blocks"),
                                       F.count("*").alias("c")).where("c > 1").drop("c")
    dealt = materialize(entries.join(lists, "key").withColumn(
        "own", F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")), "spelling-lists")
    release(entries)
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("key", F.col("own").alias("i"), every.alias("j"), F.col("word").alias("a"), F.col("mask").alias("ma"))
    right = dealt.select("key", every.alias("i"), F.col("own").alias("j"), F.col("word").alias("b"), F.col("mask").alias("mb"))
    met = left.join(right, ["key", "i", "j"]).where(
        (F.bit_count(F.col("ma").bitwiseXOR(F.col("mb"))) <= 2) & (F.col("a") < F.col("b"))
        & (F.levenshtein("a", "b", 1) == 1)).select("a", "b").distinct()
    pairs = materialize(met, "spelling-pairs")
    release(dealt)
    return pairs


def with_forms(words: DataFrame, pairs: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of ``words``."""
    both = pairs.union(pairs.select("b", "a")).toDF("word", "other")
    known = both.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other")
    best = known.groupBy("word").agg(F.count("*").alias("near"), F.min(F.struct(
        (-F.col("m")).alias("m"), "other")).alias("best"))
    chosen = (-F.col("best.m")) >= times * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(chosen, F.col("best.other")).alias("form"), F.when(chosen, -F.col("best.m")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words of ``forms`` that have a form: the last word along the forms."""
    current = materialize(forms.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("further"))
        following = materialize(current.join(onward, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")),
            "spelling-roots")
        release(current)
        current = following.select("word", "root")
        current._shared_path = following._shared_path
        if following.where("moved").isEmpty():
            return current


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``."""
    words = materialize(counted(docs, id_col, text_col), "spelling-words")
    forms = materialize(with_forms(words, near_pairs(words)), "spelling-forms")
    return forms.join(roots(forms), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
