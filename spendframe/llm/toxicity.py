"""Toxicity scoring behind a noisy-channel deobfuscation.

Writers hide words by look-alike characters (``m0r0n``), spacing (``m o r o n``) and
repetition (``mooooron``).  A suspicious span becomes a lattice: each character may stand
for itself, for the letters it resembles, for nothing (a separator or a repeat), each at a
channel cost.  Viterbi decoding picks the cheapest path under a letter-trigram model counted
from the whole corpus.  A separator hides inside a word or stands between two, so a span that has
any is decoded a second time with word boundaries among the choices.  A corpus that never spaces
a word out gives that model little to place boundaries by, so in the first reading every piece
between two separators, up to JOINED of them wide, counts as a word too.  Spans have any length: decoding takes time in proportion to it.  The plain words of a text and the restored ones are then scored by
a logistic model.

On Spark: one pass counts letter trigrams (a fixed-size table, added up by key).  One pass over
the labelled training rows counts, for every word, the toxic and clean documents that hold it;
counts are added up per task before the shuffle.  The VOCABULARY words and word beginnings that
tell the classes apart best are the features, and the weights are fitted by L1-regularised logistic regression
on at most FIT_ROWS labelled rows with different texts, taken in the order of a hash (both
bounds are parameters).  A last pass scores every whole text inside its task.  What is
broadcast is the trigram table and the vocabulary, both of fixed size.

Labels of rows with crc32(doc_id as text) mod 5 = 0 are never read.  doc_id, lang, source and
labels are no inputs of a score.

Defined results: null and empty texts get the score of the intercept; rows without a usable
label (null, or absent) do not train; a document labelled twice counts as toxic if one label
says so; with no usable training rows every score is 0; repeated rows each get their row; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendframe.llm import kernels
from spendframe.llm.common import let_through, materialize, release

#: Bounds of the fit: words that become features, and labelled rows that are fitted.
VOCABULARY = 2000
FIT_ROWS = 20_000
#: A word must be in so many training documents.
LEAST_DOCUMENTS = 5
#: Lengths in bytes of the word beginnings that are features beside whole words.
PREFIXES = (4, 5)
#: Most separated pieces that one hidden word is made of (beside all of a span).
JOINED = 24
#: A longer repetition of one character reads as this many of it (no hidden letters beyond).
REPEATED = 6
#: Spans up to this length are remembered within a task; longer ones are decoded each time.
REMEMBERED = 64
FOLDS = 5

#: The letters that a character resembles.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "&": "a", "#": "h",
    "*": "abcdefghijklmnopqrstuvwxyz",
}
SEPARATES = set(" .-_*~'`,/\\")
#: Channel costs (nats): a look-alike, any letter for a star, a dropped separator or repeat, a kept repeat,
#: a separator that ends a word.
COST_ALIKE, COST_STAR, COST_DROP, COST_REPEAT, COST_BOUNDARY = 0.7, 1.2, 0.2, 0.3, 1.0

LETTERS = 28  # boundary, a-z, any other letter

_CLASS = np.zeros(256, np.uint8)
_CLASS[97:123] = np.arange(1, 27)
_CLASS[65:91] = np.arange(1, 27)
_CLASS[128:] = 27
_LETTER = _CLASS > 0
_ALIKE = np.zeros(256, bool)
_ALIKE[[ord(c) for c in LOOKALIKES]] = True
_TRAILING = np.zeros(256, bool)
_TRAILING[[ord(c) for c in "!*#&|<>(+.,;:?)%\"'-_"]] = True


_LONG_REPEAT = re.compile(r"(.)\1{%d,}" % REPEATED, re.DOTALL)


class Restorer:
    """Viterbi decoder of suspicious spans under letter-trigram log probabilities."""

    def __init__(self, logp: np.ndarray):
        self.logp = logp.reshape(LETTERS, LETTERS, LETTERS)
        self.known: dict[str, np.ndarray] = {}

    def __call__(self, span: str) -> np.ndarray:
        """The features of the words that ``span`` may hide, each once."""
        found = self.known.get(span)
        if found is None:
            found = self.features(span)
            if len(span) <= REMEMBERED:
                if len(self.known) >= 100_000:
                    self.known.clear()
                self.known[span] = found
        return found

    def features(self, span: str) -> np.ndarray:
        span = _LONG_REPEAT.sub(lambda m: m[1] * REPEATED, span)
        pieces = self.decode(span, "mark").split(" ")
        words = {"".join(pieces)}
        if len(pieces) > 1:
            words.update(self.decode(span, "boundary").split())
        return np.unique(np.concatenate([np.array([h for w in words for h in text_hashes(w)], np.uint64),
                                         piece_hashes([x.encode() for x in pieces if x])]))

    def options(self, c: str, before: str) -> list[tuple[str, float]]:
        """(letter or nothing, channel cost) that a character may stand for."""
        out = []
        if "a" <= c <= "z":
            out.append((c, COST_REPEAT if c == before else 0.0))
            if c == before:
                out.append(("", COST_DROP))
        elif c.isalpha():
            out.append((c, 0.0))
        cost = COST_STAR if c == "*" else COST_ALIKE
        out += [(x, cost) for x in LOOKALIKES.get(c, "")]
        if c in SEPARATES or (c in LOOKALIKES and c == before):
            out.append(("", COST_DROP))
        return out or [("", COST_ALIKE)]

    def decode(self, span: str, separators: str = "drop") -> str:
        """The cheapest reading of ``span``: one word ("drop"), the same with a space wherever a
        separator was dropped ("mark"), or any number of words with spaces between ("boundary").
        A state (the last two letters) keeps its reading as a chain."""
        span = span.lower()
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for c in span:
            following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            options = [(x, cost, (ord(x) - 96 if "a" <= x <= "z" else 27) if x else -1)
                       for x, cost in self.options(c, before)]
            if separators == "boundary" and c in SEPARATES:
                options.append((" ", COST_BOUNDARY, 0))
            marks = separators == "mark" and c in SEPARATES
            for (p, q), (total, chain) in states.items():
                for x, cost, k in options:
                    if k < 0:
                        key, value, said = (p, q), total + cost, (chain, " ") if marks else chain
                    else:
                        key, value, said = (q, k), total + cost - self.logp[p, q, k], (chain, x)
                    if key not in following or value < following[key][0]:
                        following[key] = (value, said)
            states, before = following, c
        chain = min(states.items(), key=lambda s: s[1][0] - self.logp[s[0][0], s[0][1], 0])[1][1]
        said = []
        while chain is not None:
            chain, x = chain
            said.append(x)
        return "".join(reversed(said))


def spans_of(buffer: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, document) of suspicious spans: words with a look-alike beside letters or
    a letter three times in a row (punctuation behind the word cut off), and runs of three or more one-character words."""
    start, end, doc = kernels.word_spans(buffer, offsets)
    if not len(start):
        return []
    # punctuation behind a word is none of its letters
    words_end = end
    end = end.copy()
    while True:
        trim = (end > start + 1) & _TRAILING[buffer[end - 1]]
        if not trim.any():
            break
        end[trim] -= 1
    letter, alike = _LETTER[buffer], _ALIKE[buffer]
    both = np.zeros(len(buffer) + 1, np.int32)
    # a look-alike beside a letter
    near = np.zeros(len(buffer), bool)
    near[1:] = alike[1:] & letter[:-1]
    near[:-1] |= alike[:-1] & letter[1:]
    thrice = np.zeros(len(buffer), bool)
    if len(buffer) > 2:
        thrice[2:] = letter[2:] & (buffer[2:] == buffer[1:-1]) & (buffer[2:] == buffer[:-2]) & (buffer[2:] < 128)
    # separators inside a word between single characters (m.o.r.o.n)
    dotted = np.zeros(len(buffer), bool)
    if len(buffer) > 4:
        quiet = ~letter & ~alike & (buffer < 128) & (buffer > 32)
        dotted[4:] = letter[4:] & quiet[3:-1] & letter[2:-2] & quiet[1:-3] & letter[:-4]
    np.cumsum(near | thrice | dotted, out=both[1:])
    size = end - start
    hit = np.flatnonzero((both[end] > both[start]) & (size >= 3))
    out = [(int(start[i]), int(end[i]), int(doc[i])) for i in hit]
    single = (words_end - start == 1) & (letter | alike)[start]
    same = np.zeros(len(start), bool)
    same[1:] = single[1:] & single[:-1] & (doc[1:] == doc[:-1])
    first = np.flatnonzero(single & ~same)
    stop = np.concatenate([np.flatnonzero(single & ~np.append(same[1:], False)) + 1])
    for a, b in zip(first, stop):
        if b - a >= 3:
            out.append((int(start[a]), int(end[b - 1]), int(doc[a])))
    return out


@lru_cache(maxsize=1 << 16)
def text_hashes(word: str) -> tuple[int, ...]:
    """The features of one restored word: itself and its beginnings."""
    raw = np.frombuffer(word.encode(), np.uint8)
    if not len(raw):
        return ()
    ends = [len(raw), *(k for k in PREFIXES if len(raw) > k)]
    h = kernels.RangeHash(raw, 3, fold_case=True)(np.zeros(len(ends), np.int64), np.array(ends))
    return (int(h[0]), *(int(x) ^ k for x, k in zip(h[1:], ends[1:])))


def piece_hashes(pieces: list[bytes]) -> np.ndarray:
    """The features of all words made of 1 to JOINED neighbouring ``pieces``, three bytes at least."""
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    if len(pieces) < 2 or len(raw) < 3:
        return np.zeros(0, np.uint64)
    at = np.concatenate([[0], np.cumsum([len(x) for x in pieces])]).astype(np.int64)
    of = kernels.RangeHash(raw, 3, fold_case=True)
    out = []
    for n in range(1, min(JOINED, len(pieces)) + 1):
        start, end = at[:-n], at[n:]
        some = end - start >= 3
        out.append(of(start[some], end[some]))
    for k in PREFIXES:
        # a beginning is one of a longer word, as for plain words
        start = at[:-1][at[np.minimum(np.arange(len(at) - 1) + JOINED, len(at) - 1)] - at[:-1] > k]
        out.append(of(start, start + k) ^ np.uint64(k))
    return np.concatenate(out)


def word_features(buffer: np.ndarray, offsets: np.ndarray, restore: Restorer) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every letter run, its first bytes (PREFIXES of them: a stem with
    any ending), and every restored word."""
    start, end, doc = kernels.runs(buffer, offsets, _LETTER)
    if not len(start):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    of = kernels.RangeHash(buffer, 3, fold_case=True)
    hashes, docs = [of(start, end)], [doc]
    for k in PREFIXES:
        long = np.flatnonzero(end - start > k)
        hashes.append(of(start[long], start[long] + k) ^ np.uint64(k))
        docs.append(doc[long])
    raw = buffer.tobytes()
    restored = [(h, d) for a, b, d in spans_of(buffer, offsets)
                for h in restore(raw[a:b].decode("utf-8", "replace"))]
    if restored:
        h, d = zip(*restored)
        hashes.append(np.array(h, np.uint64))
        docs.append(np.array(d, doc.dtype))
    h, doc = np.concatenate(hashes), np.concatenate(docs)
    order = np.argsort(doc, kind="stable")
    return h[order], doc[order]


def letter_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of a letter after two others, counted over all texts."""
    cells = LETTERS ** 3

    def run(batches):
        counts = np.zeros(cells, np.int64)
        for batch in batches:
            for _, buffer, offsets in kernels.slices(batch, "text"):
                padded = np.zeros(len(buffer) + 2 * (len(offsets) - 1) + 2, np.uint8)
                shift = np.repeat(2 * np.arange(1, len(offsets)), np.diff(offsets))
                padded[np.arange(len(buffer)) + shift] = _CLASS[buffer]
                c = padded.astype(np.int32)
                counts += np.bincount(c[:-2] * LETTERS ** 2 + c[1:-1] * LETTERS + c[2:], minlength=cells)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["cell", "n"])

    rows = (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "cell int, n bigint")
            .groupBy("cell").agg(F.sum("n").alias("n")).collect())  # at most LETTERS^3 rows
    counts = np.full(cells, 0.5)
    for r in rows:
        counts[r.cell] += r.n
    table = counts.reshape(LETTERS, LETTERS, LETTERS)
    return np.log(table / table.sum(axis=2, keepdims=True)).ravel().astype(np.float32)


def _word_counts(train: DataFrame, letters) -> DataFrame:
    """(word, n_toxic, n_clean): documents of each class that hold the word."""
    def run(batches):
        restore = Restorer(letters.value)
        for batch in batches:
            for part, buffer, offsets in kernels.slices(batch, "text"):
                n = len(offsets) - 1
                h, doc = word_features(buffer, offsets, restore)
                h, bounds = kernels.distinct_by_document(h, doc, n)
                toxic = np.repeat(part.column(1).to_numpy(zero_copy_only=False) == 1, np.diff(bounds))
                words, at = np.unique(h, return_inverse=True)
                hits = np.bincount(at, weights=toxic, minlength=len(words)).astype(np.int64)
                every = np.bincount(at, minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(hits), pa.array(every - hits)],
                    names=["word", "t", "c"])

    return (train.select("text", "toxic").mapInArrow(run, "word bigint, t bigint, c bigint")
            .groupBy("word").agg(F.sum("t").alias("n_toxic"), F.sum("c").alias("n_clean")))


def _fit(rows: np.ndarray, cols: np.ndarray, y: np.ndarray, n_features: int,
         sweeps: int = 40, l1: float = 0.2) -> np.ndarray:
    """L1-regularised logistic regression by coordinate descent: one feature at a time takes
    a Newton step (of 1 at most) with soft threshold, which touches its own rows only.  The
    last weight is the intercept, which is not penalised."""
    n = len(y)
    order = np.argsort(cols, kind="stable")
    bounds = np.searchsorted(cols[order], np.arange(n_features + 1))
    of = [rows[order[a:b]] for a, b in zip(bounds[:-1], bounds[1:])]
    w = np.zeros(n_features + 1)
    w[-1] = np.log((y.sum() + 0.5) / (n - y.sum() + 0.5))
    z = np.full(n, w[-1])

    def step(j, at, penalty):
        p = 1 / (1 + np.exp(-z[at]))
        g, h = float((p - y[at]).sum()), float((p * (1 - p)).sum()) + 1e-3
        to = w[j] - g / h
        to = np.sign(to) * max(abs(to) - penalty / h, 0.0)
        move = float(np.clip(to - w[j], -1, 1))
        if move:
            w[j] += move
            z[at] += move
        return abs(move)

    for sweep in range(sweeps):
        every = sweep % 10 < 2                       # in between, only features in use
        most = max([step(j, at, l1) for j, at in enumerate(of) if len(at) and (every or w[j])], default=0.0)
        most = max(most, step(n_features, slice(None), 0.0))
        if most < 0.01:
            break
    return w


def held_out(doc_id):
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


class Model:
    """What scoring needs, all of fixed size: trigram table, feature words, weights."""

    def __init__(self, letters: np.ndarray, words: np.ndarray, weights: np.ndarray):
        self.letters, self.words, self.weights = letters, words, weights


def learn(docs: DataFrame, labels: DataFrame, vocabulary: int = VOCABULARY, fit_rows: int = FIT_ROWS) -> Model:
    spark = docs.sparkSession
    letters = letter_model(docs)
    shared = spark.sparkContext.broadcast(letters)
    marks = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    marks = marks.withColumn("_key", F.xxhash64("doc_id"))
    train = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", "text", F.xxhash64("doc_id").alias("_key"))
    # labels have no proven bound, so they are never broadcast
    train = let_through(train, marks, "_key").join(marks.drop("_key").hint("merge"), "doc_id").select(
        "text", "toxic", F.xxhash64("text").alias("th"))
    train = materialize(train, "toxic-train")
    totals = train.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    nothing = Model(letters, np.zeros(0, np.uint64), np.zeros(1))
    if not totals.n or not totals.t or totals.t == totals.n:
        return nothing
    t, c = float(totals.t), float(totals.n - totals.t)
    odds = F.log((F.col("n_toxic") + 0.5) / (t + 1)) - F.log((F.col("n_clean") + 0.5) / (c + 1))
    spread = F.sqrt(1 / (F.col("n_toxic") + 0.5) + 1 / (F.col("n_clean") + 0.5))
    top = (_word_counts(train, shared).where(F.col("n_toxic") + F.col("n_clean") >= LEAST_DOCUMENTS)
           .select("word", (odds / spread).alias("z")).orderBy(F.abs("z").desc(), "word").limit(vocabulary).collect())
    words = np.sort(np.array([r.word for r in top], np.int64).view(np.uint64))
    feature_words = spark.sparkContext.broadcast(words)

    def run(batches):
        restore = Restorer(shared.value)
        known = feature_words.value
        for batch in batches:
            for part, buffer, offsets in kernels.slices(batch, "text"):
                n = len(offsets) - 1
                cols, bounds = _hits(buffer, offsets, restore, known)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(2),
                     pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(cols))],
                    names=["th", "toxic", "hits"])

    # the rows of the fit by the hash of their text; at most fit_rows keys are broadcast
    keys = train.select("th").distinct().orderBy(F.xxhash64("th"), "th").limit(fit_rows)
    sample = train.join(F.broadcast(keys), "th").select("text", "th", F.col("toxic").cast("int").alias("toxic"))
    fitted = sample.mapInArrow(run, "th bigint, toxic int, hits array<int>").groupBy("th").agg(
        F.max("toxic").alias("toxic"), F.first("hits").alias("hits")).orderBy("th").toArrow()
    release(train)
    hits = fitted.column("hits").combine_chunks()
    cols = hits.flatten().to_numpy()
    rows = np.repeat(np.arange(len(hits)), np.diff(hits.offsets.to_numpy()))
    weights = _fit(rows, cols, fitted.column("toxic").to_numpy().astype(float), len(words))
    return Model(letters, words, weights)


def _hits(buffer, offsets, restore, known) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each document and their bounds."""
    n = len(offsets) - 1
    if not len(known):
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64)
    h, doc = word_features(buffer, offsets, restore)
    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
    hit = known[at] == h
    cols, bounds = kernels.distinct_by_document(at[hit].astype(np.int32), doc[hit], n)
    return cols, bounds


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with one more column, the score of its text (0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType(), False)])
    names = [f"c{i}" for i in range(len(docs.columns))] + ["score"]
    text = f"c{docs.columns.index(text_col)}"

    def run(batches):
        m = shared.value
        restore = Restorer(m.letters)
        for batch in batches:
            batch = pa.RecordBatch.from_arrays(batch.columns, names=names[:-1])
            for part, buffer, offsets in kernels.slices(batch, text):
                n = len(offsets) - 1
                cols, bounds = _hits(buffer, offsets, restore, m.words)
                doc = np.repeat(np.arange(n), np.diff(bounds))
                z = np.bincount(doc, weights=m.weights[cols], minlength=n) + m.weights[-1]
                found = 1 / (1 + np.exp(-z)) if len(m.words) else np.zeros(n)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(found)], names=schema.names)

    return docs.mapInArrow(run, schema)


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    scored = score(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def rejected_out(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that a model learned from them and ``labels`` rejects."""
    model = learn(docs.select("doc_id", "text"), labels)
    return score(docs, model, out="_toxicity").where("_toxicity < 0.5").drop("_toxicity")
