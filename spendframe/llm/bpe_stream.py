"""BPE encoding and decoding as streaming transducers.

Encoding.  A merge can be changed by text to the right only through a chain: its right
operand is consumed by an earlier merge to the right, whose own right operand may be consumed
by a still earlier one, and so on.  Ranks fall along the chain, so it ends; the longest one,
in symbols, is the merge list's *sufficient lookahead* and is computed once from the list.
The encoder reads symbols into a short window, merges the window, and emits every token that
ends at least that far before the window's end: nothing that follows can change it.  Memory
is the window, whatever the length of a word; a document is read word by word.

Decoding.  A state machine turns ids into bytes and bytes into text incrementally, holding
the one to three bytes of an unfinished UTF-8 character and whether a separator is due.

The vocabulary file is a parameter.  Its content (a fixed size) is broadcast, so executors
need no copy of the file.  Encoding uses no shuffle; each task keeps a bounded table of words
already encoded.

Defined results: null text counts as empty and gives no tokens; repeated rows each give their
row; an empty table gives an empty result; other columns pass through in `encode`.  A piece
of text without any white space is held whole while it is split into words.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Fixed values of the word-end vocabulary: its white space class, word pattern and suffix.
WHITE_SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^ \p{L}\p{N}]+"
WORD_END = "</w>"
ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\t\n\x0b\x0c\r a-z0-9]+")

#: Words kept per worker, and the length in symbols from which a word is streamed.
CACHE_WORDS = 250_000
STREAM_FROM = 200


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: visible Latin-1 characters stand
    for themselves, the others take the code points from 256 on, in order."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        if b in visible:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


def sufficient_lookahead(merges: list[tuple[str, str]], length) -> int:
    """Symbols to the right of a token that can still change it, over all tokens.

    ``reach(t, rank)``: how far right of t one must see to know that t stands at that rank:
    its last part must have stood when t was formed, and no earlier merge (t, x) may have
    consumed it, for which x must have stood.  Merges are taken in rank order, so what is
    known of a token at that moment is what holds below that rank."""
    formed: dict[str, int] = {}
    consumed: dict[str, int] = {}
    most = 0
    for left, right in merges:
        beyond = max(formed.get(right, 0), consumed.get(right, 0))
        reach = length(right) + beyond
        token = left + right
        consumed[left] = max(consumed.get(left, 0), reach)
        formed[token] = max(formed.get(token, 0), beyond)
        most = max(most, reach, beyond)
    return most + 1


class Vocabulary:
    """Merge table, lookahead, and encoder of one word-end BPE file (its JSON text)."""

    def __init__(self, text: str):
        data = json.loads(text)
        model = data["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in data["added_tokens"]}
        self.tokens = {i: t for t, i in {**self.ids, **self.added}.items()}
        symbols = byte_symbols()
        self.first = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + WORD_END] for s in symbols]
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.rank = {(self.ids[a], self.ids[b]): rank for rank, (a, b) in enumerate(pairs)}
        self.made = [self.ids[a + b] for a, b in pairs]
        self.tables: dict = {}
        self.lookahead = sufficient_lookahead(pairs, lambda t: len(t.removesuffix(WORD_END)) or 1)
        self.space = regex.compile(f"[{WHITE_SPACE}]+")
        self.word = regex.compile(WORD_PATTERN)
        self.special = regex.compile("|".join(regex.escape(t) for t in self.added)) if self.added else None
        self.bytes_in: dict[int, tuple[bytes, bool]] = {}

    def merge(self, ids: list[int]) -> list[int]:
        """Merges of lowest rank first, leftmost first, until none applies; ``ids`` is used up."""
        of, made, none = self.rank.get, self.made, len(self.made)
        ranks = [of(pair, none) for pair in zip(ids, ids[1:])]
        while ranks:
            r = min(ranks)
            if r == none:
                break
            i = ranks.index(r)
            ids[i] = made[r]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = of((ids[i], ids[i + 1]), none)
            if i:
                ranks[i - 1] = of((ids[i - 1], ids[i]), none)
        return ids

    def length(self, token: int) -> int:
        return len(self.tokens[token].removesuffix(WORD_END)) or 1

    def stream(self, symbols: Iterable[int], step: int = 256) -> Iterator[int]:
        """Tokens of one word from its symbol ids, each as soon as it is stable."""
        window: list[int] = []
        for symbol in symbols:
            window.append(symbol)
            if len(window) >= step + 2 * self.lookahead:
                done, limit = 0, len(window) - self.lookahead
                for token in self.merge(window.copy()):
                    if done + self.length(token) > limit:
                        break
                    done += self.length(token)
                    yield token
                window = window[done:]
        yield from self.merge(window)

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8", "surrogatepass")
        first, last = self.first, self.last
        if len(raw) < STREAM_FROM:
            return self.merge([first[b] for b in raw[:-1]] + [last[raw[-1]]])
        n = len(raw) - 1
        return list(self.stream(first[b] if i < n else last[b] for i, b in enumerate(raw)))

    def words(self, text: str) -> list[str]:
        """The words of a text without added tokens: NFC, white space to one space, each
        character to lower case by itself, then the word pattern."""
        if text.isascii():                           # the same pattern in ASCII; every other character splits
            return ASCII_WORD.findall(text.lower())
        text = unicodedata.normalize("NFC", text)
        return self.word.findall(self.space.sub(" ", text).replace("Σ", "σ").lower())

    def pieces(self, text: str) -> Iterator[tuple[str | None, list[str]]]:
        """(added token or None, words) in order."""
        if self.special is None or "<|" not in text:
            yield None, self.words(text)
            return
        at = 0
        for m in self.special.finditer(text):
            yield None, self.words(text[at:m.start()])
            yield m.group(), []
            at = m.end()
        yield None, self.words(text[at:])


class Encoder:
    """Feed text in chunks, get ids; a chunk is cut at its last white space."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.held = vocabulary, ""
        self.cache: dict[str, list[int]] = {}

    def _ids(self, text: str) -> list[int]:
        out: list[int] = []
        for added, words in self.v.pieces(text):
            if added is not None:
                out.append(self.v.added[added])
            for w in words:
                found = self.cache.get(w)
                if found is None:
                    if len(self.cache) >= CACHE_WORDS:
                        self.cache.clear()
                    found = self.cache[w] = self.v.encode_word(w)
                out.extend(found)
        return out

    def feed(self, chunk: str) -> list[int]:
        self.held += chunk
        cut = max(self.held.rfind(" "), self.held.rfind("\n"))
        if cut < 0:
            return []
        ready, self.held = self.held[:cut], self.held[cut:]
        return self._ids(ready)

    def finish(self) -> list[int]:
        ready, self.held = self.held, ""
        return self._ids(ready)


class Decoder:
    """Ids to text, incrementally.

    ``as_tokens``: the token strings joined by one space, as the file's own (absent) decoder
    rule asks.  Else readable text: the tokens' bytes as UTF-8, a space after each word end."""

    def __init__(self, vocabulary: Vocabulary, as_tokens: bool = True):
        self.v, self.as_tokens, self.due = vocabulary, as_tokens, False
        self.utf8 = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        if self.as_tokens:
            text = " ".join([self.v.tokens[i] for i in ids])
            if text and self.due:
                text = " " + text
            self.due = self.due or bool(text)
            return text
        out = []
        for i in ids:
            known = self.v.bytes_in.get(i)
            if known is None:
                token = self.v.tokens[i]
                if token in self.v.added:
                    known = (token.encode(), True)
                else:
                    stem = token.removesuffix(WORD_END)
                    known = (bytes(self.v.byte_of[c] for c in stem), stem != token)
                self.v.bytes_in[i] = known
            if self.due:
                out.append(" ")
            out.append(self.utf8.decode(known[0], final=known[1]))
            self.due = known[1]
        return "".join(out)

    def finish(self) -> str:
        return self.utf8.decode(b"", final=True)


_LOADED: dict[str, Vocabulary] = {}


def _vocabulary(text: str) -> Vocabulary:
    key = hashlib.sha256(text.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Vocabulary(text)
    return _LOADED[key]


class _WordTable(dict):
    """word -> what ``render`` makes of its ids, up to CACHE_WORDS words; a worker keeps it."""

    def __init__(self, vocabulary: Vocabulary, render):
        self.v, self.render = vocabulary, render

    def __missing__(self, word: str):
        if len(self) >= CACHE_WORDS:
            self.clear()
        found = self[word] = self.render(self.v, self.v.encode_word(word))
        return found


def _table(vocabulary: Vocabulary, render) -> _WordTable:
    if render not in vocabulary.tables:
        vocabulary.tables[render] = _WordTable(vocabulary, render)
    return vocabulary.tables[render]


def _decimal_and_spelled(v: Vocabulary, ids: list[int]) -> tuple[str, str]:
    return " ".join(map(str, ids)), Decoder(v).feed(ids)


def _packed(v: Vocabulary, ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def _joined(v: Vocabulary, table: _WordTable, text: str) -> list:
    """What ``table`` has of every word and added token of a text, in order."""
    out: list = []
    for added, words in v.pieces(text):
        if added is not None:
            out.append(table.render(v, [v.added[added]]))
        out.extend([table[w] for w in words])
    return out


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``docs`` with one more column: the ids of ``text_col`` (array of int)."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    schema = T.StructType([*docs.schema.fields, T.StructField(out, T.ArrayType(T.IntegerType(), False), False)])

    def run(batches):
        v = _vocabulary(shared.value)
        table = _table(v, _packed)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            packed = [b"".join(_joined(v, table, t.as_py() or "")) for t in texts]
            offsets = np.zeros(len(packed) + 1, np.int64)
            np.cumsum([len(p) // 4 for p in packed], out=offsets[1:])
            values = pa.array(np.frombuffer(b"".join(packed), np.int32))
            ids = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
            yield pa.RecordBatch.from_arrays([*batch.columns, ids], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary_path: str, ids_col: str = "ids", out: str = "decoded",
           as_tokens: bool = True) -> DataFrame:
    """``df`` with one more column: the decoded text of ``ids_col``; null ids give ''."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType(), False)])

    def run(batches):
        v = _vocabulary(shared.value)
        for batch in batches:
            texts = []
            for ids in batch.column(batch.schema.get_field_index(ids_col)):
                d = Decoder(v, as_tokens)
                texts.append(d.feed(ids.as_py() or []) + d.finish())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): each text encoded, then decoded from its ids."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary_path))
    schema = T.StructType([docs.schema[id_col], T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())])

    def run(batches):
        v = _vocabulary(shared.value)
        table = _table(v, _decimal_and_spelled)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for t in batch.column(1):
                found = _joined(v, table, t.as_py() or "")
                ids = " ".join([f[0] for f in found])
                counts.append(ids.count(" ") + 1 if ids else 0)
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                text_sha.append(hashlib.sha256(" ".join([f[1] for f in found]).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                names=schema.names)

    return docs.select(id_col, text_col).mapInArrow(run, schema)
