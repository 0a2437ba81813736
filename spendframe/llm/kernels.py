"""Array kernels over a batch of texts: one byte buffer, vectorised over all its documents.

The operators call these inside mapInArrow; Spark decides which rows a batch holds."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer text is a batch of its own.
SLICE_BYTES = 1 << 20

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and odd multiplications)."""
    x = x ^ (x >> _U(31))
    x *= _U(0x7FB5D329728EA185)
    x ^= x >> _U(27)
    x *= _U(0x81DADEF4BC2DD44D)
    x ^= x >> _U(33)
    return x


@lru_cache(maxsize=8)
def byte_values(seed: int, fold_case: bool) -> np.ndarray:
    """A 64-bit value for each byte; with ``fold_case`` A-Z have the values of a-z."""
    table = _mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed * 2654435761 + 12345))
    if fold_case:
        table[65:91] = table[97:123]
    return table


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(seed: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd multiplier modulo 2^64, and of its inverse."""
    if seed not in _POWERS or len(_POWERS[seed][0]) < n + 1:
        m = int(_mixed(np.array([seed + 77], _U))[0]) | 1
        inverse = pow(m, -1, 1 << 64)
        size = max(n + 1, SLICE_BYTES + 1024)
        up, down = np.full(size, m, _U), np.full(size, inverse, _U)
        up[0] = down[0] = 1
        np.cumprod(up, out=up)
        np.cumprod(down, out=down)
        _POWERS[seed] = (up, down)
    up, down = _POWERS[seed]
    return up[: n + 1], down[: n + 1]


class RangeHash:
    """64-bit hashes of any byte range of a buffer from one prefix sum (modulo 2^64)."""

    def __init__(self, buffer: np.ndarray, seed: int = 1, fold_case: bool = False):
        up, self.down = powers(seed, len(buffer))
        self.sums = np.zeros(len(buffer) + 1, _U)
        np.cumsum(byte_values(seed, fold_case)[buffer] * up[:-1], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of a batch in pieces of about SLICE_BYTES of text; null is empty."""
    column = batch.column(batch.schema.get_field_index(text))
    column = pc.fill_null(column.cast(pa.large_utf8()), "")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SLICE_BYTES, side="right")) - 1)
        j = min(j, len(column))
        yield batch.slice(i, j - i), data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        i = j


_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[32, 9, 10, 11, 12, 13]] = True


def runs(buffer: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every maximal run of bytes with ``member``; runs end with
    their document."""
    inside = np.zeros(len(buffer) + 2, bool)
    inside[1:-1] = member[buffer]
    edge = np.zeros(len(buffer) + 1, bool)
    edge[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def word_spans(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every word."""
    return runs(buffer, offsets, ~_SEPARATOR)


def shingle_hashes(words: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every k-word shingle; a document with fewer words has one, its
    whole sequence.  ``words`` holds word hashes in order."""
    factors = _mixed(np.arange(1, k + 1, dtype=_U) * _U(0xD6E8FEB86659FD93)) | _U(1)
    counts = np.bincount(doc, minlength=n_docs)
    n = max(len(words) - k + 1, 0)
    h = np.zeros(n, _U)
    for j in range(k):
        h += words[j: j + n] * factors[j]
    whole = doc[:n] == doc[k - 1:] if n else np.zeros(0, bool)
    h, at = _mixed(h[whole]), doc[:n][whole]
    first = np.concatenate([[0], np.cumsum(counts)])[:-1]
    more_h, more_d = [h], [at]
    for c in range(1, k):
        docs = np.flatnonzero(counts == c)
        if len(docs):
            v = np.full(len(docs), c, _U) * _U(0xA0761D6478BD642F)
            for j in range(c):
                v += words[first[docs] + j] * factors[j]
            more_h.append(_mixed(v))
            more_d.append(docs)
    if len(more_h) > 1:
        h, at = np.concatenate(more_h), np.concatenate(more_d)
        order = np.argsort(at, kind="stable")
        h, at = h[order], at[order]
    return h, at


def distinct_by_document(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document in ascending order, and where each document's begin
    (n_docs + 1 places).  ``doc`` ascends."""
    bounds = np.concatenate([[0], np.cumsum(np.bincount(doc, minlength=n_docs))])
    h = h.copy()
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a > 1:
            h[a:b].sort()
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    kept = np.concatenate([[0], np.cumsum(keep)])
    return h[keep], kept[bounds]


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums (modulo 2^64) of ``values`` between consecutive bounds; empty segments give 0."""
    sums = np.zeros(len(values) + 1, values.dtype)
    np.cumsum(values, out=sums[1:])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def shingle_sets(buffer: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes of each document (A-Z folded) and their bounds."""
    start, end, doc = word_spans(buffer, offsets)
    n = len(offsets) - 1
    words = RangeHash(buffer, 1, fold_case=True)(start, end)
    return distinct_by_document(*shingle_hashes(words, doc, n, k), n)
