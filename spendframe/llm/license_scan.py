"""License scans: winnowed template fingerprints find candidates, banded alignment decides.

Words are runs of letters and digits, A-Z folded.  Every GRAM words are
hashed; of every WINDOW neighbouring hashes the smallest is a fingerprint, so any stretch of
GRAM + WINDOW - 1 equal words shares one.  The fingerprints of the templates make an inverted
index (fingerprint -> template, place).  The fingerprints of a document are looked up in it;
hits of one template on about the same diagonal are one candidate region.  There the template
is aligned with the document by dynamic programming in a band around the diagonal: template
words may be missing or replaced, document words may be extra.  A region is reported when the
matched words cover enough of the template, with the span from the first to the last match.

The index depends on the templates alone (a fixed, small size) and is broadcast; documents
are scanned inside their tasks, without a shuffle.

Defined results: null, empty and wordless texts have no matches; repeated rows each report
theirs; overlapping regions of one template report the best one (ties: the first); different
templates may overlap; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendframe.llm import kernels

GRAM = 3
WINDOW = 2
BAND = 8
LEAST_COVERAGE = 0.8

#: Public license notices and texts, as they are written in works.
TEMPLATES: dict[str, str] = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
        "in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."),
    "mit-line": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
        "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
        "subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."),
    "gpl-3-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
        "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
        "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met: 1. Redistributions of source code must retain the above "
        "copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary "
        "form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
        "the documentation and/or other materials provided with the distribution."),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
}

WORD = re.compile(r"(?:[A-Za-z0-9]|[^\x00-\x7f])+")
_MEMBER = np.zeros(256, bool)
_MEMBER[48:58] = _MEMBER[65:91] = _MEMBER[97:123] = _MEMBER[128:] = True


def gram_hashes(buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place of the first word in its document, document) of the winnowed word grams
    of a batch of texts.  A text of fewer than GRAM words has none."""
    start, end, doc = kernels.runs(buffer, offsets, _MEMBER)
    h = kernels.RangeHash(buffer, 5, fold_case=True)(start, end) if len(buffer) else np.zeros(0, np.uint64)
    n = max(len(h) - GRAM + 1, 0)
    grams = np.zeros(n, np.uint64)
    for j in range(GRAM):
        grams = grams * np.uint64(0x9E3779B97F4A7C15) + h[j:j + n]
    grams = kernels._mixed(grams)
    whole = doc[:n] == doc[GRAM - 1:] if n else np.zeros(0, bool)
    grams, at = grams[whole], np.flatnonzero(whole)
    d = doc[at]
    keep = np.zeros(len(grams), bool)
    if len(grams):
        alone = np.bincount(d)[d] < WINDOW
        windows = np.lib.stride_tricks.sliding_window_view(grams, min(WINDOW, len(grams)))
        inside = d[:len(windows)] == d[len(d) - len(windows):]
        keep[(np.arange(len(windows)) + windows.argmin(axis=1))[inside]] = True
        keep |= alone
    first = np.searchsorted(doc, np.arange(len(offsets)), side="left")
    return grams[keep], at[keep] - first[d[keep]], d[keep]


def words_at(text: str) -> tuple[list[str], list[tuple[int, int]]]:
    """Lower-cased words of a text and their spans in code points."""
    found = [(m.group().lower(), m.span()) for m in WORD.finditer(text)]
    return [w for w, _ in found], [s for _, s in found]


class Index:
    """Inverted index of template fingerprints."""

    def __init__(self, templates: dict[str, str]):
        self.names = list(templates)
        self.words = [words_at(t)[0] for t in templates.values()]
        raw = [t.encode() for t in templates.values()]
        offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
        h, place, template = gram_hashes(np.frombuffer(b"".join(raw), np.uint8), offsets)
        order = np.argsort(h, kind="stable")
        self.h, self.template, self.place = h[order], template[order], place[order]

    def candidates(self, h: np.ndarray, place: np.ndarray, doc: np.ndarray) -> list[tuple[int, int, int]]:
        """(document, template, diagonal) of candidate regions from document fingerprints;
        the diagonal is the place in the text less the place in the template."""
        low, high = np.searchsorted(self.h, h, "left"), np.searchsorted(self.h, h, "right")
        hits = sorted({(int(doc[i]), int(self.template[j]), int(place[i] - self.place[j]))
                       for i in np.flatnonzero(high > low) for j in range(low[i], high[i])})
        out: list[tuple[int, int, int]] = []
        for hit in hits:
            if not out or out[-1][:2] != hit[:2] or hit[2] - out[-1][2] > BAND // 2:
                out.append(hit)
        return out


def align(template: list[str], words: list[str], diagonal: int, band: int = BAND) -> tuple[int, int, int]:
    """(matched words, first, end) of the best banded alignment: as many equal words in order
    as possible, fewest skipped on the way; end is exclusive, in words of the text."""
    empty = (0, 0, 0, 0)  # matched, - skipped, first, end
    row = {d: empty for d in range(-band, band + 1)}
    for i, w in enumerate(template):
        following = {}
        for d in range(-band, band + 1):
            j = i + diagonal + d
            best = row.get(d, empty)                                # both step on, unequal
            if best[0]:
                best = (best[0], best[1] - 1, best[2], best[3])
            if 0 <= j < len(words) and words[j] == w:
                m, s, first, _ = row.get(d, empty)
                best = max(best, (m + 1, s, first if m else j, j + 1), key=lambda c: c[:2])
            for other, cost in ((row.get(d + 1, empty), 1), (following.get(d - 1, empty), 1)):
                if other[0]:
                    best = max(best, (other[0], other[1] - cost, other[2], other[3]), key=lambda c: c[:2])
            following[d] = best
        row = following
    m, _, first, end = max(row.values(), key=lambda c: (c[0], c[1]))
    return m, first, end


def matches(text: str, regions: list[tuple[int, int]], index: Index,
            least: float = LEAST_COVERAGE) -> list[tuple[str, int, int, int, float]]:
    """(template, start, end, matched words, coverage) of a text's regions, in code points."""
    words, at = words_at(text)
    found = []
    for template, diagonal in regions:
        own = index.words[template]
        m, first, end = align(own, words, diagonal)
        if m and m >= least * len(own):
            found.append((template, m, first, end))
    out, taken = [], set()
    for template, m, first, end in sorted(found, key=lambda f: (f[0], -f[1], f[2])):
        if not any((template, k) in taken for k in range(first, end)):
            taken.update((template, k) for k in range(first, end))
            out.append((index.names[template], at[first][0], at[end - 1][1], m, m / len(index.words[template])))
    return sorted(out, key=lambda f: (f[1], f[0]))


SCHEMA = "template string, start bigint, end bigint, matched_words int, coverage double"


def scan(docs: DataFrame, templates: dict[str, str] | None = None, least: float = LEAST_COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per match: the id, template, span, matched words and coverage."""
    index = Index(TEMPLATES if templates is None else templates)
    shared = docs.sparkSession.sparkContext.broadcast(index)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        found_by = shared.value
        for batch in batches:
            for part, buffer, offsets in kernels.slices(batch, "text"):
                regions: dict[int, list[tuple[int, int]]] = {}
                for d, template, diagonal in found_by.candidates(*gram_hashes(buffer, offsets)):
                    regions.setdefault(d, []).append((template, diagonal))
                found = [(d, *f) for d, r in regions.items()
                         for f in matches(part.column(1)[d].as_py(), r, found_by, least)]
                ids, *cols = zip(*found) if found else [()] * 6
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(ids, pa.int64())), pa.array(cols[0], pa.string()),
                     pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32()),
                     pa.array(cols[4], pa.float64())],
                    names=["doc_id", "template", "start", "end", "matched_words", "coverage"])

    return rows.mapInArrow(run, f"doc_id {kind}, {SCHEMA}")
