"""License scans: winnowed fingerprints find candidates, banded alignment confirms.

Texts and templates are sequences of lower-cased letter and digit runs. Hashes of
three words in a row are winnowed for templates: of each few neighbours the smallest
is kept. Templates too short for that at the asked coverage have all their runs, as
short as needed. All texts are looked up in the inverted index of these fingerprints; each
hit names a template and a diagonal. Around the diagonals of a template the words are
aligned in a band, which tolerates changed, missing and added words, and gives how
much of the template is covered and by what span of the text."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from mercato.llm import textbytes as tb
from mercato.llm.registry import register, table
from mercato.llm.shipping import map_arrow

# Public license notices by SPDX name, as they stand in files.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS '
        "OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-or-later": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-notice": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without '
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "all-rights-reserved": "All rights reserved.",
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}
WORDS = 3
NEIGHBOURS = 2
BAND = 8
MIN_COVERAGE = 0.8
TOKEN = tb.LETTER.copy()
TOKEN[ord("0") : ord("9") + 1] = True
MATCH, MISMATCH, GAP = 2, -1, -1


def tokens(piece: tb.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of all words of a slice."""
    starts, ends = tb.runs(TOKEN[piece.data], piece.offsets)
    return starts, ends, tb.span_hash(tb.prefix_hash(tb.LOWER[piece.data]), starts, ends)


def winnowed(hashes: np.ndarray, neighbours: int = NEIGHBOURS) -> np.ndarray:
    """Places of the smallest (rightmost of equal) hash in each window."""
    n = len(hashes) - neighbours + 1
    if n <= 0:
        return np.array([int(hashes.argmin())]) if len(hashes) else np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, neighbours)
    return np.unique(np.arange(n) + neighbours - 1 - windows[:, ::-1].argmin(axis=1))


def unbroken(size: int, min_coverage: float) -> int:
    """Words in a row that stay together in any text that has `min_coverage` of a
    template of `size` words, the others changed or missing."""
    needed = min(size, max(1, math.ceil(min_coverage * size)))
    return -(-needed // (size - needed + 1))


class TemplateIndex:
    """Templates as word hashes, and their fingerprints: sorted hashes with template
    number and place. `widths` has the words of a fingerprint by template: at most those
    that stay together at `min_coverage`, and winnowed only if one is then left."""

    def __init__(
        self,
        templates: Mapping[str, str],
        words: int = WORDS,
        neighbours: int = NEIGHBOURS,
        min_coverage: float = MIN_COVERAGE,
    ):
        self.names = sorted(templates)
        self.sequences, self.widths, found = [], [], []
        for k, name in enumerate(self.names):
            piece = next(tb.slices(pa.array([templates[name]])))
            hashes = tokens(piece)[2]
            self.sequences.append(hashes)
            together = unbroken(len(hashes), min_coverage) if len(hashes) else 0
            self.widths.append(min(words, together))
            joined = tb.shingles(hashes, self.widths[-1]) if together else hashes
            at = winnowed(joined, neighbours) if together >= words + neighbours - 1 else np.arange(len(joined))
            found += [(int(joined[i]), k, int(i)) for i in at]
        found.sort()
        self.hashes = np.array([f[0] for f in found], tb.U64)
        self.template = np.array([f[1] for f in found], np.int64)
        self.place = np.array([f[2] for f in found], np.int64)

    def hits(self, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a place in the text and a fingerprint's number."""
        low = np.searchsorted(self.hashes, joined)
        some = np.flatnonzero(self.hashes[np.minimum(low, len(self.hashes) - 1)] == joined) if len(self.hashes) else low[:0]
        many = np.searchsorted(self.hashes, joined[some], "right") - low[some]
        at = np.repeat(some, many)
        number = np.repeat(low[some], many) + np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
        return at, number


def aligned(text: np.ndarray, template: np.ndarray, band: int = BAND) -> tuple[int, int, int]:
    """Best local alignment of a template within a stretch of text whose first word is
    on the lowest diagonal: matched words, and the first and last matched word of the
    text (from 0). Cells are kept only within the band around the template's length."""
    m, n = len(template), len(text)
    score = np.zeros((m + 1, n + 1), np.int32)
    step = np.zeros((m + 1, n + 1), np.int8)
    best, at = 0, (0, 0)
    spread = n - m
    for i in range(1, m + 1):
        same = text == template[i - 1]
        for j in range(max(1, i - band), min(n, i + max(spread, 0) + band) + 1):
            ways = (0, score[i - 1, j - 1] + (MATCH if same[j - 1] else MISMATCH), score[i - 1, j] + GAP, score[i, j - 1] + GAP)
            k = int(np.argmax(ways))
            score[i, j], step[i, j] = ways[k], k
            if ways[k] > best:
                best, at = int(ways[k]), (i, j)
    i, j = at
    last, first, matched = j - 1, j, 0
    while i and j and step[i, j]:
        if step[i, j] == 1:
            if text[j - 1] == template[i - 1]:
                matched, first = matched + 1, j - 1
            i, j = i - 1, j - 1
        elif step[i, j] == 2:
            i -= 1
        else:
            j -= 1
    return matched, first, last


def _stretches(diagonals: np.ndarray, size: int, band: int) -> list[tuple[int, int]]:
    """Stretches of the text (first word, one past the last) around hits on nearby
    diagonals. Diagonals further apart than the band belong to other occurrences, so a
    stretch is never much longer than the template."""
    out: list[list[int]] = []
    for d in np.unique(diagonals).tolist():
        if out and d <= out[-1][0] + band:
            out[-1][1] = d
        else:
            out.append([d, d])
    return [(a - band, b + size + band) for a, b in out]


def _apart(spans: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """Of spans of one template that overlap, the one with most matched words: the
    others are parts of the same occurrence."""
    kept: dict[tuple[int, int], int] = {}
    for (x, y), n in sorted(spans.items(), key=lambda s: (-s[1], s[0][1] - s[0][0], s[0])):
        if all(y <= a or b <= x for a, b in kept):
            kept[(x, y)] = n
    return kept


def scanned(documents: DataFrame, templates: Mapping[str, str] = TEMPLATES, min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """`documents` with `licenses`: for each template found its `name`, `coverage`
    (matched words by words of the template), `start` and `end` (UTF-8 bytes of the text),
    by start and name. A template is found as often as it stands in a text; where one
    template contains another, both are reported.

    A text that has `min_coverage` of a template is found whichever words are changed or
    missing. Words added within it can hide it if with the changed ones they leave no
    fingerprint together: two words for templates of five, three or four for longer ones.
    A null, empty or
    unlicensed text has an empty list; repeated rows have equal lists. An empty table
    or no templates give no matches. A column named `licenses` is replaced. The index
    is as large as the templates, not the data."""
    docs = documents.drop("licenses")
    index = TemplateIndex(templates, min_coverage=min_coverage)
    shared = documents.sparkSession.sparkContext.broadcast(index)
    item = T.StructType().add("name", "string").add("coverage", "double").add("start", "long").add("end", "long")
    schema = T.StructType(list(docs.schema)).add("licenses", T.ArrayType(item))
    arrow_item = pa.struct([("name", pa.string()), ("coverage", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix = shared.value
        lengths = sorted(set(ix.widths) - {0})
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for piece in tb.slices(batch.column(batch.schema.get_field_index("text"))):
                starts, ends, hashes = tokens(piece)
                first = np.searchsorted(starts, piece.offsets)
                row = np.repeat(np.arange(len(piece)), np.diff(first))
                by: dict[tuple[int, int], list[int]] = {}
                for n in lengths:
                    at, number = ix.hits(tb.shingles(hashes, n))
                    for a, f in zip(at.tolist(), number.tolist()):
                        if row[a] == row[a + n - 1]:
                            by.setdefault((int(row[a]), int(ix.template[f])), []).append(a - int(ix.place[f]))
                for (r, k), diagonals in by.items():
                    sequence = ix.sequences[k]
                    base = int(piece.offsets[r])
                    band = min(BAND, max(1, len(sequence) // 2))
                    spans: dict[tuple[int, int], int] = {}
                    for a, b in _stretches(np.array(diagonals), len(sequence), band):
                        a, b = max(a, int(first[r])), min(b, int(first[r + 1]))
                        matched, x, y = aligned(hashes[a:b], sequence, band)
                        if matched >= min_coverage * len(sequence):
                            span = (int(starts[a + x]) - base, int(ends[a + y]) - base)
                            spans[span] = max(matched, spans.get(span, 0))
                    found[piece.first + r] += [
                        {"name": ix.names[k], "coverage": n / len(sequence), "start": x, "end": y}
                        for (x, y), n in _apart(spans).items()
                    ]
            for each in found:
                each.sort(key=lambda m: (m["start"], m["name"], m["end"]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(arrow_item))], names=schema.names)

    return map_arrow(docs, run, schema)


@register("op6_license_scan")
def op6_license_scan(spark, sf_dir):
    return scanned(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
