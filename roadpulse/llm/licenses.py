"""License scan: winnowed fingerprints of templates find candidates, banded alignment judges them.

Every template is a sequence of lower-case words (letters and digits). The smallest hash of each
`winnow` neighbouring `gram`-word shingles enters an inverted index, shingle -> (template, place). A
text probes the index with all its shingles, so any copy that holds one chosen shingle is
met. Hits of one template on nearby diagonals form a candidate; the template is then aligned with the
words around it, inside a band about that diagonal, for the fewest edits. Altered copies may hold no
chosen shingle. So where `coverage` lets d words of a template miss, d + 1 of its places are seeds as
well: a copy holds the word of one at least. A seed is aligned on its own if the words around it can
make the coverage; copies so found are added where no other copy of the template lies. Candidates whose
matched words make `coverage` of the template are reported with their spans in words and characters.

A null or empty text has no rows; null ids keep their rows; repeated rows are each reported; texts
are read whole (only words of templates are looked at); an empty table gives an empty result; further
columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORD = re.compile(r"[^\W_]+")
SCHEMA = ("doc_id long, license string, coverage double, matched int, edits int, first_word int, n_words int, "
          "first_char int, end_char int")

#: Notices by which public licenses are declared, in their usual wording.
TEMPLATES = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."),
    "CC-BY-NC-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    "MIT notice": "Released under the MIT License.",
    "MIT": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included "
        "in all copies or substantial portions of the Software."),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer."),
}


def template_words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def spans(text: str) -> list[tuple[int, int]]:
    """Where the words of `template_words(text)` stand in `text`: lower-casing can lengthen a
    character, so places in the lower-cased text are led back to their characters."""
    lowered = text.lower()
    found = [m.span() for m in _WORD.finditer(lowered)]
    if len(lowered) == len(text):
        return found
    origin = np.repeat(np.arange(len(text)), [len(c.lower()) for c in text])
    return [(int(origin[a]), int(origin[b - 1]) + 1) for a, b in found]


class TemplateIndex:
    def __init__(self, templates: dict[str, str], gram: int = 3, winnow: int = 4, coverage: float = 0.8):
        self.gram = gram
        self.names = sorted(templates)
        self.texts = [template_words(templates[n]) for n in self.names]
        self.number = {w: i for i, w in enumerate(sorted({w for t in self.texts for w in t}))}
        self.ids = [np.array([self.number[w] for w in t]) for t in self.texts]
        self.index: dict[tuple, list[tuple[int, int]]] = {}
        for k, ids in enumerate(self.ids):
            grams = [tuple(ids[i:i + gram].tolist()) for i in range(max(1, len(ids) - gram + 1))]
            hashed = [xxhash.xxh64_intdigest(repr(g).encode()) for g in grams]
            span = min(winnow, len(grams))
            chosen = {min(range(i, i + span), key=lambda j: (hashed[j], -j)) for i in range(len(grams) - span + 1)}
            for i in sorted(chosen):
                self.index.setdefault(grams[i], []).append((k, i))
        size = len(self.number)
        #: words that a copy must match, by template
        self.need = np.array([math.ceil(coverage * len(ids)) for ids in self.ids])
        self.words = np.array([np.bincount(ids, minlength=size) for ids in self.ids]).reshape(len(self.ids), size)
        self.seeds: list[dict[int, list[int]]] = []  # by template: word -> places
        for ids, words, need in zip(self.ids, self.texts, self.need.tolist(), strict=True):
            own: dict[int, list[int]] = {}
            # long words are the rare ones
            for i in sorted(range(len(ids)), key=lambda i: (-len(words[i]), i))[:len(ids) - need + 1]:
                own.setdefault(int(ids[i]), []).append(i)
            self.seeds.append(own)

    def band(self, k: int, share: float) -> int:
        return max(2, int(share * len(self.ids[k])))

    def candidates(self, ids: np.ndarray, share: float) -> Iterator[tuple[int, int, int]]:
        """(template, lowest, highest diagonal) of hits that lie together. ids: words, -1: in no template."""
        if len(ids) < self.gram:
            return
        known = ids >= 0
        run = np.convolve(known, np.ones(self.gram, int), "valid") == self.gram
        hits: dict[int, list[tuple[int, int]]] = {}
        for at in np.flatnonzero(run).tolist():
            for k, place in self.index.get(tuple(ids[at:at + self.gram].tolist()), ()):
                hits.setdefault(k, []).append((at - place, at))
        for k, own in sorted(hits.items()):
            own.sort()
            low = last = own[0][0]
            for diagonal, _ in own[1:]:
                if diagonal - last > self.band(k, share):
                    yield k, low, last
                    low = diagonal
                last = diagonal
            yield k, low, last

    def seeded(self, ids: np.ndarray, share: float) -> Iterator[tuple[int, int]]:
        """(template, diagonal) of seeds among words enough for the coverage."""
        there = np.bincount(ids[ids >= 0], minlength=len(self.number))
        for k in np.flatnonzero(np.minimum(there, self.words).sum(axis=1) >= self.need).tolist():
            own, band = len(self.ids[k]), self.band(k, share)
            sums = np.concatenate([[0], np.cumsum((ids >= 0) & (self.words[k] > 0)[ids])])
            for diagonal in np.unique(np.concatenate([np.flatnonzero(ids == w) - p for w, places in self.seeds[k].items() for p in places])).tolist():
                low, high = max(0, diagonal - band), min(len(ids), diagonal + own + band)
                if sums[high] - sums[low] < self.need[k]:
                    continue
                near = ids[low:high]
                if np.minimum(np.bincount(near[near >= 0], minlength=len(self.number)), self.words[k]).sum() >= self.need[k]:
                    yield k, diagonal

    def align(self, k: int, ids: np.ndarray, low: int, high: int, band: int) -> tuple[int, int, int, int]:
        """(edits, matched words, first word, end word) of template k in the text around the
        diagonals low to high, free of charge before and after."""
        own = self.ids[k].tolist()
        left, right = low - band, high + band  # text place minus template place
        n, text = len(ids), ids.tolist()
        width = right - left + 1
        far = len(own) + 1
        # a cell: (edits, -matched, first word); row i: templates' first i words, column c: text up to i + left + c
        row = [(0, 0, i) if 0 <= (i := left + c) <= n else (far, 0, 0) for c in range(width)]
        for i, word in enumerate(own, 1):
            new = []
            for c in range(width):
                end = i + left + c
                if not 0 <= end <= n:
                    new.append((far, 0, 0))
                    continue
                e, m, f = row[c]
                if end and text[end - 1] == word:
                    best = (e, m - 1, f)
                elif end:
                    best = (e + 1, m, f)
                else:
                    best = (far, 0, 0)
                if c + 1 < width:
                    e, m, f = row[c + 1]
                    best = min(best, (e + 1, m, f))
                if c:
                    e, m, f = new[-1]
                    best = min(best, (e + 1, m, f))
                new.append(best)
            row = new
        cell = min((x, c) for c, x in enumerate(row))
        (edits, matched, first), c = cell
        return edits, -matched, first, min(n, len(own) + left + c)


def scan(docs: DataFrame, templates: dict[str, str] | None = None, *, gram: int = 3, winnow: int = 4, coverage: float = 0.8,
         band: float = 0.1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (SCHEMA) per found copy. `band`: share of a template's length, 2 words at least."""
    templates = TEMPLATES if templates is None else templates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = TemplateIndex(templates, gram, winnow, coverage)
        number = index.number
        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                split = _WORD.findall(text.lower()) if text else []
                if not split:
                    continue
                ids = np.fromiter((number.get(w, -1) for w in split), np.int64, len(split))
                found = {}
                for k, low, high in index.candidates(ids, band):
                    edits, matched, first, end = index.align(k, ids, low, high, index.band(k, band))
                    if matched >= coverage * len(index.ids[k]):
                        found[k, first, end] = (edits, matched)
                taken, more = {}, set()
                for k, first, end in found:
                    taken.setdefault(k, []).append((first, end))
                for k, at in index.seeded(ids, band):
                    if any(a <= at and at + len(index.ids[k]) <= b for a, b in taken.get(k, ())):
                        continue  # all its words lie in a copy
                    edits, matched, first, end = index.align(k, ids, at, at, index.band(k, band))
                    if matched >= coverage * len(index.ids[k]):
                        more.add((edits, -matched, first, end, k))
                for edits, matched, first, end, k in sorted(more):
                    if all(end <= a or b <= first for a, b in taken.setdefault(k, [])):
                        taken[k].append((first, end))
                        found[k, first, end] = (edits, -matched)
                if found:
                    places = spans(text)
                    for (k, first, end), (edits, matched) in sorted(found.items()):
                        out.append((doc_id, index.names[k], matched / len(index.ids[k]), matched, edits, first, end - first,
                                    places[first][0], places[end - 1][1]))
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)

    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64(), "int": pa.int32()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in SCHEMA.split(", ")])
    names = schema.names
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)
