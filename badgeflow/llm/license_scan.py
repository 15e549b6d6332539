"""License scan: runs of lines compared with licence templates by Dice coefficient over word bigrams.

Text is normalised to lower-case words. A candidate is any run of consecutive lines; its score against a
template is 2 |common| / (|run| + |template|) over distinct word bigrams. A run can reach the threshold t only
if its size lies between t / (2 - t) and (2 - t) / t times the template's, and only if it holds at least
t / (2 - t) of the template's bigrams. So a document is first looked up in an inverted index of all template
bigrams; the few (document, template) pairs with enough of them are compared exactly, growing runs from
each line that holds a bigram of the template, only while their size is in bounds and from one new bigram to the next,
so that blank and repeated lines cost nothing. A notice may share its lines with other text: for a licence without
a run of lines, runs of words are scored that lie in lines whose whole size is out of bounds. (A whole notice in lines
within bounds is found as lines.) Everything happens where the documents lie; nothing is shuffled.

The templates are a parameter: a list given by the caller, not data that grows with the corpus.

Defined cases: null and empty texts match nothing, nor do texts of one word. Of equal scores the shortest run (of lines, or of
words) is reported, then the first. Repeated rows each keep their row; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter, OrderedDict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from badgeflow.llm.common import column_type, slices, words_of

THRESHOLD = 0.8
_WORD = re.compile("[0-9a-z\x80-\U0010ffff]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

#: Notices of public licences, by licence and usual wording.
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-3.0", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
version."""),
    ("GPL-2.0", """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later
version."""),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD-3-Clause", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("MPL-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
)

Bigrams = frozenset[tuple[str, str]]


def normalised(text: str) -> list[str]:
    return _WORD.findall(text.translate(_LOWER))


def bigrams(words: Sequence[str]) -> Bigrams:
    return frozenset(zip(words, words[1:]))


@dataclass(frozen=True)
class Index:
    """Templates with their bigrams, and for each bigram hash the templates that have it."""

    names: tuple[str, ...]
    sets: tuple[Bigrams, ...]
    hashes: np.ndarray
    owners: np.ndarray  # of each hash; hashes repeat where several templates share a bigram
    need: np.ndarray  # bigrams of a template that a run must have at least
    threshold: float


def index(templates: Sequence[tuple[str, str]], threshold: float = THRESHOLD) -> Index:
    kept = [(name, normalised(text)) for name, text in templates]
    kept = [(name, words) for name, words in kept if len(words) > 1]
    words = words_of([" ".join(w) for _, w in kept])
    hashes, whole = words.grams(2)
    pairs = np.unique(np.stack([hashes[whole], words.doc[: len(hashes)][whole].astype(np.uint64)], axis=1), axis=0)
    sets = tuple(bigrams(w) for _, w in kept)
    need = np.array([threshold / (2 - threshold) * len(s) for s in sets]) - 1e-9
    return Index(tuple(n for n, _ in kept), sets, pairs[:, 0].copy(), pairs[:, 1].astype(np.int64), need, threshold)


def candidates(texts: list[str], templates: Index) -> np.ndarray:
    """(text, template) pairs in which the text has enough of the template's bigrams."""
    words = words_of(texts)
    hashes, whole = words.grams(2)
    hashes, doc = hashes[whole], words.doc[: len(hashes)][whole]
    low = np.searchsorted(templates.hashes, hashes, "left")
    n = np.searchsorted(templates.hashes, hashes, "right") - low
    found = np.flatnonzero(n)
    at = np.repeat(low[found], n[found]) + np.arange(n[found].sum()) - np.repeat(np.cumsum(n[found]) - n[found], n[found])
    shared = np.unique(np.stack([np.repeat(doc[found], n[found]), at], axis=1), axis=0)
    size = len(templates.names)
    counts = np.bincount(shared[:, 0] * size + templates.owners[shared[:, 1]], minlength=0)
    pair = np.flatnonzero(counts)
    pair = pair[counts[pair] >= templates.need[pair % size]]
    return np.stack([pair // size, pair % size], axis=1)


class Grams:
    """Bigrams of the words of some lines, in order, with the lines that they begin and end in."""

    def __init__(self, lines: list[list[str]]):
        words = [w for line in lines for w in line]
        line_of = [n for n, line in enumerate(lines) for _ in line]
        self.grams = list(zip(words, words[1:]))
        self.begin, self.end = line_of[:-1], line_of[1:]
        later: dict[tuple[str, str], int] = {}
        self.again = [0] * len(self.grams)  # the next place of the same bigram
        for i in range(len(self.grams) - 1, -1, -1):
            self.again[i] = later.get(self.grams[i], len(self.grams))
            later[self.grams[i]] = i

    def first_ones(self, at: set[int]) -> Iterator[tuple[int, Iterator[int]]]:
        """For each place of ``at``, last one first: the places from there on at which a bigram comes for the first time.

        Repeats are never passed over one by one: an ordered table holds the next place of each distinct bigram.
        """
        coming: OrderedDict[tuple[str, str], int] = OrderedDict()
        for i in range(len(self.grams) - 1, -1, -1):
            coming[self.grams[i]] = i
            coming.move_to_end(self.grams[i], last=False)
            if i in at:
                yield i, iter(coming.values())

    def too_long_from(self, most: float) -> list[float]:
        """For each line, the first one with which the lines from there hold more than ``most`` distinct bigrams."""
        n = (self.end[-1] if self.end else 0) + 1
        out, counts, upto, k = [math.inf] * n, Counter(), 0, 0
        for a in range(n):
            while k < len(self.grams) and self.begin[k] < a:  # those before the first line leave
                if k < upto:
                    counts[self.grams[k]] -= 1
                    if not counts[self.grams[k]]:
                        del counts[self.grams[k]]
                k += 1
            upto = max(upto, k)
            while upto < len(self.grams) and len(counts) <= most:
                counts[self.grams[upto]] += 1
                upto += 1
            if len(counts) > most:
                out[a] = self.end[upto - 1]
        return out


def best_run(text: Grams, template: Bigrams, threshold: float) -> tuple[float, int, int] | None:
    """Score, first and last line of the best run of lines; of equal scores the shortest, then the first.

    Lines without a bigram of the template at a run's end only lower its score or lengthen it, so runs are tried from
    lines in which such a bigram begins up to lines in which a new one ends. From where all of a line's such bigrams
    have come again, the run without that line is no worse and shorter.
    """
    grams, begin, end = text.grams, text.begin, text.end
    first_of = {line: i for i, line in reversed([*enumerate(begin)])}
    starts, needed = set(), Counter()  # needed: runs from a line end before this line
    for i, g in enumerate(grams):
        if g in template:
            starts.add(first_of[begin[i]])
            again = text.again[i]
            needed[begin[i]] = max(needed[begin[i]], end[again] if again < len(grams) else math.inf)
    most = (2 - threshold) / threshold * len(template) + 1e-9
    best = None
    for i, places in text.first_ones(starts):
        size = common = gained = 0
        upto = None
        for k in chain(places, [None]):
            if upto is not None and (k is None or end[k] != upto):  # the line is complete
                if size > most or upto >= needed[begin[i]]:
                    break
                if gained:
                    score = 2 * common / (size + len(template))
                    rank = (-score, upto - begin[i], begin[i])
                    if score >= threshold and (best is None or rank < best):
                        best = rank
                gained = 0
            if k is not None:
                upto = end[k]
                size += 1
                gained += grams[k] in template
                common += grams[k] in template
    return best and (-best[0], best[2], best[2] + best[1])


def best_window(text: Grams, template: Bigrams, threshold: float) -> tuple[float, int, int] | None:
    """Score, first and last line of the best run of words in lines that are too long to be scored as a whole.

    A bigram at an end that the template lacks only lowers the score, so runs begin and end with common ones.
    A run counts as at least the template's size: it must not gain by leaving out the word that differs. Of equal
    scores the shortest run is taken, then the first.
    """
    grams, begin, end = text.grams, text.begin, text.end
    most = (2 - threshold) / threshold * len(template) + 1e-9
    too_long_from = text.too_long_from(most)
    best = None
    for i, places in text.first_ones({i for i, g in enumerate(grams) if g in template}):
        common, again = 0, text.again[i]
        if again < len(grams) and begin[again] != begin[i]:  # a later line may not be too long
            again = len(grams)
        for size, k in enumerate(places, 1):
            if size > most or k >= again:
                break
            if grams[k] in template:
                common += 1
                score = 2 * common / (max(size, len(template)) + len(template))
                rank = (-score, k - i, i)
                if score >= threshold and (best is None or rank < best) and end[k] >= too_long_from[begin[i]]:
                    best = rank
    return best and (-best[0], begin[best[2]], end[best[2] + best[1]])


_FOUND = pa.list_(pa.struct([("license", pa.string()), ("score", pa.float64()), ("first_line", pa.int32()), ("last_line", pa.int32())]))


def _matched(texts: list[str], templates: Index) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in texts]
    split: dict[int, Grams] = {}
    pairs = candidates(texts, templates).tolist()
    for search in (best_run, best_window):
        known = [{m["license"] for m in matches} for matches in out]
        for d, t in pairs:
            if search is best_window and templates.names[t] in known[d]:
                continue
            if d not in split:
                split[d] = Grams([normalised(line) for line in texts[d].split("\n")])
            run = search(split[d], templates.sets[t], templates.threshold)
            if run:
                out[d].append({"license": templates.names[t], "score": run[0], "first_line": run[1], "last_line": run[2]})
    rank = lambda m: (-m["score"], m["license"], m["first_line"], m["last_line"])
    for d, matches in enumerate(out):
        matches.sort(key=rank)
        names = [m["license"] for m in matches]
        out[d] = [m for i, m in enumerate(matches) if m["license"] not in names[:i]]
    return out


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id and licenses: for each licence found its best run, best first; of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(index(templates, threshold))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, texts in slices(batches):
            found = pa.array(_matched(texts, shared.value), _FOUND)
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), found], names=["doc_id", "licenses"])

    return docs.select("doc_id", "text").mapInArrow(
        rows,
        f"doc_id {column_type(docs, 'doc_id')}, "
        "licenses array<struct<license:string,score:double,first_line:int,last_line:int>>",
    )
