"""License scans by a generalised suffix automaton of licence words.

All licence templates and phrases go into one suffix automaton. A text's words stream through it and
give matching statistics: for each word the longest run ending there that occurs in some template.
Long runs are chained per template, in order and with small gaps, into covered template spans; a
template whose words are covered to a large part labels the text. Phrases are read off the same
statistics: a phrase stands where the match is at least as long and its state lies below the phrase's.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.util import chunks, mapped

#: Phrases whose words, one after another, carry a label.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Wording of public licence notices and headers, by label.
TEMPLATES = {
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice "
        "and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        "Released under the MIT License.",
    ),
    "apache-2": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "Licensed under the Apache License, Version 2.0.",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
        "disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
        "derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, "
        "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
        "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
        "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
        "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
        "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
        "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Licensed under the BSD 3-Clause License.",
        "Licensed under the BSD License.",
    ),
    "gpl": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
        "version.",
        "This work is licensed under the GNU General Public License, version 3.",
    ),
    "lgpl": ("This work is licensed under the GNU Lesser General Public License, version 3.",),
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "cc-by": ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "Licensed under CC BY 4.0."),
    "cc-by-sa": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "cc-by-nc": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "proprietary": ("All rights reserved. No part of this publication may be reproduced without prior written permission.",),
}

#: Words are runs of these bytes once A-Z is lower case: digits, a-z and all of non-ASCII.
_WORD_BYTES = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().translate(_WORD_BYTES).split()


class SuffixAutomaton:
    """Generalised suffix automaton of token sequences, with the templates and places of each state."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for s in sequences:
            last = 0
            for token in s:
                last = self._extend(last, token)
        #: Of each state: template -> all positions after places where the state's strings end.
        self.places: list[dict[int, list[int]]] = [{} for _ in self.next]
        for k, s in enumerate(sequences):
            at = 0
            for i, token in enumerate(s):
                at = up = self.next[at][token]
                while up > 0:
                    self.places[up].setdefault(k, []).append(i + 1)
                    up = self.link[up]

    def _new(self, length: int, link: int, out: dict[int, int]) -> int:
        self.next.append(out)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, p: int, q: int, token: int) -> int:
        """A state for the shorter strings of ``q`` that are reached through ``p``."""
        twin = self._new(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = twin
        while p >= 0 and self.next[p].get(token) == q:
            self.next[p][token] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, token: int) -> int:
        q = self.next[last].get(token)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, token)
        new, p = self._new(self.length[last] + 1, 0, {}), last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][token]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, token)
        return new

    def state(self, sequence: list[int]) -> int:
        at = 0
        for token in sequence:
            at = self.next[at][token]
        return at

    def stream(self, tokens: list[int]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest match that ends at each token."""
        at, n = 0, 0
        for token in tokens:
            while at and token not in self.next[at]:
                at = self.link[at]
                n = self.length[at]
            to = self.next[at].get(token)
            at, n = (to, n + 1) if to is not None else (0, 0)
            yield at, n


class LicenceScanner:
    def __init__(self, min_run: int = 4, max_gap: int = 8, min_cover: float = 0.6):
        self.min_run, self.max_gap, self.min_cover = min_run, max_gap, min_cover
        self.labels = [label for label, texts in TEMPLATES.items() for _ in texts]
        sequences = [split_words(t) for texts in TEMPLATES.values() for t in texts]
        phrases = [split_words(p) for p in PHRASES]
        self.vocabulary = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for s in sequences + phrases for w in s))}
        numbered = [[self.vocabulary[w] for w in s] for s in sequences + phrases]
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(numbered)
        self.phrase_at: dict[int, list[tuple[int, str]]] = {}
        for s, label in zip(numbered[len(sequences) :], PHRASES.values(), strict=True):
            self.phrase_at.setdefault(self.automaton.state(s), []).append((len(s), label))
        #: Phrases that end every string of a state, through its suffix links.
        self.phrases = [self._above(v) for v in range(len(self.automaton.next))]
        self.shortest = min(min(len(p) for p in phrases), min_run)

    def _above(self, v: int) -> list[tuple[int, str]]:
        out = []
        while v > 0:
            out += self.phrase_at.get(v, [])
            v = self.automaton.link[v]
        return out

    def scan(self, words: list[bytes]) -> dict:
        """Base places, and covered spans (template, first word, words, share of the template)."""
        get = self.vocabulary.get
        ids = np.fromiter((get(w, 0) for w in words), np.int32, len(words))
        known = np.concatenate([[0], (ids > 0).view(np.int8), [0]])
        edges = np.flatnonzero(np.diff(known))
        base: list[tuple[int, str]] = []
        runs: list[tuple[int, int, int, int]] = []
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a < self.shortest:
                continue
            before = (0, 0)
            for i, (v, n) in enumerate([*self.automaton.stream(ids[a:b].tolist()), (0, 0)]):
                for size, label in self.phrases[v]:
                    if n >= size:
                        base.append((a + i - size + 1, label))
                # A run that the next word doesn't lengthen is maximal.
                if before[1] >= self.min_run and n <= before[1]:
                    for k, ends in self.automaton.places[before[0]].items():
                        if k < len(self.sizes):
                            runs += [(k, a + i - before[1], before[1], end) for end in ends]
                before = (v, n)
        return {"base": base, "spans": self._chain(runs)}

    def _chain(self, runs: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Runs (template, start, words, template end) joined in order, per template, across small gaps.

        The chain that ends in a run is the best over all runs before it within reach, so a stray run doesn't
        end a span. Chains are given by falling cover; one that shares words with a better one is left out.
        """
        spans = []
        for k in sorted({r[0] for r in runs}):
            own = sorted(r[1:] for r in runs if r[0] == k)
            longest = max(n for _, n, _ in own)
            covered, first, low = [], [], 0
            for j, (s, n, end) in enumerate(own):
                while own[low][0] + longest + self.max_gap < s:
                    low += 1
                best, start = n, s
                for i in range(low, j):
                    at, place = own[i][0] + own[i][1], own[i][2]
                    gain = min(n, s + n - at, end - place)
                    if gain > 0 and s - at <= self.max_gap and end - n - place <= self.max_gap and covered[i] + gain > best:
                        best, start = covered[i] + gain, first[i]
                covered.append(best)
                first.append(start)
            taken: list[tuple[int, int]] = []
            for j in sorted(range(len(own)), key=lambda j: (-covered[j], first[j])):  # noqa: B023
                begin, after = first[j], own[j][0] + own[j][1]
                at = bisect_left(taken, (begin, after))
                if (at and taken[at - 1][1] > begin) or (at < len(taken) and taken[at][0] < after):
                    continue
                taken.insert(at, (begin, after))
                spans.append((k, begin, after - begin, min(1.0, covered[j] / self.sizes[k])))
        return sorted(spans)


@lru_cache(maxsize=4)
def scanner(min_run: int, max_gap: int, min_cover: float) -> LicenceScanner:
    return LicenceScanner(min_run, max_gap, min_cover)


def scan_licences(docs: DataFrame, min_run: int = 4, max_gap: int = 8, min_cover: float = 0.6) -> DataFrame:
    """Licences of each row: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``spans`` holds the covered template spans (label, first_word, n_words, cover); labels joins the base
    labels with those of spans that cover ``min_cover`` of their template; score is the largest cover, 1 where
    a phrase stands. Null texts count as empty (no words, no places, score 0); repeated rows give
    repeated rows, an empty table none; other columns are ignored. No shuffle; memory holds one text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(min_run, max_gap, min_cover)
        schema = pa.schema(
            [
                ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
                ("spans", pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("cover", pa.float64())]))),
            ]
        )
        for batch in chunks(batches, 1):
            out: list[list] = [[] for _ in schema]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = split_words(text)
                seen = find.scan(words)
                places = [p for p, _ in seen["base"]]
                base = {label for _, label in seen["base"]}
                spans = [(find.labels[k], a, n, c) for k, a, n, c in seen["spans"]]
                labels = base | {s[0] for s in spans if s[3] >= min_cover}
                row = (
                    doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                    ",".join(sorted(labels)), 1.0 if base else max((s[3] for s in spans), default=0.0),
                    [dict(zip(("label", "first_word", "n_words", "cover"), s, strict=True)) for s in spans],
                )
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    ddl = (
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, spans array<struct<label string, first_word long, n_words long, cover double>>"
    )
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(mapped(run, ddl))
