"""Licence scan by a positional index of rare words.

Licence notices and whole licence texts (``TEMPLATES``) are word sequences; the index lists every word's places
in them. A first pass counts, over all documents, in how many each licence word occurs, which gives its weight
(IDF). A file ranks its own licence words by weight:

1. A template can only be there if the file's words make up ``MIN_SCORE`` of its weight. The file's highest-IDF
   words of that template, down to where the rest weighs less than ``MIN_SCORE``, are looked up: a notice that is
   there has at least one of them in its place.
2. A word at file position p and template position q votes for the start p - q. Starts may drift apart by a fifth
   of the template's length (``drift``), as words are inserted, left out or changed.
3. The mandatory key phrase must stand word for word near a voted start, and the votes within the drift of it must
   weigh what step 1 leaves open.
4. The score is the largest share of the template's weight that stands in order within the drift.

Steps 1 to 3 drop only what step 4 would reject, so neither long files nor several licences in one file lose
anything. The counts are one row per licence word, some hundred, and are the only data that reach the driver.

Defined results: a null or empty text has no words, no labels and score 0; repeated rows each get a row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedloom.llm.common import map_arrow, utf8

#: Phrases that name a licence, and the labels they give.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Public licence notices and texts as (label, notice, mandatory key phrase).
TEMPLATES = (
    ("mit-notice", "released under the mit license", "mit license"),
    ("mit-notice", "licensed under the mit license", "mit license"),
    (
        "mit-text",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        "permission is hereby granted free of charge",
    ),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license",
        "you may not use this file except in compliance",
    ),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", "general public license version 2"),
    (
        "gpl-notice",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        "gnu general public license as published",
    ),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        "redistribution and use in source and binary forms",
    ),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-4.0", "licensed under a creative commons attribution 4 0 international license", "creative commons attribution 4 0"),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        "mozilla public license",
    ),
    (
        "apache-2.0-header",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required
        by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
        "you may not use this file except in compliance",
    ),
    (
        "gpl-header",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program.""",
        "in the hope that it will be useful",
    ),
    (
        "mit-whole",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
        "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS
        BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
        OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
        "the software is provided as is",
    ),
    (
        "bsd-3-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
        list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
        3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
        derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS
        AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS
        BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON
        ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY
        WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
        "endorse or promote products derived from this software",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted,
        provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS"
        AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND
        FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
        WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS
        ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
        "for any purpose with or without fee is hereby granted",
    ),
    (
        "zlib",
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable
        for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose,
        including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The
        origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this
        software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered
        source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice
        may not be removed or altered from any source distribution.""",
        "origin of this software must not be misrepresented",
    ),
)
#: Words that may be inserted or lost in a short notice; a long one may drift by a fifth of its words.
SLACK = 2
MIN_SCORE = 0.5

#: A-Z become a-z, what is no digit, letter or part of a longer UTF-8 sequence becomes a space.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


def _split(phrase: str) -> list[bytes]:
    return words_of(phrase.encode())


def vocabulary(templates=TEMPLATES) -> set[bytes]:
    return {w for _, notice, _ in templates for w in _split(notice)}


class Notice:
    """One template under the weights of its words."""

    def __init__(self, label: str, notice: str, phrase: str, weight: dict[bytes, float]):
        self.label, self.words, self.phrase = label, _split(notice), _split(phrase)
        self.places = defaultdict(list)
        for q, word in enumerate(self.words):
            self.places[word].append(q)
        self.weight = [weight[w] for w in self.words]
        self.total = sum(self.weight)
        self.drift = max(SLACK, len(self.words) // 5)
        self.ranked = sorted(self.places, key=lambda w: (-weight[w], w))
        # The phrase is looked for from its rarest word.
        self.at = min(range(len(self.phrase)), key=lambda i: (-weight[self.phrase[i]], i))
        self.phrase_place = next(i for i in range(len(self.words)) if self.words[i : i + len(self.phrase)] == self.phrase)

    def keys(self, present: set[bytes]) -> tuple[list[bytes], float]:
        """The file's highest-IDF words of this template, and the weight their votes must reach at a start."""
        own = [w for w in self.ranked if w in present]
        rest = sum(self.weight[q] for w in own for q in self.places[w])
        taken = 0
        while taken < len(own) and rest >= MIN_SCORE * self.total:
            rest -= sum(self.weight[q] for q in self.places[own[taken]])
            taken += 1
        return own[:taken], MIN_SCORE * self.total - rest

    def starts(self, words: list[bytes], positions: dict[bytes, list[int]], keys: list[bytes], needed: float) -> list[int]:
        """Starts with the key phrase in its place and enough votes of the keys within the drift."""
        votes, of = [], []
        for key in keys:
            for q in self.places[key]:
                votes.append(np.asarray(positions[key]) - q)
                of.append(np.full(len(votes[-1]), q))
        votes, of = np.concatenate(votes), np.concatenate(of)
        order = np.argsort(votes, kind="stable")
        votes, of = votes[order], of[order]
        found = []
        for p in positions[self.phrase[self.at]]:
            begin = p - self.at
            if begin < 0 or words[begin : begin + len(self.phrase)] != self.phrase:
                continue
            start = begin - self.phrase_place
            lo, hi = np.searchsorted(votes, (start - self.drift, start + self.drift + 1))
            # A hair is left for sums in another order.
            if lo < hi and sum(self.weight[q] for q in set(of[lo:hi].tolist())) >= needed - 1e-9:
                found.append(start)
        return found

    def score(self, words: list[bytes], start: int) -> float:
        """Largest share of the weight that stands in order, each word within the drift of its place."""
        n = len(self.words)
        best = [0.0] * (n + 1)  # of the words before each place; rises from left to right
        for p in range(max(0, start - self.drift), min(len(words), start + n + self.drift)):
            places = self.places.get(words[p], ())
            near = range(bisect_left(places, p - start - self.drift), bisect_left(places, p - start + self.drift + 1))
            for i in reversed(near):
                q = places[i]
                reached, after = best[q] + self.weight[q], q + 1
                while after <= n and best[after] < reached:
                    best[after] = reached
                    after += 1
        return min(1.0, best[n] / self.total)


@dataclass
class LicenceIndex:
    """Places of all licence words in the templates, from the number of documents with each of them."""

    documents: int
    frequency: dict[bytes, int]
    templates: tuple = TEMPLATES
    phrases: tuple = PHRASES

    def __post_init__(self):
        known = sorted(vocabulary(self.templates))
        self.weight = {w: math.log((self.documents + 1) / (self.frequency.get(w, 0) + 1)) + 1e-3 for w in known}
        self.notices = [Notice(*template, self.weight) for template in self.templates]
        # Weight of each word in each template, by which a file's templates are chosen.
        self.row = {w: i for i, w in enumerate(known)}
        self.shares = np.zeros((len(known), len(self.notices)))
        for t, notice in enumerate(self.notices):
            for word, places in notice.places.items():
                self.shares[self.row[word], t] = len(places) * self.weight[word] / notice.total
        # A phrase is looked for from its rarest word.
        self.anchors = defaultdict(list)
        for text, label in self.phrases:
            phrase = _split(text)
            at = min(range(len(phrase)), key=lambda i: (-self.weight.get(phrase[i], math.inf), phrase[i]))
            self.anchors[phrase[at]].append((at, phrase, label))

    def scan(self, text: bytes) -> tuple:
        """(n_words, base places as (start, label), matches as (label, start, score))."""
        words = words_of(text)
        distinct = set(words)
        present = distinct & self.row.keys()
        chosen = []
        if present:
            reach = self.shares[[self.row[w] for w in present]].sum(axis=0)
            for t in np.flatnonzero(reach >= MIN_SCORE - 1e-9):
                if present.issuperset(self.notices[t].phrase):
                    chosen.append((self.notices[t], *self.notices[t].keys(present)))
        wanted = {w for notice, keys, _ in chosen for w in (*keys, notice.phrase[notice.at])} | (self.anchors.keys() & distinct)
        positions = defaultdict(list)
        if wanted:
            for p, w in enumerate(words):
                if w in wanted:
                    positions[w].append(p)
        base = [
            (p - at, label)
            for word in self.anchors.keys() & distinct
            for at, phrase, label in self.anchors[word]
            for p in positions[word]
            if p >= at and words[p - at : p - at + len(phrase)] == phrase
        ]
        matches = []
        for notice, keys, needed in chosen:
            for start in notice.starts(words, positions, keys, needed) if keys else ():
                score = notice.score(words, start)
                if score >= MIN_SCORE:
                    matches.append((notice.label, max(0, start), score))
        return len(words), sorted(base), sorted(matches)


def document_frequency(docs: DataFrame, words: set[bytes], text_col: str = "text") -> tuple[int, dict[bytes, int]]:
    """Number of documents, and of those with each of ``words``: one small row per word and batch is summed up."""
    known = {w: i for i, w in enumerate(sorted(words))}

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts = [0] * len(known)
        texts = utf8(batch.column(0))
        for text in texts:
            for word in known.keys() & set(words_of(text)):
                counts[known[word]] += 1
        return pa.RecordBatch.from_arrays(
            [pa.array([*range(len(known)), -1], pa.int32()), pa.array([*counts, len(texts)], pa.int64())], ["word", "n"]
        )

    counted = map_arrow(docs.select(text_col), per_batch, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    found = {r.word: r.n for r in counted.collect()}
    return found.get(-1, 0), {w: found.get(i, 0) for w, i in known.items()}


def scan_documents(spark: SparkSession, docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, base, matches) of every row: places of phrases, and templates with start and score."""
    n, frequency = document_frequency(docs, vocabulary(templates), text_col)
    index = spark.sparkContext.broadcast(LicenceIndex(n, frequency, templates))

    def per_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [index.value.scan(x) for x in utf8(batch.column(1))]
        place = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string())]))
        match = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([f[0] for f in found], pa.int64()),
                pa.array([[{"start": s, "label": x} for s, x in f[1]] for f in found], place),
                pa.array([[{"label": x, "start": s, "score": c} for x, s, c in f[2]] for f in found], match),
            ],
            ["doc_id", "n_words", "base", "matches"],
        )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id bigint, n_words bigint, base array<struct<start:bigint,label:string>>, matches array<struct<label:string,start:bigint,score:double>>"
    return map_arrow(rows, per_batch, schema)
