"""License scans: winnowed fingerprints pick candidates, banded alignment measures them.

Every run of three words of a template is hashed; of each window of such runs
the smallest hash is kept (winnowing) and enters an inverted index.  Every run
of every document is looked up, so a template of which a whole window was
copied is found.  Hits of a template on nearby diagonals make one candidate,
which is aligned with the template in a band around them; gaps and changed
words are allowed.  A finding reports the share of the template's words that
are matched and the place in the text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.llm.common import load
from leafmill.llm.hashing import U, blocks, shingles, word_hashes

RUN, WINDOW, COVERAGE = 3, 4, 0.8
#: Half width of the band, in words: a share of the template's length, and this at least.
BAND, BAND_SHARE = 6, 0.1
MATCH, MISMATCH, GAP = 2, -1, -1
#: Bytes of templates that are indexed and broadcast.
INDEX_BYTES = 16 << 20

#: Notices, and whole short licenses, as they are worded (fixed values).
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("all-rights-reserved", "All rights reserved."),
    ("mit-line", "Released under the MIT License."),
    ("mit-line-2", "Licensed under the MIT License."),
    ("apache-2.0-line", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0-line", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-4.0-line", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0-line", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0-line", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("gpl-3.0-or-later", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    ("isc", 'Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.'),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    (
        "mit-whole",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ),
    (
        "bsd-2-clause-whole",
        'Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.',
    ),
    (
        "zlib-whole",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)


def winnow(h: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest hash of every window (the last one, if equal); of all of them, if fewer."""
    if len(h) <= window:
        return np.array([len(h) - 1 - int(np.argmin(h[::-1]))]) if len(h) else np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(h, window)[:, ::-1]
    return np.unique(np.arange(len(views)) + window - 1 - views.argmin(axis=1))


@dataclass
class Templates:
    """names; words: hashes of each template's words; prints, and for each print the (template, position) pairs that have it."""

    names: list[str]
    words: list[np.ndarray]
    prints: np.ndarray
    places: list[list[tuple[int, int]]]


def index(templates: Sequence[tuple[str, str]]) -> Templates:
    """The inverted index; a template of fewer words than a run is refused."""
    words, found = [], defaultdict(list)
    for k, (name, text) in enumerate(templates):
        h, doc, *_ = word_hashes([text.encode()])
        if len(h) < RUN:
            raise ValueError(f"template {name} has fewer than {RUN} words")
        words.append(h)
        runs = shingles(h, doc, RUN)[0]
        for p in winnow(runs, WINDOW).tolist():
            found[int(runs[p])].append((k, p))
    prints = np.array(sorted(found), U)
    return Templates([n for n, _ in templates], words, prints, [found[p] for p in prints.tolist()])


def align(a: np.ndarray, b: np.ndarray, shift: int, band: int) -> tuple[int, int, int]:
    """Best local alignment of a with b, a[i] meeting b[i + shift + d] for |d| <= band: (matched words, first and after the last word of b)."""
    width = 2 * band + 1
    score = np.zeros((len(a) + 1, width), np.int32)
    d = np.arange(width)
    same = np.zeros((len(a), width), bool)
    for i in range(len(a)):
        j = i + shift - band + d
        inside = (j >= 0) & (j < len(b))
        same[i] = inside & (b[np.clip(j, 0, max(len(b) - 1, 0))] == a[i])
        step = np.where(same[i], MATCH, MISMATCH)
        diagonal = np.where(inside, score[i] + step, 0)
        up = np.concatenate([score[i][1:], [0]]) + GAP
        best = np.maximum(np.maximum(diagonal, up), 0)
        # words of b without a partner, to the left within the row
        score[i + 1] = np.maximum.accumulate(best - GAP * d) + GAP * d
    i, k = (int(x) for x in np.unravel_index(score.argmax(), score.shape))
    matched, end, start = 0, i + shift - band + k, i + shift - band + k
    while i > 0 and score[i, k] > 0:
        s = score[i, k]
        step = MATCH if same[i - 1, k] else MISMATCH
        if s == score[i - 1, k] + step and 0 <= i - 1 + shift - band + k < len(b):
            matched += bool(same[i - 1, k])
            i -= 1
            start = i + shift - band + k
        elif k + 1 < width and s == score[i - 1, k + 1] + GAP:
            i, k = i - 1, k + 1
        elif k > 0 and s == score[i, k - 1] + GAP:
            k -= 1
        else:
            break
    return matched, max(start, 0), min(end, len(b))


def find(t: Templates, texts: list[bytes], coverage: float) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(text number, template, coverage, matched words, start byte, end byte) of every finding."""
    h, doc, start, end = word_hashes(texts)
    runs, rdoc, rpos = shingles(h, doc, RUN)
    if not len(runs) or not len(t.prints):
        return
    at = np.minimum(np.searchsorted(t.prints, runs), len(t.prints) - 1)
    hits: dict[tuple[int, int], list[tuple[int, int]]] = defaultdict(list)
    for r in np.flatnonzero(t.prints[at] == runs).tolist():
        for k, p in t.places[at[r]]:
            hits[int(rdoc[r]), k].append((int(rpos[r]) - p, int(rpos[r])))
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    for (i, k), own in sorted(hits.items()):
        words = t.words[k]
        band = max(BAND, int(BAND_SHARE * len(words)))
        b = h[first[i] : first[i + 1]]
        own.sort()
        group, done = [own[0]], []
        for x in [*own[1:], None]:
            # diagonals a template's length apart are copies of their own
            if x is not None and x[0] - group[-1][0] <= band // 2 and x[0] - group[0][0] <= min(band, len(words) - 1):
                group.append(x)
                continue
            shift = group[len(group) // 2][0]
            # a copy that starts where the last one ended doesn't meet its words
            before = done[-1][1] if done and shift >= done[-1][1] else 0
            lo, hi = max(before, shift - band), min(len(b), shift + len(words) + band)
            n, s, e = align(words, b[lo:hi], shift - lo, band)
            s, e = s + lo, e + lo
            # neighbouring diagonals of one copy give the same place again
            if n >= coverage * len(words) and e > s and not any(s < y and x0 < e for x0, y in done):
                done.append((s, e))
                yield i, k, n / len(words), n, int(start[first[i] + s]), int(end[first[i] + e - 1])
            group = [x]


def of_table(templates: DataFrame, name: str = "name", text: str = "text") -> list[tuple[str, str]]:
    """(name, text) of a table of templates, in order of names; null texts are left out, and more bytes than INDEX_BYTES are refused."""
    rows = templates.select(F.col(name).cast("string").alias("name"), F.col(text).alias("text")).filter("name is not null and text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).collect()[0][0] or 0
    if size > INDEX_BYTES:
        raise ValueError(f"the templates have {size} bytes, more than {INDEX_BYTES}")
    return [tuple(r) for r in rows.orderBy("name", "text").collect()]


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] | DataFrame = TEMPLATES, coverage: float = COVERAGE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per template found in a document, and per place.

    Returns (key, license, coverage, matched_words, start, end), places in code
    points, end exclusive.  Every copy in a text counts; null text is empty;
    texts without a template give no rows; repeated rows give theirs each;
    null keys stay; other columns are not read.  The templates are a list or a
    table (see ``of_table``), of bounded size, and are broadcast.
    """
    if isinstance(templates, DataFrame):
        templates = of_table(templates)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(index(templates))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = sent.value
        for batch in batches:
            take, cols = [], [[] for _ in range(5)]
            for at, texts in blocks(batch.column(1)):
                for i, k, share, n, s, e in find(t, texts, coverage):
                    take.append(at + i)
                    lead = len(texts[i][:s].decode("utf-8", "surrogatepass"))
                    for c, x in zip(cols, (t.names[k], share, n, lead, lead + len(texts[i][s:e].decode("utf-8", "surrogatepass"))), strict=True):
                        c.append(x)
            if take:
                kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(take)), *(pa.array(c, x) for c, x in zip(cols, kinds, strict=True))], ["doc_id", "license", "coverage", "matched_words", "start", "end"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, license string, coverage double, matched_words long, start long, end long").withColumnRenamed("doc_id", key)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every license notice in all documents."""
    return scan(load(spark, sf_dir, "documents"))
