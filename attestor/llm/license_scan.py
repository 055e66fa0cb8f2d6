"""License scans: normalised text compared with templates by Dice coefficient over word bigrams.

Text is folded to lower-case words of ASCII letters, digits and non-ASCII characters; everything
else separates words.  A candidate is any stretch of whole lines, and, where none of a template is
found, any stretch of words, so that a notice may share its line with other words.  Dice is 2|A & B| / (|A| + |B|)
over bigrams with their counts, so it reaches the threshold t only if the sizes are within
t / (2 - t) of each other: for each template only stretches inside these bounds are looked at, and
of them only those with enough words' bigrams from the template to reach t.

A text may hold several licences.  Found stretches of one template that overlap are merged into the
best, those of whole lines first.  A stretch of words inside a larger find of another template is left
out if that template accounts for all bigrams it was found by (BSD-2-Clause inside BSD-3-Clause).  Nulls and empty texts, and templates of fewer than two words, match nothing.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestor.llm.common import by_bytes, map_arrow, mix64, text_bytes, with_text, word_hashes

THRESHOLD = 0.9

# Public licence notices and texts, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/.",
    ],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "MIT": [
        "Licensed under the MIT License.",
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related or neighboring rights to this work."],
    "Proprietary": ["All rights reserved."],
}

_BREAK = np.ones(256, bool)
_BREAK[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def bigrams(words: np.ndarray) -> np.ndarray:
    """Hash of each word with the next one."""
    return mix64(words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) if len(words) > 1 else np.zeros(0, np.uint64)


@dataclass
class Template:
    name: str
    number: int
    counts: dict[int, int]
    keys: np.ndarray  # distinct bigrams, sorted
    size: int
    low: int  # bounds of a candidate's number of bigrams
    high: int


def prepare(templates: dict[str, list[str]], threshold: float) -> list[Template]:
    out = []
    for name, texts in sorted(templates.items()):
        for i, text in enumerate(texts):
            raw, bounds = text_bytes(pa.array([text]))
            b = bigrams(word_hashes(raw, bounds, space=_BREAK).hashes)
            if len(b):
                low, high = int(np.ceil(len(b) * threshold / (2 - threshold) - 1e-9)), int(np.floor(len(b) * (2 - threshold) / threshold + 1e-9))
                out.append(Template(name, i, Counter(b.tolist()), np.unique(b), len(b), low, high))
    return out


def scan_text(words: np.ndarray, lines: np.ndarray, grams: np.ndarray, templates: list[Template], threshold: float) -> list[tuple[str, int, float, int, int]]:
    """(licence, template, dice, first line, end line) found in one text; the lines are those a stretch lies in.

    ``lines`` are the bounds of the lines in ``words``; ``grams`` the text's bigrams.
    """
    found = []
    n = len(lines) - 1
    for t in templates:
        at = np.searchsorted(t.keys, grams)
        at[at == len(t.keys)] = 0
        hits = np.concatenate([[0], np.cumsum(t.keys[at] == grams)])
        if 2 * hits[-1] < threshold * (t.low + t.size):
            continue
        best: list[tuple[float, int, int]] = []
        # Stretches begin on lines with words; the size bounds give the range of their last line.
        begin = np.flatnonzero(np.diff(lines) > 0)
        first = np.searchsorted(lines, lines[begin] + t.low + 1, "left")
        last = np.searchsorted(lines, lines[begin] + t.high + 1, "right") - 1
        for k in np.flatnonzero(first <= np.minimum(last, n)).tolist():
            b = int(begin[k])
            for e in range(int(first[k]), min(int(last[k]), n) + 1):
                if lines[e] == lines[e - 1]:
                    continue
                size = int(lines[e] - lines[b]) - 1
                top = int(hits[lines[e] - 1] - hits[lines[b]])
                if 2 * min(top, t.size) < threshold * (size + t.size):
                    continue
                own = Counter(grams[lines[b] : lines[e] - 1].tolist())
                shared = sum(min(c, t.counts.get(g, 0)) for g, c in own.items())
                dice = 2 * shared / (size + t.size)
                if dice >= threshold:
                    best.append((dice, b, e))
        taken: list[tuple[int, int]] = []
        covered = np.zeros(n, bool)
        for dice, b, e in sorted(best, key=lambda x: (-x[0], x[1], x[2])):
            if not covered[b:e].any():
                covered[b:e] = True
                taken.append((b, e))
                found.append(((t.name, t.number, dice, b, e), t, int(lines[b]), int(lines[e]), False))
        for dice, b, e in word_stretches(grams, t, threshold, [(int(lines[b]), int(lines[e])) for b, e in taken]):
            line, end = int(np.searchsorted(lines, b, "right")) - 1, int(np.searchsorted(lines, e, "left"))
            found.append(((t.name, t.number, dice, line, end), t, b, e, True))
    least = min((t.size for _, t, _, _, of_words in found if of_words), default=0)
    # A larger find that spans a stretch begins at or before it, by no more than the longest find.
    larger = sorted((f for f in found if f[1].size > least), key=lambda f: f[2])
    begins, longest = [f[2] for f in larger], max((f[3] - f[2] for f in larger), default=0)

    def accounted(t: Template, b: int, e: int) -> bool:
        around = larger[bisect_left(begins, e - longest) : bisect_right(begins, b)]
        return any(_accounts_for(o, t, b, e, grams) for o in around)

    out = [f for f, t, b, e, of_words in found if not (of_words and accounted(t, b, e))]
    return sorted(out, key=lambda f: (f[3], f[4], -f[2], f[0], f[1]))


def _accounts_for(other: tuple, t: Template, b: int, e: int, grams: np.ndarray) -> bool:
    """Whether a find of another template spans the words b to e, is larger, and has all bigrams that they share with ``t``."""
    _, u, lo, hi, _ = other
    if u is t or not (lo <= b and e <= hi) or u.size <= t.size:
        return False
    return all(g in u.counts for g in grams[b : e - 1].tolist() if g in t.counts)


def word_stretches(grams: np.ndarray, t: Template, threshold: float, taken: list[tuple[int, int]]) -> list[tuple[float, int, int]]:
    """(dice, first word, end word) of the best stretches of words that overlap neither each other nor those taken.

    The best begin and end with a bigram of the template: any other at an end only lowers Dice.
    """
    at = np.searchsorted(t.keys, grams)
    at[at == len(t.keys)] = 0
    places = np.flatnonzero(t.keys[at] == grams)
    within = np.searchsorted(places, places + t.high, "left") - np.arange(len(places))
    starts = np.flatnonzero(2 * np.minimum(within, t.size) >= threshold * (t.low + t.size))
    covered = np.zeros(len(grams) + 1, bool)
    for b, e in taken:
        covered[b:e] = True

    def best(k: int) -> tuple[float, int, int] | None:
        """The best stretch from a place on, up to the next one taken."""
        begin = int(places[k])
        ahead = covered[begin : begin + t.high + 1]
        limit = begin + (int(ahead.argmax()) if ahead.any() else len(ahead))
        own: Counter[int] = Counter()
        shared, out = 0, None
        for p in places[k : k + int(within[k])].tolist():
            if p + 2 > limit:
                break
            g = int(grams[p])
            own[g] += 1
            shared += own[g] <= t.counts[g]
            size = p - begin + 1
            dice = 2 * shared / (size + t.size)
            if size >= t.low and dice >= threshold and (out is None or dice > -out[0]):
                out = (-dice, begin, p + 2)
        return out

    heap = [(*x, k) for k in starts.tolist() if (x := best(k))]
    heapq.heapify(heap)
    out = []
    while heap:
        dice, b, e, k = heapq.heappop(heap)
        if covered[b:e].any():
            if again := best(k):
                heapq.heappush(heap, (*again, k))
            continue
        covered[b:e] = True
        out.append((-dice, b, e))
    return out


FOUND = "array<struct<license:string,template:int,dice:double,first_line:int,end_line:int>>"


def scan(df: DataFrame, templates: dict[str, list[str]] | None = None, threshold: float = THRESHOLD, keep: tuple[str | Column, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, ``licenses`` (what was found, by line from 0, ends exclusive) and ``license`` and ``dice`` of the best."""
    ready = prepare(templates or TEMPLATES, threshold)
    shared = df.sparkSession.sparkContext.broadcast((ready, np.unique(np.concatenate([np.zeros(0, np.uint64), *(t.keys for t in ready)]))))
    inner = with_text(df, text, keep, "licenses", "license", "dice")
    names = inner.columns[1:]
    kind = pa.list_(pa.struct([("license", pa.string()), ("template", pa.int32()), ("dice", pa.float64()), ("first_line", pa.int32()), ("end_line", pa.int32())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, keys = shared.value
        quick = np.zeros(1 << 16, bool)
        quick[(keys >> np.uint64(48)).astype(np.int64)] = True
        least = min((threshold * (t.low + t.size) / 2 for t in ready), default=np.inf)
        for batch in batches:
            raw, bounds = text_bytes(batch.column(0))
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for a, b in by_bytes(bounds, 1 << 20):
                part, at = raw[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                w = word_hashes(part, at, space=_BREAK)
                grams = bigrams(w.hashes)
                maybe = np.flatnonzero(quick[(grams >> np.uint64(48)).astype(np.int64)])
                hit = maybe[np.isin(grams[maybe], keys)]
                count = np.bincount(np.searchsorted(w.rows, hit, "right") - 1, minlength=b - a)
                for i in np.flatnonzero(count >= least).tolist():
                    lo, hi = w.rows[i], w.rows[i + 1]
                    breaks = at[i] + np.flatnonzero(part[at[i] : at[i + 1]] == 0x0A)
                    lines = np.concatenate([[0], np.searchsorted(w.starts[lo:hi], breaks), [hi - lo]])
                    own = scan_text(w.hashes[lo:hi], lines, grams[lo : hi - 1], ready, threshold)
                    found[a + i] = [dict(zip(("license", "template", "dice", "first_line", "end_line"), f, strict=True)) for f in own]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, kind)], [*names, "licenses"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields[1:])
    out = map_arrow(inner, work, f"{schema}, licenses {FOUND}")
    best = F.try_element_at(F.array_sort("licenses", lambda x, y: F.when(x["dice"] > y["dice"], -1).when(x["dice"] < y["dice"], 1).when(x["license"] < y["license"], -1).when(x["license"] > y["license"], 1).otherwise(0)), F.lit(1))
    return out.withColumns({"license": best["license"], "dice": best["dice"]})
