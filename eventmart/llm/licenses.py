"""License scan by conditional compression.

A block of text that holds a license compresses much better once the compressor has seen the
license. Every candidate block is compressed plainly and with each template as a raw zstandard
dictionary; templates are ranked by how much of their own compressed size the block loses, and
those with enough gain are confirmed by comparing the wording word by word.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import cache

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import col

# Notices of public licenses, as their texts state them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        'distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. '
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
        "list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above "
        "copyright notice, this list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution. Neither the name of the copyright holder nor the names of its "
        "contributors may be used to endorse or promote products derived from this software without specific prior "
        "written permission."
    ),
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        "GNU General Public License for more details."
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
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
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}
CUES = "licen[cs]|copyright|permission|permitted|redistribut|free software|public domain|warrant|creative commons|unencumbered|merchantab"
LEVEL = 9
DIFFERENT = 0.1  # wording differences allowed, as a share of the template's words
MIN_GAIN = 0.1  # least share of the template's compressed size that a block must lose; the wording decides

_BITS = 32
_ONE = 1 << _BITS
_LOW = _ONE - 1
_MANY = 1 << 60

_CUE = re.compile(CUES, re.IGNORECASE)
_WORD = re.compile(r"\w+(?:[.-]\w+)*")
SCHEMA = "start long, end long, template string, gain double, differences int, wording string"


@dataclass(frozen=True)
class Template:
    name: str
    words: tuple[str, ...]
    ids: tuple[int, ...]
    size: int
    compressor: zstandard.ZstdCompressor


def _plain() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)


@cache
def _word_ids() -> dict[str, int]:
    """A number for every word of the templates."""
    return {w: i for i, w in enumerate(sorted({w for t in TEMPLATES.values() for w in _WORD.findall(t.lower())}))}


@cache
def _templates() -> tuple[Template, ...]:
    out = []
    for name, text in TEMPLATES.items():
        text = text.lower()
        words = tuple(_WORD.findall(text))
        known = zstandard.ZstdCompressionDict(text.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        own = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_content_size=False, write_dict_id=False)
        data = text.encode()
        size = len(_plain().compress(data)) - len(own.compress(data))
        out.append(Template(name, words, tuple(map(_word_ids().__getitem__, words)), size, own))
    return tuple(out)


def candidate_blocks(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the stretches around license words, in a bounded number of words.

    Lines with a cue, at most four lines apart, form a stretch with two lines before and after. A
    stretch longer than two of the longest templates is read in overlapping blocks, so that each
    template fits into one.
    """
    lines, at = [], 0
    for line in text.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    starts = [a for a, _ in lines]
    marked = sorted({bisect_right(starts, m.start()) - 1 for m in _CUE.finditer(text)})
    longest = max(len(t.words) for t in _templates())
    i = 0
    while i < len(marked):
        j = i
        while j + 1 < len(marked) and marked[j + 1] <= marked[j] + 5:
            j += 1
        start, end = lines[max(0, marked[i] - 2)][0], lines[min(len(lines) - 1, marked[j] + 2)][1]
        places = [m.span() for m in _WORD.finditer(text, start, end)]
        if len(places) <= 2 * longest:
            yield start, end
        else:
            for k in range(0, len(places) - longest, longest):
                part = places[k : k + 2 * longest]
                if _CUE.search(text, part[0][0], part[-1][1]):
                    yield part[0][0], part[-1][1]
        i = j + 1


def _closest(template: Template, words: np.ndarray) -> tuple[int, int, int] | None:
    """(differences, first word, word after the last) of the run of words that is closest to a template.

    Differences are words changed, added or left out at the least. None if over DIFFERENT of the template's.
    """
    at = np.arange(len(words) + 1)
    # differences above, a start below: the smallest number has the fewest differences, then the latest start
    start = _LOW - at
    best = start
    for word in template.ids:
        left_out = best + _ONE
        kept = best[:-1] + np.where(words == word, 0, _ONE)
        best = np.minimum(left_out, np.append(_MANY, kept))
        best = np.minimum.accumulate(best - at * _ONE) + at * _ONE
    last = int(np.argmin(best >> _BITS))
    changed, first = int(best[last] >> _BITS), int(_LOW - (best[last] & _LOW))
    return (changed, first, last) if changed <= DIFFERENT * len(template.ids) and first < last else None


def _compare(template: Template, words: list[str]) -> list[tuple[int, int, int, str]]:
    """(first word, word after the last, differences, wording) of each place of a template in a block."""
    ids = np.array([_word_ids().get(w, -1) for w in words], np.int64)
    found, rest = [], [(0, len(words))]
    while rest:
        low, high = rest.pop()
        hit = _closest(template, ids[low:high]) if high > low else None
        if not hit:
            continue
        changed, first, last = hit[0], low + hit[1], low + hit[2]
        notes = []
        if changed:
            for op, a, b, c, d in SequenceMatcher(None, template.words, words[first:last], autojunk=False).get_opcodes():
                if op != "equal":
                    notes.append(f"{' '.join(template.words[a:b]) or '-'} > {' '.join(words[first + c : first + d]) or '-'}")
        found.append((first, last, changed, "; ".join(notes)))
        rest += [(low, first), (last, high)]
    return found


def scan_text(text: str | None) -> list[tuple[int, int, str, float, int, str]]:
    """Licenses in a text: (start, end, template, gain, differences, wording), by place."""
    found: dict[tuple[int, int], tuple] = {}
    plain = _plain()
    for start, end in candidate_blocks(text or ""):
        data = text[start:end].lower().encode("utf-8", "surrogatepass")
        base = len(plain.compress(data))
        ranked = sorted(((base - len(t.compressor.compress(data))) / t.size, t.name, t) for t in _templates())[::-1]
        places = [m.span() for m in _WORD.finditer(text, start, end)]
        words = [text[a:b].lower() for a, b in places]
        for gain, name, template in [r for r in ranked if r[0] >= MIN_GAIN]:
            for first, last, changed, wording in _compare(template, words):
                if changed <= DIFFERENT * len(template.words):
                    key = places[first][0], places[last - 1][1]
                    hit = (*key, name, round(gain, 6), changed, wording)
                    if key not in found or (changed, -gain) < (found[key][4], -found[key][3]):
                        found[key] = hit
    # of overlapping finds the one with more text stays
    kept: list[tuple] = []  # by place
    for hit in sorted(found.values(), key=lambda h: (h[0] - h[1], h[4], h[0], h[2])):
        i = bisect_left(kept, hit)
        if (not i or kept[i - 1][1] <= hit[0]) and (i == len(kept) or hit[1] <= kept[i][0]):
            kept.insert(i, hit)
    return kept


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, start, end (code points), template, gain, differences, wording: one row per license found.

    gain is the share of the template's compressed size that the block loses with it as a dictionary;
    differences counts changed words (the fewest that lead from one wording to the other), wording names
    them. A license that stands several times has a row for each place. A text without licenses, null and
    empty ones included, has no row. Rows with a null key and repeated rows are scanned like any other.
    """

    @F.pandas_udf(f"array<struct<{SCHEMA}>>")
    def run(texts: pd.Series) -> pd.Series:
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pd.Series([[dict(zip(names, hit, strict=True)) for hit in scan_text(t)] for t in texts])

    rows = docs.select(col(key).alias("key"), col(text).alias("text")).where(F.col("text").rlike(f"(?i){CUES}"))
    hits = rows.select("key", F.inline(run("text")))
    return hits.withColumnRenamed("key", key)
