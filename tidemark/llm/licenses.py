"""License scans by patience alignment.

A notice is found by aligning its template with the words of the text. Words that occur once in the
template and once in the stretch of text are anchors; the longest increasing run of anchors fixes the
alignment; the gaps between neighbouring anchors are aligned the same way, after equal words at both
ends of a gap are matched outright. Coverage is the share of the template's words that the alignment
matches, in order.

Which stretches are aligned: a template's key is a word that every match must hold (see below), of several the one
that the fewest templates share; a template without such a word has as many rare words as keys as a match may miss,
and one more. Around each occurrence of a key in the text, the stretch is as long as the template would reach there, and a quarter
more. A match beyond ``least`` counts; occurrences inside an accepted match are not aligned again, the
template's next occurrence is. Of matches that overlap, the template with more matched words stays.

A match must hold each of its template's words that say which licence it is: numbers and the words of
``NAMING``, and in short templates those that no other licence's template has. Between its first and last
word no other word of ``RIVALS`` may stand, so that a licence without a template is not taken for one with.

Words are runs of letters and digits, lower-cased. Null and empty texts have no notices. Texts of any
length are scanned whole, row by row; repeated rows give repeated results, an empty table an empty
result. Other columns are kept; an input column named like the result is replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import bounded_batches, parts_of, texts_of

# Wordings of public licences' notices, several for one licence.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT-0", "Released under the MIT-0 License."),
    ("MIT-0", "Licensed under the MIT-0 license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("BSD", "Released under the BSD License."),
    ("Apache", "Released under the Apache License."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL", "Released under the GNU General Public License."),
    *(
        (name, line)
        for kind, words in (("GPL", "GNU General Public License"), ("LGPL", "GNU Lesser General Public License"), ("AGPL", "GNU Affero General Public License"))
        for version in {"GPL": ("2", "3"), "LGPL": ("2", "2.1", "3"), "AGPL": ("3",)}[kind]
        for name, line in (
            (f"{kind}-{version if '.' in version else version + '.0'}", f"This work is licensed under the {words}, version {version}."),
            (kind, f"This program is free software: you can redistribute it and/or modify it under the terms of the {words} as published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version."),
        )
    ),
    *(
        (f"CC-BY{short}-4.0", line)
        for short, long in (("", ""), ("-SA", "-ShareAlike"), ("-NC", "-NonCommercial"), ("-ND", "-NoDerivatives"), ("-NC-SA", "-NonCommercial-ShareAlike"), ("-NC-ND", "-NonCommercial-NoDerivatives"))
        for line in (f"Licensed under CC BY{short} 4.0.", f"This work is licensed under a Creative Commons Attribution{long} 4.0 International License.")
    ),
    ("All rights reserved", "All rights reserved."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)

# Words that say which licence it is. RIVALS are rare enough to tell of another licence wherever they stand.
RIVALS = frozenset(
    "apache mit bsd isc gnu gpl lgpl agpl lesser library affero mozilla mpl eclipse epl artistic boost zlib cc nc nd sa "
    "attribution noncommercial noderivatives noderivs sharealike unlicense unencumbered waived".split()
)
NAMING = RIVALS | frozenset(("general", "creative", "by"))
SHORT = 12  # words of a template of which none may miss that no other licence's template has

WORD = re.compile(r"[^\W_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _rising(places: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence of distinct numbers, by patience piles."""
    tops: list[int] = []
    pile: list[int] = []
    below: list[int] = []
    for i, place in enumerate(places):
        k = bisect_left(tops, place)
        tops[k : k + 1] = [place]
        pile[k : k + 1] = [i]
        below.append(pile[k - 1] if k else -1)
    out, i = [], pile[-1] if pile else -1
    while i >= 0:
        out.append(i)
        i = below[i]
    return out[::-1]


def align(text: list[str], template: list[str]) -> list[tuple[int, int]]:
    """Matched places (text, template), rising in both."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(text), 0, len(template))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and text[a] == template[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a >= b or c >= d:
            continue
        mine, its = Counter(text[a:b]), Counter(template[c:d])
        where = {w: i for i, w in enumerate(text[a:b], a) if mine[w] == 1}
        anchors = [(where[w], j) for j, w in enumerate(template[c:d], c) if its[w] == 1 and w in where]
        if not anchors:
            continue
        anchors = [anchors[i] for i in _rising([i for i, _ in anchors])]
        out += anchors
        ends = [(a - 1, c - 1), *anchors, (b, d)]
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(ends[:-1], ends[1:], strict=True)]
    return sorted(out)


class Scanner:
    """The templates, and where to look for each."""

    def __init__(self, templates: tuple[tuple[str, str], ...], least: float):
        self.templates = [(name, words_of(text)) for name, text in templates]
        least = Fraction(str(least))
        self.enough = [ceil(least * len(words)) for _, words in self.templates]
        spread = Counter(w for _, words in self.templates for w in set(words))
        owners: dict[str, set[str]] = defaultdict(set)
        for name, words in self.templates:
            for w in words:
                owners[w].add(name)
        self.needed: list[set[str]] = []
        self.keys: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, words) in enumerate(self.templates):
            naming = RIVALS if len(words) > SHORT else NAMING
            own = {w for w in words if len(words) <= SHORT and len(owners[w]) == 1}
            self.needed.append(own | {w for w in words if w in naming or w.isdigit()})
            rare = sorted(range(len(words)), key=lambda i: (spread[words[i]], -len(words[i]), i))
            sure = next((words[i] for i in rare if words[i] in self.needed[k] and not words[i].isdigit()), None)
            if sure is not None:
                rare = [i for i, w in enumerate(words) if w == sure]
            else:  # more rare words than a match may miss, so that a match always holds one of them
                rare = rare[: len(words) - self.enough[k] + 1]
            for i in rare:
                self.keys[words[i]].append((k, i))
        self.known = frozenset(self.keys)

    def names(self, k: int, words: list[str], begin: int, matched: list[tuple[int, int]]) -> bool:
        """Whether the match holds every word that names its licence, and none between that names another."""
        template = self.templates[k][1]
        if not self.needed[k] <= {template[j] for _, j in matched}:
            return False
        places = {i for i, _ in matched}
        between = [words[begin + i] for i in range(matched[0][0], matched[-1][0]) if i not in places]
        if self.templates[k][0] == "MIT" and "0" in between:  # another licence
            return False
        return not any(w in RIVALS - self.needed[k] for w in between)

    def scan(self, text: str) -> list[tuple[str, float, int, int, int]]:
        """License, coverage, first and last word, and matched words of every notice in the text."""
        words = words_of(text)
        found: list[tuple[str, float, int, int, int]] = []
        if self.known.isdisjoint(words):
            return found
        done: dict[int, int] = defaultdict(int)
        for place, word in enumerate(words):
            for k, at in self.keys.get(word, ()):
                if place < done[k]:
                    continue
                name, template = self.templates[k]
                slack = 2 + len(template) // 4
                begin = max(done[k], place - at - slack)
                matched = align(words[begin : place + len(template) - at + slack], template)
                if len(matched) >= self.enough[k] and self.names(k, words, begin, matched):
                    first, last = begin + matched[0][0], begin + matched[-1][0]
                    found.append((name, round(len(matched) / len(template), 4), first, last, len(matched)))
                    done[k] = last + 1
        found.sort(key=lambda f: (-f[4], f[2], f[0]))
        taken: list[tuple[str, float, int, int, int]] = []
        for f in found:
            if all(f[3] < t[2] or f[2] > t[3] for t in taken):
                taken.append(f)
        return sorted(taken, key=lambda f: f[2])


NOTICES = "array<struct<license:string,coverage:double,first_word:int,last_word:int,matched:int>>"


def scan(
    df: DataFrame, text: str, *, templates: tuple[tuple[str, str], ...] = TEMPLATES, least: float = 0.8, slice_bytes: int = 4 << 20
) -> DataFrame:
    """``df`` without the text, with ``notices``: what its notices cover of which licence's template, and where."""
    kept = [f for f in df.schema.fields if f.name not in {text, "notices"}]
    new = T.StructType([*kept, T.StructField("notices", T.DataType.fromDDL(NOTICES))])
    item = pa.struct([("license", pa.string()), ("coverage", pa.float64()), ("first_word", pa.int32()), ("last_word", pa.int32()), ("matched", pa.int32())])
    names = [f.name for f in item]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least)
        for batch in parts_of(batches, text, slice_bytes):
            found = [[dict(zip(names, n, strict=True)) for n in scanner.scan(t)] for t in texts_of(batch, text)]
            columns = [batch.column(batch.schema.get_field_index(f.name)) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(item))], names=new.names)

    return bounded_batches(df).mapInArrow(run, new)
