"""Licence notices in texts, found and measured by patience alignment with templates.

A place in a text is worth aligning if a window of twice the template's length holds enough of
the template's words; an alignment cannot match more words than stand there, so nothing above the
wanted coverage is missed. There, words that occur once in the text and once in the
template are anchors; the longest increasing subsequence of their places is kept, and the
gaps between anchors are aligned the same way, down to equal words at the gaps' edges. Coverage
is the share of the template's words that are matched.

Words are runs of letters and digits in lower case.

Defined results: null and empty texts have no notices; of places that overlap the best coverage
stays (the longer template, then the earlier id, where two tie); a template without words is
left out; repeated rows give repeated results; columns other than ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import blocks, folded_words, word_hashes
from millrace.llm.settings import tuned

LEAST = 0.7

# Wordings of public licence notices.
TEMPLATES = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "mit-line": "Released under the MIT License.",
    "cc-by-nc-4.0-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-4.0-line": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-line": "Licensed under CC BY-SA 4.0.",
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
        "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
        "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, "
        "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom "
        "the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission "
        "notice shall be included in all copies or substantial portions of the Software."
    ),
    "bsd-2-clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and "
        "the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions "
        "and the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    "gpl-3.0": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. "
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Matched places of two word lists, in order."""
    out: list[tuple[int, int]] = []
    gaps = [(0, len(a), 0, len(b))]
    while gaps:
        a0, a1, b0, b1 = gaps.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        once_a, once_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        place = {w: j for j, w in enumerate(b[b0:b1], b0) if once_b[w] == 1}
        anchors = [(i, place[w]) for i, w in enumerate(a[a0:a1], a0) if once_a[w] == 1 and w in place]
        kept = _increasing(anchors)
        if not kept:
            continue
        out += kept
        for (i, j), (p, q) in zip([(a0 - 1, b0 - 1), *kept], [*kept, (a1, b1)]):
            gaps.append((i + 1, p, j + 1, q))
    return sorted(out)


def _increasing(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of pairs that rises in both places: patience sorting with links back."""
    tops: list[int] = []
    ends: list[int] = []
    back: list[int] = []
    for at, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        back.append(ends[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(j)
            ends.append(at)
        else:
            tops[pile], ends[pile] = j, at
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(pairs[at])
        at = back[at]
    return out[::-1]


class Templates:
    """Templates as word hashes, with the words each of them needs."""

    def __init__(self, texts: Mapping[str, str], least: float):
        self.names, self.words, self.least = [], [], least
        for name in sorted(texts):
            raw = np.frombuffer(texts[name].encode(), np.uint8)
            words = folded_words(raw, np.array([0, len(raw)]))
            if len(words.starts):
                self.names.append(name)
                self.words.append(word_hashes(words.data, words.starts, words.ends))
        self.all = np.unique(np.concatenate([*self.words, np.zeros(0, np.uint64)]))
        self.has = np.stack([np.isin(self.all, w) for w in self.words]) if self.words else np.zeros((0, 0), bool)

    def find(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, float, int, int]]:
        """(text, template, matched, coverage, first word, word after the last) in a block of texts."""
        if not len(self.all) or not len(hashes):
            return []
        at = np.searchsorted(self.all, hashes).clip(max=len(self.all) - 1)
        places = np.flatnonzero(self.all[at] == hashes)
        words = at[places]
        text = np.searchsorted(first, places, "right") - 1
        out = []
        for t, template in enumerate(self.words):
            m = len(template)
            need, reach = int(np.ceil(self.least * m)), 2 * m
            own = self.has[t][words]
            spot, home = places[own], text[own]
            if len(spot) < need:
                continue
            far = np.minimum(spot + reach, first[home + 1])
            held = np.searchsorted(spot, far) - np.arange(len(spot))
            begin = np.flatnonzero(held >= need)
            target = template.tolist()
            done = -1
            for i in begin.tolist():
                if spot[i] < done:
                    continue
                a, b = int(spot[i]), int(far[i])
                pairs = patience(target, hashes[a:b].tolist())
                while pairs and pairs[0][1]:  # stray words came first: look again from the first match on
                    a += pairs[0][1]
                    b = int(min(a + reach, first[home[i] + 1]))
                    pairs = patience(target, hashes[a:b].tolist())
                if len(pairs) >= need:
                    low, high = a + pairs[0][1], a + pairs[-1][1] + 1
                    out.append((int(home[i]), t, len(pairs), len(pairs) / m, low - int(first[home[i]]), high - int(first[home[i]])))
                    done = high
        return out


def _best(found: list[tuple]) -> list[tuple]:
    """Of overlapping places the best covered one, in order of place."""
    kept: list[tuple] = []
    for f in sorted(found, key=lambda f: (-f[3], -f[2], f[1], f[4])):
        if not any(f[4] < k[5] and k[4] < f[5] for k in kept):
            kept.append(f)
    return sorted(kept, key=lambda f: f[4])


def notices(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, least: float = LEAST) -> DataFrame:
    """(doc_id, license, coverage, first_word, end_word, passage): every notice in every text."""
    shared = tuned(docs.sparkSession).sparkContext.broadcast(Templates(templates, least))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for rows, data, offsets in blocks(batches, "text"):
            words = folded_words(data, offsets)
            by_text: dict[int, list] = {}
            for f in known.find(word_hashes(words.data, words.starts, words.ends), words.first):
                by_text.setdefault(f[0], []).append(f)
            out = []
            for i in sorted(by_text):
                for _, t, _, coverage, low, high in _best(by_text[i]):
                    a, b = words.starts[words.first[i] + low], words.ends[words.first[i] + high - 1]
                    out.append((i, known.names[t], coverage, low, high, data[a:b].tobytes().decode("utf-8", "replace")))
            i, *columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.string(), pa.float64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.record_batch([rows.column("doc_id").take(pa.array(i, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                  ["doc_id", "license", "coverage", "first_word", "end_word", "passage"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(apply, "doc_id bigint, license string, coverage double, first_word bigint, end_word bigint, passage string")
