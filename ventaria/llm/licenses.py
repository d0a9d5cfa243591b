"""License scans by patience alignment.

A template is looked for where its rarer words occur: each hit implies where the
template would begin, and every start that as many hits agree on as an occurrence
must hold is a candidate with a window of its own, so neighbouring notices stay
apart. The window is aligned with the template: equal ends are taken
off, the words unique to both sides become anchors, the longest increasing
subsequence of their places keeps the order, and the gaps between anchors are
aligned the same way. Anchors that stand too far from the others are dropped. The
share of template words aligned is the coverage; a text word belongs to one
occurrence of a template at most, the best aligned first.

One scan without a shuffle; work follows the number of hits. Words are runs of
letters and digits, lower-cased. Defined results: null and empty texts have no
licenses; every occurrence is reported, also repeated lines; other columns are
ignored; templates without words are left out.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ventaria.llm import text as T
from ventaria.llm.decontam import hashes_of

# Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with "
                         "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
                         "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
                         "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
                    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
                    "conditions and the following disclaimer.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                      "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                  "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                  "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "reserved": "All rights reserved.",
}
PLAIN = frozenset("a an and any are as at be by do for from in is it its may not of on or that the this to under use with you your work v 2 3 0".split())
OCCURRENCES = "doc_id long, license string, coverage double, n_aligned long, first_word long, last_word long"


def longest_rising(values: list[int]) -> list[int]:
    """Indexes of a longest strictly increasing subsequence, by patience piles."""
    tops: list[int] = []
    places: list[int] = []
    back: list[int] = []
    for k, value in enumerate(values):
        pile = bisect_left(tops, value)
        back.append(places[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            places.append(k)
        else:
            tops[pile], places[pile] = value, k
    chain, k = [], places[-1] if places else -1
    while k >= 0:
        chain.append(k)
        k = back[k]
    return chain[::-1]


def align(text: list[int], template: list[int]) -> list[tuple[int, int]]:
    """Aligned (text place, template place) pairs in rising order."""
    pairs, gaps = [], [(0, len(text), 0, len(template))]
    while gaps:
        a, b, c, d = gaps.pop()
        while a < b and c < d and text[a] == template[c]:
            pairs.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and text[b - 1] == template[d - 1]:
            b, d = b - 1, d - 1
            pairs.append((b, d))
        if a >= b or c >= d:
            continue
        ours, theirs = Counter(text[a:b]), Counter(template[c:d])
        place = {w: k for k, w in enumerate(text[a:b], a) if ours[w] == 1}
        shared = [(place[w], k) for k, w in enumerate(template[c:d], c) if theirs[w] == 1 and w in place]
        anchors = [shared[k] for k in longest_rising([p for p, _ in shared])]
        if anchors:
            pairs += anchors
            borders = [(a - 1, c - 1), *anchors, (b, d)]
            gaps += [(x + 1, u, y + 1, v) for (x, y), (u, v) in zip(borders, borders[1:])]
    return sorted(pairs)


def closest(pairs: list[tuple[int, int]], width: int) -> list[tuple[int, int]]:
    """The most pairs in a row that stand within ``width`` words of text; outlying ones are dropped."""
    best, low = (0, 0, 0), 0
    for high in range(len(pairs)):
        while pairs[high][0] - pairs[low][0] >= width:
            low += 1
        best = max(best, (high + 1 - low, -(pairs[high][0] - pairs[low][0]), low))
    return pairs[best[2]:best[2] + best[0]]


class Scanner:
    def __init__(self, templates: dict[str, str], least: float):
        self.least = least
        self.names = [n for n, t in templates.items() if any(c.isalnum() for c in t)]
        self.words = [w.tolist() for w in hashes_of([templates[n] for n in self.names])]
        plain = set(np.concatenate(hashes_of(sorted(PLAIN))).tolist())
        self.seeds: dict[int, list[tuple[int, int]]] = {}
        self.needed: list[int] = []  # seed words that an occurrence holds at least
        for k, words in enumerate(self.words):
            rare = [w for w in words if w not in plain] or words
            self.needed.append(max(1, math.ceil(least * len(words)) - sum(w not in rare for w in words)))
            for place, w in enumerate(words):
                if w in rare:
                    self.seeds.setdefault(w, []).append((k, place))
        self.keys = np.array(sorted(self.seeds), np.uint64)

    def find(self, hashes: np.ndarray, hits: np.ndarray) -> list[tuple[int, float, int, int, int]]:
        """(template, coverage, aligned, first, last) of every occurrence in one text; ``hits`` are places of seed words."""
        begins: dict[int, list[int]] = {}
        for at in hits.tolist():
            for k, place in self.seeds[int(hashes[at])]:
                begins.setdefault(k, []).append(at - place)
        found = []
        for k, starts in begins.items():
            found += [(k, len(pairs) / len(self.words[k]), len(pairs), pairs[0][0], pairs[-1][0])
                      for pairs in self.occurrences(hashes, k, np.sort(np.array(starts)))]
        return sorted(found, key=lambda x: (x[3], x[0]))

    def occurrences(self, hashes: np.ndarray, k: int, starts: np.ndarray) -> list[list[tuple[int, int]]]:
        """Aligned pairs of every occurrence of template ``k``, no text word in two of them.

        Every start that enough hits agree on, within the farthest an occurrence may be shifted, is a peak of its own;
        of peaks closer than ``step`` the one with the most votes is taken.
        """
        words = self.words[k]
        slack = max(2, len(words) // 6)
        step = max(1, slack // 2)
        far = slack + int((1 - self.least) * len(words)) + 1 + step
        value, votes = np.unique(starts, return_counts=True)
        near = np.searchsorted(starts, value + far, "right") - np.searchsorted(starts, value - far, "left")
        peaks: dict[int, tuple[int, int]] = {}
        for start, n in zip(value[near >= self.needed[k]].tolist(), votes[near >= self.needed[k]].tolist()):
            peaks[start // step] = max(peaks.get(start // step, (0, 0)), (n, -start))
        made, tally = [], Counter(words)
        for _, start in peaks.values():
            best: list[tuple[int, int]] = []
            wide = Counter(hashes[max(0, -start - far):max(0, -start + len(words) + far)].tolist())
            if sum(min(n, wide[w]) for w, n in tally.items()) < self.least * len(words):
                continue
            for margin in (0, slack, far):
                left = max(0, -start - margin)
                window = hashes[left:max(left, -start + len(words) + margin)].tolist()
                pairs = closest([(left + at, place) for at, place in align(window, words)], len(words) + slack)
                best = max(best, pairs, key=len)
                if len(best) == len(words):
                    break
            if len(best) >= self.least * len(words):
                made.append(best)
        made.sort(key=lambda pairs: (-len(pairs), pairs[-1][0] - pairs[0][0], pairs[0][0]))
        used: set[int] = set()
        kept = []
        for pairs in made:
            pairs = [pair for pair in pairs if pair[0] not in used]
            if len(pairs) >= self.least * len(words):
                used.update(at for at, _ in pairs)
                kept.append(pairs)
        return kept


def scan_licenses(docs: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    scanner = docs.sparkSession.sparkContext.broadcast(Scanner(templates, least))  # templates are a fixed parameter

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = scanner.value
        words = T.words_of(batch, T.ALNUM, lower=True)
        at = np.flatnonzero(np.isin(words.hashes, tool.keys))
        rows = []
        if len(at):
            text = np.searchsorted(words.first, at, "right") - 1
            for k in np.unique(text).tolist():
                low, high = words.first[k], words.first[k + 1]
                rows += [(k, *made) for made in tool.find(words.hashes[low:high], at[text == k] - low)]
        columns = list(zip(*rows)) or [()] * 6
        return T.named_batch(doc_id=batch.column("doc_id").take(pa.array(columns[0], pa.int64())),
                             license=pa.array([tool.names[n] for n in columns[1]], pa.string()),
                             coverage=pa.array(columns[2], pa.float64()), n_aligned=pa.array(columns[3], pa.int64()),
                             first_word=pa.array(columns[4], pa.int64()), last_word=pa.array(columns[5], pa.int64()))

    return T.scan(T.id_and_text(docs), step, OCCURRENCES)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(T.documents(spark, sf_dir))
