"""Licence scans with a generalised suffix automaton (operator 2).

Texts are words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` with A-Z lower-cased. The templates
(``TEMPLATES``) make one suffix automaton over word numbers. A document streams through it:
at each word the automaton knows the longest run of words ending there that occurs in a
template (matching statistics). Runs that can't be extended and have at least ``MIN_MATCH``
words are matches, with all their places in the templates. Matches of one template that go
on in the same order, with at most ``MAX_GAP`` words between them, are chained into spans; a
span's coverage is the share of the template's words it holds. A template whose best span
covers ``MIN_COVER`` of it, with ``MIN_WORDS`` words or more, gives its label. The score is the
best coverage of any span, 1 for a template in full, 0 without a match.

Base phrases (``PHRASES``) are places where their words stand consecutively; their labels stay
whatever the method says.

Defined results: a null text is empty and has no word, label or place, and score 0; texts are
read whole; repeated rows are scanned alike; an empty table gives an empty result; extra
columns do not matter.
"""

from __future__ import annotations

from bisect import insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import doc_id_of, documents, ship, text_of

#: The phrases of the contract and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

#: Words of public licences (grants and notices), by label.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                 "in compliance with the License. You may obtain a copy of the License at "
                 "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                 "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                 "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                 "language governing permissions and limitations under the License."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation, either version 3 of the License, "
              "or (at your option) any later version."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
              "General Public License as published by the Free Software Foundation; either version 2 of the License, "
              "or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the "
              "MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or "
                  "as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International "
                 "License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)
MIN_MATCH = 4
MAX_GAP = 8
MIN_COVER = 0.6
MIN_WORDS = 5
#: Word characters stay (A-Z lower-cased); all others become spaces.
WORD_CHARS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_CHARS).split()


class Automaton:
    """Generalised suffix automaton of the templates' words, with places of long factors."""

    def __init__(self, templates: list[list[int]], shortest: int):
        self.step: list[dict[int, int]] = [{}]
        self.link, self.size = [-1], [0]
        ends: list[set[tuple[int, int]]] = [set()]
        for number, template in enumerate(templates):
            last = 0
            for i, word in enumerate(template):
                last = self._grow(last, word, ends)
                ends[last].add((number, i + 1))
        # A state's places are those of all states that link to it.
        for s in sorted(range(1, len(self.size)), key=lambda s: -self.size[s]):
            if self.size[self.link[s]] >= shortest:
                ends[self.link[s]] |= ends[s]
        self.places = [sorted(e) for e in ends]

    def _new(self, size: int, step: dict[int, int], link: int, ends: list) -> int:
        self.step.append(step)
        self.size.append(size)
        self.link.append(link)
        ends.append(set())
        return len(self.size) - 1

    def _split(self, p: int, word: int, q: int, ends: list) -> int:
        """The state of the longest factor ending at p, then ``word``, of which q holds more."""
        if self.size[q] == self.size[p] + 1:
            return q
        twin = self._new(self.size[p] + 1, dict(self.step[q]), self.link[q], ends)
        self.link[q] = twin
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = twin
            p = self.link[p]
        return twin

    def _grow(self, last: int, word: int, ends: list) -> int:
        if word in self.step[last]:
            return self._split(last, word, self.step[last][word], ends)
        new = self._new(self.size[last] + 1, {}, 0, ends)
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, word, self.step[p][word], ends)
        return new

    def matches(self, words: list[int], shortest: int):
        """(first word, words, places) of each run of the stream that can't be extended."""
        state = length = 0
        for i, word in enumerate(words):
            before, held = state, length
            while state and word not in self.step[state]:
                state = self.link[state]
                length = self.size[state]
            if word in self.step[state]:
                state, length = self.step[state][word], length + 1
            if length <= held and held >= shortest:
                yield i - held, held, self._at(before, held)
        if length >= shortest:
            yield len(words) - length, length, self._at(state, length)

    def _at(self, state: int, length: int):
        return [(t, end - length) for t, end in self.places[state]]


def scanner():
    """Word numbers, automaton, template sizes and labels."""
    numbers: dict[bytes, int] = {}
    templates = [[numbers.setdefault(w, len(numbers)) for w in words_of(text.encode())] for _, text in TEMPLATES]
    return numbers, Automaton(templates, MIN_MATCH), [len(t) for t in templates], [label for label, _ in TEMPLATES]


def chained(found: list[tuple[int, int, int]], gap: int = MAX_GAP) -> int:
    """Template words that the best chain of (place, template place, words) covers."""
    best = 0
    covers: list[tuple[int, int, int]] = []  # (end, template end, covered), by end
    for at, own, n in sorted(found):
        most = n
        for end, other, c in reversed(covers):
            if end < at - gap:
                break
            over = max(0, end - at, other - own)
            if own >= other - over and own - other <= gap and over < n:
                most = max(most, c + n - over)
        insort(covers, (at + n, own + n, most))
        best = max(best, most)
    return best


def scan(text: bytes, templates):
    """With ``scanner()``'s result: (words, places of phrases, first and last word of them, base labels, labels, score)."""
    numbers, automaton, sizes, names = templates
    words = words_of(text)
    joined = b" " + b" ".join(words) + b" "
    base, starts = set(), []
    for phrase, label in PHRASES:
        wanted, at = f" {phrase} ".encode(), -1
        while (at := joined.find(wanted, at + 1)) >= 0:
            base.add(label)
            starts.append(joined.count(b" ", 0, at))
    known = np.fromiter((numbers.get(w, -1) for w in words), np.int64, len(words))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known >= 0, [False]]).astype(np.int8)))
    per: dict[int, list[tuple[int, int, int]]] = {}
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if b - a >= MIN_MATCH:
            for at, n, places in automaton.matches(known[a:b].tolist(), MIN_MATCH):
                for t, own in places:
                    per.setdefault(t, []).append((a + at, own, n))
    labels, score = set(base), 0.0
    for t, found in per.items():
        covered = min(chained(found), sizes[t])
        score = max(score, covered / sizes[t])
        if covered >= MIN_WORDS and covered >= MIN_COVER * sizes[t]:
            labels.add(names[t])
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score)


def licences(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score."""
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def work(batches):
        templates = scanner()
        for batch in batches:
            cols = list(zip(*(scan(t.as_py(), templates) for t in batch.column(1)))) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["doc_id", *names])

    rows = docs.select(doc_id_of(docs).alias("doc_id"), text_of(docs).cast("binary").alias("text"))
    return rows.mapInArrow(work, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                 "base_labels string, labels string, score double")


def op2_licence_scan(spark, sf_dir):
    """Query: licence phrases, labels and scores of all documents."""
    return licences(documents(spark, sf_dir))


ship(__name__)
