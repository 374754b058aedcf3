"""Licence scans with a generalised suffix automaton of licence words.

All phrases and templates go, word by word, into one suffix automaton. A text
streams through it and yields at each word the longest run of words that ends
there and stands in some template (matching statistics). Phrases are read off
the states passed; the runs that cannot be made longer are matches. Matches of
a template that lie close together, in the same order in text and template, are
chained to the chain that covers most words of the template. Only stretches
whose pairs of neighbouring words occur in templates are streamed: elsewhere
no run has two words.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayledger.llm.words import ALNUM, Words, buffers, find_words, pieces

# Phrases that name a licence.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Public licence notices.
TEMPLATES = {
    "agpl": "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "apache": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
    "either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "cc-by": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "licensed under CC BY-NC 4.0",
    "cc-by-sa": "licensed under CC BY-SA 4.0",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
    "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or "
    "FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
    "that the above copyright notice and this permission notice appear in all copies.",
    "lgpl": "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
    "Software Foundation",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
    '(the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
    "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
    "subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
    "with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
    "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
    "non-commercial, and by any means.",
}


def words_of(text: str) -> list[bytes]:
    found = find_words(*buffers(pa.array([text])), lower=True, letters=ALNUM)
    return [found.data[a:b].tobytes() for a, b in zip(found.starts, found.ends, strict=True)]


@dataclass
class State:
    length: int  # of its longest run
    link: int  # state of the longest run that is a proper end of it and stands in more places
    next: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (template, words up to its end) of all places
    phrases: list[tuple[int, str]] = field(default_factory=list)  # (words, label) of the phrases it ends with


class Automaton:
    """Suffix automaton of several word lists. Sequences 0 to n-1 are the templates, the phrases follow."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.labels = sorted(templates)
        texts = [words_of(templates[k]) for k in self.labels] + [words_of(p) for p in phrases]
        self.sizes = [len(t) for t in texts]
        self.vocabulary = sorted({w for t in texts for w in t})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.pairs = np.zeros((len(number) + 1,) * 2, bool)  # its last row and column stand for other words
        self.states = [State(0, -1)]
        marks = []
        for k, words in enumerate(texts):
            at = 0
            for i, w in enumerate(words):
                at = self._add(at, number[w])
                marks.append((at, (k, i + 1)))
                if i:
                    self.pairs[number[words[i - 1]], number[w]] = True
        for at, place in marks:  # a place of a run is one of all its ends
            while at > 0:
                self.states[at].ends.append(place)
                at = self.states[at].link
        named = {}
        for words, label in zip(texts[len(self.labels) :], phrases.values(), strict=True):
            at = 0
            for w in words:
                at = self.states[at].next[number[w]]
            named.setdefault(at, []).append((len(words), label))
        for at, state in enumerate(self.states):
            while at > 0:
                state.phrases.extend(named.get(at, ()))
                at = self.states[at].link
        known = find_words(*buffers(pa.array([" ".join(w.decode() for w in self.vocabulary)])), letters=ALNUM).hashes()
        self.order = np.argsort(known)
        self.known = known[self.order]

    def _add(self, last: int, word: int) -> int:
        """The state of the run of ``last`` with one more word."""
        states = self.states
        if word in states[last].next:
            q = states[last].next[word]
            return q if states[q].length == states[last].length + 1 else self._split(last, q, word)
        new = len(states)
        states.append(State(states[last].length + 1, 0))
        while last >= 0 and word not in states[last].next:
            states[last].next[word] = new
            last = states[last].link
        if last >= 0:
            q = states[last].next[word]
            states[new].link = q if states[q].length == states[last].length + 1 else self._split(last, q, word)
        return new

    def _split(self, last: int, q: int, word: int) -> int:
        """A state for the shorter runs of ``q``, those that end with ``last`` and the word."""
        states = self.states
        copy = len(states)
        states.append(State(states[last].length + 1, states[q].link, dict(states[q].next)))
        states[q].link = copy
        while last >= 0 and states[last].next.get(word) == q:
            states[last].next[word] = copy
            last = states[last].link
        return copy

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """At each word the state and length of the longest run of a template that ends there."""
        at, length = 0, 0
        for w in words:
            while at and w not in self.states[at].next:
                at = self.states[at].link
                length = self.states[at].length
            if w in self.states[at].next:
                at, length = self.states[at].next[w], length + 1
            yield at, length

    def numbers(self, words: Words) -> np.ndarray:
        """Vocabulary number of each word; those outside have the number after the last."""
        hashes = words.hashes()
        at = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        return np.where(self.known[at] == hashes, self.order[at], len(self.known))

    def stretches(self, words: Words) -> Iterator[tuple[int, list[int]]]:
        """First word and vocabulary numbers of the stretches of neighbours that also are neighbours in a template."""
        number = self.numbers(words)
        linked = self.pairs[number[:-1], number[1:]] if len(number) else np.zeros(0, bool)
        inner = words.first[1:-1]
        linked[inner[(inner > 0) & (inner < len(number))] - 1] = False
        edge = np.diff(np.concatenate([[0], linked.astype(np.int8), [0]]))
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
            found = number[a : b + 1].tolist()
            # equal hashes are equal words, but for a chance that is looked at here
            same = [words.data[words.starts[a + k] : words.ends[a + k]].tobytes() == self.vocabulary[w] for k, w in enumerate(found)]
            yield a, [w if ok else len(self.vocabulary) for w, ok in zip(found, same, strict=True)]


def best_chain(matches: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """(covered words, first and last text word) of the chain that covers most; matches are (text start, template start, words).

    Matches of a chain follow each other without overlap in text and template; ties go to the chain that ends first, then starts last.
    """
    # fronts: the best chains so far by template end, rising in both; a match joins them once the text has passed it
    ends, chains, waiting, best = [0], [(0, 0)], [], (0, 0, 0)
    for at, of, n in sorted(matches):
        while waiting and waiting[0][0] <= at:
            _, end, covered, begin = heappop(waiting)
            k = bisect_right(ends, end)
            if covered > chains[k - 1][0]:
                stop = k
                while stop < len(ends) and chains[stop][0] <= covered:
                    stop += 1
                ends[k:stop], chains[k:stop] = [end], [(covered, begin)]
        covered, begin = chains[bisect_right(ends, of) - 1]
        begin = begin if covered else at
        best = max(best, (covered + n, -(at + n - 1), begin))
        heappush(waiting, (at + n, of + n, covered + n, begin))
    return best[0], best[2], -best[1]


def scan_licences(docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None, least: int = 4,
                  covered: float = 0.5, covered_words: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, places (structs of label and start: each place of a phrase), spans (structs of label, start, end,
    covered: the best chain of each template, by label), score (greatest covered share, 1 where a phrase stands).

    Texts are lower-cased in A-Z; words are runs of letters a-z, digits and characters outside ASCII. A match has at least
    ``least`` words. A chain is a span if it covers the share ``covered`` of its template and ``covered_words`` words, or all
    of a template that is shorter. Matches further apart than the template is long are not chained. A null text is empty: no
    words, no places, score 0. Rows are worked on one by one, equal rows and ids too; other columns do not take part.
    """
    automaton = Automaton(TEMPLATES if templates is None else templates, PHRASES if phrases is None else phrases)

    def chains(matches: dict[int, list[tuple[int, int, int]]]) -> tuple[list[dict], float]:
        spans, score = [], 0.0
        for k in sorted(matches):
            size, groups, reach = automaton.sizes[k], [], -1
            for m in sorted(matches[k]):
                if not groups or m[0] > reach + size:
                    groups.append([])
                groups[-1].append(m)
                reach = max(reach, m[0] + m[2])
            n, begin, end = max((best_chain(g) for g in groups), key=lambda c: (c[0], -c[1]))
            score = max(score, n / size)
            if n >= min(size, max(covered_words, covered * size)):
                spans.append({"label": automaton.labels[k], "start": begin, "end": end + 1, "covered": n / size})
        return spans, score

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in pieces(whole, "text"):
                words = find_words(*buffers(b.column("text")), lower=True, letters=ALNUM)
                places, matches = [[] for _ in range(b.num_rows)], [{} for _ in range(b.num_rows)]
                for first, numbers in automaton.stretches(words):
                    d = int(np.searchsorted(words.first, first, "right")) - 1
                    first -= int(words.first[d])
                    seen = [*automaton.statistics(numbers), (0, 0)]
                    for i, (at, length) in enumerate(seen[:-1]):
                        state = automaton.states[at]
                        places[d].extend({"label": label, "start": first + i + 1 - n} for n, label in state.phrases if n <= length)
                        if seen[i + 1][1] <= length:  # no run goes on with the next word
                            for k, end in state.ends:
                                if k < len(automaton.labels) and length >= min(least, automaton.sizes[k]):
                                    matches[d].setdefault(k, []).append((first + i + 1 - length, end - length, length))
                found = [chains(m) if m else ([], 0.0) for m in matches]
                yield pa.RecordBatch.from_arrays(
                    [b.column("id"), pa.array(words.counts, pa.int64()),
                     pa.array(places, pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))),
                     pa.array([s for s, _ in found], pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("covered", pa.float64())]))),
                     pa.array([1.0 if p else s for p, (_, s) in zip(places, found, strict=True)], pa.float64())],
                    names=["id", "n_words", "places", "spans", "score"],
                )

    kind = docs.schema[key].dataType.simpleString()
    schema = f"id {kind}, n_words long, places array<struct<label:string,start:long>>, spans array<struct<label:string,start:long,end:long,covered:double>>, score double"
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(scan, schema).withColumnRenamed("id", key)


def licence_report(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    base = F.col("places.label")
    return scan_licences(docs).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.start").alias("first_word"), F.array_max("places.start").alias("last_word"),
        listed(base).alias("base_labels"), listed(F.concat(base, F.col("spans.label"))).alias("labels"), "score",
    )
