"""Licence texts in documents: a generalised suffix automaton of the templates'
words gives, for each word of a text, the longest template passage that ends there
(matching statistics); long matches are chained into covered template spans.

``scan`` works row by row inside Spark tasks: no shuffle, nothing kept between rows.
The automaton holds at most twice as many states as the templates have words; it
travels with the tasks, so templates and phrases beyond MAX_WORDS words are refused
(scan the same table with several lists and concatenate: the results of one
template do not depend on the others).

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case,
compared by 64-bit hashes. Only words that stand in a template reach the automaton;
any other word ends all matches.

* A match counts from MIN_MATCH words on, and is maximal to the right: the next word
  does not extend it.
* Matches of one template are chained in the order of both texts, with at most GAP
  words skipped on either side; words that two matches share count once.
* A chain is a span if it covers COVER of its template, or ENOUGH words of it. Spans of
  one template do not overlap: larger covers go first, then earlier starts.
* Phrases are found wherever their words stand one after the other.

Cases: a null text is empty and has no words; a null id is kept; repeated rows each
get their result; an empty table stays empty; other columns pass through, and those
called like a result are replaced. A text is handled whole, however long."""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm import textbuf

MIN_MATCH = 4
GAP = 8
COVER = 0.7
ENOUGH = 40
MAX_WORDS = 100_000

#: Phrases that name a licence, and their labels.
PHRASES = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]

#: Passages of public licences and the usual notices, with their labels.
TEMPLATES = [
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of
the Software."""),
    ("mit", "Released under the MIT License"),
    ("apache-2.0", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except
in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on
an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."""),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."""),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
that the following conditions are met: Redistributions of source code must retain the above copyright notice, this
list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright
notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("mpl-2.0", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of
the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
]

_CODES = np.arange(256)
#: True for bytes of words: digits, letters in lower case, and all bytes beyond ASCII.
_WORD = ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 97) & (_CODES <= 122)) | (_CODES >= 128)

_PLACE = T.StructType([T.StructField("label", T.StringType()), T.StructField("word", T.LongType())])
_SPAN = T.StructType([
    T.StructField("label", T.StringType()), T.StructField("template", T.IntegerType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("covered", T.LongType()), T.StructField("coverage", T.DoubleType())])
_OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(_PLACE)),
                     T.StructField("spans", T.ArrayType(_SPAN))])


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each word of a text column's bytes."""
    low = textbuf.LOWER[data]
    solid = _WORD[low]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    full = off[1:] > off[:-1]
    before[off[:-1][full]] = False
    after[off[1:][full] - 1] = False
    start, end = np.flatnonzero(solid & ~before), np.flatnonzero(solid & ~after) + 1
    return np.searchsorted(off, start, side="right") - 1, textbuf.span_hash(low, start, end)


def hashes(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    return words(data, np.array([0, len(data)]))[1].tolist()


class Automaton:
    """Suffix automaton of several word sequences (lists of hashes).

    ``step`` lists the transitions of a state, ``link`` its longest proper suffix that
    stands in other places too, ``size`` the length of its longest string."""

    def __init__(self, sequences: list[list[int]], phrases: list[list[int]]):
        self.vocabulary = np.unique(np.array([w for s in sequences + phrases for w in s], textbuf.U64))
        number = {w: i for i, w in enumerate(self.vocabulary.tolist())}
        self.step, self.link, self.size = [{}], [-1], [0]
        known = [[number[w] for w in s] for s in sequences + phrases]
        for s in known:
            last = 0
            for w in s:
                last = self._grow(last, w)
        self.ends: list[list[tuple[int, int]]] = [[] for _ in self.step]
        for t, s in enumerate(known[:len(sequences)]):
            state = 0
            for i, w in enumerate(s):
                state = self.step[state][w]
                self.ends[state].append((t, i + 1))
        self.below: list[list[int]] = [[] for _ in self.step]
        for state in range(1, len(self.step)):
            self.below[self.link[state]].append(state)
        own: dict[int, list[tuple[int, int]]] = {}
        for p, s in enumerate(known[len(sequences):]):
            state = 0
            for w in s:
                state = self.step[state][w]
            if s:
                own.setdefault(state, []).append((len(s), p))
        self.hits: list[tuple] = [()] * len(self.step)  # phrases that end wherever a state's strings end
        self.own = own
        for state in sorted(range(1, len(self.step)), key=self.size.__getitem__):
            up = self.link[state]
            self.hits[state] = self.hits[up] + tuple(own.get(up, ()))

    def _state(self, size: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.size.append(size)
        return len(self.step) - 1

    def _split(self, at: int, word: int) -> int:
        """The state of exactly the strings of ``at`` followed by ``word``."""
        target = self.step[at][word]
        if self.size[target] == self.size[at] + 1:
            return target
        part = self._state(self.size[at] + 1, dict(self.step[target]), self.link[target])
        self.link[target] = part
        while at != -1 and self.step[at].get(word) == target:
            self.step[at][word] = part
            at = self.link[at]
        return part

    def _grow(self, last: int, word: int) -> int:
        if word in self.step[last]:
            return self._split(last, word)
        new, at = self._state(self.size[last] + 1, {}, 0), last
        while at != -1 and word not in self.step[at]:
            self.step[at][word] = new
            at = self.link[at]
        if at != -1:
            self.link[new] = self._split(at, word)
        return new

    def places(self, state: int) -> list[tuple[int, int]]:
        """(template, end) of every place where the strings of a state end."""
        found, todo = [], [state]
        while todo:
            at = todo.pop()
            found += self.ends[at]
            todo += self.below[at]
        return found

    def stream(self, position: np.ndarray, word: np.ndarray):
        """Matches (start, end, state) of at least MIN_MATCH words, and (phrase, start) of every phrase.

        ``word`` holds the numbers of the known words of one text, ``position`` their places."""
        step, link, size, hits, own = self.step, self.link, self.size, self.hits, self.own
        matches, found = [], []
        state, length, last = 0, 0, -2
        for i, w in zip(position.tolist(), word.tolist()):
            if i != last + 1:
                if length >= MIN_MATCH:
                    matches.append((last + 1 - length, last + 1, state))
                state = length = 0
            elif w not in step[state]:
                if length >= MIN_MATCH:
                    matches.append((last + 1 - length, last + 1, state))
                while state and w not in step[state]:
                    state = link[state]
                    length = size[state]
            if w in step[state]:
                state, length = step[state][w], length + 1
                for n, p in hits[state]:
                    found.append((p, i + 1 - n))
                for n, p in own.get(state, ()):
                    if n <= length:
                        found.append((p, i + 1 - n))
            last = i
        if length >= MIN_MATCH:
            matches.append((last + 1 - length, last + 1, state))
        return matches, found


def chain(matches, automaton: Automaton, sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """(template, start, end, covered) of the spans that the matches of one text cover."""
    nodes: dict[int, list[list]] = {}  # per template: end, template end, covered, start, extended
    for start, end, state in matches:
        for t, t_end in automaton.places(state):
            t_start = t_end - (end - start)
            row = nodes.setdefault(t, [])
            best, before = end - start, None
            for j in range(len(row) - 1, -1, -1):
                other = row[j]
                if other[0] < start - GAP:
                    break
                if other[0] < end and other[1] < t_end and t_start - other[1] <= GAP:
                    gain = other[2] + min(end - max(start, other[0]), t_end - max(t_start, other[1]))
                    if gain > best:
                        best, before = gain, other
            if before is not None:
                before[4] = True
            row.append([end, t_end, best, before[3] if before else start, False])
    spans = []
    for t, row in sorted(nodes.items()):
        starts: list[int] = []
        ends: list[int] = []
        need = min(COVER * sizes[t], ENOUGH)
        for end, _, covered, start, _ in sorted((n for n in row if not n[4] and n[2] >= need), key=lambda n: (-n[2], n[3], n[0])):
            k = bisect_left(starts, start)
            if (k == 0 or ends[k - 1] <= start) and (k == len(starts) or starts[k] >= end):
                starts.insert(k, start)
                ends.insert(k, end)
                spans.append((t, start, end, covered))
    return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def scan(df: DataFrame, text: str = "text", templates=TEMPLATES, phrases=PHRASES, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with n_words, places and spans.

    ``templates`` and ``phrases`` are lists of (label, text). places holds (label, word) of
    every phrase, spans (label, template, start, end, covered, coverage): start and end are
    words from 0, end exclusive; covered counts the template's words that were found."""
    labels, marks = [x for x, _ in templates], [x for x, _ in phrases]
    bodies, heads = [hashes(t) for _, t in templates], [hashes(t) for _, t in phrases]
    if sum(map(len, bodies + heads)) > MAX_WORDS:
        raise ValueError(f"templates of over {MAX_WORDS} words in all: scan with several lists")
    automaton, sizes = Automaton(bodies, heads), [len(b) for b in bodies]
    kept = [c for c in (df.columns if keep is None else keep) if c not in _OUT.names]
    schema = T.StructType([df.schema[c] for c in kept] + _OUT.fields)
    place, span = (pa.struct([("label", pa.string()), ("word", pa.int64())]),
                   pa.struct([("label", pa.string()), ("template", pa.int32()), ("start", pa.int64()),
                              ("end", pa.int64()), ("covered", pa.int64()), ("coverage", pa.float64())]))

    def read(batches):
        vocabulary = automaton.vocabulary
        for batch in textbuf.chunks(batches, text):
            data, off = textbuf.buffers(batch.column(text))
            row, word = words(data, off)
            count = np.bincount(row, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(count)])
            at = np.minimum(np.searchsorted(vocabulary, word), max(len(vocabulary) - 1, 0))
            known = np.flatnonzero(vocabulary[at] == word) if len(vocabulary) else np.zeros(0, np.int64)
            cuts = np.searchsorted(known, first)
            places, spans = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for r in np.flatnonzero(cuts[1:] > cuts[:-1]).tolist():
                here = known[cuts[r]:cuts[r + 1]]
                matches, found = automaton.stream(here - first[r], at[here])
                places[r] = [{"label": marks[p], "word": w} for p, w in sorted(found, key=lambda f: (f[1], f[0]))]
                spans[r] = [{"label": labels[t], "template": t, "start": a, "end": b, "covered": c, "coverage": c / sizes[t]}
                            for t, a, b, c in chain(matches, automaton, sizes)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(count.astype(np.int64)), pa.array(places, pa.list_(place)),
                                                   pa.array(spans, pa.list_(span))], names=kept + _OUT.names)

    wanted = kept + ([] if text in kept else [text])
    return df.select(*wanted).mapInArrow(read, schema)
