"""License scans: a generalised suffix automaton over the words of licence templates.

Each document's words stream through the automaton, which yields matching statistics (the longest
stretch of words, ending here, that occurs in some template). From them follow, for every template and all its places,
the maximal stretches that it shares with the text. They are chained into covered
spans of a template: a chain's stretches stand in the same order in the template and in the text and share no
word of either, and of all chains those that cover most are taken. A template is reported if a chain covers enough of it,
unless its span lies within the span of a template that is covered better: in more words, or in as many and a larger share of it
(a licence's name in a longer one).
Only runs of words that templates know are streamed: any other word resets the automaton.

The places of a state are those of all states below it, one stretch of a tour of the tree of links, so
the automaton takes memory linear in the templates, however often they repeat themselves.

Defined results: a null or empty text has no words, no places, score 0 and empty labels; repeated
rows and doc_ids are scanned each by itself; no rows give no rows; other columns stay untouched.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Mapping
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.scratch import small_batches
from loamline.llm.text import alnum_ascii, by_slices, words_of

#: Phrases of the base scan and the labels that they carry.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices by which licences are usually declared; a parameter of the scan.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version",
    ],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "cc-by-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "cc0-1.0": ["To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"],
    "lgpl-3.0": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "agpl-3.0": ["You can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    ],
    "mpl-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
    "epl-2.0": ["This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"],
    "zlib": ["This software is provided as-is, without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software"],
    "boost-1.0": ["Distributed under the Boost Software License, Version 1.0"],
    "unlicense": ["This is free and unencumbered software released into the public domain"],
}

_SPAN = pa.struct([("template", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("coverage", pa.float64())])
_STRUCT = pa.struct(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()), ("spans", pa.list_(_SPAN)),
    ]
)
_DDL = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:array<string>,labels:array<string>,"
    "score:double,spans:array<struct<template:int,first_word:bigint,last_word:bigint,coverage:double>>>"
)


class SuffixAutomaton:
    """All stretches of several word sequences, with the places where each stretch occurs."""

    def __init__(self) -> None:
        self.length, self.link, self.next = [0], [-1], [{}]
        #: Of each state the places (sequence, end) of the prefixes that it stands for.
        self.own: list[list[tuple[int, int]]] = [[]]

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        self.own.append([])
        return len(self.length) - 1

    def _extend(self, last: int, word: int) -> int:
        if (q := self.next[last].get(word)) is not None:  # another sequence has this prefix's stretch
            if self.length[q] == self.length[last] + 1:
                return q
            return self._split(last, q, word)
        cur = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][word]
            self.link[cur] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, word)
        return cur

    def _split(self, p: int, q: int, word: int) -> int:
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words: list[int], number: int) -> None:
        """Insert sequence ``number``; each of its prefixes ends at a state."""
        last = 0
        for at, word in enumerate(words):
            last = self._extend(last, word)
            self.own[last].append((number, at))

    def finish(self) -> None:
        """Lay all places out in the order of a tour of the links, where each state's are ``tour[begin:end]``."""
        below: list[list[int]] = [[] for _ in self.length]
        for v in range(1, len(self.length)):
            below[self.link[v]].append(v)
        self.tour, self.begin, self.end = [], [0] * len(self.length), [0] * len(self.length)
        stack = [0]
        while stack:
            v = stack.pop()
            if v < 0:
                self.end[~v] = len(self.tour)
                continue
            self.begin[v] = len(self.tour)
            self.tour += self.own[v]
            stack.append(~v)
            stack += below[v]

    def stretches(self, state: int, now: int, shortest: int) -> Iterator[tuple[int, int, int]]:
        """(sequence, end, words): at every place that shares at least ``shortest`` words with the ``now`` last ones, how many it shares."""
        done = (self.begin[state],) * 2
        while now >= shortest:
            for at in chain(range(self.begin[state], done[0]), range(done[1], self.end[state])):
                yield (*self.tour[at], now)
            done = self.begin[state], self.end[state]
            state = self.link[state]
            now = self.length[state]

    def statistics(self, words: list[int]) -> tuple[list[int], list[int]]:
        """Matching statistics: per word the state and the length of the longest stretch that ends there."""
        length, link, following = self.length, self.link, self.next
        state, now, states, lengths = 0, 0, [], []
        for word in words:
            to = following[state].get(word)
            while to is None and state > 0:
                state = link[state]
                now = length[state]
                to = following[state].get(word)
            if to is None:
                state = now = 0
            else:
                state, now = to, now + 1
            states.append(state)
            lengths.append(now)
        return states, lengths


class Scanner:
    """Scans texts for templates and base phrases in one pass of one automaton."""

    def __init__(self, templates: Mapping[str, list[str]], phrases: Mapping[str, str], *, shortest: int = 3, cover: float = 0.8) -> None:
        self.vocabulary: dict[str, int] = {}
        self.automaton, self.sequences, self.names, self.phrase = SuffixAutomaton(), [], [], {}
        self.shortest, self.cover = shortest, cover
        listed = [(label, text, False) for label, texts in templates.items() for text in texts] + [(label, text, True) for text, label in phrases.items()]
        for label, text, base in listed:
            w = words_of(alnum_ascii(pa.array([text])))
            names = w.names.to_pylist()
            ids = [self.vocabulary.setdefault(names[i], len(self.vocabulary)) for i in w.ids]
            if base:
                self.phrase[len(self.sequences)] = label
            self.automaton.add(ids, len(self.sequences))
            self.sequences.append(ids)
            self.names.append(label)
        #: Per state the phrases that end there, with their lengths: its own and those that its links know.
        self.phrase_ends = [[(s, at + 1) for s, at in sorted(own) if s in self.phrase and at == len(self.sequences[s]) - 1] for own in self.automaton.own]
        for v in sorted(range(1, len(self.phrase_ends)), key=self.automaton.length.__getitem__):
            self.phrase_ends[v] += self.phrase_ends[self.automaton.link[v]]
        self.automaton.finish()
        self.shortest_run = min([2, shortest, *(len(self.sequences[s]) for s in self.phrase)])

    def scan_run(self, words: list[int], start: int, places: list, matches: list) -> None:
        """Adds base places (start, label) and maximal stretches (template, first in template, first in text, length)."""
        states, lengths = self.automaton.statistics(words)
        for i, (v, n) in enumerate(zip(states, lengths, strict=True)):
            for s, k in self.phrase_ends[v]:
                if k <= n:
                    places.append((start + i - k + 1, self.phrase[s]))
            if n >= self.shortest:
                after = words[i + 1] if i + 1 < len(words) else -1
                for s, at, k in self.automaton.stretches(v, n, self.shortest):
                    sequence = self.sequences[s]
                    if s not in self.phrase and (at + 1 == len(sequence) or sequence[at + 1] != after):  # else it goes on
                        matches.append((s, at + 1 - k, start + i - k + 1, k))

    def chains(self, matches: list) -> list[tuple[int, int, int, float]]:
        """Spans (template, first word, last word, covered share) of the chains that cover most, which share no words of the text."""
        found = []
        by: dict[int, set] = {}
        for s, a, b, n in matches:
            by.setdefault(s, set()).add((b, a, n))
        for s, listed in by.items():
            found += _spans(s, sorted(listed), len(self.sequences[s]), self.shortest)
        return found

    def scan(self, text: pa.Array) -> pa.Array:
        """The result struct of each of the null-free texts."""
        w = words_of(alnum_ascii(text))
        known = np.array([self.vocabulary.get(x, -1) for x in _in_vocabulary(w.names, self.vocabulary)], np.int64)
        ids = known[w.ids] if len(w.ids) else np.zeros(0, np.int64)
        # runs of known words that stay inside one text
        edge = np.zeros(len(ids) + 1, bool)
        edge[w.offsets] = True
        inside = ids >= 0
        begins = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1]))))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))) + 1
        long = ends - begins >= self.shortest_run
        begins, ends = begins[long], ends[long]
        owner = np.searchsorted(w.offsets, begins, "right") - 1
        n = len(text)
        out: dict[int, tuple[list, list]] = {}
        for b, e, doc in zip(begins.tolist(), ends.tolist(), owner.tolist(), strict=True):
            places, matches = out.setdefault(doc, ([], []))
            self.scan_run(ids[b:e].tolist(), b - int(w.offsets[doc]), places, matches)
        rows = [self._result(int(k), *out.get(i, ((), ()))) for i, k in enumerate(w.counts)]
        return pa.array(rows, _STRUCT) if n else pa.array([], _STRUCT)

    def _outermost(self, spans: list[tuple[int, int, int, float]]) -> list[tuple[int, int, int, float]]:
        """The spans that lie in no span of which more words, or as many and a larger share of the template, are covered."""
        sized = sorted((((-round(x[3] * len(self.sequences[x[0]])), -x[3]), x) for x in spans))
        firsts, lasts, kept = [], [], []  # spans none of which lies in another, in order
        for _, same in groupby(sized, key=lambda x: x[0]):
            free = []
            for _, x in same:
                at = bisect_right(firsts, x[1])
                if not at or lasts[at - 1] < x[2]:
                    free.append(x)
            kept += free
            for _, first, last, _ in free:
                at = bisect_right(firsts, first)
                if at and lasts[at - 1] >= last:
                    continue
                at = bisect_left(firsts, first)
                to = bisect_right(lasts, last)
                firsts[at:to], lasts[at:to] = [first], [last]
        return kept

    def _result(self, n_words: int, places, matches) -> dict:
        spans = self.chains(matches) if matches else []
        base = sorted({label for _, label in places})
        starts = [at for at, _ in places]
        kept = self._outermost([x for x in spans if x[3] >= self.cover])
        labels = sorted({*base, *(self.names[s] for s, *_ in kept)})
        return {
            "n_words": n_words, "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": base, "labels": labels, "score": min(1.0, max((x[3] for x in spans), default=0.0)),
            "spans": [{"template": s, "first_word": a, "last_word": b, "coverage": c} for s, a, b, c in sorted(kept, key=lambda x: x[1:3])],
        }


def _spans(template: int, stretches: list[tuple[int, int, int]], size: int, shortest: int) -> list[tuple[int, int, int, float]]:
    """Chains over (place in the text, place in the template, words), sorted: the best first, then the best of those that share no words of the text with it.

    A chain goes on to a stretch that begins behind its last one in both, at most a template's length further on in the text;
    where two overlap, the end of the first and then the start of the second are cut, and ``shortest`` words of each must be left.
    """
    b, a, n = (np.array(x, np.int64) for x in zip(*stretches, strict=True))
    covered, left, before, back = n.copy(), n.copy(), [-1] * len(stretches), 0
    for j in range(1, len(stretches)):
        while b[j] - b[back] > 2 * size:  # stretches are no longer than the template: none further back is near enough
            back += 1
        i = slice(back, j)
        ends, ends_there = b[i] + n[i], a[i] + n[i]
        shared = np.maximum(np.maximum(ends - b[j], ends_there - a[j]), 0)
        goes_on = (b[i] < b[j]) & (a[i] < a[j]) & (n[j] + left[i] - shared >= 2 * shortest) & (ends < b[j] + n[j]) & (ends_there < a[j] + n[j]) & (b[j] - ends <= size)
        if goes_on.any():
            sums = np.where(goes_on, covered[i] - shared, -1)[::-1]  # of equal ones the nearest
            nearest = j - 1 - int(np.argmax(sums))
            if covered[nearest] - shared[nearest - back] > 0:
                covered[j] += covered[nearest] - shared[nearest - back]
                before[j] = nearest
                left[j] -= max(0, shared[nearest - back] - (left[nearest] - shortest))
    covered = covered.tolist()
    found, firsts, lasts = [], [], []  # places of what is taken, in order of the text

    def free(first: int, last: int) -> bool:
        at = bisect_right(firsts, last)
        return not at or lasts[at - 1] < first

    for at in sorted(range(len(stretches)), key=lambda j: (-covered[j], stretches[j][0])):
        last = stretches[at][0] + stretches[at][2] - 1
        if not free(stretches[at][0], last):
            continue
        first = at
        while before[first] >= 0 and free(stretches[before[first]][0], last):
            first = before[first]
        start = stretches[first][0]
        found.append((template, start, last, (covered[at] - covered[first] + stretches[first][2]) / size))
        place = bisect_right(firsts, start)
        firsts.insert(place, start), lasts.insert(place, last)
    return found


def _in_vocabulary(names: pa.Array, vocabulary: Mapping[str, int]) -> list:
    """The distinct words with nulls for all that no template has."""
    known = pc.is_in(names, pa.array(list(vocabulary), names.type))
    return pc.if_else(known, names, pa.scalar(None, names.type)).to_pylist()


def templates_of(table: DataFrame, label: str = "label", text: str = "text", *, most_bytes: int = 16 << 20) -> dict[str, list[str]]:
    """Templates from a table, say of full licence texts. Every task holds them all, so a table of over ``most_bytes`` of text is an error.

    Rows without a label or a text are left out, repeated ones count once.
    """
    rows = table.select(F.col(label).alias("label"), F.col(text).alias("text")).where("label IS NOT NULL AND text IS NOT NULL").distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        raise ValueError(f"{size} bytes of templates, more than {most_bytes}")
    found: dict[str, list[str]] = {}
    for name, words in rows.orderBy("label", "text").collect():
        found.setdefault(name, []).append(words)
    return found


def with_licenses(docs: DataFrame, into: str, text: str = "text", *, templates: Mapping[str, list[str]] = TEMPLATES, phrases: Mapping[str, str] = BASE_PHRASES, shortest: int = 3, cover: float = 0.8) -> DataFrame:
    """``docs`` with a struct ``into``: counts, labels, the best coverage as score, and template spans.

    shortest: words that a stretch needs to count. cover: the share of a template that a chain must cover.
    """
    scanner = Scanner(templates, phrases, shortest=shortest, cover=cover)
    small_batches(docs.sparkSession)

    @F.arrow_udf(_DDL)
    def scan(column: pa.Array) -> pa.Array:
        return by_slices(column, scanner.scan, _STRUCT)

    return docs.withColumn(into, scan(F.col(text)))
