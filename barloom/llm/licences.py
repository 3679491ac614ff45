"""Licence scans: a generalised suffix automaton of licence words, and chains of long matches."""

from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.texts import map_texts

MATCH_WORDS = 3
COVERAGE = 0.75
TEMPLATE_BYTES = 4 << 20

# --- Fixed values: phrases, and notices by label. ---
PHRASES = [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software "
               "distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
            "option) any later version"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction, including without limitation the rights to use, "
            "copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("public-domain", "This is free and unencumbered software released into the public domain"),
]
#: Word bytes as they are, A-Z in lower case, all other bytes blank.
FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
# --- End of fixed values. ---


def words(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


class Automaton:
    """Generalised suffix automaton of several word sequences.

    ``ends[state]`` lists (sequence, last word) for every place where the state's strings end.
    """

    def __init__(self, sequences: list[list]):
        self.next, self.link, self.length, self.ends = [{}], [-1], [0], [[]]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].append((number, at))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            self.ends[self.link[state]].extend(self.ends[state])
        self.ends[0] = []
        self.ends = [sorted(set(e)) for e in self.ends]

    def _state(self, length, edges, link):
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        self.ends.append([])
        return len(self.next) - 1

    def _split(self, state, word, target):
        """Part the strings that fit after ``state`` from the longer ones of ``target``."""
        copy = self._state(self.length[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last, word):
        target = self.next[last].get(word)
        if target is not None:
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        new = self._state(self.length[last] + 1, {}, 0)
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            fits = self.length[target] == self.length[state] + 1
            self.link[new] = target if fits else self._split(state, word, target)
        return new

    def walk(self, sequence) -> int:
        """The state of a string that the sequences hold."""
        state = 0
        for word in sequence:
            state = self.next[state][word]
        return state

    def statistics(self, sequence):
        """State and length of the longest match ending at each word."""
        state = length = 0
        for word in sequence:
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            yield state, length


class Scanner:
    """Phrases and templates over one automaton."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES, match_words=MATCH_WORDS, coverage=COVERAGE):
        self.labels = [label for label, _ in [*phrases, *templates]]
        sequences = [words(t.encode()) for _, t in [*phrases, *templates]]
        self.codes = {w: i for i, w in enumerate(sorted({w for s in sequences for w in s}), 1)}
        self.sizes, self.phrases = [len(s) for s in sequences], len(phrases)
        self.automaton = Automaton([[self.codes[w] for w in s] for s in sequences])
        self.match_words, self.coverage = match_words, coverage
        # The fewest words that make a phrase, or a match with a template.
        least = [min(match_words, s) for s in self.sizes[self.phrases:]]
        self.shortest, self.least = min([*self.sizes[:self.phrases], *least], default=1), min(least, default=match_words)
        # By state: the phrases that end its strings, its own or those of its suffixes, and places in templates.
        self.whole = [[] for _ in self.automaton.next]
        for n in range(self.phrases):
            self.whole[self.automaton.walk(self.codes[w] for w in sequences[n])].append(n)
        for state in sorted(range(1, len(self.whole)), key=lambda s: self.automaton.length[s]):
            self.whole[state] = self.whole[self.automaton.link[state]] + self.whole[state]
        self.inner = [[(n, at) for n, at in e if n >= self.phrases] for e in self.automaton.ends]

    def scan(self, text: bytes):
        """Number of words, phrase places (start, phrase), and template spans (first, last, template, coverage)."""
        found = words(text)
        codes = np.fromiter(map(self.codes.get, found, repeat(0)), np.int32, len(found))
        # Words that no template has end every match: only runs of known words are streamed.
        edges = np.flatnonzero(np.diff(np.concatenate(([0], codes > 0, [0])).astype(np.int8)))
        places, blocks = [], []
        for first, end in edges.reshape(-1, 2).tolist():
            if end - first < self.shortest:
                continue
            before = None
            for at, (state, length) in enumerate(self.automaton.statistics(codes[first:end].tolist()), first):
                for n in self.whole[state]:
                    if self.sizes[n] <= length:
                        places.append((at - self.sizes[n] + 1, n))
                if before and length <= before[2]:
                    blocks.append(before)
                before = at, state, length
            blocks.append(before)
        return len(found), places, self._chains([b for b in blocks if b[2] >= self.least])

    def _chains(self, blocks):
        """Spans of templates that chained matches cover to the asked share.

        Matches follow each other in text and template, overlaps counted once, and a chain
        reaches over no more than twice the template's words, so each looks back on few others.
        """
        by_template = {}
        for at, state, length in blocks:
            for n, place in self.inner[state]:
                if length >= min(self.match_words, self.sizes[n]):
                    by_template.setdefault(n, []).append((at, place, length))
        spans = []
        for n, items in by_template.items():
            size, best = self.sizes[n], []
            items.sort()
            low = 0
            for at, place, length in items:
                covered, first = length, at - length + 1
                while items[low][0] < at - 2 * size:
                    low += 1
                for (other, spot, _), (chained, start) in zip(items[low:len(best)], best[low:]):
                    fresh = min(length, at - other, place - spot)
                    if fresh > 0 and start >= at - 2 * size and chained + fresh > covered:
                        covered, first = chained + fresh, start
                best.append((covered, first))
            # Of chains that overlap, the one that covers most stays.
            kept = None
            for first, end, covered in sorted((f, i[0], c) for (c, f), i in zip(best, items) if c >= self.coverage * size):
                if kept and first <= kept[1]:
                    kept = kept[0] if covered <= kept[0][2] else (first, end, covered), max(kept[1], end)
                    continue
                if kept:
                    spans.append((*kept[0][:2], n, min(1.0, kept[0][2] / size)))
                kept = (first, end, covered), end
            if kept:
                spans.append((*kept[0][:2], n, min(1.0, kept[0][2] / size)))
        return sorted(spans)


def read_sequences(df: DataFrame, label="label", text="text", most=TEMPLATE_BYTES) -> list[tuple[str, str]]:
    """Phrases or templates for a ``Scanner`` from a table, each distinct (label, text) once, in their order.

    They are part of the automaton, which every task holds: a table of over ``most`` bytes of text is refused.
    Rows without a label or without a word are left out.
    """
    rows = df.select(F.col(label).cast("string").alias("label"), F.col(text).alias("text")).dropna().distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most:
        raise ValueError(f"{size} bytes of licence texts; at most {most} are held in memory")
    return [(r.label, r.text) for r in rows.orderBy("label", "text").collect() if words(r.text.encode())]


def scan(df: DataFrame, key="doc_id", text="text", scanner: Scanner | None = None) -> DataFrame:
    """``(key, n_words, places, spans)``, one row per input row.

    ``places`` are structs (word, label) of every place where a phrase's words stand
    consecutively; ``spans`` are structs (first, last, label, coverage) of template spans, in
    words from 0. Null and empty texts have no words; repeated rows and null keys are kept.
    """
    scanner = scanner or Scanner()
    place = T.StructType([T.StructField("word", T.LongType()), T.StructField("label", T.StringType())])
    span = T.StructType([
        T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
        T.StructField("label", T.StringType()), T.StructField("coverage", T.DoubleType())])
    fields = [T.StructField("n_words", T.LongType()), T.StructField("places", T.ArrayType(place)),
              T.StructField("spans", T.ArrayType(span))]
    kinds = [
        pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])),
        pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("label", pa.string()), ("coverage", pa.float64())])),
    ]

    def make():
        def apply(texts):
            found = [scanner.scan(t or b"") for t in texts.to_pylist()]
            name = scanner.labels
            places = [[{"word": w, "label": name[n]} for w, n in sorted(p)] for _, p, _ in found]
            spans = [[{"first": f, "last": e, "label": name[n], "coverage": c} for f, e, n, c in s] for _, _, s in found]
            return [pa.array([n for n, _, _ in found], pa.int64()), pa.array(places, kinds[0]), pa.array(spans, kinds[1])]
        return apply

    return map_texts(df, text, [key], fields, make)
