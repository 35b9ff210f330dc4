"""Licence scans with a generalised suffix automaton over licence templates.

All templates, as sequences of words, are put into one suffix automaton. A text is streamed through
it word by word: at each word the automaton gives the length of the longest ending stretch that
stands in some template (matching statistics). Long stretches are then chained, template by
template, in the order of text and template; a licence is found where a chain covers enough of a
template. Phrases are templates too: they are found where the stretch that ends at a word has the
whole phrase as its end.

A text needs memory for its word numbers only. The automaton is built from the fixed templates, so
its size does not depend on the data.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tapewatch.llm.support import pieces_of

#: Phrases that name a licence, and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: The opening or the grant of public licences, as their authors publish them.
TEMPLATES = {
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the Software), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so"
    ),
    "apache-notice": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"
    ),
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, "
        "or (at your option) any later version."
    ),
    "gpl-line": "This work is licensed under the GNU General Public License, version 3.",
    "mit-line": "Released under the MIT License.",
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met"
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "mpl-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at"
    ),
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-line": "Licensed under CC BY-SA 4.0.",
    "cc-by-line": "Licensed under CC BY 4.0.",
}

#: Words that a stretch must share with a template to become part of a chain.
MIN_STRETCH = 3
#: Share of a template's words that a chain must cover.
MIN_COVER = 0.75
#: Words that may be skipped, in the text or in the template, between two stretches of a chain.
MAX_GAP = 8

SCAN = (
    "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: array<string>,"
    " labels: array<string>, score: double,"
    " spans: array<struct<label: string, first_word: bigint, last_word: bigint, cover: double>>>"
)
#: Words of lower-cased UTF-8: digits, a-z and whatever is not ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


@dataclass
class State:
    length: int = 0
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    #: A place where the state's stretches end: (template, number of its words up to there). Others follow
    #: from the states whose link leads here.
    ends: set[tuple[int, int]] = field(default_factory=set)


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word numbers."""

    def __init__(self, sequences: list[list[int]]):
        self.states = [State()]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence, 1):
                last = self._extend(last, word)
                self.states[last].ends.add((number, at))
        # every end of a state is an end of its link, too
        for state in sorted(self.states[1:], key=lambda state: -state.length):
            self.states[state.link].ends |= state.ends
        self.states[0].ends = set()
        self.places = [tuple(sorted(state.ends)) for state in self.states]

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        there = states[last].next.get(word)
        if there is not None:
            if states[there].length == states[last].length + 1:
                return there
            return self._clone(last, word, there)
        new = len(states)
        states.append(State(states[last].length + 1))
        at = last
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = new
            at = states[at].link
        if at < 0:
            states[new].link = 0
        else:
            there = states[at].next[word]
            same = states[there].length == states[at].length + 1
            states[new].link = there if same else self._clone(at, word, there)
        return new

    def _clone(self, at: int, word: int, there: int) -> int:
        """Split `there`: the stretches that `at` and `word` make become a state of their own."""
        states, copy = self.states, len(self.states)
        states.append(State(states[at].length + 1, states[there].link, dict(states[there].next)))
        states[there].link = copy
        while at >= 0 and states[at].next.get(word) == there:
            states[at].next[word] = copy
            at = states[at].link
        return copy

    def statistics(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        """For each word number, -1 for an unknown word: (state, length) of the longest stretch ending there."""
        states, state, length = self.states, 0, 0
        for word in ids:
            if word < 0:
                state, length = 0, 0
            else:
                while state and word not in states[state].next:
                    state = states[state].link
                    length = states[state].length
                if word in states[state].next:
                    state, length = states[state].next[word], length + 1
                else:
                    length = 0
            yield state, length


class Scanner:
    """The automaton of phrases and templates, and what a text has of them."""

    def __init__(self, phrases: dict[str, str], templates: dict[str, str]):
        self.vocabulary: dict[bytes, int] = {}
        self.phrases = [(label, self._numbers(text)) for text, label in phrases.items()]
        self.templates = [(label, self._numbers(text)) for label, text in templates.items()]
        sequences = [ids for _, ids in self.phrases + self.templates]
        self.automaton = SuffixAutomaton(sequences)
        #: For each state, the phrases (number, words) that its longest stretch ends with.
        self.endings: list[tuple[tuple[int, int], ...]] = [()] * len(self.automaton.states)
        for number, (_, ids) in enumerate(self.phrases):
            for state, _ in self.automaton.statistics(ids):
                pass  # to the state of the whole phrase
            self.endings[state] += ((number, len(ids)),)
        shortest_first = sorted(range(1, len(self.endings)), key=lambda at: self.automaton.states[at].length)
        for state in shortest_first:  # a link is shorter, so it has its own already
            self.endings[state] += self.endings[self.automaton.states[state].link]
        #: For each state, the places in templates where its stretches end: (template, words up to there, most
        #: words of a stretch ending there, the template's next word or None). A link adds places of shorter ones.
        self.stops: list[tuple[tuple[int, int, int, int | None], ...]] = [()] * len(self.endings)
        for state in shortest_first:
            length, further = self.automaton.states[state].length, self.stops[self.automaton.states[state].link]
            if length >= MIN_STRETCH:
                places = set(self.automaton.places[state])
                self.stops[state] = tuple(
                    (number, words, length, sequences[number][words] if words < len(sequences[number]) else None)
                    for number, words in sorted(places)
                    if number >= len(self.phrases)
                ) + tuple(stop for stop in further if stop[:2] not in places)

    def _numbers(self, text: str) -> list[int]:
        return [self.vocabulary.setdefault(word, len(self.vocabulary)) for word in words_of(text)]

    def runs(self, text: str) -> tuple[int, list[tuple[int, list[int]]]]:
        """Number of words, and the runs (first word, numbers) of words that some template has."""
        total, runs = 0, []
        get, unknown = self.vocabulary.get, -1
        for piece in pieces_of(text.encode().lower()):
            words = _WORD.findall(piece)
            ids = np.fromiter((get(word, unknown) for word in words), np.int32, len(words))
            known = ids >= 0
            edges = np.flatnonzero(np.diff(known, prepend=False, append=False))
            for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
                found = ids[a:b].tolist()
                if runs and runs[-1][0] + len(runs[-1][1]) == total + a:
                    runs[-1][1].extend(found)
                else:
                    runs.append((total + a, found))
            total += len(words)
        return total, runs

    def scan(self, text: str | None) -> dict:
        total, runs = self.runs(text or "")
        starts, base = [], set()
        stretches: dict[int, list[tuple[int, int, int]]] = {}
        for begin, ids in runs:
            if len(ids) < 2:
                continue
            ended = list(self.automaton.statistics(ids))
            for at, (state, length) in enumerate(ended):
                for number, words in self.endings[state]:
                    if length >= words:
                        starts.append(begin + at + 1 - words)
                        base.add(self.phrases[number][0])
                # a template's own stretch ends where the text goes on with another word than the template
                if length >= MIN_STRETCH:
                    after = ids[at + 1] if at + 1 < len(ids) else -1
                    for number, words, most, following in self.stops[state]:
                        if following != after:
                            own = min(length, most)
                            stretches.setdefault(number, []).append((begin + at + 1 - own, words - own, own))
        spans = [span for number in sorted(stretches) for span in self._chains(number, stretches[number])]
        labels = {span["label"] for span in spans}
        score = max((span["cover"] for span in spans), default=0.0)
        return {
            "n_words": total,
            "n_base": len(starts),
            "first_word": min(starts, default=None),
            "last_word": max(starts, default=None),
            "base_labels": sorted(base),
            "labels": sorted(base | labels),
            "score": 1.0 if base else score,
            "spans": spans,
        }

    def _chains(self, number: int, found: list[tuple[int, int, int]]) -> Iterator[dict]:
        """Spans of the text whose stretches, in the order of the template, cover enough of it."""
        label, ids = self.templates[number - len(self.phrases)]
        chains: list[list[int]] = []  # text begin, text end, template end, words covered
        near: list[list[int]] = []  # those that a stretch may still extend: `at` only grows
        for at, place, length in sorted(set(found)):
            best = None
            near = [chain for chain in near if at - chain[1] <= MAX_GAP]
            for chain in reversed(near):
                skip_text, skip_template = at - chain[1], place - chain[2]
                overlap = max(0, -skip_text, -skip_template)
                if skip_text <= MAX_GAP and skip_template <= MAX_GAP and overlap < length and (
                    at + length > chain[1] and place + length > chain[2]
                ):
                    gain = chain[3] + length - overlap
                    if best is None or gain > best[0]:
                        best = (gain, chain)
            if best and best[0] > length:
                gain, chain = best
                chains.append([chain[0], at + length, place + length, gain])
            else:
                chains.append([at, at + length, place + length, length])
            near.append(chains[-1])
        taken: list[tuple[int, int]] = []  # disjoint, in the order of the text
        for begin, end, _, covered in sorted(chains, key=lambda chain: (-chain[3], chain[0], chain[1])):
            if covered < MIN_COVER * len(ids):
                break
            spot = bisect(taken, (begin, end))
            if (not spot or taken[spot - 1][1] <= begin) and (spot == len(taken) or end <= taken[spot][0]):
                taken.insert(spot, (begin, end))
                yield {
                    "label": label,
                    "first_word": begin,
                    "last_word": end - 1,
                    "cover": min(1.0, covered / len(ids)),
                }


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, templates: tuple) -> Scanner:
    return Scanner(dict(phrases), dict(templates))


def scanned(text: Column, phrases: dict[str, str] = PHRASES, templates: dict[str, str] = TEMPLATES) -> Column:
    """What licences a text names or contains, as the struct `SCAN`.

    `n_base` counts all places of the phrases; `first_word` and `last_word` are the smallest and the
    largest word, from 0, that one starts at, else null. `labels` has those of phrases found and of
    templates covered; `spans` says where the templates are. `score` is 1 if a phrase was found, else the
    largest cover of a template. Null and empty texts have no words.
    """
    given = tuple(phrases.items()), tuple(templates.items())

    @F.arrow_udf(SCAN)
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scanner = _scanner(*given)
        span = pa.struct(
            [("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("cover", pa.float64())]
        )
        kind = pa.struct(
            [
                ("n_words", pa.int64()),
                ("n_base", pa.int64()),
                ("first_word", pa.int64()),
                ("last_word", pa.int64()),
                ("base_labels", pa.list_(pa.string())),
                ("labels", pa.list_(pa.string())),
                ("score", pa.float64()),
                ("spans", pa.list_(span)),
            ]
        )
        for texts in batches:
            yield pa.array([scanner.scan(text.as_py()) for text in texts], kind)

    return column(text)
