"""Licences in texts, by matching statistics against a generalised suffix automaton.

The automaton holds every run of words of every template and phrase. A text streams through it: at
each word the automaton's state stands for the longest run of words that ends here and occurs in a
template. Runs that can't be made longer are matches; those of one template that follow each other in
the text and in the template are chained. A chain is a span of the text, a span of the template and
the share of the template that it covers; the largest share is a text's score. A phrase is found where the current run ends with it.

Words that begin no pair of words of any template can be skipped: the automaton is only entered
for stretches of such pairs, which numpy finds, so most of a text costs a hash of each word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.arrow_words import Chunk, WordReader
from sluiceworks.llm.tables import modest_batches

# fixed values: phrases that name a licence, and the label each stands for
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# fixed values: notices and sections of common licences; what stands before a slash is the label
TEMPLATES = {
    "mit": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software "
        "and associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute "
        "sublicense and or sell copies of the software"
    ),
    "apache": (
        "you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at unless required by applicable law or agreed to in writing software distributed "
        "under the license is distributed on an as is basis without warranties or conditions of any "
        "kind either express or implied"
    ),
    "gpl": (
        "this program is free software you can redistribute it and or modify it under the terms of the "
        "gnu general public license as published by the free software foundation"
    ),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted "
        "provided that the following conditions are met"
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without "
        "fee is hereby granted"
    ),
    "mpl": "this source code form is subject to the terms of the mozilla public license",
    "cc-by": "this work is licensed under a creative commons attribution international license",
    "mit/condition": (
        "the above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the software"
    ),
    "mit/warranty": (
        "the software is provided as is without warranty of any kind express or implied including but "
        "not limited to the warranties of merchantability fitness for a particular purpose and "
        "noninfringement in no event shall the authors or copyright holders be liable for any claim "
        "damages or other liability whether in an action of contract tort or otherwise arising from out "
        "of or in connection with the software or the use or other dealings in the software"
    ),
    "bsd/conditions": (
        "redistributions of source code must retain the above copyright notice this list of conditions "
        "and the following disclaimer redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other "
        "materials provided with the distribution"
    ),
    "bsd/endorsement": (
        "neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written permission"
    ),
    "bsd/disclaimer": (
        "this software is provided by the copyright holders and contributors as is and any express or "
        "implied warranties including but not limited to the implied warranties of merchantability and "
        "fitness for a particular purpose are disclaimed in no event shall the copyright holder or "
        "contributors be liable for any direct indirect incidental special exemplary or consequential "
        "damages including but not limited to procurement of substitute goods or services loss of use "
        "data or profits or business interruption however caused and on any theory of liability whether "
        "in contract strict liability or tort including negligence or otherwise arising in any way out "
        "of the use of this software even if advised of the possibility of such damage"
    ),
    "isc/disclaimer": (
        "the software is provided as is and the author disclaims all warranties with regard to this "
        "software including all implied warranties of merchantability and fitness in no event shall the "
        "author be liable for any special direct indirect or consequential damages or any damages "
        "whatsoever resulting from loss of use data or profits whether in an action of contract "
        "negligence or other tortious action arising out of or in connection with the use or performance "
        "of this software"
    ),
    "apache/copyright grant": (
        "subject to the terms and conditions of this license each contributor hereby grants to you a "
        "perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to "
        "reproduce prepare derivative works of publicly display publicly perform sublicense and "
        "distribute the work and such derivative works in source or object form"
    ),
    "apache/warranty": (
        "unless required by applicable law or agreed to in writing licensor provides the work and each "
        "contributor provides its contributions on an as is basis without warranties or conditions of "
        "any kind either express or implied including without limitation any warranties or conditions "
        "of title non infringement merchantability or fitness for a particular purpose"
    ),
    "gpl/notice": (
        "this program is distributed in the hope that it will be useful but without any warranty without "
        "even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
        "general public license for more details"
    ),
    "gpl/warranty": (
        "there is no warranty for the program to the extent permitted by applicable law except when "
        "otherwise stated in writing the copyright holders and or other parties provide the program as "
        "is without warranty of any kind either expressed or implied including but not limited to the "
        "implied warranties of merchantability and fitness for a particular purpose"
    ),
}
LEAST_MATCH = 3  # words
LEAST_SHARE = 0.6  # of a template, for its label
SPAN_SHARE = 0.2  # of a template, from which a chain is a span; less is a few words that any text may have
INSIDE = np.ones(256, dtype=bool)  # bytes of words once A-Z is lowered
INSIDE[:0x80] = False
INSIDE[0x30:0x3A] = True
INSIDE[0x61:0x7B] = True


@dataclass
class State:
    length: int
    link: int
    next: dict[int, int] = field(default_factory=dict)
    # (template, place of its last word) of the runs that the state stands for
    ends: set[tuple[int, int]] = field(default_factory=set)
    phrases: list[tuple[int, int]] = field(default_factory=list)  # (length, phrase)


class SuffixAutomaton:
    """Of several sequences of numbers."""

    def __init__(self) -> None:
        self.states = [State(0, -1)]

    def add(self, template: int, words: list[int]) -> int:
        """Returns the state of the whole sequence."""
        last = 0
        for place, word in enumerate(words):
            last = self._extend(last, word)
            self.states[last].ends.add((template, place))
        return last

    def _extend(self, last: int, word: int) -> int:
        states = self.states
        known = states[last].next.get(word)
        if known is not None:
            if states[known].length == states[last].length + 1:
                return known
            return self._split(last, word, known)
        new = len(states)
        states.append(State(states[last].length + 1, 0))
        at = last
        while at >= 0 and word not in states[at].next:
            states[at].next[word] = new
            at = states[at].link
        if at >= 0:
            target = states[at].next[word]
            fits = states[target].length == states[at].length + 1
            states[new].link = target if fits else self._split(at, word, target)
        return new

    def _split(self, at: int, word: int, target: int) -> int:
        """A state for the shorter runs of ``target``, those that ``at`` and its links lead to."""
        states, part = self.states, len(self.states)
        old = states[target]
        states.append(State(states[at].length + 1, old.link, dict(old.next)))
        old.link = part
        while at >= 0 and states[at].next.get(word) == target:
            states[at].next[word] = part
            at = states[at].link
        return part

    def finish(self, phrases: dict[int, tuple[int, int]]) -> None:
        """Hand places and phrases (by state: length, number) from longer runs to their suffixes."""
        order = sorted(range(1, len(self.states)), key=lambda s: -self.states[s].length)
        for s in order:
            self.states[self.states[s].link].ends |= self.states[s].ends if self.states[s].link else set()
        for s in reversed(order):
            own = [phrases[s]] if s in phrases else []
            self.states[s].phrases = own + self.states[self.states[s].link].phrases


class LicenseScanner:
    def __init__(self, templates: dict[str, str], phrases: dict[str, str]):
        self.templates = list(templates)
        self.names = [*(t.partition("/")[0] for t in templates), *phrases.values()]
        texts = [t.split() for t in (*templates.values(), *phrases)]
        self.sizes = [len(t) for t in texts]
        self.n_templates = len(templates)
        column = pa.array([" ".join(t) for t in texts])
        reader = WordReader(lower=True, inside=INSIDE)
        chunk = next(reader.chunks(column))
        pairs, whole = chunk.grams(2)
        self.words = np.unique(chunk.hashes)
        self.pairs = np.unique(pairs[whole])
        numbers = np.searchsorted(self.words, chunk.hashes)
        self.automaton = SuffixAutomaton()
        ends: dict[int, tuple[int, int]] = {}
        begins = []
        for t, (a, b) in enumerate(zip(chunk.bounds[:-1].tolist(), chunk.bounds[1:].tolist(), strict=True)):
            state = self.automaton.add(t, numbers[a:b].tolist())
            if t >= self.n_templates:
                ends[state] = (b - a, t)
                begins.append(pairs[a])
        self.automaton.finish(ends)
        self.begins = np.unique(np.array(begins, np.uint64))

    def stretches(self, chunk: Chunk) -> list[tuple[int, int]]:
        """Word ranges within one document that can hold a phrase or a match of LEAST_MATCH words."""
        if not len(chunk.hashes):
            return []
        pairs, whole = chunk.grams(2)
        there = np.searchsorted(self.pairs, pairs)
        known = whole & (self.pairs[np.minimum(there, len(self.pairs) - 1)] == pairs)
        edge = np.diff(np.concatenate([[0], known.view(np.int8), [0]]))
        begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        phrase = np.concatenate([[0], np.cumsum(known & np.isin(pairs, self.begins))])
        good = (end - begin >= LEAST_MATCH - 1) | (phrase[end] > phrase[begin])
        return list(zip(begin[good].tolist(), (end[good] + 1).tolist(), strict=True))

    def scan(self, chunk: Chunk) -> list[tuple]:
        """For each document: words, places of phrases, first and last of them, labels, score, spans."""
        bounds = chunk.bounds
        places: dict[int, list[tuple[int, int]]] = {}
        matches: dict[int, list[tuple[int, int, int]]] = {}
        for a, b in self.stretches(chunk):
            d = int(np.searchsorted(bounds, a, side="right")) - 1
            numbers = np.searchsorted(self.words, chunk.hashes[a:b]).tolist()
            self._stream(
                numbers, a - int(bounds[d]), places.setdefault(d, []), matches.setdefault(d, [])
            )
        out = []
        for d, n in enumerate(np.diff(bounds).tolist()):
            found = places.get(d, [])
            base = {self.names[p] for _, p in found}
            spans = [
                dict(zip(SPAN_FIELDS, (self.names[t], self.templates[t], *where, share), strict=True))
                for t, *where, share in self._chains(matches.get(d, []))
            ]
            labels = base | {x["label"] for x in spans if x["share"] >= LEAST_SHARE}
            score = 1.0 if found else max((x["share"] for x in spans), default=0.0)
            spans = [x for x in spans if x["share"] >= SPAN_SHARE]
            starts = [s for s, _ in found]
            out.append(
                (n, len(found), min(starts, default=None), max(starts, default=None),
                 ",".join(sorted(base)), ",".join(sorted(labels)), score, spans)
            )
        return out

    def _stream(
        self, numbers: list[int], at: int, places: list[tuple[int, int]], matches: list[tuple[int, int, int]]
    ) -> None:
        """Adds (start, phrase) and (end, length, state) of the maximal runs."""
        states, state, length = self.automaton.states, 0, 0
        for i, word in enumerate(numbers):
            if length and word not in states[state].next and length >= LEAST_MATCH:
                matches.append((at + i, length, state))
            while state and word not in states[state].next:
                state = states[state].link
                length = states[state].length
            if word in states[state].next:
                state, length = states[state].next[word], length + 1
            for size, phrase in states[state].phrases:
                if size <= length:
                    places.append((at + i + 1 - size, phrase))
        if length >= LEAST_MATCH:
            matches.append((at + len(numbers), length, state))

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int, int, float]]:
        """(template, text start, text end, template start, template end, share) of chains, by text start.

        A chain ends where nothing makes it longer for as many words as the template has, or where it
        covers the whole template. What stands before and after it is looked at again, so that each
        copy of a template is found. Chains of one template don't overlap.
        """
        events: dict[int, list[tuple[int, int, list[int]]]] = {}
        for end, length, state in matches:
            own: dict[int, list[int]] = {}
            for t, last in sorted(self.automaton.states[state].ends, reverse=True):
                if t < self.n_templates:
                    own.setdefault(t, []).append(last + 1)
            for t, stops in own.items():
                events.setdefault(t, []).append((end, length, stops))
        out = []
        for t, own_events in events.items():
            left = [(0, len(own_events))]
            while left:
                low, high = left.pop()
                chain = self._first_chain(own_events, low, high, self.sizes[t])
                out.append((t, *chain))
                before = after = low
                while before < high and own_events[before][0] <= chain[0]:
                    before += 1
                while after < high and own_events[after][0] - own_events[after][1] < chain[1]:
                    after += 1
                left += [x for x in ((low, before), (after, high)) if x[0] < x[1]]
        return sorted(out, key=lambda c: (c[1], c[0]))

    def _first_chain(
        self, events: list[tuple[int, int, list[int]]], low: int, high: int, size: int
    ) -> tuple[int, int, int, int, float]:
        """The best chain from the first of the events on, up to where it ends."""
        covers = np.zeros(size + 1, np.int64)  # by the number of words done with
        begins: dict[int, tuple[int, int]] = {}  # of the text and of the template, likewise
        best, chain = 0, (0, 0, 0, 0, 0.0)
        for end, length, stops in (events[i] for i in range(low, high)):
            if best == size or (best and end - length - chain[1] > size):
                break
            for stop in stops:
                # covered words before this match, and with those of it that are new
                values = covers[:stop] + np.minimum(length, stop - np.arange(stop))
                before = int(values.argmax())
                value = int(values[before])
                if value <= covers[stop]:
                    continue
                begin = begins[before] if covers[before] else (end - length, stop - length)
                covers[stop], begins[stop] = value, begin
                if value > best:
                    best, chain = value, (begin[0], end, begin[1], stop, value / size)
        return chain


KIND = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double"
)
SPAN_FIELDS = ("label", "template", "text_start", "text_end", "template_start", "template_end", "share")
SPANS = pa.list_(
    pa.struct([*[(f, pa.string()) for f in SPAN_FIELDS[:2]], *[(f, pa.int64()) for f in SPAN_FIELDS[2:6]], ("share", pa.float64())])
)
SPANS_KIND = (
    "spans array<struct<label:string,template:string,text_start:long,text_end:long,"
    "template_start:long,template_end:long,share:double>>"
)


def _scanned(templates: dict[str, str], phrases: dict[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, reader = LicenseScanner(templates, phrases), WordReader(lower=True, inside=INSIDE)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), SPANS]
        names = [*(f.split(" ")[0] for f in KIND.split(", ")), "spans"]
        for batch in batches:
            for chunk in reader.chunks(batch.column(1)):
                columns = zip(*scanner.scan(chunk), strict=True)
                ids = batch.column(0).slice(chunk.first, len(chunk))
                yield pa.RecordBatch.from_arrays(
                    [ids, *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]], names
                )

    return run


def scan_licenses(
    docs: DataFrame, templates: dict[str, str] | None = None, phrases: dict[str, str] | None = None
) -> DataFrame:
    """What licences each row of ``docs`` (doc_id, text, ...) names or quotes.

    Words are runs of ASCII letters and digits, A-Z lowered, and of characters beyond ASCII.
    The texts of ``templates`` (by label) and the ``phrases`` (with their labels) are such words with
    spaces between; a phrase has two at least. n_base counts the places where the words of a phrase
    stand consecutively, first_word and last_word are the smallest and largest start, counted from 0,
    else null. base_labels has the labels of these, labels also those of templates of which a chain
    covers LEAST_SHARE, both distinct, sorted and joined by commas. score is 1 with a phrase, else
    the largest share covered. spans has a row for each chain that covers SPAN_SHARE, ends exclusive and
    places in words; a template named "label/section" is a section of its own. Null and empty texts have no words and score 0. Null doc_ids and
    repeated rows are returned as they are. An empty table gives an empty result. Columns other
    than doc_id and text aren't read.
    """
    modest_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_scanned(templates or TEMPLATES, phrases or PHRASES), f"{KIND}, {SPANS_KIND}")
