"""Licence scan with a generalised suffix automaton over licence words.

All template texts go into one automaton.  A file's words are streamed through
it; after each word the automaton knows the longest suffix read that occurs in
any template (the matching statistics).  Maximal matches are chained, template
by template, into covered spans; a template whose chain covers enough of it
gives its label.  Short base phrases are templates too: a phrase ends at a word
if the current match, or a suffix of it, is the whole phrase.

Words: A-Z lower-cased, then runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.

Null or empty text: 0 words, no spans, null positions, score 0.  Repeated rows
are scanned each on its own; columns other than id and text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the contract.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Opening words of public licences and common notices, (label, text).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
               "in compliance with the License. You may obtain a copy of the License at "
               "http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", "Unless required by applicable law or agreed to in writing, software distributed under the License "
               "is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
               "or implied."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Shortest match that may join a chain, widest gap (words) inside one, and the
#: covered share of a template that gives its label.
MIN_MATCH, MAX_GAP, MIN_COVER = 3, 12, 0.5

SCHEMA = ("{id} {id_type}, n_words long, base array<struct<label: string, start: long>>, "
          "spans array<struct<label: string, start: long, end: long, covered: long, coverage: double>>")


def words_of(text: str | None) -> list[bytes]:
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class Automaton:
    """Generalised suffix automaton of word sequences.

    ``where[state]`` holds, for each template with the state's words, the end of
    one occurrence; ``phrases[state]`` the base phrases that end there."""

    def __init__(self, templates: list[tuple[str, str]], phrases: dict[str, str]):
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        self.labels = [label for label, _ in templates]
        texts = [words_of(t) for _, t in templates]
        self.sizes = [len(t) for t in texts]
        heads = list(phrases.items())
        coded = [[self.vocab.setdefault(w, len(self.vocab)) for w in t]
                 for t in texts + [words_of(p) for p, _ in heads]]
        for seq in coded:
            last = 0
            for c in seq:
                last = self._extend(last, c)
        self.where: list[dict[int, int]] = [{} for _ in self.len]
        for t, seq in enumerate(coded[:len(texts)]):
            state = 0
            for end, c in enumerate(seq, 1):
                state = self.next[state][c]
                up = state
                while up > 0 and t not in self.where[up]:
                    self.where[up][t] = end
                    up = self.link[up]
        marks: dict[int, list[tuple[str, int]]] = {}
        for (_, label), seq in zip(heads, coded[len(texts):]):
            state = 0
            for c in seq:
                state = self.next[state][c]
            marks.setdefault(state, []).append((label, len(seq)))
        #: all phrases on the way from a state to the root, with their lengths
        self.phrases: list[list[tuple[str, int]]] = []
        for s in range(len(self.len)):
            found, up = [], s
            while up > 0:
                found += marks.get(up, [])
                up = self.link[up]
            self.phrases.append(found)

    def _new(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, q: int, c: int) -> int:
        clone = self._new(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, c: int) -> int:
        q = self.next[last].get(c)
        if q is not None:
            return q if self.len[q] == self.len[last] + 1 else self._split(last, q, c)
        cur, p = self._new(self.len[last] + 1, {}, 0), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = cur
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[cur] = q if self.len[q] == self.len[p] + 1 else self._split(p, q, c)
        return cur

    def stream(self, codes: list[int], at: int) -> Iterator[tuple[int, int, int]]:
        """(position, state, matched words) after each word of a run of known
        words that begins at ``at``: the matching statistics."""
        nxt, link, length = self.next, self.link, self.len
        state = n = 0
        for i, c in enumerate(codes, at):
            to = nxt[state].get(c)
            while to is None and state:
                state = link[state]
                n = length[state]
                to = nxt[state].get(c)
            if to is not None:
                state, n = to, n + 1
            yield i, state, n


def scan(auto: Automaton, text: str | None) -> tuple[int, list[tuple], list[tuple]]:
    """Words, base phrases (label, start) and template spans of one text."""
    words = words_of(text)
    get = auto.vocab.get
    codes = [get(w, -1) for w in words]
    base, matches = [], []
    i, n = 0, len(codes)
    while i < n:
        if codes[i] < 0:
            i += 1
            continue
        j = i + 1
        while j < n and codes[j] >= 0:
            j += 1
        if j - i > 1:  # no phrase or chained match is one word
            before, state_before, at_before = 0, 0, 0
            for at, state, m in auto.stream(codes[i:j], i):
                for label, size in auto.phrases[state]:
                    if size <= m:
                        base.append((label, at - size + 1))
                if m != before + 1 and before >= MIN_MATCH:
                    matches.append((at_before - before + 1, at_before + 1, state_before))
                before, state_before, at_before = m, state, at
            if before >= MIN_MATCH:
                matches.append((at_before - before + 1, at_before + 1, state_before))
        i = j
    return n, base, chain(auto, matches) if matches else []


def chain(auto: Automaton, matches: list[tuple[int, int, int]]) -> list[tuple]:
    """Chains of matches in text order whose places in a template rise too."""
    open_: dict[int, list[int]] = {}
    spans = []

    def close(t: int) -> None:
        start, end, covered, _ = open_.pop(t)
        if covered >= MIN_COVER * auto.sizes[t]:
            spans.append((auto.labels[t], start, end, covered, min(1.0, covered / auto.sizes[t])))

    for start, end, state in matches:
        for t, place in auto.where[state].items():
            have = open_.get(t)
            if have and (start - have[1] > MAX_GAP or place <= have[3]):
                close(t)
                have = None
            fresh = end - max(start, have[1]) if have else end - start
            if have:
                have[1], have[2], have[3] = end, have[2] + max(0, fresh), place
            else:
                open_[t] = [start, end, fresh, place]
    for t in list(open_):
        close(t)
    return sorted(spans, key=lambda s: (s[1], s[2], s[0]))


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 templates: list[tuple[str, str]] = TEMPLATES,
                 phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """Id, word count, base phrases and template spans of every row; no shuffle."""
    id_type = docs.select(id_col).schema[0].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = Automaton(templates, phrases)
        base_t = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
        span_t = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                     ("covered", pa.int64()), ("coverage", pa.float64())]))
        for b in batches:
            found = [scan(auto, t.as_py()) for t in b.column(1)]
            yield pa.record_batch([
                b.column(0), pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[dict(zip(("label", "start"), x)) for x in p] for _, p, _ in found], base_t),
                pa.array([[dict(zip(("label", "start", "end", "covered", "coverage"), x)) for x in s]
                          for _, _, s in found], span_t)],
                names=[id_col, "n_words", "base", "spans"])

    return rows.mapInArrow(run, SCHEMA.format(id=f"`{id_col}`", id_type=id_type))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One flat row per scanned text.  ``score``: 1 for a whole base phrase, else
    the largest covered share of a template."""
    starts = F.transform("base", lambda x: x["start"])
    base = F.array_distinct(F.transform("base", lambda x: x["label"]))
    own = F.array_distinct(F.transform("spans", lambda x: x["label"]))
    join = lambda a: F.array_join(F.array_sort(a), ",")
    cover = F.coalesce(F.array_max(F.transform("spans", lambda x: x["coverage"])), F.lit(0.0))
    return scanned.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        join(base).alias("base_labels"), join(F.array_union(base, own)).alias("labels"),
        F.when(F.size("base") > 0, 1.0).otherwise(cover).alias("score"),
        F.size("spans").cast("long").alias("n_spans"),
        F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["covered"]),
                   F.lit(0).cast("long")).alias("covered_words"))
