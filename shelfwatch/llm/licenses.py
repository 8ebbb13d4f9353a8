"""Licence notices found with a generalised suffix automaton of template words (operator 7)."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from shelfwatch.llm.common import map_rows

# Phrases of the base scan and their labels.
BASE = [
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

# Notices of well-known licences.
TEMPLATES = [
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
            "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
            "permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright "
            "notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                 "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
              "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
              "later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    # siblings of these, and the heads of whole licence texts
    ("apache-2", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, "
                 "AND DISTRIBUTION"),
    ("apache-1.1", "Licensed under the Apache License, Version 1.1."),
    ("apache-1.1", "The Apache Software License, Version 1.1"),
    ("mpl-2", "Mozilla Public License Version 2.0"),
    ("mpl-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", "Released under the ISC License."),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
                  "commercial or non-commercial, and by any means."),
]
_VERBATIM = "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed."
for _label, _name, _version, _head in [
        ("gpl-2", "GNU General Public License", "2", "June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc."),
        ("gpl-3", "GNU General Public License", "3", "29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
        ("lgpl-2.1", "GNU Lesser General Public License", "2.1", "February 1999 Copyright (C) 1991, 1999 Free Software Foundation, Inc."),
        ("lgpl-3", "GNU Lesser General Public License", "3", "29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc."),
        ("agpl-3", "GNU Affero General Public License", "3", "19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.")]:
    TEMPLATES += [(_label, f"{_name} Version {_version}, {_head} {_VERBATIM}"),
                  (_label, f"This program is free software; you can redistribute it and/or modify it under the terms of the {_name} as "
                           f"published by the Free Software Foundation; either version {_version} of the License, or (at your option) "
                           "any later version.")]
    if _label != "gpl-3":
        TEMPLATES.append((_label, f"This work is licensed under the {_name}, version {_version}."))
_CC = {"by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives", "by-nc": "Attribution-NonCommercial",
       "by-nc-sa": "Attribution-NonCommercial-ShareAlike", "by-nc-nd": "Attribution-NonCommercial-NoDerivatives"}
for _short, _name in _CC.items():
    if _short != "by-nc":
        TEMPLATES += [(f"cc-{_short}", f"Licensed under CC {_short.upper()} 4.0."),
                      (f"cc-{_short}", f"This work is licensed under a Creative Commons {_name} 4.0 International License.")]
    TEMPLATES.append((f"cc-{_short}", f"This work is licensed under a Creative Commons {_name.replace('Derivatives', 'Derivs')} 3.0 Unported License."))

#: the words by which licences differ. Those that a template holds must be matched, each phrase as a whole.
NEEDED = {
    "mit": ["mit license"],
    "isc": ["isc license"],
    "apache-2": ["apache license version 2 0"],
    "apache-1.1": ["version 1 1"],
    "mpl-2": ["mozilla public license v 2 0", "mozilla public license version 2 0"],
    "mpl-1.1": ["mozilla public license version 1 1"],
    "gpl-2": ["gnu general public license", "version 2"],
    "gpl-3": ["gnu general public license", "version 3"],
    "lgpl-2.1": ["gnu lesser general public license", "version 2 1"],
    "lgpl-3": ["gnu lesser general public license", "version 3"],
    "agpl-3": ["gnu affero general public license", "version 3"],
    "bsd": ["source and binary forms"],
} | {f"cc-{_s}": [f"{w} {v}" for w in (f"cc {_s.replace('-', ' ')}", f"commons {_n.lower().replace('-', ' ')}",
                                       f"commons {_n.lower().replace('-', ' ').replace('derivatives', 'derivs')}") for v in ("4 0", "3 0")]
     for _s, _n in _CC.items()}

#: a word is a run of digits, lower-case letters and bytes beyond ASCII
_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))
MIN_MATCH = 3  # words of a match that may stand in a chain, where all templates are that long
MAX_GAP = 8  # words of the file between two matches of a chain
MIN_COVER = 0.7  # share of a template's words that makes a span


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_KEEP).split()


@dataclass
class State:
    length: int = 0
    link: int = -1
    next: dict[int, int] = field(default_factory=dict)
    ends: list[tuple[int, int]] = field(default_factory=list)  # (template, last word) of the strings of this state
    base: list[tuple[int, int]] = field(default_factory=list)  # (words, base phrase) that end here


class Automaton:
    """Generalised suffix automaton of the templates' word sequences, base phrases included."""

    def __init__(self, base=None, templates=None):
        self.base = [(words_of(p), label) for p, label in (BASE if base is None else base)]
        self.templates = [(label, words_of(t)) for label, t in (TEMPLATES if templates is None else templates)]
        # a string shorter than MIN_MATCH words is a match in itself
        self.least_match = min([MIN_MATCH, *[len(ws) for _, ws in self.templates if ws]])
        self.least_run = min([self.least_match, *[len(ws) for ws, _ in self.base if ws]])
        self.needed = [self._needed(label, ws) for label, ws in self.templates]
        self.vocab: dict[bytes, int] = {}
        self.states = [State()]
        strings = [w for w, _ in self.base] + [w for _, w in self.templates]
        coded = [[self.vocab.setdefault(w, len(self.vocab)) for w in ws] for ws in strings]
        for ids in coded:
            last = 0
            for c in ids:
                last = self._extend(last, c)
        states = self.states
        for t, ids in enumerate(coded):
            v = 0
            for j, c in enumerate(ids):
                v = states[v].next[c]  # the whole prefix is in the automaton
                u = v
                while u > 0:
                    if t < len(self.base):
                        if j + 1 == len(ids) and states[u].length >= len(ids) > states[states[u].link].length:
                            states[u].base.append((len(ids), t))
                    else:
                        states[u].ends.append((t - len(self.base), j))
                    u = states[u].link
        for i in sorted(range(1, len(states)), key=lambda i: states[i].length):
            states[i].base = states[i].base + states[states[i].link].base

    @staticmethod
    def _needed(label: str, words: list[bytes]) -> list[list[tuple[int, int]]]:
        """For each distinguishing phrase of the label that the template holds, its places (first word, end)."""
        phrases = [words_of(p) for p in NEEDED.get(label, [])]
        places = [[(i, i + len(p)) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p] for p in phrases]
        return [p for p in places if p]

    def _extend(self, last: int, c: int) -> int:
        s = self.states
        if c in s[last].next:
            q = s[last].next[c]
            return q if s[q].length == s[last].length + 1 else self._clone(last, q, c)
        cur = len(s)
        s.append(State(s[last].length + 1))
        p = last
        while p >= 0 and c not in s[p].next:
            s[p].next[c] = cur
            p = s[p].link
        if p < 0:
            s[cur].link = 0
        else:
            q = s[p].next[c]
            s[cur].link = q if s[q].length == s[p].length + 1 else self._clone(p, q, c)
        return cur

    def _clone(self, p: int, q: int, c: int) -> int:
        s = self.states
        clone = len(s)
        s.append(State(s[p].length + 1, s[q].link, dict(s[q].next)))
        while p >= 0 and s[p].next.get(c) == q:
            s[p].next[c] = clone
            p = s[p].link
        s[q].link = clone
        return clone

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, float]]]:
        """Base hits (first word, base phrase) and template spans (first word, end, template, share covered)."""
        ids = np.fromiter((self.vocab.get(w, -1) for w in words), np.int32, len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        states = self.states
        hits, matches = [], []
        for a, b in zip(known[::2].tolist(), known[1::2].tolist()):
            if b - a < self.least_run:  # no phrase or match is that short
                continue
            v, n = 0, 0
            stream = ids[a:b].tolist()
            for j, c in enumerate(stream):
                grown = c in states[v].next
                if not grown and n >= self.least_match:
                    matches.append((a + j - n, n, v))
                while v and c not in states[v].next:
                    v = states[v].link
                    n = states[v].length
                if c in states[v].next:
                    v = states[v].next[c]
                    n += 1
                    for k, t in states[v].base:
                        if k <= n:
                            hits.append((a + j + 1 - k, t))
            if n >= self.least_match:
                matches.append((b - n, n, v))
        return hits, self._chain(matches)

    def _chain(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
        """Chain matches of one template in file and template order; keep chains that cover enough of it.

        A match that occurs several times in a template takes the first occurrence
        behind what the chain covers. Matches come in file order, and a chain
        ends when the next match is too far or can't follow. A chain must hold
        the template's distinguishing phrases, each within one match. Of spans
        that overlap and bear different labels the best covered stays.
        """
        # template: first word, end in file, end in template, covered, matches (first word, end in template)
        open_chains: dict[int, list] = {}
        spans = []

        def close(t: int) -> None:
            first, end, _, covered, matched = open_chains.pop(t)
            share = covered / len(self.templates[t][1])
            if share >= MIN_COVER and all(any(s <= a and z <= e for a, z in places for s, e in matched) for places in self.needed[t]):
                spans.append((first, end, t, share))

        for at, n, v in matches:
            places: dict[int, list[int]] = {}
            for t, last in self.states[v].ends:
                places.setdefault(t, []).append(last + 1 - n)
            for t, starts in places.items():
                starts = [s for s in starts if s >= 0]
                if not starts:
                    continue
                c = open_chains.get(t)
                if c and at - c[1] <= MAX_GAP:
                    cut = max(0, c[1] - at)  # words that the chain has already
                    later = [s for s in starts if s + cut >= c[2]]
                    if later and n > cut:
                        c[1], c[2], c[3] = at + n, min(later) + n, c[3] + n - cut
                        c[4].append((min(later), min(later) + n))
                        continue
                if c:
                    if c[3] >= MIN_COVER * len(self.templates[t][1]) or at - c[1] > MAX_GAP or n > c[3]:
                        close(t)
                    else:
                        continue
                open_chains[t] = [at, at + n, min(starts) + n, n, [(min(starts), min(starts) + n)]]
        for t in list(open_chains):
            close(t)
        best: list[tuple[int, int, int, float]] = []
        for span in sorted(spans, key=lambda x: (-x[3], -len(self.templates[x[2]][1]), x)):
            label = self.templates[span[2]][0]
            if all(span[1] <= b[0] or b[1] <= span[0] or self.templates[b[2]][0] == label for b in best):
                best.append(span)
        return sorted(best)


def scan_licenses(docs: DataFrame, base=None, templates=None) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: ``doc_id, n_words, base_hits, spans, score``.

    ``base_hits`` (first word, end, label) are all places of the base phrases.
    ``spans`` (first word, end, label, cover) are chains of long matches that
    cover at least MIN_COVER of a template and the words that tell it from its
    siblings (NEEDED); where labels compete the best covered wins. ``score`` is the largest cover, 1
    for a base phrase. Null and empty texts have no words, no hits and score 0.
    Repeated rows come out repeatedly, an empty table gives an empty result; further columns are ignored.
    """
    machine = Automaton(base, templates)

    def work(batches):
        for ids, texts in batches:
            out = []
            for t in texts:
                words = words_of(t)
                hits, spans = machine.scan(words)
                out.append((len(words),
                            [{"first": a, "end": a + len(machine.base[k][0]), "label": machine.base[k][1]} for a, k in sorted(hits)],
                            [{"first": a, "end": e, "label": machine.templates[k][0], "cover": x} for a, e, k, x in spans],
                            1.0 if hits else max((x for *_, x in spans), default=0.0)))
            yield [ids, *[list(c) for c in zip(*out)]]

    hit, span = "struct<first:bigint,end:bigint,label:string>", "struct<first:bigint,end:bigint,label:string,cover:double>"
    return map_rows(docs.select("doc_id", "text"),
                    f"doc_id bigint, n_words bigint, base_hits array<{hit}>, spans array<{span}>, score double", work)
