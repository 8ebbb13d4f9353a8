"""Secrets in texts by a trigram inverted index (operator 12).

From the regular expression of a rule a Boolean query over trigrams is derived
that every text with a match must satisfy. Documents are indexed in segments:
the texts of a batch, concatenated, give for each trigram that some query asks
for the sorted list of the segment's rows that hold it. Queries intersect and
unite these postings, and only the rows that are left are searched with the
rule itself. A rule without mandatory trigrams searches every row. Segments
live where their texts are read, so texts are never shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from re import _constants as C
from re import _parser as parser

import numpy as np
from pyspark.sql import DataFrame

from shelfwatch.llm.common import LOWER_AZ, map_rows


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern``, leftmost first and not overlapping; those whose ``group`` has fewer than ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base kinds, in their order.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),  # longer runs are whole matches, shorter ones none
)

# Public formats of credentials.
ADDED = (
    Rule("bearer", r"(?i)bearer\x20+[A-Za-z0-9+/_.=-]{16,}"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,1000}\.eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:[\x20\x09-\x0DA-Za-z0-9+/=]*-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("slack", r"xox[abeoprs]-[A-Za-z0-9-]{10,}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{24,}"),
    Rule("url", r"[a-z][a-z0-9+.-]{0,19}://[^\x20\x09-\x0D/:@]+:[^\x20\x09-\x0D/@]+@"),
)

#: alternatives that a mandatory string may have before it is cut
ALTERNATIVES = 64

# A query is None (holds always), a trigram as a number, or ("and" | "or", set of queries).


def _all_of(parts) -> object:
    parts = {q for q in parts if q is not None}
    flat = frozenset(x for q in parts for x in (q[1] if isinstance(q, tuple) and q[0] == "and" else [q]))
    return None if not flat else next(iter(flat)) if len(flat) == 1 else ("and", flat)


def _any_of(parts) -> object:
    parts = frozenset(parts)
    sets = {q: q[1] if isinstance(q, tuple) and q[0] == "and" else frozenset({q}) for q in parts if q is not None}
    # what asks for more than another alternative does adds nothing
    parts = frozenset(q for q in parts if q is None or not any(s < sets[q] for s in sets.values()))
    return None if None in parts or not parts else next(iter(parts)) if len(parts) == 1 else ("or", parts)


def _grams(s: bytes) -> object:
    return _all_of(s[i] << 16 | s[i + 1] << 8 | s[i + 2] for i in range(len(s) - 2))


def _pieces(tree, ignore_case: bool) -> list:
    """A sequence of sets of strings that must stand there in full, and of queries for what lies between."""
    out: list = []
    for op, av in tree:
        if op is C.LITERAL:
            out.append(_letters([av], ignore_case))
        elif op is C.IN:
            out.append(_class(av, ignore_case))
        elif op is C.SUBPATTERN:
            _, add, drop, sub = av
            out += _pieces(sub, (ignore_case or bool(add & re.I)) and not drop & re.I)
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            least, most, sub = av
            if least == 0 and most == 1 and (whole := _whole(sub, ignore_case)) is not None:
                out.append(whole | {b""})
                continue
            part = _pieces(sub, ignore_case)
            out += part * min(least, 4)
            if most != least or least > 4:
                out.append(_Gap(None))
        elif op is C.BRANCH:
            wholes = [_whole(b, ignore_case) for b in av[1]]
            if None not in wholes and len(both := frozenset().union(*wholes)) <= ALTERNATIVES:
                out.append(both)
            else:
                out.append(_Gap(_any_of(_query(_pieces(b, ignore_case)) for b in av[1])))
        elif op in (C.AT, C.ASSERT, C.ASSERT_NOT):
            continue  # no width; leaving out what they ask for only weakens the query
        else:
            out.append(_Gap(None))
    return out


@dataclass(frozen=True)
class _Gap:
    """Anything, if it satisfies the query."""

    query: object


def _letters(codes, ignore_case: bool):
    """Strings of one character; a gap if letter case goes beyond A-Z."""
    if ignore_case and any(c > 127 for c in codes):
        return _Gap(None)
    return frozenset(chr(c).encode("utf-8", "surrogatepass").translate(LOWER_AZ) for c in codes)


def _class(members, ignore_case: bool):
    codes: set[int] = set()
    for op, av in members:
        if op is C.LITERAL:
            codes.add(av)
        elif op is C.RANGE and av[1] - av[0] < 256:
            codes.update(range(av[0], av[1] + 1))
        else:
            return _Gap(None)
    found = _letters(sorted(codes), ignore_case)
    return found if isinstance(found, frozenset) and len(found) <= 16 else _Gap(None)


def _whole(tree, ignore_case: bool):
    """All strings that a part of a pattern can be, or None if they are too many to tell."""
    runs = [frozenset({b""})]
    for p in _pieces(tree, ignore_case):
        if isinstance(p, _Gap) or len(runs[-1]) * len(p) > ALTERNATIVES:
            return None
        runs.append(frozenset(a + b for a in runs[-1] for b in p))
    return runs[-1]


def _query(pieces: list) -> object:
    run, parts = frozenset({b""}), []
    for p in [*pieces, _Gap(None)]:
        if isinstance(p, _Gap) or len(run) * len(p) > ALTERNATIVES:
            parts.append(_any_of(_grams(s) for s in run))
            run = frozenset({b""})
        if isinstance(p, _Gap):
            parts.append(p.query)
        else:
            run = frozenset(a + b for a in run for b in p)
    return _all_of(parts)


def trigram_query(pattern: str) -> object:
    """What the trigrams of a text, A-Z in lower case, must satisfy if ``pattern`` matches in it; None if nothing must.

    Patterns are taken as with re.ASCII: ``(?i)`` concerns A-Z alone.
    """
    return _query(_pieces(tree := parser.parse(pattern, re.A), bool(tree.state.flags & re.I)))


def trigrams(query: object) -> set[int]:
    if isinstance(query, tuple):
        return set().union(*map(trigrams, query[1]))
    return set() if query is None else {query}


class Index:
    """Wanted trigrams, and the postings of a segment of texts."""

    PIECE = 1 << 22

    def __init__(self, wanted: set[int]):
        self.grams = np.array(sorted(wanted), np.uint32)
        self.known = np.zeros(1 << 24, bool)
        self.known[self.grams] = True

    def load(self, texts: Sequence[bytes]) -> Index:
        """Postings of ``texts``: for every wanted trigram the rows that hold it."""
        a = np.frombuffer(b"\0\0".join(texts).translate(LOWER_AZ), np.uint8)
        ends = np.cumsum([len(t) + 2 for t in texts])
        pairs = []
        for s in range(0, len(a), self.PIECE):
            b = a[s:s + self.PIECE + 2].astype(np.uint32)
            code = b[:-2] << np.uint32(16) | b[1:-1] << np.uint32(8) | b[2:]
            at = np.flatnonzero(self.known[code])
            gram = np.searchsorted(self.grams, code[at])
            pairs.append(np.unique(gram * len(texts) + np.searchsorted(ends, at + s, side="right")))
        pairs = np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64)
        gram, row = np.divmod(pairs, max(1, len(texts)))
        cuts = np.searchsorted(gram, np.arange(len(self.grams) + 1))
        self.postings = {int(g): row[lo:hi] for g, lo, hi in zip(self.grams, cuts, cuts[1:])}
        self.everything = np.arange(len(texts))
        return self

    def rows(self, query: object) -> np.ndarray:
        """Sorted rows of the segment that satisfy ``query``."""
        if query is None:
            return self.everything
        if not isinstance(query, tuple):
            return self.postings[query]
        lists = sorted((self.rows(q) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(lists))
        out = lists[0]
        for x in lists[1:]:
            if not len(out):
                break
            out = np.intersect1d(out, x, assume_unique=True)
        return out


def matches(rule: Rule, text: str, compiled: re.Pattern | None = None) -> list[tuple[int, int]]:
    found = (compiled or re.compile(rule.pattern, re.A)).finditer(text)
    return [m.span() for m in found if m.end(rule.group) - m.start(rule.group) >= rule.least]


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE + ADDED) -> DataFrame:
    """``doc_id, spans`` for every row of ``docs(doc_id, text)``; spans are (kind, first, end) in code points, end exclusive.

    Spans come by first, then by the order of the rules; spans of different
    rules may overlap. Null and empty texts have none. Rows are taken one by
    one: repeated ones come out repeatedly, null ids stay, further columns are
    ignored, an empty table gives an empty result. Whole texts are searched.
    """
    rules = tuple(rules)
    queries = [trigram_query(r.pattern) for r in rules]
    wanted = set().union(*map(trigrams, queries)) if queries else set()

    def work(batches):
        index = Index(wanted)
        compiled = [re.compile(r.pattern, re.A) for r in rules]
        for ids, texts in batches:
            texts = [t or "" for t in texts]
            index.load([t.encode("utf-8", "surrogatepass") for t in texts])
            spans: list[list] = [[] for _ in ids]
            for k, (rule, query) in enumerate(zip(rules, queries)):
                for i in index.rows(query).tolist():
                    spans[i] += [(a, k, z) for a, z in matches(rule, texts[i], compiled[k])]
            yield [ids, [[{"kind": rules[k].kind, "first": a, "end": z} for a, k, z in sorted(s)] for s in spans]]

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, spans array<struct<kind:string,first:bigint,end:bigint>>", work)
