"""Benchmark decontamination by CGK embedding and bit-sampling LSH (operator 1).

Candidates come from two families of windows. CGK walks start at words whose
pair with the next word occurs in an item. At one edit in five characters few
walks stay in step for a whole window, so these alone find what is copied with
few edits. The other family starts at every character, of items and documents:
runs of four characters, as many as the item's length allows for the target
recall, with none or one character (SHAPES) between two of them on either side,
which steps over one edit of any kind as a walk that falls into step again does.
"""

from __future__ import annotations

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_rows

SIMILARITY = 0.8  # 1 - edits / characters of the item
REPEATS = 3
#: recall of run windows at edits spread at random up to the verified similarity; sets how many runs an item's windows have
TARGET = 0.95
RUN = 4
#: items of fewer characters leave windows too little room and are searched exactly, by pieces of which edits leave one whole
SHORT = 12
#: windows of one, two and three runs: places of the four-character strings that a key hashes. The last but one takes
#: edits six characters apart, the last (two runs of six) such as are further apart
SHAPES = (((0,),), ((0, 4), (0, 5)), ((0, 4, 8), (0, 4, 9), (0, 5, 9), (0, 5, 10), (0, 5, 11), (0, 2, 7, 9)))
MOST_RUNS, REACH = len(SHAPES), max(max(s) for shapes in SHAPES for s in shapes) + RUN
#: steps of the walk per window class, and how many of them a key samples
CLASSES = ((8, 8), (32, 12), (128, 20))
MAP_BITS = 22
SLICE = 1 << 18  # bytes of items that a pass over the documents looks for
PIECE = 1 << 20
BATCH = 1 << 12
LOOK = 4096
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_MIXERS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)


def normal(text: str | None) -> bytes:
    """Lower case, one space between words."""
    return b" ".join((text or "").lower().encode("utf-8", "surrogatepass").split())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _tables():
    rng = np.random.default_rng(2016)
    letters = rng.integers(1, 1 << 63, 256, dtype=_U)
    steps = max(t for t, _ in CLASSES)
    walks = rng.integers(0, 2, (REPEATS, steps, 256), dtype=np.int64)
    sampled = [[np.sort(rng.choice(t, m, replace=False)) for t, m in CLASSES] for _ in range(REPEATS)]
    return letters, walks, sampled


_LETTERS, _WALKS, _SAMPLED = _tables()


def word_pairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all words that another one follows after one space, and a hash of each such pair.

    ``a`` holds normalised texts, each closed by a zero byte.
    """
    n = len(a)
    gap = (a == 32) | (a == 0)
    starts = np.flatnonzero(~gap & np.concatenate(([True], gap[:-1])))
    if not len(starts):
        return starts, np.zeros(0, _U)
    ends = np.flatnonzero(gap & np.concatenate(([False], ~gap[:-1])))
    if len(ends) < len(starts):
        ends = np.append(ends, n)
    power = np.cumprod(np.concatenate(([_U(1)], np.full(n, _BASE, _U))))
    total = np.concatenate(([_U(0)], np.cumsum(_LETTERS[a] * power[:n])))
    inverse = np.cumprod(np.concatenate(([_U(1)], np.full(n, _INVERSE, _U))))
    word = _mix((total[ends] - total[starts]) * inverse[starts])
    pair = np.flatnonzero((ends[:-1] + 1 == starts[1:]) & (a[np.minimum(ends[:-1], n - 1)] == 32))
    return starts[pair], _mix(word[pair] * _U(3) + word[pair + 1])


def window_keys(a: np.ndarray, at: np.ndarray, room: np.ndarray | None) -> list[tuple[np.ndarray, np.ndarray]]:
    """LSH keys of the windows that start at ``at``: (index into ``at``, key), for each repeat and class.

    The CGK walk puts out the byte under its pointer in each step and moves on
    or stays by a random bit of (step, byte); after a difference two walks fall
    into step again soon, so few edits give few unequal steps. A key hashes the
    bytes put out at sampled steps. With ``room`` (bytes left in the item) a
    window must have as many bytes as its class has steps.
    """
    out = []
    last = len(a) - 1
    for r in range(REPEATS):
        keys = [np.full(len(at), 1 + r * len(CLASSES) + c, _U) for c in range(len(CLASSES))]
        p = at.copy()
        marks = [set(s.tolist()) for s in _SAMPLED[r]]
        for j in range(_WALKS.shape[1]):
            byte = a[np.minimum(p, last)]
            for c, s in enumerate(marks):
                if j in s:
                    keys[c] = keys[c] * _U(_BASE) + byte + _U(1)
            p += _WALKS[r, j][byte]
        for c, (steps, _) in enumerate(CLASSES):
            keep = np.arange(len(at)) if room is None else np.flatnonzero(room >= steps)
            out.append((keep, _mix(keys[c][keep]).view(np.int64)))
    return out


def item_classes(n_bytes: int) -> list[int]:
    """Classes of which an item shows windows: all that leave it several, but the shortest only if no other does."""
    fitting = [c for c, (t, _) in enumerate(CLASSES) if t * 3 // 2 <= n_bytes]
    return fitting[1:] or fitting or ([0] if n_bytes >= CLASSES[0][0] else [])


def folded(text: str) -> np.ndarray:
    """A byte per character: ASCII as it is, all others hashed to 128..255; 0 is left for the ends of texts."""
    a = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(a) and a.max() > 127:
        a = np.where(a < 128, a, np.uint32(128) + (a * np.uint32(0x9E3779B1) >> np.uint32(25)))
    return np.maximum(a.astype(np.uint8), 1)


def run_keys(a: np.ndarray, runs: int):
    """Keys of the windows of ``runs`` runs at every character, for each shape: (characters, keys).
    ``a`` goes on for REACH bytes behind the last key."""
    n = len(a) - REACH
    b = a.astype(np.uint32)
    g = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    parts = [g * np.uint32(m) for m, _ in zip(_MIXERS, max(SHAPES[runs - 1], key=len))]
    for shape in SHAPES[runs - 1]:
        key = parts[0][:n]
        for part, at in zip(parts[1:], shape[1:]):
            key = key + part[at:at + n]
        yield shape[-1] + RUN, key


def run_recall(chars: int, runs: int, similarity: float, trials: int = 400) -> float:
    """Share of items of so many characters that keep a window of ``runs`` runs under the most edits that the
    similarity allows: substitutions, deletions and insertions at random places, drawn here."""
    rng = np.random.default_rng(chars * 8 + runs)
    edits = int((1 - similarity) * chars + 1e-9)
    hurt = np.argsort(rng.random((trials, chars)), axis=1)[:, :edits]
    kind = np.zeros((trials, chars), np.int8)
    np.put_along_axis(kind, hurt, rng.integers(1, 4, (trials, edits), dtype=np.int8), axis=1)
    lost, before = (kind == 1) | (kind == 2), kind == 3  # ``before``: a character was put in before this one
    room = chars - RUN + 1
    if room < 1:
        return 0.0
    whole = ~lost[:, :room]
    for i in range(1, RUN):
        whole = whole & ~lost[:, i:i + room] & ~before[:, i:i + room]
    good = whole
    for _ in range(runs - 1):
        ahead = np.zeros((trials, room + RUN + 2), bool)
        ahead[:, :room] = good
        put = np.zeros((trials, room + RUN + 2), bool)
        put[:, :chars] = before[:, :room + RUN + 2]
        # next to each other (one character put in at most), or one character apart in the item and at most one in the text
        good = whole & (ahead[:, RUN:RUN + room] | ahead[:, RUN + 1:RUN + 1 + room] & ~put[:, RUN:RUN + room] & ~put[:, RUN + 1:RUN + 1 + room])
    return float(good.any(axis=1).mean())


_LEAST: dict[tuple[float, int], int] = {}


def least_chars(similarity: float, runs: int) -> int:
    """Characters from which on windows of ``runs`` runs reach TARGET (an item with fewer gets fewer runs)."""
    if runs == 1:
        return RUN
    if (similarity, runs) in _LEAST:
        return _LEAST[similarity, runs]
    lo, hi = runs * RUN, 2048
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if run_recall(mid, runs, similarity) >= TARGET else (mid + 1, hi)
    _LEAST[similarity, runs] = lo
    return lo


def runs_of(chars: int, similarity: float) -> int:
    return max([r for r in range(1, MOST_RUNS + 1) if chars >= least_chars(similarity, r)], default=0)


class Table:
    """Keys and the places that bear them, behind two maps of some bits of the keys."""

    def __init__(self, keys: np.ndarray, places: np.ndarray):
        order = np.lexsort((places, keys))
        keys, places = keys[order], places[order]
        new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (places[1:] != places[:-1])))[:len(keys)]
        self.places = places[new]
        self.keys, self.first, self.count = np.unique(keys[new], return_index=True, return_counts=True)
        self.map, self.second = np.zeros(1 << MAP_BITS, bool), np.zeros(1 << (MAP_BITS - 1), bool)
        self.map[self._bit(self.keys)] = True
        self.second[self._bit(self.keys * self.keys.dtype.type(_MIXERS[0]), 1)] = True

    @staticmethod
    def _bit(keys: np.ndarray, less: int = 0) -> np.ndarray:
        return keys >> keys.dtype.type(keys.dtype.itemsize * 8 - MAP_BITS + less)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into ``keys``, place) of all equal keys."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        there = np.flatnonzero(self.map[self._bit(keys)])
        there = there[self.second[self._bit(keys[there] * keys.dtype.type(_MIXERS[0]), 1)]]
        some = keys[there]
        k = np.minimum(np.searchsorted(self.keys, some), len(self.keys) - 1)
        same = self.keys[k] == some
        there, k = there[same], k[same]
        n = self.count[k]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(there, n), self.places[np.repeat(self.first[k], n) + inside]


class Bench:
    """Some items, with the keys of their windows and the bit vectors that their alignments need."""

    def __init__(self, rows: list[tuple[int | None, str | None]], similarity: float):
        self.ids, self.texts = [], []
        self.short: list[tuple[int | None, str, int]] = []
        for i, t in rows:
            t = normal(t).decode("utf-8", "surrogatepass")
            if len(t) >= SHORT:
                self.ids.append(i)
                self.texts.append(t)
            elif t:
                self.short.append((i, t, int((1 - similarity) * len(t) + 1e-9)))
        pieces = [folded(t) for t in self.texts]
        self.chars = np.array([len(t) for t in self.texts], np.int64)
        self.start = np.cumsum([0, *(self.chars + 1)])[:-1].astype(np.int64)
        self.edits = np.floor((1 - similarity) * self.chars + 1e-9).astype(np.int64)
        self.owner = np.repeat(np.arange(len(pieces)), self.chars + 1)
        runs = [([], []) for _ in range(MOST_RUNS)]
        walk_keys, walk_places = [], []
        for a, t, start in zip(pieces, self.texts, self.start.tolist()):
            n = runs_of(len(a), similarity)
            for size, keys in run_keys(np.concatenate((a, np.zeros(REACH, np.uint8))), n):
                fits = max(0, len(a) - size + 1)
                runs[n - 1][0].append(keys[:fits])
                runs[n - 1][1].append(np.arange(fits) + start)
            classes = item_classes(len(t.encode("utf-8", "surrogatepass")))
            closed = np.append(a, np.uint8(0))
            at, pairs = word_pairs(closed)
            if len(at):
                for k, (keep, keys) in enumerate(window_keys(closed, at, len(a) - at)):
                    if k % len(CLASSES) in classes:
                        walk_keys.append((keys.view(_U), pairs[keep]))
                        walk_places.append(at[keep] + start)
        self.runs = [Table(np.concatenate([np.zeros(0, np.uint32), *k]), np.concatenate([np.zeros(0, np.int64), *p])) for k, p in runs]
        self.walks = Table(np.concatenate([np.zeros(0, _U), *[k for k, _ in walk_keys]]), np.concatenate([np.zeros(0, np.int64), *walk_places]))
        pairs = np.concatenate([np.zeros(0, _U), *[p for _, p in walk_keys]])
        self.pairs = Table(pairs, np.zeros(len(pairs), np.int64))
        # bit vectors of the items and of the items backwards, a word more than they need, one after the other
        letters = np.unique(np.concatenate([np.zeros(1, np.uint8), *pieces]))
        self.letter = np.zeros(256, np.int64)  # 0 stands for all that no item has
        self.letter[letters] = np.arange(len(letters))
        self.words = (self.chars + 63) // 64 + 1
        sizes = self.words * len(letters)
        self.base = (np.cumsum(sizes) - sizes).astype(np.int64)
        self.vectors = [np.zeros(int(sizes.sum()), _U) for _ in range(2)]
        for a, base, w in zip(pieces, self.base.tolist(), self.words.tolist()):
            for way, x in zip(self.vectors, (a, a[::-1])):
                j = np.arange(len(x))
                np.bitwise_or.at(way, base + self.letter[x] * w + (j >> 6), _U(1) << (j & 63).astype(_U))

    def hits(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Characters of ``a`` and of the items where windows are alike."""
        found = []
        closed, part = np.concatenate((a, np.zeros(REACH, np.uint8))), PIECE >> 3
        for s in range(0, len(a), part):
            for n, table in enumerate(self.runs, 1):
                for _, keys in run_keys(closed[s:s + part + REACH], n) if len(table.keys) else ():
                    at, place = table.find(keys)
                    found.append((at + s, place))
        for s in range(0, len(a) if len(self.walks.keys) else 0, PIECE):
            first = max(0, s - 1)
            part = a[first:s + PIECE + LOOK]
            at, pairs = word_pairs(part)
            mine = (at + first >= s) & (at + first < s + PIECE) & ((at + first > s) | (s == 0) | np.isin(part[0], (0, 32)))
            at = at[mine]
            at = at[self.pairs.find(pairs[mine])[0]]
            if len(at):
                for keep, keys in window_keys(part, at, None):
                    k, place = self.walks.find(keys.view(_U))
                    found.append((at[keep][k] + first, place))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, place = (np.concatenate(c) for c in zip(*found))
        order = np.lexsort((at, at - place))
        at, place = at[order], place[order]
        # windows less than a run apart on a diagonal: an alignment through the later goes through the first too
        first = np.concatenate(([True], (np.diff(at - place) != 0) | (np.diff(at) > RUN)))[:len(at)]
        return at[first], place[first]

    def fewest(self, letters, at, item, offset, rows, budget, back: bool) -> np.ndarray:
        """Fewest edits that turn ``rows`` characters of the item from ``offset`` on into a string that starts at ``at``.

        With ``back`` all goes to the left from there. Columns of the edit
        matrix are bit vectors in words; alignments of a batch go on together.
        """
        out = rows.copy()
        width = (rows + 63) // 64
        order = np.lexsort((rows + budget, width))
        vectors, step = self.vectors[back], -1 if back else 1
        for n in np.unique(width[width > 0]).tolist():
            own = order[width[order] == n]
            for s in range(0, len(own), BATCH):
                k = own[s:s + BATCH]
                start = offset[k] if not back else self.chars[item[k]] - offset[k]
                shift = (start & 63).astype(_U)
                rest = _U(63) - shift
                words, base = self.words[item[k]], self.base[item[k]] + (start >> 6)
                last = words - 1 - (start >> 6)  # the item's last word is 0, and so are all behind it
                up = [np.full(len(k), ~_U(0)) for _ in range(n)]
                down = [np.zeros(len(k), _U) for _ in range(n)]
                bit = ((rows[k] - 1) & 63).astype(_U)
                cost, best = rows[k].copy(), rows[k].copy()
                p = at[k] - back
                ahead_by = [np.minimum(w + 1, last) for w in range(n)]
                for _ in range(int((rows[k] + budget[k]).max())):
                    row = base + letters.take(p, mode="clip") * words
                    p += step
                    rise_in, fall_in = _U(1), _U(0)
                    here = vectors.take(row)
                    for w in range(n):
                        ahead = vectors.take(row + ahead_by[w])
                        eq = here >> shift | ahead << _U(1) << rest
                        here = ahead
                        u, d = up[w], down[w]
                        xv = eq | d
                        if w:
                            eq |= fall_in
                        xh = (((eq & u) + u) ^ u) | eq
                        rise, fall = d | ~(xh | u), u & xh
                        if w == n - 1:
                            cost += ((rise >> bit & _U(1)) - (fall >> bit & _U(1))).view(np.int64)
                            np.minimum(best, cost, out=best)
                            rise, fall = rise << _U(1) | rise_in, fall << _U(1) | fall_in
                        else:
                            carry = rise >> _U(63), fall >> _U(63)
                            rise, fall = rise << _U(1) | rise_in, fall << _U(1) | fall_in
                            rise_in, fall_in = carry
                        up[w], down[w] = fall | ~(xv | rise), rise & xv
                out[k] = best
        return out

    def aligned(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hits of which one side can be aligned within the item's edits: places in ``a``, items and places in them.

        No hit that an alignment within the edits goes through is lost: the cost
        of a part of an item is never above that of the whole. Alignments may
        run into the next text and take other letters for equal (``folded``).
        """
        at, place = self.hits(a)
        item = self.owner[place]
        place = place - self.start[item]
        letters = np.concatenate((self.letter[a], [0]))
        budget = self.edits[item]

        def cost(k, most, back):
            side = place[k] if back else self.chars[item[k]] - place[k]
            return self.fewest(letters, at[k], item[k], place[k], np.minimum(side, most), budget[k], back)

        left = place > self.chars[item] // 2  # the longer side first, and of it no more than tells chance from a copy
        kept = []
        for back in (False, True):
            k = np.flatnonzero(left == back)
            kept.append(k[cost(k, (budget[k] * 11 // 5 + 63) // 64 * 64, back) <= budget[k]])
        k = np.concatenate(kept)
        return at[k], item[k], place[k]


def best_match(item: str, text: str) -> tuple[int, int]:
    """Fewest edits that turn ``item`` into some part of ``text``, and where that part ends.

    Exact; columns of the edit matrix are bit vectors in Python integers.
    """
    found = text.find(item)
    if found >= 0:
        return 0, found + len(item)
    m = len(item)
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, cost = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        eq = masks.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        rise = down | (full & ~(diag | up))
        fall = up & diag
        if rise & top:
            cost += 1
        elif fall & top:
            cost -= 1
        rise = (rise << 1) & full  # a match may start anywhere: the top row is 0
        fall = (fall << 1) & full
        up = fall | (full & ~(diag | rise))
        down = rise & diag
        if cost < best:
            best, end = cost, j + 1
    return best, end


def short_match(item: str, edits: int, text: str) -> tuple[int, int] | None:
    """Fewest edits, if at most ``edits``, that turn ``item`` into a part of ``text``, and a place where it lies. Exact.

    So many edits leave one of ``edits`` + 1 pieces of the item as it is."""
    at = text.find(item)
    if at >= 0 or not edits:
        return (0, at) if at >= 0 else None
    best = None
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    for a, z in zip(cuts, cuts[1:]):
        at = text.find(item[a:z])
        while at >= 0 and (best is None or best[0] > 1):
            first = max(0, at - a - edits)
            found, _ = best_match(item, text[first:at - a + len(item) + edits])
            if found <= edits and (best is None or found < best[0]):
                best = found, first
            at = text.find(item[a:z], at + 1)
    return best


def _found(docs: DataFrame, bench: Bench, similarity: float) -> DataFrame:
    """All places of documents that hold an item of ``bench``."""
    # by value: executors need no copy of this module
    shared = docs.sparkSession.sparkContext.broadcast(cloudpickle.dumps(bench))

    def row(doc, item_id, text, edits, first, region):
        return (doc[0], item_id, edits, len(text), 1 - edits / len(text), len(doc[1][:first].encode("utf-8", "surrogatepass")), region)

    def places(held, b):
        for doc in held:
            for item_id, text, most in b.short:
                if (found := short_match(text, most, doc[1])) is not None:
                    yield row(doc, item_id, text, *found, doc[1][found[1]:found[1] + len(text) + 2 * most])
        if not b.texts:
            return
        known: dict[tuple[int, str], tuple[int, int]] = {}
        parts = [folded(t) for _, t in held]
        a = np.concatenate([x for p in parts for x in (p, np.zeros(1, np.uint8))])
        ends = np.cumsum([len(p) + 1 for p in parts])
        at, item, place = b.aligned(a)
        doc = np.searchsorted(ends, at, side="right")
        at = at - np.concatenate(([0], ends))[doc]
        first, end = at - place - b.edits[item] - 1, at - place + b.chars[item] + b.edits[item] + 1
        spans: list[list[int]] = []
        for k in np.lexsort((first, item, doc)).tolist():
            span = [int(doc[k]), int(item[k]), max(0, int(first[k])), int(end[k])]
            if spans and spans[-1][:2] == span[:2] and span[2] <= spans[-1][3]:
                spans[-1][3] = max(spans[-1][3], span[3])
            else:
                spans.append(span)
        for d, i, first, end in spans:
            text, region = b.texts[i], held[d][1][first:end]
            if (i, region) not in known:
                known[i, region] = best_match(text, region)
            edits, _ = known[i, region]
            if edits <= (1 - similarity) * len(text) + 1e-9:
                yield row(held[d], b.ids[i], text, edits, first, region)

    def work(batches):
        b = cloudpickle.loads(shared.value)
        held, size = [], 0
        for ids, texts in batches:
            out = []
            for i, t in zip(ids, texts):
                t = normal(t).decode("utf-8", "surrogatepass")
                if not t:
                    continue
                held.append((i, t))
                size += len(t)
                if size > 4 * PIECE:
                    out += places(held, b)
                    held, size = [], 0
            if out:
                yield [list(c) for c in zip(*out)]
        if held:
            out = list(places(held, b))
            if out:
                yield [list(c) for c in zip(*out)]

    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, item_id bigint, edits bigint, item_chars bigint, similarity double, first bigint, region string", work)


def contaminated(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Documents that hold a benchmark item: ``doc_id, item_id, edits, item_chars, similarity, first, region``.

    ``docs(doc_id, text)``, ``items(item_id, text)``. A document holds an item
    if some part of its text (in lower case, runs of spaces as one) is within
    (1 - similarity) x the item's characters in edits of it. Candidates come
    from equal keys of windows at all characters; each is verified by exact edit
    distance, so all rows are right, and recall is probabilistic: an item has a
    window per character, of which one has to survive, and windows are short
    enough for TARGET at edits spread at random. Short items are searched
    exactly in every text; null and empty items and texts match nothing. One row
    per document and item with the fewest edits; repeated rows count once, an
    empty table on either side gives an empty result, further columns are ignored.
    ``first`` is a byte offset of the matched region in the normalised text.
    Documents are read once for each SLICE bytes of items.
    """
    rows = items.where("text IS NOT NULL").select("item_id", "text").distinct()
    slices = max(1, -(-(rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // SLICE))
    found = None
    for s in range(slices):
        some = sorted(((r["item_id"], r["text"]) for r in rows.where(F.pmod(F.xxhash64("text"), F.lit(slices)) == s).collect()), key=str)
        part = _found(docs, Bench(some, similarity), similarity)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "item_id").agg(
        F.min(F.struct("edits", "first", "item_chars", "similarity", "region")).alias("m")).select(
        "doc_id", "item_id", "m.edits", "m.item_chars", "m.similarity", "m.first", "m.region")


def decontaminate(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no item."""
    bad = contaminated(docs.select("doc_id", "text"), items, similarity).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["_bad"]), "left_anti")
