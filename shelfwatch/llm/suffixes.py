"""Repeated passages by suffix order and longest-previous-factor (operator 3).

Sorting all suffixes of a corpus by a shuffle would move it hundreds of times
over. Every window of ``min_len`` bytes holds an anchor, the least hash among
its ``gram``-byte strings, and equal windows hold the same anchor at the same
place. Anchors that occur more than once are looked at again with what all
windows share that hold them in their first or in their last part. Only
suffixes around what is repeated there meet: those that start there are sorted, and the order of the suffixes that start
one byte further left is induced from it, byte by byte, with their common
prefixes. The longest previous factor of a suffix is its longest common prefix
with the next suffix before or behind it in suffix order that starts earlier in
the corpus (previous and next smaller position); a window has an earlier copy if
that is min_len or more. Whole surroundings that are equal byte for byte are
told by a hash of 128 bits, and only one of them is sorted.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_rows, stage_mapped
from shelfwatch.session import stage_table

MIN_LEN = 400
GRAM = 128
PIECE = 1 << 20
BLOCK = 4096
#: anchors with more different surroundings than this are sorted in parts, which then exchange window hashes
GROUP = 20_000
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.default_rng(400).integers(1, 1 << 63, 256, dtype=_U)


def _mix(x):
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Hasher:
    """Hashes of substrings of one byte array after another."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, _U)

    def load(self, a: np.ndarray) -> Hasher:
        n = len(a) + 1
        if n > len(self.power):
            self.power = np.cumprod(np.concatenate(([_U(1)], np.full(n, _BASE, _U))))
            self.inverse = np.cumprod(np.concatenate(([_U(1)], np.full(n, _INVERSE, _U))))
        self.total = np.zeros(n, _U)
        np.cumsum(_LETTERS[a] * self.power[:n - 1], out=self.total[1:])
        return self

    def all(self, k: int) -> np.ndarray:
        return _mix((self.total[k:] - self.total[:-k]) * self.inverse[:len(self.total) - k])

    def some(self, first: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.total[end] - self.total[first]) * self.inverse[first] + (end - first).astype(_U))


def _anchors(h: np.ndarray, w: int) -> np.ndarray:
    """Places of the least value (the leftmost of equal ones) of every ``w`` values in a row."""
    bits = _U(max(1, int(len(h) - 1).bit_length()))
    low = (h >> bits << bits) | np.arange(len(h), dtype=_U)
    size = 1
    while size * 2 <= w:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if size < w:
        low = np.minimum(low[:len(low) - (w - size)], low[w - size:])
    at = (low & ((_U(1) << bits) - _U(1))).astype(np.int64)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def anchors_of(b: bytes, min_len: int, gram: int, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of a text: places and hashes of their grams."""
    n = len(b)
    found = []
    for s in range(0, n - min_len + 1, PIECE):  # the windows that start in this piece
        base = max(0, s - min_len)
        end = min(n, s + PIECE + 2 * min_len)
        a = np.frombuffer(b, np.uint8, end - base, base)
        hasher.load(a)
        first = s - base
        windows = min(PIECE, n - min_len + 1 - s)
        h = hasher.all(gram)
        at = _anchors(h[first:first + windows + min_len - gram], min_len - gram + 1) + first
        found.append((at + base, h[at]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at, kg = (np.concatenate(c) for c in zip(*found))
    at, keep = np.unique(at, return_index=True)
    return at, kg[keep]


def halves_of(b: bytes, at: np.ndarray, min_len: int, gram: int, hasher: Hasher) -> list[tuple[np.ndarray, ...]]:
    """For the windows that hold an anchor in their first and in their last part: the
    start of what they all share, its hash, and the hash of all that they hold."""
    n, side = len(b), min_len - gram
    half = side // 2
    out = []
    for near in np.split(at, np.flatnonzero(np.diff(at // PIECE)) + 1) if len(at) else []:
        base = max(0, int(near[0]) - min_len)
        hasher.load(np.frombuffer(b[base:int(near[-1]) + 2 * min_len], np.uint8))
        for k, (back, core, steps) in enumerate(((0, min_len - half, half), (half + 1, gram + half + 1, side - half - 1))):
            q = near - back
            q = q[(q >= 0) & (q + core <= n)]
            lo, hi = np.maximum(q - steps, 0), np.minimum(q + min_len, n)
            out.append((q, np.full(len(q), steps), _mix(hasher.some(q - base, q + core - base) + _U(k)),
                        _mix(hasher.some(lo - base, hi - base) + (q - lo).astype(_U))))
    return out


def _next_less(rank: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every place the nearest one before it that holds a smaller rank (-1: none), and the least ``lcp`` on the way.

    ``lcp[i]`` belongs to places i - 1 and i. A place that doesn't hold a smaller
    rank hands on its own answer so far, so the steps double, and all places
    take theirs together.
    """
    n = len(rank)
    at, least = np.arange(-1, n - 1), lcp.copy()
    open_ = np.arange(n)
    while True:
        open_ = open_[at[open_] >= 0]
        open_ = open_[rank[at[open_]] > rank[open_]]
        if not len(open_):
            return at, least
        via = at[open_]
        least[open_] = np.minimum(least[open_], least[via])
        at[open_] = at[via]


def longest_previous(rank: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """The longest previous factor of each suffix: its longest common prefix with a suffix of smaller rank.

    Suffixes stand in suffix order; ``rank`` is their order in the corpus, no
    two alike, and ``lcp[i]`` the common prefix of i - 1 and i (0 for the first)."""
    n = len(rank)
    before, m = _next_less(rank, lcp)
    behind, k = _next_less(rank[::-1], np.concatenate(([0], lcp[:0:-1])))
    return np.maximum(np.where(before >= 0, m, 0), np.where(behind >= 0, k, 0)[::-1]) if n else np.zeros(0, np.int64)


def repeats_in_block(group: np.ndarray, rank: np.ndarray, left: np.ndarray, texts: list[bytes], min_len: int, gram: int,
                     first_stays: bool) -> np.ndarray:
    """Which windows around anchors are repeated: (offset of the anchor in the window, member) -> bool.

    Members of a group share ``gram`` bytes at ``left`` in their texts; ``rank``
    orders members by position in the corpus. With ``first_stays`` the window
    of least rank among equal ones isn't marked.
    """
    n, steps = len(texts), min_len - gram
    out = np.zeros((steps + 1, n), bool)
    right = [t[k:] for t, k in zip(texts, left.tolist())]
    order = np.array(sorted(range(n), key=lambda i: (group[i], right[i])), np.int64)
    room = np.array([len(r) for r in right])
    table = np.frombuffer(b"".join([r.ljust(min_len, b"\0") for r in right]), np.uint8).reshape(n, min_len)
    before = np.frombuffer(b"".join([t[:k][::-1].ljust(steps, b"\0") for t, k in zip(texts, left.tolist())]), np.uint8).reshape(n, steps)
    a, b = order[:-1], order[1:]
    apart = table[a] != table[b]
    same = np.where(apart.any(axis=1), apart.argmax(axis=1), min_len)
    same = np.where(group[a] == group[b], np.minimum(same, np.minimum(room[a], room[b])), 0)
    lcp = np.concatenate(([0], same))  # common bytes with the suffix before
    for o in range(steps + 1):
        near = lcp >= min_len
        if near.any():
            some = np.flatnonzero(near | np.append(near[1:], False))  # the others share less with their neighbours
            place = rank[order[some]]
            common = np.where(near[some], lcp[some], 0)  # 0 parts the runs
            factor = longest_previous(place, common)
            if not first_stays:  # the same with the corpus read backwards: the longest later factor
                factor = np.maximum(factor, longest_previous(-place, common))
            out[o, order[some[factor >= min_len]]] = True
        if o == steps:
            break
        # go one byte to the left; who can't reach min_len any more stays behind
        reach = np.maximum(lcp, np.append(lcp[1:], 0)) >= gram + o
        live = np.flatnonzero(reach & (left[order] > o))
        if len(live) < 2:
            break
        key = group[order[live]] * 256 + before[order[live], o]
        sort = np.argsort(key, kind="stable")
        live, key = live[sort], key[sort]
        span = np.empty(2 * (len(live) - 1), np.int64)
        linked = key[1:] == key[:-1]
        span[::2] = np.where(linked, live[:-1] + 1, 0)
        span[1::2] = np.where(linked, live[1:] + 1, 1)
        least = np.minimum.reduceat(np.append(lcp, 0), span)[::2]
        order, lcp = order[live], np.concatenate(([0], np.where(linked, least + 1, 0)))
    return out


def _runs(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(member, first offset, last offset) of each run of marks along the offsets."""
    edge = np.diff(np.pad(marked.T.astype(np.int8), ((0, 0), (1, 1))), axis=1)
    who, first = np.nonzero(edge == 1)
    return who, first, np.nonzero(edge == -1)[1] - 1


def _ranks(ids: list, th: list, pos: list) -> np.ndarray:
    low = -(1 << 63)
    order = sorted(range(len(ids)), key=lambda i: (low if ids[i] is None else ids[i], th[i], pos[i]))
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    return rank


_PIECE_OUT = ("doc_id bigint, th bigint, first bigint, end bigint, kg bigint, off int, wh bigint")


def _find(contexts: DataFrame, min_len: int, gram: int, first_stays: bool) -> DataFrame:
    """Repeated byte ranges of anchors' members; for groups in parts also one row per different window (``wh`` not null)."""
    def work(batches):
        hasher = Hasher()

        def block(rows):
            ids, th, pos, kg, part, parts, left, texts = (list(c) for c in zip(*rows))
            names = {}
            group = np.array([names.setdefault((k, p), len(names)) for k, p in zip(kg, part)], np.int64)
            rank, lefts = _ranks(ids, th, pos), np.array(left, np.int64)
            marked = repeats_in_block(group, rank, lefts, texts, min_len, gram, first_stays)
            who, first, last = _runs(marked)
            out = [(ids[m], th[m], pos[m] - z, pos[m] - a + min_len, None, None, None)
                   for m, a, z in zip(who.tolist(), first.tolist(), last.tolist())]
            seen = {}  # of groups in parts: the first member with a window
            for m in sorted(np.flatnonzero(np.array(parts) > 1).tolist(), key=rank.__getitem__):
                t = np.frombuffer(texts[m], np.uint8)
                if len(t) >= min_len:
                    h = hasher.load(t).all(min_len)
                    offs = left[m] - np.arange(len(h))
                    for o, x in zip(offs.tolist(), h.view(np.int64).tolist()):
                        if 0 <= o <= min_len - gram:
                            seen.setdefault((kg[m], part[m], o, x), m)
            out += [(ids[m], th[m], pos[m] - o, pos[m] - o + min_len, k, o, x) for (k, _, o, x), m in seen.items()]
            return [list(c) for c in zip(*out)] if out else None

        held = []
        for cells in batches:
            held += zip(*cells)
            # only whole groups; the last one may go on in the next batch
            while len(held) > BLOCK and held[0][3:5] != held[-1][3:5]:
                cut = min(len(held) - 1, BLOCK)
                while cut < len(held) and held[cut][3:5] == held[cut - 1][3:5]:
                    cut += 1
                if cut == len(held):
                    cut = BLOCK
                    while held[cut][3:5] == held[cut - 1][3:5]:
                        cut -= 1
                if out := block(held[:cut]):
                    yield out
                held = held[cut:]
        if held and (out := block(held)):
            yield out

    return map_rows(contexts, _PIECE_OUT, work)


def word_hashes(b: bytes, hasher: Hasher) -> np.ndarray:
    """A hash of every word (run of bytes other than the six spaces) of a text."""
    a = np.frombuffer(b, np.uint8)
    space = (a == 32) | (a >= 9) & (a <= 13)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    if not len(edge):
        return np.zeros(0, _U)
    return hasher.load(a).some(edge[::2], edge[1::2])


def _word_windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every ``k`` words in a row."""
    n = len(words)
    if n < k:
        return np.zeros(0, _U)
    power = np.cumprod(np.concatenate(([_U(1)], np.full(n, _BASE, _U))))
    inverse = np.cumprod(np.concatenate(([_U(1)], np.full(n, _INVERSE, _U))))
    total = np.concatenate(([_U(0)], np.cumsum(words * power[:n])))
    return _mix((total[k:] - total[:-k]) * inverse[:n - k + 1])


def shared_windows(base: DataFrame, words: int) -> DataFrame:
    """``(doc_id, th, n_shared)``: how many different windows of ``words`` words of a text another row has too.

    Of every ``words`` words in a row the least hashed run of half as many is an
    anchor; texts that share a window share its anchor, and only windows around
    shared anchors are compared, by 64-bit hashes.
    """
    half = (words + 1) // 2

    def anchors(batches):
        hasher = Hasher()
        for ids, th, texts in batches:
            out = []
            for i, h, t in zip(ids, th, texts):
                runs = _word_windows(word_hashes(t.encode("utf-8", "surrogatepass"), hasher), half)
                if len(runs) > words - half:
                    out += [(i, h, g) for g in np.unique(runs[_anchors(runs, words - half + 1)]).view(np.int64).tolist()]
            if out:
                yield [list(c) for c in zip(*out)]

    def windows(batches):
        hasher = Hasher()
        for ids, th, texts, shared in batches:
            out = []
            for i, h, t, gs in zip(ids, th, texts, shared):
                seq = word_hashes(t.encode("utf-8", "surrogatepass"), hasher)
                runs = _word_windows(seq, half)
                at = _anchors(runs, words - half + 1)
                at = at[np.isin(runs[at].view(np.int64), np.array(gs, np.int64))]
                whole = _word_windows(seq, words)
                near = np.zeros(len(whole) + 1, np.int64)  # windows that hold an anchor
                np.add.at(near, np.maximum(at - (words - half), 0), 1)
                np.add.at(near, np.minimum(at + 1, len(whole)), -1)
                out += [(i, h, w) for w in np.unique(whole[np.cumsum(near[:-1]) > 0]).view(np.int64).tolist()]
            if out:
                yield [list(c) for c in zip(*out)]

    grams = stage_mapped(map_rows(base.select("doc_id", "th", "text"), "doc_id bigint, th bigint, kg bigint", anchors), "runs")
    often = stage_table(grams.groupBy("kg").agg(F.count("*").alias("n")).where("n > 1").select("kg"), "often")
    mine = grams.join(often, "kg", "left_semi").groupBy("doc_id", "th").agg(F.collect_set("kg").alias("gs"))
    found = stage_mapped(map_rows(base.join(mine, ["doc_id", "th"]).select("doc_id", "th", "text", "gs"), "doc_id bigint, th bigint, wh bigint", windows), "shared")
    again = found.groupBy("wh").agg(F.count("*").alias("n")).where("n > 1").select("wh")
    return found.join(again, "wh", "left_semi").groupBy("doc_id", "th").agg(F.count_distinct("wh").alias("n_shared"))


def repeated_spans(docs: DataFrame, min_len: int = MIN_LEN, gram: int = GRAM, keep: str = "first", group: int = GROUP,
                   with_text: bool = False, words: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, spans, kept_sha256`` (and ``kept``, the bytes left;
    with ``words`` also ``n_shared``: different windows of so many words that another row has too).

    Texts are taken as UTF-8 bytes, null as empty. A byte is removed if a
    window of ``min_len`` bytes over it also starts elsewhere: with keep="first"
    at an earlier position (documents in order of doc_id, null first, then a
    hash of the text), so the first copy stays; with keep="none" anywhere, so
    all copies go. Windows are judged on the input, may overlap and don't cross
    documents. Rows equal in doc_id and text are copies of each other for
    keep="none"; for keep="first" they are one document. ``spans`` (first, end)
    are maximal. Null and shorter texts stay whole, an empty table gives an empty
    result, further columns are ignored. Equality rests on 64-bit hashes for grams and 128 bits for
    whole surroundings; windows are compared byte by byte in suffix order.
    """
    first_stays = keep == "first"
    side = min_len - gram
    text = F.coalesce("text", F.lit(""))
    # (doc_id, th) names a row; doc_id is not null from here on, a null one is in th
    low = F.lit(-(1 << 63)).cast("long")
    base = docs.select(F.coalesce("doc_id", low).alias("doc_id"), F.xxhash64(F.col("doc_id").isNull(), text).alias("th"), text.alias("text"))

    def find(batches):
        hasher = Hasher()
        for ids, th, texts in batches:
            got = [anchors_of(t.encode("utf-8", "surrogatepass"), min_len, gram, hasher) for t in texts]
            who = np.repeat(np.arange(len(ids)), [len(at) for at, _ in got]).tolist()
            at, kg = (np.concatenate(c) for c in zip(*got))
            yield [[ids[i] for i in who], [th[i] for i in who], at.astype(np.int32), kg.view(np.int64)]

    def halve(batches):
        hasher = Hasher()
        for ids, th, texts, ats in batches:
            out = []
            for i, h, t, at in zip(ids, th, texts, ats):
                for q, steps, kg, cls in halves_of(t.encode("utf-8", "surrogatepass"), np.sort(np.array(at, np.int64)), min_len, gram, hasher):
                    out += zip([i] * len(q), [h] * len(q), q.tolist(), steps.tolist(), kg.view(np.int64).tolist(), cls.view(np.int64).tolist())
            if out:
                yield [list(c) for c in zip(*out)]

    anchors = stage_mapped(map_rows(base.where(F.octet_length("text") >= min_len), "doc_id bigint, th bigint, pos int, kg bigint", find), "anchors")
    often = stage_table(anchors.groupBy("kg").agg(F.count("*").alias("n")).where("n > 1").select("kg"), "often")
    shared = (anchors.join(often, "kg", "left_semi").groupBy("doc_id", "th")
              .agg(F.collect_set("pos").alias("ats")))
    # every document that shares an anchor, with its text; equal rows stay, they count as copies
    cand = stage_table(base.join(shared, ["doc_id", "th"]), "candidates")
    parts_of = stage_mapped(map_rows(cand.select("doc_id", "th", "text", "ats"), "doc_id bigint, th bigint, pos int, steps int, kg bigint, cls bigint", halve), "halves")
    classes = parts_of.groupBy("kg", "cls").agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "th", "pos")).alias("rep"))
    classes = stage_table(classes, "classes")
    kinds = stage_table(classes.groupBy("kg").agg(F.count("*").alias("kinds"), F.sum("copies").alias("n")).where("n > 1").select("kg", "kinds"), "kinds")
    told = classes.join(kinds, "kg")
    here = F.struct("doc_id", "th", "pos")
    marks = stage_table(
        parts_of.join(told, ["kg", "cls"])
        .withColumn("lead", here.eqNullSafe(F.col("rep")))
        .withColumn("full", (F.col("copies") > 1) & (~F.col("lead") if first_stays else F.lit(True)))
        .withColumn("ask", (F.col("kinds") > 1) & F.col("lead"))
        .where("full OR ask").withColumn("parts", F.ceil(F.col("kinds") / group).cast("int"))
        .select("doc_id", "th", "pos", "steps", "kg", "full", "ask", "parts").distinct(), "marks")
    asks = marks.where("ask").groupBy("doc_id", "th").agg(
        F.collect_list(F.struct("pos", "steps", "kg", "parts")).alias("asks"))

    def cut(batches):
        for ids, th, texts, all_asks in batches:
            out = []
            for i, h, t, ms in zip(ids, th, texts, all_asks):
                b = t.encode("utf-8", "surrogatepass")
                for m in ms:
                    p, n = m["pos"], m["parts"]
                    lo = max(0, p - m["steps"])
                    out.append((i, h, p, m["kg"], hash((i, p)) % n if n > 1 else 0, n, p - lo, b[lo:p + min_len]))
            yield [list(c) for c in zip(*out)]

    contexts = map_rows(cand.select("doc_id", "th", "text").join(asks, ["doc_id", "th"]).select("doc_id", "th", "text", "asks"),
                        "doc_id bigint, th bigint, pos int, kg bigint, part int, parts int, left int, bytes binary", cut)
    contexts = contexts.repartition("kg", "part").sortWithinPartitions("kg", "part")
    pieces = stage_mapped(_find(contexts, min_len, min_len - side // 2, first_stays), "pieces")
    windows = pieces.where("wh IS NOT NULL")
    window_kinds = windows.groupBy("kg", "off", "wh").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "first")).alias("least")).where("n > 1")
    across = windows.join(window_kinds, ["kg", "off", "wh"])
    if first_stays:
        across = across.where(~F.struct("doc_id", "th", "first").eqNullSafe(F.col("least")))
    whole = marks.where("full").select("doc_id", "th", F.greatest(F.col("pos") - F.col("steps"), F.lit(0)).cast("long").alias("first"),
                                       (F.col("pos") + min_len).cast("long").alias("end"))
    ranges = pieces.where("wh IS NULL").select("doc_id", "th", "first", "end").unionAll(whole) \
        .unionAll(across.select("doc_id", "th", "first", "end"))
    ranges = ranges.groupBy("doc_id", "th").agg(F.collect_set(F.struct("first", "end")).alias("ranges"))
    hit = cand.select("doc_id", "th", "text").join(ranges, ["doc_id", "th"]).select("doc_id", "th", "text", "ranges")

    def remove(batches):
        for ids, th, texts, all_ranges in batches:
            spans_of, kept_of = [], []
            for t, rs in zip(texts, all_ranges):
                b = t.encode("utf-8", "surrogatepass")
                spans = []
                for a, z in sorted((r["first"], min(r["end"], len(b))) for r in rs):
                    if spans and a <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], z)
                    else:
                        spans.append({"first": a, "end": z})
                cuts = [0, *[x for s in spans for x in (s["first"], s["end"])], len(b)]
                kept_of.append(b"".join([b[a:z] for a, z in zip(cuts[::2], cuts[1::2])]))
                spans_of.append(spans)
            yield [ids, th, spans_of, [hashlib.sha256(k).hexdigest() for k in kept_of], kept_of if with_text else [None] * len(ids)]

    done = stage_mapped(map_rows(hit, "doc_id bigint, th bigint, spans array<struct<first:bigint,end:bigint>>, sha string, bytes_left binary",
                                 remove), "removed").dropDuplicates(["doc_id", "th"])  # of equal rows
    all_docs = base.select("doc_id", "th", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("own_sha"),
                           *([F.col("text")] if with_text else []))
    if words is not None:
        all_docs = all_docs.join(shared_windows(base, words), ["doc_id", "th"], "left")
    out = all_docs.join(done, ["doc_id", "th"], "left").withColumn("doc_id", F.when(F.col("doc_id") != low, F.col("doc_id")))
    spans = F.coalesce("spans", F.array().cast("array<struct<first:bigint,end:bigint>>"))
    return out.select("doc_id", "n_bytes",
                      F.aggregate(spans, F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["first"]).alias("n_removed"),
                      spans.alias("spans"), F.coalesce("sha", "own_sha").alias("kept_sha256"),
                      *([F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared")] if words is not None else []),
                      *([F.coalesce("bytes_left", F.encode("text", "utf-8")).alias("kept")] if with_text else []))
