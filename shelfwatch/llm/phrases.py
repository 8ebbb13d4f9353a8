"""Document fingerprints by locally consistent parsing (operator 5).

A text is cut into phrases at places that only the symbols around them decide,
phrases get names, and the row of names is cut again. Equal substrings are cut
alike wherever they stand, apart from a few phrases at their ends.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import map_rows
from shelfwatch.operators.keys import with_global_rank

#: slots of the sketch for the phrases of each level, which are the weights of the levels: phrases of the
#: lowest (about 3 characters) are common to all texts of a language
LEVEL_SLOTS = (8, 32, 24)
SLOTS = sum(LEVEL_SLOTS)
SYMBOLS_AT_ONCE = 1 << 20
#: text of a bucket; more where there would be over MAX_BUCKETS buckets (760 MB of 100 TB)
BUCKET_BYTES = 16 << 20
MAX_BUCKETS = 1 << 17
#: rows of a bucket, at least, that the split points are chosen from
SAMPLE = 32
_U = np.uint64
_EMPTY = np.iinfo(np.uint64).max


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _toss(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing: the lowest bit in which a symbol differs from
    the one before it, and that bit's value. Symbols that differ from their
    neighbour get labels that do too; a text's first symbol is compared with
    itself in its lowest bit flipped."""
    prev = np.empty_like(x)
    prev[1:] = x[:-1]
    prev[first] = x[first] ^ x.dtype.type(1)
    d = x ^ prev
    low = d & (~d + x.dtype.type(1))
    place = np.bitwise_count(low - x.dtype.type(1))
    return (place << 1 | ((x & low) != 0)).astype(np.uint8)


def parse(x: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of many non-empty texts in a row, and where each text's names start."""
    n = len(x)
    # a run of one symbol becomes one symbol
    fresh = np.empty(n, bool)
    fresh[0] = True
    np.not_equal(x[1:], x[:-1], out=fresh[1:])
    fresh[starts] = True
    at = np.flatnonzero(fresh)
    runs = np.diff(np.append(at, n))
    starts = np.searchsorted(at, starts)
    sym = _mix(x[at].astype(_U) + _U(0x9E3779B97F4A7C15) * runs.astype(_U))
    label = _toss(sym, starts)
    for _ in range(3):  # 64 bits, then fewer than 128, 14, 8 and 6 labels
        label = _toss(label, starts)
    m = len(sym)
    cut = np.zeros(m, bool)  # a phrase starts at a label greater than both neighbours
    cut[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    cut[starts] = True
    last = np.append(starts[1:], m) - 1
    cut[last[last > starts]] = False
    begin = np.flatnonzero(cut)
    sizes = np.diff(np.append(begin, m))
    inside = np.arange(m) - np.repeat(begin, sizes)
    powers = np.cumprod(np.full(int(sizes.max()) + 1, 0x9E3779B97F4A7C15, _U))
    return _mix(np.add.reduceat(sym * powers[inside], begin) + sizes.astype(_U)), np.searchsorted(begin, starts)


def sketches(texts: list[str]) -> np.ndarray:
    """(texts, SLOTS) sketch: in each slot 16 bits of the least phrase name that falls into it; -1: none.

    Every level has slots of its own, whatever the length of the text."""
    out = np.full(len(texts) * SLOTS, _EMPTY, _U)
    at = 0
    while at < len(texts):
        group, n = [], 0
        while at + len(group) < len(texts) and (not group or n < SYMBOLS_AT_ONCE):
            group.append(texts[at + len(group)])
            n += len(group[-1])
        rows = np.array([i for i, t in enumerate(group) if t], np.int64)
        if len(rows):
            x = np.frombuffer("".join(group).encode("utf-32-le", "surrogatepass"), "<u4")
            starts = np.concatenate(([0], np.cumsum([len(group[i]) for i in rows])[:-1])).astype(np.int64)
            first = 0
            for slots in LEVEL_SLOTS:
                x, starts = parse(x, starts)
                doc = np.repeat(rows, np.diff(np.append(starts, len(x)))) + at
                np.minimum.at(out, doc * SLOTS + first + (x % _U(slots)).astype(np.int64), x >> _U(6))
                first += slots
        at += len(group)
    return np.where(out == _EMPTY, -1, (_mix(out) >> _U(48)).astype(np.int64)).reshape(len(texts), SLOTS)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common phrases: equal slots among those that either fills; 1 for two empty texts."""
    used = int(((a >= 0) | (b >= 0)).sum())
    return float(((a == b) & (a >= 0)).sum() / used) if used else 1.0


def to_text(sketch: np.ndarray) -> str:
    """Four hex digits per slot, dots for an empty one."""
    return "".join([f"{v:04x}" if v >= 0 else "...." for v in sketch.tolist()])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``docs(doc_id, text)``; null texts are empty, an empty text fills no slot."""
    def work(batches):
        for ids, texts in batches:
            yield [ids, [to_text(s) for s in sketches([t or "" for t in texts])]]
    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, fingerprint string", work)


def split_points(keyed: DataFrame, n: int, buckets: int) -> list[tuple[int, int]]:
    """``buckets - 1`` pairs ``(key, h)`` of rows of ``keyed(key, h)`` that cut its ``n`` rows into near equal parts, ascending.

    They are chosen from a sample by row position, of at least SAMPLE rows a
    bucket and at most twice that (all rows, where there are not more)."""
    if buckets == 1:
        return []
    one_of = max(1, n // (buckets * SAMPLE))
    chance = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(one_of))
    ranked = with_global_rank(keyed.select("key", "h", chance.alias("c")).where("c = 0").select("key", "h"), ["key", "h"], "r")
    size = ranked.agg(F.max("r")).first()[0] or 0
    step = lambda r: F.floor(r * buckets / F.lit(max(size, 1)))
    cuts = ranked.where((F.col("r") < size) & (step(F.col("r")) > step(F.col("r") - 1))).orderBy("r").select("key", "h")
    return [(r["key"], r["h"]) for r in cuts.collect()]  # fewer than MAX_BUCKETS


def bucket_of(cuts: list[tuple[int, int]]):
    """Pandas function of (key, h, salt): how many cuts lie below a row; rows that equal several cuts are spread over their buckets by the salt."""
    keys, hashes = (np.array([c[i] for c in cuts], np.int64) for i in (0, 1))

    def place(key: pd.Series, h: pd.Series, salt: pd.Series) -> pd.Series:
        k, v, s = key.to_numpy(), h.to_numpy(), salt.to_numpy()
        out, end = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        shared = np.flatnonzero(end > out)  # rows whose key is that of a cut
        for lo in np.unique(out[shared]):
            at = shared[out[shared] == lo]
            inside = hashes[lo:end[at[0]]]
            least, most = np.searchsorted(inside, v[at], "left"), np.searchsorted(inside, v[at], "right")
            out[at] = lo + least + s[at] % np.maximum(most - least, 1)
        return pd.Series(out.astype(np.int32))

    return F.pandas_udf(place, "int")


def with_next(docs: DataFrame) -> DataFrame:
    """Rows sorted by descending doc_id in contiguous buckets: ``bucket, ahead, doc_id, text``.

    Each bucket ends with a copy of the row that follows it (``ahead`` true);
    behind the last bucket that is the first row of all. So every row's
    successor is its neighbour in a partition, and a text is shuffled once.
    Equal doc_ids are ordered by a hash of the text and split by it; a null
    doc_id comes last. Rows equal in both may stand in any bucket between
    their neighbours. The number of buckets follows from the bytes of all texts.
    """
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).cast("long").alias("key"), F.xxhash64(text).alias("h"), "doc_id", text.alias("text"))
    n, size, top = keyed.agg(F.count(F.lit(1)), F.sum(F.octet_length("text")), F.max(F.struct("key", "h"))).first()
    if not n:
        return keyed.select(F.lit(0).alias("bucket"), F.lit(False).alias("ahead"), "doc_id", "text")
    buckets = max(1, min(MAX_BUCKETS, size // BUCKET_BYTES, n // SAMPLE))
    cuts = split_points(keyed, n, buckets)
    bucket = F.lit(0)
    if cuts:
        bucket = bucket_of(cuts)("key", "h", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 31)))
    rows = keyed.select(bucket.alias("bucket"), F.lit(False).alias("ahead"), "key", "h", "doc_id", "text")
    # a cut is the greatest row of its bucket and follows the bucket above it; the greatest of all follows the lowest bucket
    heads = spark.createDataFrame([(0, *top), *[(i + 1, *c) for i, c in enumerate(cuts)]], "to int, key long, h long")
    found = (keyed.join(F.broadcast(heads.select("key", "h").distinct()), ["key", "h"])  # at most MAX_BUCKETS rows
             .groupBy("key", "h").agg(F.max(F.struct("doc_id", "text")).alias("r")))
    ends = found.join(F.broadcast(heads), ["key", "h"]).select(F.col("to").alias("bucket"), F.lit(True).alias("ahead"), "key", "h", "r.doc_id", "r.text")
    return (rows.unionByName(ends).repartitionById(buckets, F.col("bucket"))
            .sortWithinPartitions("bucket", "ahead", F.col("key").desc(), F.col("h").desc())
            .select("bucket", "ahead", "doc_id", "text"))


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of the following text."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def edit_study(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    One row per row of ``docs(doc_id, text)``: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``; the next document
    is the one with the next lower doc_id, after the lowest the highest. A
    table of one row is followed by itself, an empty table gives an empty
    result. Null texts are empty; repeated rows come out repeatedly; further
    columns are ignored.
    """
    def work(batches):
        held = None  # the last row, which waits for its successor, with its sketch
        for buckets, ahead, ids, texts in batches:
            own = sketches(texts)
            rows = list(zip(buckets, ahead, ids, texts, own))
            if held is not None:
                rows.insert(0, held)
            held = rows[-1]
            pairs = [(a, b) for a, b in zip(rows, rows[1:]) if a[0] == b[0] and not a[1]]
            changed = [edited(a[3], b[3]) for a, b in pairs]
            marks = sketches(changed)
            yield [[a[2] for a, _ in pairs], [len(a[3]) for a, _ in pairs],
                   [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
                   [to_text(a[4]) for a, _ in pairs], [to_text(m) for m in marks],
                   [likeness(a[4], m) for (a, _), m in zip(pairs, marks)], [likeness(a[4], b[4]) for a, b in pairs]]

    return map_rows(with_next(docs), "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
                    "edited_fingerprint string, near_edited double, near_next double", work)
