"""Spelling variants by blocked Gram matrices of letter counts (operator 11).

One inserted or deleted letter changes the letter counts of a word by a squared
distance of 1, one replaced letter by 2 at most. Words lie in blocks of equal
length and equal counts of a few groups of letters; a block meets itself and
the adjacent blocks of its length and of the length above, whose group counts
an edit can reach. For two blocks A and B the matrix product of their letter
counts gives all squared distances at once; pairs at most two apart are
verified letter by letter. Only links between near words leave a task, added
up for each word.
"""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import LOWER_AZ, map_rows, stage_mapped
from shelfwatch.session import stage_table

LEAST_CHARS, LEAST_COUNT, FORM_TIMES = 7, 2, 10
RUN = "[A-Za-zÀ-ÿ]"
#: one run in so many loses a letter
LOSS = 31
#: words that a task counts before it passes the counts on
WORDS_AT_ONCE = 100_000
#: words of a tile, the part of a block that a task holds, and letters of it
TILE, TILE_LETTERS = 1024, 1 << 14
#: letter pairs compared at a time
COMPARED = 1 << 22


def counted_words(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``(word, n)``: words of ``docs(doc_id, text)`` with at least so many characters and occurrences."""
    # what has too few letters stays too short; a run is taken from its first letter to its last
    runs = re.compile(f"{RUN}{{{least_chars},}}")
    lower = {c: c + 32 for c in range(65, 91)}

    def work(batches):
        known: dict[str, int] = {}
        for ids, texts in batches:
            for i, t in zip(ids, texts):
                if not t:
                    continue
                start = zlib.crc32(b"" if i is None else str(i).encode())
                start = zlib.crc32(b":", start)
                t = t.encode("utf-8", "surrogatepass").translate(LOWER_AZ).decode("utf-8", "surrogatepass") if t.isascii() else t.translate(lower)
                own: dict[str, int] = {}
                for w in runs.findall(t):
                    own[w] = own.get(w, 0) + 1
                for w, k in own.items():
                    h = zlib.crc32(w.encode(), start)
                    if h % LOSS == 0:
                        at = h % len(w)
                        w = w[:at] + w[at + 1:]
                        if len(w) < least_chars:
                            continue
                    known[w] = known.get(w, 0) + k
                if len(known) > WORDS_AT_ONCE:
                    yield [list(known), list(known.values())]
                    known = {}
        if known:
            yield [list(known), list(known.values())]

    found = map_rows(docs.select("doc_id", "text"), "word string, n bigint", work)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def letter_groups(words: int) -> int:
    """Groups of letters whose counts tell blocks apart: the more words, the more groups; results don't depend on it."""
    return min(12, max(2, round(math.log10(max(words, 1)))))


def _steps(groups: int) -> list[list[int]]:
    """Where a block meets its adjacent blocks: differences in (length, counts of all groups but the last), each pair of blocks once."""
    unit = [[int(i == j) for j in range(groups)] for i in range(groups)]
    same = [[0] * groups] + [[a - b for a, b in zip(unit[i], unit[j])] for i in range(groups) for j in range(groups) if i != j]
    replaced = [[0, *s[:-1]] for s in same if s >= [0] * groups]
    put_in = [[1, *u[:-1]] for u in unit]
    return replaced + put_in


def tiles(words: DataFrame, groups: int) -> DataFrame:
    """``(block, part, words, n)``: words of a block in parts of about TILE, as concatenated Latin-1 letters and their counts."""
    letters = [chr(c) for c in (*range(97, 123), *range(0xC0, 0x100))]
    size = F.length("word")
    counts = [size - F.length(F.translate("word", "".join(letters[g::groups]), "")) for g in range(groups - 1)]
    placed = words.select("word", "n", F.array(size, *counts).alias("block"))
    heads = placed.groupBy("block").agg(F.count("*").alias("k")).select(
        "block", F.greatest(F.ceil(F.col("k") / TILE), F.ceil(F.col("k") * F.col("block")[0] / TILE_LETTERS)).cast("int").alias("parts"))
    return (placed.join(heads, "block")
            .withColumn("part", F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"))
            .groupBy("block", "part").agg(F.collect_list(F.struct("word", "n")).alias("w"))
            .select("block", "part", F.encode(F.array_join("w.word", ""), "ISO-8859-1").alias("words"), F.col("w.n").alias("n")))


def _counts(a: np.ndarray, letters: np.ndarray) -> np.ndarray:
    """Letter counts of the words of equal length in the rows of ``a``, for the ``letters`` in use."""
    n, length = a.shape
    column = np.zeros(256, np.int64)
    column[letters] = np.arange(len(letters))
    flat = (np.arange(n)[:, None] * len(letters) + column[a]).ravel()
    # products of counts are exact in single precision while they stay below 2**24
    return np.bincount(flat, minlength=n * len(letters)).reshape(n, -1).astype(np.float32 if length < 4096 else np.float64)


def near_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` that one edit turns into each other; words of ``b`` are as long as those of ``a`` or one letter longer."""
    letters = np.unique(np.concatenate((a.ravel(), b.ravel())))
    ca, cb = _counts(a, letters), _counts(b, letters)
    apart = (ca * ca).sum(axis=1)[:, None] + (cb * cb).sum(axis=1) - 2 * (ca @ cb.T)
    i, j = np.nonzero(apart <= 2)
    keep = np.zeros(len(i), bool)
    length, step = a.shape[1], max(1, COMPARED // max(1, a.shape[1]))
    for s in range(0, len(i), step):
        x, y = a[i[s:s + step]], b[j[s:s + step]]
        if b.shape[1] == length:
            keep[s:s + step] = (x != y).sum(axis=1) == 1
        else:
            ahead = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
            behind = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            keep[s:s + step] = ahead + behind >= length
    return i[keep], j[keep]


def near_words(words: DataFrame) -> DataFrame:
    """``(word, n_near, best)`` for every word of ``words(word, n)`` that has near words: how many, and
    as (-n, word) the one of largest n, the smallest in code-point order of equal ones."""
    spark = words.sparkSession
    groups = letter_groups(words.count())
    own = stage_table(tiles(words, groups), "tiles")
    steps = F.array(*[F.array(*map(F.lit, s)) for s in _steps(groups)])
    here = own.select(F.explode(steps).alias("step"), "*").select(
        F.zip_with("block", "step", lambda x, y: x + y).alias("meets"), F.col("block").alias("a_block"),
        F.col("part").alias("a_part"), F.col("words").alias("a"), F.col("n").alias("an"))
    there = own.select(F.col("block").alias("meets"), "part", F.col("words").alias("b"), F.col("n").alias("bn"))
    pairs = here.join(there, "meets").where((F.col("a_block") != F.col("meets")) | (F.col("a_part") <= F.col("part"))).select(
        F.col("a_block")[0].alias("la"), F.col("meets")[0].alias("lb"), "a", "an", "b", "bn",
        ((F.col("a_block") == F.col("meets")) & (F.col("a_part") == F.col("part"))).alias("same"))

    def work(batches):
        for rows in batches:
            best: dict[bytes, list] = {}

            def link(held):
                """All tiles in ``held`` against the tile that they have in common."""
                la, lb, _, _, b, bn, _ = held[0]
                a, an = b"".join([h[2] for h in held]), [x for h in held for x in h[3]]
                i, j = near_pairs(np.frombuffer(a, np.uint8).reshape(-1, la), np.frombuffer(b, np.uint8).reshape(-1, lb))
                ends = np.cumsum([len(h[3]) for h in held])
                tile = np.searchsorted(ends, i, side="right")
                own = np.array([h[6] for h in held])[tile]  # a tile against itself: each pair once
                keep = ~own | (i - np.concatenate(([0], ends))[tile] < j)
                for p, q in zip(i[keep].tolist(), j[keep].tolist()):
                    u, v = a[p * la:(p + 1) * la], b[q * lb:(q + 1) * lb]
                    for w, near in ((u, (-bn[q], v)), (v, (-an[p], u))):
                        e = best.get(w)
                        if e is None:
                            best[w] = [1, near]
                        else:
                            e[0] += 1
                            e[1] = min(e[1], near)

            held: list[tuple] = []
            size = 0
            for row in sorted(zip(*rows), key=lambda r: (r[1], r[4], r[0])):
                if held and (row[:2] != held[0][:2] or row[4] != held[0][4] or size > 4 * TILE):
                    link(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
            if held:
                link(held)
            if best:
                text = lambda s: s.decode("latin-1")
                yield [list(map(text, best)), [e[0] for e in best.values()],
                       [{"minus_n": e[1][0], "form": text(e[1][1])} for e in best.values()]]

    found = stage_mapped(map_rows(pairs, "word string, n_near bigint, best struct<minus_n:bigint,form:string>", work), "links")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best"))


def spelling_variants(docs: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = FORM_TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``docs(doc_id, text)``.

    Runs of letters lose A-Z's case, and one in LOSS, chosen by the CRC-32 of
    document and run, a letter (a null doc_id counts as empty); words are the
    results with at least ``least_chars`` code points and ``least_count``
    occurrences. Near words differ by one edit. A word's form is its near word
    of largest n (ties: smallest in code-point order) if that is at least
    ``times`` the word's own n; root follows forms to the last one. Null, empty
    and letterless texts add no words, repeated rows count as often as they
    come, further columns are ignored, an empty table gives an empty result.
    """
    words = stage_mapped(counted_words(docs, least_chars, least_count), "words")
    near = near_words(words)
    joined = words.join(near, "word", "left")
    form_n = -F.col("best.minus_n")
    has = form_n >= times * F.col("n")
    out = stage_table(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                                    F.when(has, F.col("best.form")).alias("form"), F.when(has, form_n).alias("form_n")), "forms")
    # every step to a form multiplies n, so chains are short; each round doubles the steps taken
    most = out.agg(F.max(F.col("form_n") / F.col("n"))).first()[0]
    roots = out.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    longest = math.log(out.agg(F.max("n")).first()[0], max(times, 2)) if most else 0
    taken = 1
    while taken < longest:
        ahead = roots.select(F.col("word").alias("root"), F.col("root").alias("then"))
        roots = stage_table(roots.join(ahead, "root", "left").select("word", F.coalesce("then", "root").alias("root")), "roots")
        taken *= 2
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
