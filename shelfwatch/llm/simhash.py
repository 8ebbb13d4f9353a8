"""SimHash near-duplicates with deletion-variant signatures (operator 10)."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.llm.common import LOWER_AZ, map_rows, stage_mapped
from shelfwatch.llm.components import connected_components
from shelfwatch.session import stage_table

BITS = 64
SEED = 42


def simhash(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit fingerprint of one text; 0 for null and for texts without words."""
    words = (text or "").encode().translate(LOWER_AZ).split()  # bytes split at exactly the six spaces of the word rule
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = [0, *(ends + 1).tolist()]
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())]
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return int(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """``(doc_id, fp)``: the fingerprint of every text as a signed long."""
    def work(batches):
        for ids, texts in batches:
            yield [ids, np.array([simhash(t, shingle) for t in texts], np.uint64).view(np.int64)]
    return map_rows(docs.select("doc_id", "text"), "doc_id bigint, fp bigint", work)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, length) of the fewest segments of which one differs by at most one bit."""
    n = max_bits // 2 + 1
    cuts = [round(i * BITS / n) for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of different fingerprints that differ in at most ``max_bits`` bits.

    Every bit position w gives one variant of its segment: the segment with bit
    w left out. Two fingerprints within ``max_bits`` share a variant of some
    segment; variants are joined by equality, and the join condition verifies
    the distance and admits the pair in its first shared variant only, so a
    pair comes out once and close groups don't multiply. One row per
    fingerprint goes in, whatever the number of copies that bear it.
    """
    cut = segments(max_bits)
    masks = [((1 << n) - 1) << first for first, n in cut]
    fp, w = F.col("fp"), F.col("w")
    seg = F.lit(None).cast("long")
    for (first, n), m in reversed(list(zip(cut, masks))):
        seg = F.when(w < first + n, F.shiftrightunsigned(fp.bitwiseAND(_long(m)), first)
                     .bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), w - first)))).otherwise(seg)
    variants = (fps.select("fp").distinct()
                .select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("w"))
                .select("fp", F.call_function("shiftleft", w.cast("long"), F.lit(33)).bitwiseOR(seg).alias("key")))
    a, b = variants.alias("a"), variants.alias("b")
    x = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    bit = F.shiftright(F.col("a.key"), 33).cast("int")
    first_shared = F.lit(False)
    apart = F.lit(True)  # all earlier segments differ in two bits or more
    for (first, n), m in zip(cut, masks):
        diff = x.bitwiseAND(_long(m))
        here = (diff == F.call_function("shiftleft", F.lit(1).cast("long"), bit)) | ((diff == 0) & (bit == first))
        first_shared = first_shared | ((bit >= first) & (bit < first + n) & apart & here)
        apart = apart & (F.bit_count(diff) >= 2)
    # 64 rows per fingerprint, which the planner judges by the file of fingerprints: never through the driver
    return a.join(b.hint("merge"), (F.col("a.key") == F.col("b.key")) & (F.col("a.fp") < F.col("b.fp"))
                  & (F.bit_count(x) <= max_bits) & first_shared).select(F.col("a.fp").alias("a"), F.col("b.fp").alias("b"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs(doc_id, text)``.

    component_id is the least doc_id that links of at most ``max_bits`` bits
    reach, the row's own included. Null and wordless texts bear fingerprint 0
    and are linked by it like any other. Rows with a null doc_id keep their
    links but never name a component unless all of it is null. Repeated rows
    come out repeatedly, an empty table gives an empty result; further columns
    are ignored.
    """
    fps = stage_mapped(fingerprints(docs, shingle), "fps")
    reps = stage_table(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "reps")
    roots = connected_components(links(reps, max_bits)).toDF("fp", "root")
    # tables of a row per fingerprint grow with the data: joined by sorting, none goes through the driver
    named = reps.join(roots.hint("merge"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(least.hint("merge"), "root").select("fp", "component_id")
    return fps.join(named.hint("merge"), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``docs`` whose doc_id names their component: one document of each group.

    Copies of one row (same doc_id) are one document here and all stay or all go.
    """
    found = near_duplicates(docs, shingle, max_bits)
    drop = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("_drop")).distinct()
    return docs.join(drop, docs["doc_id"].eqNullSafe(drop["_drop"]), "left_anti")
