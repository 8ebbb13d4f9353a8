"""Mixing sources to target weights over time (operator 6); DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.llm.common import WORD, before_sums
from shelfwatch.session import stage_table

#: per weight class: relative demand at the start and at the end of training (mean 1)
SCHEDULE = {1: (1.5, 0.5), 2: (1.0, 1.0), 3: (0.5, 1.5)}
MAX_EPOCHS = 3


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Target of each source from ``(skey, source, size)`` rows.

    Sources in code point order, null last, weigh 1, 2, 3, 1, ... and share the
    sum of all sizes; a source stops at ``max_epochs`` times its size, and the
    excess is shared again by weight among the others. In order of limit per
    weight the sources that stop form a prefix, so one pass over the (few)
    sources gives the final shares.
    """
    src = sizes.groupBy("skey", "source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy()
    rank = F.row_number().over(Window.partitionBy().orderBy(F.col("source").asc_nulls_last()))
    src = (src.withColumn("weight", (1 + (rank - 1) % 3).cast("long"))
           .withColumn("most", F.col("source_size") * max_epochs)
           .withColumn("total", F.sum("source_size").over(everything)))
    filling = Window.partitionBy().orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far = filling.rowsBetween(Window.unboundedPreceding, -1)
    src = (src.withColumn("rest", F.col("total") - F.coalesce(F.sum("most").over(so_far), F.lit(0)))
           .withColumn("rest_weight", F.sum("weight").over(filling.rowsBetween(0, Window.unboundedFollowing)))
           .withColumn("at", F.row_number().over(filling))
           .withColumn("stops", F.col("most") * F.col("rest_weight") < F.col("rest") * F.col("weight")))
    share = F.min(F.when(~F.col("stops"), F.struct("at", "rest", "rest_weight"))).over(everything)
    return (src.withColumn("share", share)
            .withColumn("target", F.when(F.col("stops") & (F.col("at") < F.col("share.at")), F.col("most").cast("double"))
                        .otherwise(F.col("share.rest").cast("double") * F.col("weight") / F.col("share.rest_weight")))
            .select("skey", "weight", "source_size", "target"))


def curriculum(docs: DataFrame, keep: list[str] | None = None, schedule: dict | None = None,
               max_epochs: int = MAX_EPOCHS, bucket_digits: int = 3) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, copies, taken, positions``,
    and the columns named in ``keep`` as ``keep_<name>``.

    Within its source a document has a fixed hashed place; a source that needs
    several epochs passes its documents again in the same order. The demand of
    a source at time t is its target times a linear ramp (``schedule``); its
    integral is inverted at the words taken before a copy, which gives the time
    (0 to 1) at which the copy is trained on. A copy is taken if at least half
    of it lies within the target, so a source misses its target by at most half
    a document. Documents without words (null texts too) are taken zero times.
    A null source is a source of its own. Equal rows are ordered arbitrarily
    among themselves, which doesn't change the rows as a whole.
    """
    keep = keep or []
    order_key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
    base = docs.select(
        "doc_id", *[F.col(c).alias(f"keep_{c}") for c in keep], "source",
        F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("skey"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        order_key.alias("place"), F.crc32(F.coalesce("text", F.lit(""))).alias("crc"))
    base = stage_table(base.withColumn("slice", F.conv(F.substring("place", 1, bucket_digits), 16, 10).cast("int")), "mix")
    targets = source_targets(base.select("skey", "source", "size"), max_epochs).withColumnRenamed("skey", "_skey")
    laid = before_sums(base, "skey", "slice", [F.col("place"), F.col("doc_id"), F.col("size"), F.col("crc")], F.col("size"), "before")
    laid = laid.join(targets, F.col("skey") == F.col("_skey"))
    ramps = schedule or SCHEDULE
    start = F.lit(1.0)
    slope = F.lit(0.0)
    for weight, (s, e) in ramps.items():
        start = F.when(F.col("weight") == weight, F.lit(float(s))).otherwise(start)
        slope = F.when(F.col("weight") == weight, F.lit(float(e - s))).otherwise(slope)
    laid = laid.withColumn("ramp_start", start).withColumn("ramp_slope", slope)
    copies = F.lit(0)
    for e in range(max_epochs):
        middle = (F.lit(e) * F.col("source_size") + F.col("before")).cast("double") + F.col("size") / 2.0
        copies = copies + F.when((F.col("size") > 0) & (middle <= F.col("target")), 1).otherwise(0)
    laid = laid.withColumn("copies", copies)

    def position(epoch):
        done = (epoch * F.col("source_size") + F.col("before")).cast("double") / F.col("target")
        ramp = (F.sqrt(F.col("ramp_start") * F.col("ramp_start") + F.lit(2.0) * F.col("ramp_slope") * done)
                - F.col("ramp_start")) / F.col("ramp_slope")
        return F.when(F.col("ramp_slope") == 0, done / F.col("ramp_start")).otherwise(ramp)

    positions = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position)) \
        .otherwise(F.array().cast("array<double>"))
    return laid.select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
                       positions.alias("positions"), *[f"keep_{c}" for c in keep])


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per taken copy, range-sorted by training position."""
    return (mixed.select("*", F.posexplode("positions").alias("copy", "position")).drop("positions")
            .orderBy("position", "doc_id", "copy"))
