"""Position and previous value within a key, robust to hot keys.

``row_number()`` / ``lag()`` over ``PARTITION BY key ORDER BY …`` sends all
rows of a key to one task: a product with a third of the observations would
make one task sort a third of the data. Here:

1. identical rows collapse into counted groups (partial aggregation);
2. the groups are range-sorted by (key, order…): a hot key spans many
   partitions of similar size;
3. inside each range partition a window keyed by the partition id gives the
   previous group and running counts (one balanced exchange);
4. a table with one row per partition carries the key's running count and
   last value across partition boundaries (bounded, broadcast);
5. groups expand back to rows in chunks of at most ``chunk`` rows, spread
   over tasks by hashing (group, chunk), so even one hot group of identical
   rows is generated by many tasks.

Identical rows are interchangeable, so the result is deterministic. The sorted
groups are written once (step 2), so every later step sees the same partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.session import stage_table

_POS_BITS = 33
CHUNK = 100_000


def _asc(c: str) -> Column:
    return F.col(c).asc_nulls_last()


def sequence_with_previous(df: DataFrame, key: str, order_cols: Sequence[str], value_col: str,
                           num_col: str = "num", prev_col: str = "prev", chunk: int = CHUNK,
                           sort_output: bool = False) -> DataFrame:
    """``df`` plus ``num_col`` (1-based position within ``key`` following
    ``order_cols`` ascending, nulls last, remaining columns as tie-break) and
    ``prev_col`` (``value_col`` of the row before within the key, null for
    the first). Same result as ``row_number()`` and ``lag()`` over
    ``PARTITION BY key ORDER BY order_cols``.

    ``sort_output`` returns the rows ordered by (key, num): the expansion step
    is then range-partitioned on (key, num, chunk) instead of hashed, which
    spreads the work the same way and saves a separate global sort."""
    cols = df.columns
    order_cols = list(order_cols)
    rest = [c for c in cols if c != key and c not in order_cols]
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_c"))

    tagged = (groups.orderBy(_asc(key), *[_asc(c) for c in order_cols + rest])
              .withColumn("_m", F.monotonically_increasing_id())
              .select(*cols, "_c", F.shiftright("_m", _POS_BITS).alias("_p"),
                      F.col("_m").bitwiseAND(F.lit((1 << _POS_BITS) - 1)).alias("_i")))
    tagged = stage_table(tagged, "sequence")

    w = Window.partitionBy("_p").orderBy("_i")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    k, v = F.col(key), F.col(value_col)
    local = tagged.select(
        "*",
        F.lag(k).over(w).alias("_pk"),
        F.lag(v).over(w).alias("_pv"),
        F.lag(F.lit(1)).over(w).isNull().alias("_first"),
        F.sum("_c").over(upto).alias("_cs"))
    starts = F.when(F.col("_first") | ~F.col("_pk").eqNullSafe(k), F.col("_cs") - F.col("_c"))
    local = local.select("*", F.max(starts).over(upto).alias("_ks"))

    # One row per partition: first/last key, last value, rows, local start of the last key.
    per_part = local.groupBy("_p").agg(
        F.min_by(k, F.col("_i")).alias("_fk"), F.max_by(k, F.col("_i")).alias("_lk"),
        F.max_by(v, F.col("_i")).alias("_lv"), F.sum("_c").alias("_n"),
        F.max_by(F.col("_ks"), F.col("_i")).alias("_lks"))
    ordered = Window.orderBy("_p")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    upto_p = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cont = F.lag("_lk").over(ordered).eqNullSafe(F.col("_fk")) & F.lag("_p").over(ordered).isNotNull()
    parts = per_part.select("*", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
                            cont.alias("_cont"))
    single = F.col("_fk").eqNullSafe(F.col("_lk"))
    parts = parts.select("*", F.when(single & F.col("_cont"), F.lit(None))
                         .otherwise(F.col("_off") + F.col("_lks")).alias("_own"))
    parts = parts.select("*", F.last("_own", ignorenulls=True).over(upto_p).alias("_lstart"))
    parts = parts.select("_p", "_fk", "_off", "_cont",
                         F.when(F.col("_cont"), F.lag("_lstart").over(ordered))
                         .otherwise(F.col("_off")).alias("_fstart"),
                         F.when(F.col("_cont"), F.lag("_lv").over(ordered)).alias("_carry"))

    # The partition table has one row per shuffle partition: bounded, broadcast.
    j = local.join(F.broadcast(parts), "_p")
    in_first_key = k.eqNullSafe(F.col("_fk"))
    gstart = F.when(in_first_key, F.col("_fstart")).otherwise(F.col("_off") + F.col("_ks"))
    first_num = F.col("_off") + F.col("_cs") - gstart - F.col("_c") + 1
    first_prev = (F.when(~F.col("_first") & F.col("_pk").eqNullSafe(k), F.col("_pv"))
                  .when(F.col("_first") & F.col("_cont"), F.col("_carry")))
    grp = j.select(*cols, "_c", first_num.alias("_n1"), first_prev.alias("_p1"))

    # Expand counted groups back to rows, at most ``chunk`` rows per task-unit.
    chunks = grp.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                  F.floor((F.col("_c") - 1) / chunk).cast("bigint"))).alias("_ch"))
    if sort_output:
        spread = (chunks.repartitionByRange(_asc(key), "_n1", "_ch")
                  .sortWithinPartitions(_asc(key), "_n1", "_ch"))
    else:
        spread = chunks.repartition(*cols, "_ch")
    lo = F.col("_ch") * chunk + 1
    hi = F.least(F.col("_c"), (F.col("_ch") + 1) * chunk)
    rows = spread.select(*cols, "_n1", "_p1", F.explode(F.sequence(lo, hi)).alias("_k"))
    return rows.select(*cols,
                       (F.col("_n1") + F.col("_k") - 1).alias(num_col),
                       F.when(F.col("_k") == 1, F.col("_p1")).otherwise(F.col(value_col)).alias(prev_col))
