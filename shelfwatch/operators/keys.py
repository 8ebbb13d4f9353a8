"""Surrogate keys: consecutive ids in a total order, assigned in parallel.

A global ``row_number()`` without ``PARTITION BY`` moves every row into one
task (``Exchange SinglePartition``). Here the rows are range-partitioned and
sorted by the order key (the same distributed sort ``ORDER BY`` uses); each
row's position inside its partition comes from ``monotonically_increasing_id``
and a per-partition offset comes from a table with one row per partition
(bounded by the partition count, not by the data). The sorted rows are written
once to the shared checkpoint folder with their partition and position; counts
and numbers both come from the written rows, so they agree whatever the
optimiser reuses, and a lost executor reads the same files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.session import stage_table

_POS_BITS = 33  # monotonically_increasing_id = partition << 33 | position


def _order_exprs(df: DataFrame, order_cols: Sequence) -> list[Column]:
    exprs = [F.col(c) if isinstance(c, str) else c for c in order_cols]
    named = {c for c in order_cols if isinstance(c, str)}
    # Tie-break on every remaining column so the order is total and repeatable.
    exprs += [F.col(c).asc_nulls_first() for c in df.columns if c not in named]
    return exprs


def with_global_rank(df: DataFrame, order_cols: Sequence, rank_col: str = "rank") -> DataFrame:
    """Add a 1-based consecutive ``rank_col`` (bigint) following ``order_cols``
    (ties broken by all other columns). Equivalent to
    ``row_number() OVER (ORDER BY order_cols, <all other columns>)``."""
    cols = df.columns
    tagged = (df.orderBy(*_order_exprs(df, order_cols))
              .withColumn("_sw_mono", F.monotonically_increasing_id())
              .withColumn("_sw_part", F.shiftright("_sw_mono", _POS_BITS))
              .withColumn("_sw_pos", F.col("_sw_mono").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
              .drop("_sw_mono"))
    tagged = stage_table(tagged, "rank")
    counts = tagged.groupBy("_sw_part").agg(F.count(F.lit(1)).alias("_sw_n"))
    # One row per partition: a single-task window here is bounded by the
    # number of partitions, independent of the data volume.
    before = Window.orderBy("_sw_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_sw_part", F.coalesce(F.sum("_sw_n").over(before), F.lit(0)).alias("_sw_off"))
    return (tagged.join(F.broadcast(offsets), "_sw_part")
            .select(*cols, (F.col("_sw_off") + F.col("_sw_pos") + 1).cast("bigint").alias(rank_col)))


def assign_ids(df: DataFrame, id_col: str, order_cols: Sequence | None = None,
               start: Column | int = 0, id_type: str = "int") -> DataFrame:
    """Consecutive surrogate ids ``start+1, start+2, …`` in the order of
    ``order_cols`` (default: the first column, as the original loader did).

    ``start`` is the last id already handed out: an int or a scalar Column,
    e.g. ``last_id(existing, 'id_producto')``."""
    order_cols = list(order_cols) if order_cols else [df.columns[0]]
    start_col = F.lit(start) if isinstance(start, int) else start
    ranked = with_global_rank(df, order_cols, "_sw_rank")
    return (ranked.withColumn(id_col, (start_col.cast("bigint") + F.col("_sw_rank")).cast(id_type))
            .drop("_sw_rank"))


def last_id(existing: DataFrame, id_col: str) -> Column:
    """Scalar subquery: largest id in ``existing`` or 0 when empty."""
    return existing.select(F.coalesce(F.max(id_col).cast("bigint"), F.lit(0).cast("bigint"))).scalar()


def last_seq(sequences: DataFrame, table_name: str) -> Column:
    """Scalar subquery: last id stored for ``table_name`` in a sequence table
    ``(table_name, id, ts_load)``; 0 when the table has no entry."""
    return (sequences.where(F.col("table_name") == table_name)
            .select(F.coalesce(F.max("id").cast("bigint"), F.lit(0).cast("bigint"))).scalar())


def advance_seq(sequences: DataFrame, table_name: str, new_ids: DataFrame, id_col: str,
                load_ts: Column | None = None) -> DataFrame:
    """Sequence table after handing out ``new_ids``: the row of ``table_name``
    gets ``max(id, max(new id))`` (update by predicate), others stay."""
    top = new_ids.select(F.max(id_col).cast("bigint")).scalar()
    hit = F.col("table_name") == table_name
    ts = load_ts if load_ts is not None else F.current_timestamp()
    return sequences.select(
        "table_name",
        F.when(hit & top.isNotNull(), F.greatest(F.col("id"), top)).otherwise(F.col("id")).alias("id"),
        F.when(hit & top.isNotNull(), ts).otherwise(F.col("ts_load")).alias("ts_load"))
