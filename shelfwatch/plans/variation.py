"""Price variation per product between consecutive observations.

Star join (fact ⋈ product ⋈ date) → sequence number per product by date →
previous unit price, difference and rounded percent change. The original
query pairs each row with its predecessor by a self-join on ``num = num + 1``;
the sequence operator gives the same pairs without a join and without
sending a product's rows to one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.functions.numeric import pct_change_2dp
from shelfwatch.operators.sequence import CHUNK, sequence_with_previous


def price_table(fact: DataFrame, product_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """(id_producto, product, date, unit_price): fact with both dimensions.
    The product dimension grows with the data and is joined by sorting both
    sides, never sent through the driver; the dates (one row per day) may be."""
    prod = product_dim.select("id_producto", "product")
    dates = date_dim.select("id_date", "date")
    return (fact.select("id_producto", "id_date", "unit_price")
            .join(prod.hint("merge"), "id_producto").join(dates, "id_date")
            .select("id_producto", "product", "date", "unit_price"))


def price_variation(fact: DataFrame, product_dim: DataFrame, date_dim: DataFrame,
                    latest_only: bool = False, changes_only: bool = False,
                    ordered: bool = True, chunk: int = CHUNK) -> DataFrame:
    """Columns: id_producto, product, date, unit_price, num, num2 (previous
    num), variacion (difference), por_variacion (percent, 2-decimal ratio).

    ``latest_only`` keeps the last date present; ``changes_only`` keeps rows
    with a non-null, non-zero difference. Same-day rows are ordered by unit
    price, so the numbering is repeatable. There is no per-product window
    (``operators.sequence``), so a product may hold any share of the rows."""
    t = price_table(fact, product_dim, date_dim)
    seq = sequence_with_previous(t, "id_producto", ["date", "unit_price", "product"], "unit_price",
                                 "num", "_prev", chunk, sort_output=ordered)
    out = seq.select("id_producto", "product", "date", "unit_price", F.col("num").cast("int").alias("num"),
                     F.when(F.col("num") > 1, F.col("num") - 1).cast("int").alias("num2"),
                     (F.col("unit_price") - F.col("_prev")).alias("variacion"),
                     pct_change_2dp("unit_price", "_prev").alias("por_variacion"))
    if latest_only:
        last_day = t.select(F.max("date")).scalar()
        out = out.where(F.col("date") == last_day)
    if changes_only:
        out = out.where(F.col("variacion").isNotNull() & (F.col("variacion") != 0))
    return out  # with ``ordered`` the sequence step already emits (id_producto, num) order
