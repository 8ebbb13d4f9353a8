"""Numeric helpers: exact money sums, safe division, rounded percent change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def money_cents(col) -> Column:
    """Money value in whole cents (half up), as bigint."""
    return F.floor(_c(col) * 100 + 0.5).cast("bigint")


def money_sum(col) -> Column:
    """Exact sum of a money column with up to ten decimal digits, added as
    decimals, so the result does not depend on partitioning or row order (a
    double sum would) and prices with more than two digits keep them."""
    return F.sum(_c(col).try_cast("decimal(28,10)")).cast("double")


def safe_div(num, den) -> Column:
    """num / den, null when den is 0 or null (ANSI-safe)."""
    return F.try_divide(_c(num), _c(den))


def pct_change_2dp(cur, prev) -> Column:
    """``(round(cur / prev, 2) - 1) * 100``, the ratio of the raw values rounded half up.

    The ratio is taken as it prints (decimal(38,18)), so halves like 2.01/2.00
    round up consistently. Null when prev is 0 or null, or the ratio has more
    than 20 integer digits."""
    ratio = F.try_divide(_c(cur).cast("double"), _c(prev).cast("double")).try_cast("decimal(38,18)")
    return ((F.round(ratio, 2) - F.lit(1)) * F.lit(100)).cast("double")
