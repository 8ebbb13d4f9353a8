"""Historical migration clean-up: stamp the loaded snapshot rows, delete
records without product name or price, drop repeated loads of the same record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators import dml


def clean_history(df: DataFrame, load_ts=None, required: Sequence[str] = ("product", "price"),
                  ts_col: str = "ts_load") -> DataFrame:
    """Rows of a migrated snapshot history fit to keep: records lacking any
    ``required`` field are deleted and exact repeats (the same record loaded
    twice) collapse to one. Adds the load time."""
    cols = [c for c in df.columns if c != ts_col]
    keep = df
    for c in required:
        keep = dml.delete_where(keep, F.col(c).isNull())
    return keep.select(*cols).distinct().withColumn(ts_col, dml._ts(load_ts))
