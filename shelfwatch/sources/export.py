"""CSV export for spreadsheet users: ``;`` separator, decimal comma.

Written by the executors (one file per partition); nothing passes through the
driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType


def _plain(c: Column) -> Column:
    """All digits of a number in plain notation (exponents stay from 1e26 on)."""
    txt, size = c.cast("string"), F.abs(c)
    wide = F.when(size < 1, c.try_cast("decimal(38,37)").cast("string")).otherwise(c.try_cast("decimal(38,12)").cast("string"))
    # plain text without the zeros that end it, but one
    return F.when(txt.contains("E"), F.coalesce(F.regexp_replace(wide, r"(\.\d+?)0+$", "$1"), txt)).otherwise(txt)


def decimal_comma(df: DataFrame, decimals: int | None = None) -> DataFrame:
    """Every floating/decimal column as text with a decimal comma, in plain
    notation: all its digits, or with ``decimals`` that many (half up)."""
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType, DecimalType)):
            txt = c.cast(f"decimal(38,{decimals})").cast("string") if decimals is not None else _plain(c)
            out.append(F.replace(txt, F.lit("."), F.lit(",")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def export_csv(df: DataFrame, path: str, sep: str = ";", decimal: str = ",", header: bool = True,
               decimals: int | None = None, mode: str = "overwrite", single_file: bool = False) -> None:
    """Write ``df`` as CSV. ``single_file`` coalesces to one task: use it only
    for small tables (dimensions, daily index)."""
    out = decimal_comma(df, decimals) if decimal == "," else df
    if single_file:
        out = out.coalesce(1)
    (out.write.mode(mode).option("header", header).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def export_tables(tables: dict[str, DataFrame], base: str, **kw) -> dict[str, str]:
    """Export several tables under ``base/<name>``; returns the paths."""
    paths = {}
    for name, df in tables.items():
        paths[name] = f"{base.rstrip('/')}/{name}"
        export_csv(df, paths[name], **kw)
    return paths
