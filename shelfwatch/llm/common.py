"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from shelfwatch.session import stage_table

# Spaces of the word rules: space, tab, newline, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
LOWER_AZ = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: rows that are Python objects at a time
ROWS_AT_ONCE = 1024


def map_rows(df: DataFrame, schema: str, work: Callable[[Iterator[list[list]]], Iterator[list[list]]]) -> DataFrame:
    """``mapInArrow`` over column lists: ``work`` gets an iterator of batches (one
    Python list per column of ``df``) and yields column lists of ``schema``."""
    spark_schema = _parse_datatype_string(schema)
    assert isinstance(spark_schema, StructType)
    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        parts = (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE))
        lists = ([c.to_pylist() for c in b.columns] for b in parts)
        for out in work(lists):
            if len(out[0]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(out, arrow, strict=True)], schema=arrow)

    return df.mapInArrow(run, spark_schema)


def stage_mapped(df: DataFrame, name: str) -> DataFrame:
    """``stage_table`` with Arrow batches of ROWS_AT_ONCE rows, so that tasks hold few texts at a time."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = conf.get(key)
    conf.set(key, str(ROWS_AT_ONCE))
    try:
        return stage_table(df, name)
    finally:
        conf.set(key, usual)


def before_sums(df: DataFrame, key: str, bucket: str, order: list[Column], value: Column, out: str) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the same ``key`` that come earlier in ``order``.

    ``bucket`` is an integer column that never decreases along ``order``. Sums
    per bucket are carried in a small table, and only the rows of one (key,
    bucket) meet in a task, so a key with a third of all rows is spread over
    all of its buckets. ``key`` must not be null.
    """
    per = df.groupBy(key, bucket).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(key).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col(key).alias("_k"), F.col(bucket).alias("_b"),
                     F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(key, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("_in", F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .join(per, (F.col(key) == F.col("_k")) & (F.col(bucket) == F.col("_b")))
            .withColumn(out, F.col("_base") + F.col("_in"))
            .drop("_k", "_b", "_base", "_in"))
