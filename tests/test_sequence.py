"""Skew-proof sequence number / previous value against the window form."""

import pytest
from pyspark.sql import Window, functions as F

from shelfwatch.operators.sequence import sequence_with_previous


def window_form(df, key, order, value):
    w = Window.partitionBy(key).orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.select("*", F.row_number().over(w).cast("bigint").alias("num"), F.lag(value).over(w).alias("prev"))


@pytest.mark.parametrize("chunk,sort_output", [(1, False), (3, True), (100_000, False), (100_000, True)])
def test_matches_window_with_hot_key_and_hot_group(spark, chunk, sort_output):
    base = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") < 1500, F.lit(7)).otherwise(F.col("id") % 23).alias("k"),   # hot key
        (F.col("id") % 97).alias("d"), ((F.col("id") * 31) % 11).cast("double").alias("v"))
    hot_group = spark.range(0, 700, 1, 3).select(F.lit(5).cast("bigint").alias("k"), F.lit(1).cast("bigint").alias("d"),
                                                  F.lit(2.5).alias("v"))
    nulls = spark.createDataFrame([(None, 1, 1.0), (None, 1, 1.0), (3, None, None)], "k bigint, d bigint, v double")
    df = base.unionByName(hot_group).unionByName(nulls)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        got = sequence_with_previous(df, "k", ["d", "v"], "v", chunk=chunk, sort_output=sort_output)
        want = window_form(df, "k", ["d", "v"], "v")
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        if sort_output:
            keys = [(r.k is None, r.k, r.num) for r in got.collect()]
            assert keys == sorted(keys)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
