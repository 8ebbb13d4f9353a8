"""Property tests: the skew-proof operators agree with the plain Spark forms
on random inputs with heavy duplication (hot keys, hot rows)."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from shelfwatch.operators import dml, stats as St
from shelfwatch.operators.sequence import sequence_with_previous

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
rows_st = st.lists(st.tuples(st.sampled_from([1, 2, 2, 2, None]), st.integers(0, 4),
                             st.sampled_from([0.5, 1.5, 1.5, None])), min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_st, chunk=st.sampled_from([1, 2, 1000]))
def test_sequence_equals_window(spark, rows, chunk):
    df = spark.createDataFrame(rows, "k int, d int, v double").repartition(3)
    got = sequence_with_previous(df, "k", ["d", "v"], "v", chunk=chunk)
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_last(), F.col("v").asc_nulls_last())
    want = df.select("*", F.row_number().over(w).cast("bigint").alias("num"), F.lag("v").over(w).alias("prev"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@SETTINGS
@given(a=rows_st, b=rows_st, chunk=st.sampled_from([1, 3, 1000]))
def test_bag_diff_equals_except_all(spark, a, b, chunk):
    da = spark.createDataFrame(a, "k int, d int, v double")
    db = spark.createDataFrame(b, "k int, d int, v double")
    got = dml.bag_diff(da, db, chunk=chunk)
    want = da.exceptAll(db)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


@SETTINGS
@given(vals=st.lists(st.sampled_from([0.0, 0.0, 0.0, 1.25, 2.5, 7.0, 100.0]), min_size=1, max_size=80),
       p=st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.9, 1.0]))
def test_quantile_equals_numpy(spark, vals, p):
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    got = St.quantiles(df, "x", [p]).first()
    assert got[1] == pytest.approx(float(np.percentile(vals, p * 100)), rel=1e-12, abs=1e-12)


def test_upsert_equals_merge_then_insert(spark):
    ts = dt.datetime(2024, 1, 1)
    tgt = spark.createDataFrame([(1, "A", "x", ts), (2, "B", "y", ts)], "id int, k string, v string, ts_load timestamp")
    src = spark.createDataFrame([("B", "y2"), ("C", "z"), ("D", "w")], "k string, v string")
    one = dml.upsert(tgt, src, "k", ["v"], id_col="id", load_ts=ts)
    merged = dml.merge_update(tgt, src, "k", ["v"], load_ts=ts)
    two = merged.unionByName(dml.insert_new(merged, src, "k", "id", load_ts=ts))
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0
