"""Surrogate keys and latest row per key."""

import pytest
from pyspark.sql import functions as F, Window

from shelfwatch.operators.keys import assign_ids, last_id, with_global_rank
from shelfwatch.operators.latest import latest_per_key
from shelfwatch.operators.sequence import sequence_with_previous
from shelfwatch.operators.stats import quantiles


def test_global_rank_equals_row_number_over_many_partitions(spark):
    df = spark.range(0, 5000, 1, 13).select((F.col("id") * 7919 % 5003).alias("k"), (F.col("id") % 3).alias("t"))
    got = with_global_rank(df, ["k"], "r")
    w = Window.orderBy("k", "t")
    want = df.withColumn("r", F.row_number().over(w).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    rs = sorted(r.r for r in got.select("r").collect())
    assert rs == list(range(1, 5001))


def test_assign_ids_continues_after_existing(spark):
    existing = spark.createDataFrame([(1, "a"), (2, "b")], "id int, k string")
    new = spark.createDataFrame([("d",), ("c",), ("e",)], "k string")
    out = assign_ids(new, "id", ["k"], start=last_id(existing, "id"))
    assert sorted((r.k, r.id) for r in out.collect()) == [("c", 3), ("d", 4), ("e", 5)]


def test_assign_ids_on_empty_start(spark):
    empty = spark.createDataFrame([], "id int, k string")
    new = spark.createDataFrame([("x",)], "k string")
    assert assign_ids(new, "id", start=last_id(empty, "id")).first().id == 1


def test_latest_per_key_picks_latest_and_breaks_ties(spark):
    df = spark.createDataFrame(
        [("p1", "2023-08-26", "old"), ("p1", "2023-09-02", "new"), ("p2", "2023-09-02", "b"),
         ("p2", "2023-09-02", "a"), ("p3", None, "n"), ("p3", "2023-01-01", "x")],
        "product_id string, date string, name string").withColumn("date", F.col("date").cast("date"))
    got = {r.product_id: (str(r.date), r.name) for r in latest_per_key(df, ["product_id"], ["date"]).collect()}
    assert got == {"p1": ("2023-09-02", "new"), "p2": ("2023-09-02", "b"), "p3": ("2023-01-01", "x")}


@pytest.mark.parametrize(("reuse", "aqe"), [("true", "true"), ("false", "true"), ("false", "false")])
def test_ids_do_not_rest_on_exchange_reuse(spark, reuse, aqe):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    spark.conf.set("spark.sql.adaptive.enabled", aqe)
    try:
        df = spark.range(0, 20_000, 1, 7).select((F.col("id") * 7919 % 20_011).alias("k"), F.lit(1.0).alias("v"))
        ids = sorted(r.i for r in assign_ids(df, "i", ["k"]).select("i").collect())
        seq = sequence_with_previous(df.withColumn("k", F.col("k") % 5), "k", ["v"], "v")
        rows = seq.groupBy("k").agg(F.count("*").alias("n"), F.countDistinct("num").alias("m"), F.max("num").alias("x")).collect()
        q = quantiles(df.withColumn("v", F.col("k").cast("double")), "v", [0.25, 0.5]).first()
        w = df.agg(F.expr("percentile(k, array(0.25, 0.5))")).first()[0]
    finally:
        spark.conf.set("spark.sql.exchange.reuse", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert ids == list(range(1, 20_001))
    assert all(r.n == r.m == r.x for r in rows)
    assert [q.q25, q.q50] == w
