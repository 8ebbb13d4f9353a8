"""Warehouse load properties: idempotent reload, contiguous ids, index range,
lag equals the self-join, null keys kept in sums."""

import datetime as dt

from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.plans import etl, observations as O, variation as V, warehouse as W
from shelfwatch.sources import snapshots as Sn

TS = dt.datetime(2024, 1, 1)


def test_load_job_twice_adds_nothing(spark, sf_small, tmp_path):
    obs = O.observations(spark, sf_small)
    snaps, base = str(tmp_path / "snaps"), str(tmp_path / "wh")
    Sn.write_snapshots(obs, snaps, F.date_format("date", "yyyy"))
    etl.create_warehouse(spark, base)
    first = etl.run(spark, snaps, base, str(tmp_path / "export"), TS)
    wh = etl.open_warehouse(spark, base)
    counts = (wh.date_dim.count(), wh.product_dim.count(), wh.fact.count())
    second = etl.run(spark, snaps, base, None, TS)
    wh2 = etl.open_warehouse(spark, base)
    assert first == {"date_dim": True, "producto_dia_fact": True}
    assert second == {"date_dim": False, "producto_dia_fact": False}
    assert (wh2.date_dim.count(), wh2.product_dim.count(), wh2.fact.count()) == counts
    assert counts[2] == obs.count()
    ids = sorted(r.id_producto for r in wh2.product_dim.collect())
    assert ids == list(range(1, len(ids) + 1))
    idx = wh2.index.agg(F.min("sum_price_norm").alias("lo"), F.max("sum_price_norm").alias("hi")).first()
    assert (idx.lo, idx.hi) == (0.0, 1.0)
    seq = {r.table_name: r.id for r in etl.sequences(spark, base).collect()}
    assert seq == {"date_dim": counts[0], "producto_dim": counts[1]}


def test_incremental_load_matches_full_load(spark, sf_small):
    obs = O.observations(spark, sf_small)
    old, new = O.split_batches(obs)
    wh0 = W.initial_load(old, TS)
    wh1 = W.load_warehouse(new, wh0, TS)
    full = W.initial_load(obs, TS)
    cols = ["id_producto", "id_date", "price", "unit_price", "discount", "year"]
    # dates are numbered in arrival order, so compare facts through the date itself
    a = wh1.fact.join(wh1.date_dim.select("id_date", "date"), "id_date").join(
        wh1.product_dim.select("id_producto", "product_id"), "id_producto").select("product_id", "date", *cols[2:])
    b = full.fact.join(full.date_dim.select("id_date", "date"), "id_date").join(
        full.product_dim.select("id_producto", "product_id"), "id_producto").select("product_id", "date", *cols[2:])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_index_of_batches_equals_the_index_of_all_facts(spark, tmp_path, sf_small):
    base = f"file://{tmp_path}/wh"
    etl.create_warehouse(spark, base)
    obs = O.observations(spark, sf_small).withColumn("price", F.col("price") / 8)
    undated = obs.limit(3).withColumn("date", F.lit(None).cast("date"))  # facts without a date, in both batches
    for batch in (obs.where("date < '1996-07-01'").unionByName(undated.limit(1)),
                  obs.where("date >= '1996-06-01'").unionByName(undated), obs):
        etl.load_dataset(spark, batch, base, TS)
    wh = etl.open_warehouse(spark, base)
    want = W.daily_price_index(wh.fact, TS)
    assert wh.fact.count() >= obs.count() and want.count() == wh.index.count()
    assert wh.index.exceptAll(want).count() == 0 and want.exceptAll(wh.index).count() == 0


def test_days_are_summed_once_for_the_index(spark):
    rows = [(1 + i % 3, 1 + i % 5, 1.0 + i, 2.0 + i, 0.0, 2023, TS) for i in range(40)]
    old, new = (spark.createDataFrame(r, schemas.PRICE_FACT) for r in (rows[:25], rows[25:]))
    got = W.updated_price_index(W.daily_price_index(old, TS), old, new, TS)
    assert "decimal(28,10)" not in got._jdf.queryExecution().optimizedPlan().toString()  # the sums lie in a table
    want = W.daily_price_index(old.unionByName(new), TS)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_lag_equals_self_join(spark, sf_small):
    wh = W.initial_load(O.observations(spark, sf_small), TS)
    v = V.price_variation(wh.fact, wh.product_dim, wh.date_dim, ordered=False)
    o1, o2 = v.alias("o1"), v.alias("o2")
    sj = o1.join(o2, (F.col("o1.id_producto") == F.col("o2.id_producto")) & (F.col("o1.num") == F.col("o2.num") + 1),
                 "left").select(F.col("o1.id_producto"), F.col("o1.num"), F.col("o2.num").alias("num2"),
                                (F.col("o1.unit_price") - F.col("o2.unit_price")).alias("variacion"))
    mine = v.select("id_producto", "num", "num2", "variacion")
    assert sj.exceptAll(mine).count() == 0 and mine.exceptAll(sj).count() == 0


def test_unmatched_products_count_in_sums_not_in_num_products(spark, sf_small):
    obs = O.observations(spark, sf_small)
    wh = W.initial_load(obs, TS)
    fact = W.build_fact(obs, wh.product_dim.where(F.col("units") != "ECONOMY"), wh.date_dim, TS)
    idx = W.daily_price_index(fact, TS)
    tot = idx.agg(F.sum("num_products").alias("n")).first().n
    assert tot == fact.where(F.col("id_producto").isNotNull()).count() < obs.count()
    assert abs(idx.agg(F.sum("sum_price")).first()[0] - obs.agg(F.sum("price")).first()[0]) < 1e-3


def test_products_are_not_sent_through_the_driver(spark, tmp_path):
    part = [(i, f"red widget {i}", "b", "t", 1, 1.0) for i in range(50)]
    line = [(i, i % 50, 1.0, 2.0, 0.0, dt.datetime(2023, 1, 1 + i % 9)) for i in range(200)]
    spark.createDataFrame(part, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(str(tmp_path / "part.parquet"))
    spark.createDataFrame(line, "l_orderkey long, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_shipdate timestamp").write.parquet(str(tmp_path / "lineitem.parquet"))
    obs = O.observations(spark, str(tmp_path))
    wh = W.initial_load(obs, TS)
    keyed = ("p_partkey", "product_id", "id_producto")  # the dates (one row per day) may be sent
    for df in (obs, W.lookup_keys(obs, wh.product_dim, wh.date_dim), W.changed_products(obs, wh.product_dim, TS),
               W.update_product_dim(obs, wh.product_dim, TS), V.price_table(wh.fact, wh.product_dim, wh.date_dim)):
        df.collect()
        joins = [x for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "BroadcastHashJoin" in x]
        assert not [x for x in joins if any(k in x for k in keyed)]
    assert obs.count() == wh.fact.count() == 200
