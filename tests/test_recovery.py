"""Stored tables that survive lost runs: bucketed merge, load job, variation by batches, capture queue."""

import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.plans import etl, observations as O, variation as V, variation_store as VS, warehouse as W
from shelfwatch.session import ensure_checkpoint_dir, release_shuffles
from shelfwatch.sources import buckets as B, pages as Pg, snapshots as Sn, tables as T
from shelfwatch.streaming import queue as Q

TS = dt.datetime(2024, 1, 1)


class Lost(Exception):
    pass


def lose_at(k):
    """A hook that ends the job when the k-th table is written."""
    seen = []

    def hook(name):
        seen.append(name)
        if len(seen) == k:
            raise Lost(name)
    return hook


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def dim(spark, rows):
    return spark.createDataFrame([(f"p{i}", name, "u", "b", "[]", "c", dt.date(2023, 1, 1)) for i, name in rows],
                                 "product_id string, product string, units string, brand string, categories string, categoria string, date date")


def test_merge_rewrites_only_buckets_that_changed(spark, tmp_path):
    path = str(tmp_path / "dim")
    merge = lambda rows, **kw: B.merge_buckets(spark, path, schemas.PRODUCT_DIM, dim(spark, rows), "product_id", W.PRODUCT_ATTRS,
                                               "id_producto", ["product_id"], load_ts=TS, **kw)
    T.create_tables(spark, str(tmp_path), {"dim": B.stored_schema(schemas.PRODUCT_DIM)}, {"dim": [B.BUCKET]})
    merge([(i, "a") for i in range(200)], buckets=16)
    before = files(path)
    assert len({os.path.dirname(f) for f in before}) == 16
    assert merge([(i, "a") for i in range(200)]) == [] and files(path) == before
    touched = merge([(3, "other"), (4, "a"), (999, "new")], buckets=99)  # the stored count of buckets holds
    assert 1 <= len(touched) <= 2
    kept = {f for f in files(path) if f.split("bucket=")[1].split("/")[0] not in touched}
    assert kept == {f for f in before if f.split("bucket=")[1].split("/")[0] not in touched}
    got = {r.product_id: (r.product, r.id_producto) for r in B.read_buckets(spark, path, schemas.PRODUCT_DIM).collect()}
    assert len(got) == 201 and got["p3"][0] == "other" and got["p999"] == ("new", 201)
    assert sorted(i for _, i in got.values()) == list(range(1, 202))
    with pytest.raises(Exception, match="duplicate key"):
        merge([(5, "x"), (5, "y")])


@pytest.mark.parametrize("k", [1, 4])
def test_ids_after_a_load_that_was_lost(spark, tmp_path, sf_small, k):
    obs = O.observations(spark, sf_small).where("date < DATE'1997-01-01'").cache()
    base = str(tmp_path / "wh")
    etl.create_warehouse(spark, base, TS)
    with pytest.raises(Lost):
        etl.load_dataset(spark, obs.where("date < DATE'1996-01-01'"), base, TS, on_write=lose_at(k))
    etl.load_dataset(spark, obs, base, TS)
    wh = etl.open_warehouse(spark, base)
    days, products = obs.select("date").distinct().count(), obs.select("product_id").distinct().count()
    assert (wh.date_dim.count(), wh.date_dim.select("id_date").distinct().count(), wh.date_dim.select("date").distinct().count()) == (days,) * 3
    assert (wh.product_dim.count(), wh.product_dim.select("id_producto").distinct().count()) == (products,) * 2
    got = wh.fact.join(wh.date_dim.select("id_date", "date"), "id_date").join(wh.product_dim.select("id_producto", "product_id"), "id_producto")
    cols = ["product_id", "date", "price", "unit_price", "discount"]
    assert got.select(cols).exceptAll(obs.select(cols)).isEmpty() and obs.select(cols).exceptAll(got.select(cols)).isEmpty()
    again = W.daily_price_index(wh.fact, TS)
    assert wh.index.drop("ts_load").exceptAll(again.drop("ts_load")).isEmpty() and wh.index.count() == days
    seq = {r.table_name: r.id for r in etl.sequences(spark, base).collect()}
    assert seq == {"date_dim": wh.date_dim.agg(F.max("id_date")).first()[0], "producto_dim": wh.product_dim.agg(F.max("id_producto")).first()[0]}
    obs.unpersist()


def observed(spark, rows):
    return spark.createDataFrame(rows, "id_producto int, product string, date date, unit_price double")


@pytest.mark.parametrize("lost", [1])
def test_variation_by_batches_equals_all_at_once(spark, tmp_path, lost):
    day = lambda n: dt.date(2023, 1, 1) + dt.timedelta(n)
    rows = [(p, f"p{p}", day((p * 7 + i * 3) % 60), float((p + i * i) % 11) if i % 9 else None) for p in range(12) for i in range(25)]
    rows += [(1, "p1", day(5), 2.0)] * 3
    batches = [[r for r in rows if r[2] < day(20) and r[0] % 4], [r for r in rows if day(20) <= r[2] < day(40)] + [r for r in rows if r[2] < day(20) and r[0] % 4 == 0],
               [r for r in rows if r[2] >= day(40) and r[0] != 3], [(None, "x", day(3), 1.0)], [r for r in rows if r[2] >= day(40) and r[0] == 3] + [(2, "p2", day(0), 9.0), (2, "p2", day(59), None)]]
    base = str(tmp_path / "v")
    late = []
    for i, b in enumerate(batches):
        if lost:
            with pytest.raises(Lost):
                VS.add_batch(spark, base, observed(spark, b), i, buckets=4, on_write=lose_at(lost))
        late.append(VS.add_batch(spark, base, observed(spark, b), i, buckets=4))
    assert late[0] == late[2] == late[3] == 0 and late[4] == 1  # only product 2 got late dates
    got = [tuple(r) for r in VS.read_variation(spark, base).collect()]
    table = observed(spark, [r for b in batches for r in b if r[0] is not None])
    dates = table.select("date").distinct().withColumn("id_date", F.datediff("date", F.lit("2022-12-01")))
    whole = V.price_variation(table.join(dates, "date").select("id_producto", "id_date", "unit_price"),
                              table.select("id_producto", "product").distinct(), dates)
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in whole.collect())
    versions = [d for d in os.listdir(VS.paths(base)[1]) if d.startswith("batch=")]
    assert len(versions) <= 3


def shop(n, price="1,50"):
    return (f'<h1 class="product-title">Big Brand{n} thing</h1><p class="buy-box__active-price">{price} €</p>'
            f'<p class="buy-box__price-per-unit">2,50 €/KILO</p><span class="breadcrumb-item__link">C</span>')


@pytest.mark.parametrize("lost", [1])
def test_queue_resumes_after_a_loss(spark, tmp_path, lost):
    base, src = str(tmp_path / "q"), str(tmp_path / "pages")
    url = lambda i: f"https://shop.example/p/{i}"
    Q.create_queue(spark.createDataFrame([(str(i), url(i), i) for i in range(25)], "id_producto string, url_product string, index long"), base, cut=10)
    page = lambda ids: spark.createDataFrame([(i, url(i), shop(i) if i % 5 else "<p>no</p>") for i in ids], "page_id long, url string, html string").coalesce(1)
    page([9, 8, 0, 1, 2, 40]).write.parquet(src)
    page([3, 12, 13, 24]).write.mode("append").parquet(src)
    with pytest.raises(Exception):
        Q.process_queue(spark, base, src, "2024-01-01", Pg.SHOP_RULES, max_files_per_trigger=1, load_ts=TS, on_write=lose_at(lost))
    Q.process_queue(spark, base, src, "2024-01-01", Pg.SHOP_RULES, max_files_per_trigger=1, load_ts=TS)
    got = Q.records(spark, base).collect()
    assert [r["index"] for r in got] == [0, 1, 2, 3, 8, 9, 12, 13, 24]
    assert [r["index"] for r in got if r.reject_reason] == [0] and got[1].brand == "Brand1"
    left = {r["index"] for r in Q.open_entries(spark, base).collect()}
    assert left == set(range(25)) - {0, 1, 2, 3, 8, 9, 12, 13, 24}
    assert {(r.mark, r.gap_from, r.gap_to) for r in Q.progress(spark, base).collect()} == {(3, None, None), (3, 4, 7), (3, 10, 11), (3, 14, 23)}
    assert Q.process_queue(spark, base, src, "2024-01-01", load_ts=TS) == 0  # nothing new
    page([*range(4, 8), 10, 11, *range(14, 24), 0]).write.mode("append").parquet(src)
    Q.process_queue(spark, base, src, "2024-01-01", load_ts=TS)
    assert Q.open_entries(spark, base).isEmpty() and Q.records(spark, base).count() == 25
    assert [tuple(r) for r in Q.progress(spark, base).collect()] == [(24, None, None)]
    assert not [d for d in os.listdir(Q.queue_paths(base)["queue"]) if d.startswith("cut=")]


def test_a_long_queue_has_a_bounded_number_of_folders(spark, tmp_path):
    for name, n, cut in (("long", 20_000, 10), ("short", 95, 10), ("none", 0, 10)):
        base = str(tmp_path / name)
        i = F.col("id").cast("string")
        Q.create_queue(spark.range(n).select(i.alias("id_producto"), i.alias("url_product"), F.col("id").alias("index")), base, cut=cut)
        folders = [d for d in os.listdir(Q.queue_paths(base)["queue"]) if d.startswith("cut=")]
        assert len(folders) == {"long": 125, "short": 10, "none": 0}[name] and len(folders) <= Q.CUTS
        entries = Q.open_entries(spark, base)
        assert sorted(r["index"] for r in entries.select("index").collect()) == list(range(n))
        spans = entries.groupBy("cut").agg(F.min("index").alias("lo"), F.max("index").alias("hi")).orderBy("lo").collect()
        assert all(r.lo % cut == 0 for r in spans) and all(a.hi + 1 == b.lo for a, b in zip(spans, spans[1:]))


@pytest.mark.parametrize("query", ["load_after_losses", "variation_by_batches"])
def test_what_every_load_reads_is_worked_out_once(spark, sf_small, monkeypatch, query):
    from shelfwatch import stored_queries as S
    plans = []
    if query == "load_after_losses":
        monkeypatch.setattr(S.etl, "load_dataset", lambda spark, dataset, *a, **kw: plans.append(dataset))
        monkeypatch.setattr(S.etl, "open_warehouse", lambda *a: W.initial_load(O.observations(spark, sf_small), TS, stage=False))
    else:
        monkeypatch.setattr(S.VS, "add_batch", lambda spark, base, observed, *a, **kw: plans.append(observed))
        monkeypatch.setattr(S.VS, "read_variation", lambda *a: None)
    S.QUERIES[query](spark, sf_small)
    assert len(plans) == 4
    assert not [p for p in plans if "Join" in p._jdf.queryExecution().optimizedPlan().toString()]


def test_a_load_leaves_nothing_staged(spark, tmp_path, sf_small):
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:")
    kept = lambda: {f for f in os.listdir(scratch) if f.startswith(("shelfwatch-snapshot-", "shelfwatch-facts-"))}
    before, base, snaps = kept(), str(tmp_path / "wh"), str(tmp_path / "snaps")
    obs = O.observations(spark, sf_small).where("date < DATE'1996-01-01'")
    Sn.write_snapshots(obs, snaps, F.date_format("date", "yyyy"))
    etl.create_warehouse(spark, base, TS)
    with pytest.raises(Lost):
        etl.load_dataset(spark, obs, base, TS, on_write=lose_at(4))  # while the facts are staged
    assert kept() == before
    assert etl.run(spark, snaps, base, None, TS)["producto_dia_fact"]
    assert kept() == before and etl.open_warehouse(spark, base).fact.count() == obs.count() > 0


def test_shuffles_of_finished_writes_are_released(spark, tmp_path):
    alive = lambda: spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    release_shuffles(spark)
    before = alive()
    for k in range(3):
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().write.parquet(str(tmp_path / str(k)))
    for _ in range(50):
        release_shuffles(spark)
        if alive() <= before:
            break
        time.sleep(0.1)
    assert alive() <= before
