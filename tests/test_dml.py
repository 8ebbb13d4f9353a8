"""Table maintenance rewrites: merge/upsert, change detection, deletes, reloads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import dml

TS0 = dt.datetime(2023, 1, 1)
TS1 = dt.datetime(2024, 1, 1)
DIM = "id int, product_id string, brand string, categoria string, ts_load timestamp"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.fixture()
def target(spark):
    return spark.createDataFrame([(1, "A", "ba", "ca", TS0), (2, "B", "bb", "cb", TS0)], DIM)


def test_merge_test_from_notebook(spark, target):
    # incoming B (brand and category changed) and C
    src = spark.createDataFrame([("B", "new maker", "new group"), ("C", "bc", "cc")],
                                "product_id string, brand string, categoria string")
    out = dml.upsert(target, src, "product_id", ["brand", "categoria"], id_col="id", load_ts=TS1)
    assert rows(out, "id", "product_id", "brand", "categoria", "ts_load") == [
        (1, "A", "ba", "ca", TS0),
        (2, "B", "new maker", "new group", TS1),
        (3, "C", "bc", "cc", TS1)]


def test_upsert_same_input_twice_is_stable(spark, target):
    src = spark.createDataFrame([("B", "x", "y"), ("C", "bc", "cc")], "product_id string, brand string, categoria string")
    once = dml.upsert(target, src, "product_id", ["brand", "categoria"], id_col="id", load_ts=TS1)
    twice = dml.upsert(once, src, "product_id", ["brand", "categoria"], id_col="id", load_ts=TS1)
    assert rows(once, "id", "product_id", "brand") == rows(twice, "id", "product_id", "brand")


def test_only_changed_keeps_load_time_of_unchanged_rows(spark, target):
    src = spark.createDataFrame([("A", "ba", "ca"), ("B", "new", "cb")], "product_id string, brand string, categoria string")
    out = dml.merge_update(target, src, "product_id", ["brand", "categoria"], load_ts=TS1, only_changed=True)
    assert rows(out, "product_id", "brand", "ts_load") == [("A", "ba", TS0), ("B", "new", TS1)]


def test_duplicate_source_key_fails_like_merge(spark, target):
    src = spark.createDataFrame([("B", "x", "y"), ("B", "z", "w")], "product_id string, brand string, categoria string")
    with pytest.raises(Exception, match="duplicate key"):
        dml.merge_update(target, src, "product_id", ["brand"], load_ts=TS1).collect()


def test_null_key_is_inserted_never_matched(spark, target):
    src = spark.createDataFrame([(None, "n", "n")], "product_id string, brand string, categoria string")
    out = dml.upsert(target, src, "product_id", ["brand", "categoria"], id_col="id", load_ts=TS1)
    assert out.count() == 3 and out.where(F.col("product_id").isNull()).first().id == 3


def test_changed_rows_is_bag_difference(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "y")], "k int, v string")
    out = dml.changed_rows(a, b, ["k", "v"], ts_col=None)
    assert rows(out, "k", "v") == [(1, None), (2, "x")]   # nulls equal, multiplicity kept


def test_delete_where_keeps_rows_with_null_predicate(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 1.0)], "k int, price double")
    assert rows(dml.delete_where(df, F.col("price") > 2), "k") == [(2,), (3,)]
    assert dml.delete_all(df).count() == 0


def test_update_where(spark):
    seq = spark.createDataFrame([("t.date_dim", 0), ("t.producto_dim", 7)], "table_name string, id bigint")
    out = dml.update_where(seq, F.col("table_name") == "t.date_dim", {"id": 12})
    assert rows(out, "table_name", "id") == [("t.date_dim", 12), ("t.producto_dim", 7)]


def test_insert_rows_and_append_unseen(spark):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    more = dml.insert_rows(spark, df, [(2, "b")])
    assert more.count() == 2
    batch = spark.createDataFrame([(1, "a"), (3, "c")], "k int, v string")
    assert rows(dml.append_unseen(more, batch, key="k", ts_col=None), "k") == [(3,)]
    assert rows(dml.append_unseen(more, batch, ts_col=None), "k") == [(3,)]


def test_reload_partitions_replaces_only_batch_years(spark):
    cur = spark.createDataFrame([(1, 2022), (2, 2023), (3, 2023)], "v int, year int")
    batch = spark.createDataFrame([(9, 2023), (8, 2024)], "v int, year int")
    assert rows(dml.reload_partitions(cur, batch, ["year"]), "v", "year") == [(1, 2022), (8, 2024), (9, 2023)]
