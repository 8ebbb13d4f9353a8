"""Snapshot files, table writes, dynamic partition reload, export."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from shelfwatch.sources import export as X, snapshots as Sn, tables as T

HEADER = "product_id;price;product;brand;unit_price;units;categories;discount;date\n"
ROWS = ("70451;3.15;Galletas de jengibre y miel ;Almenar;12.6;€/KILO);"
        "['Dulces. bollería y pan', 'Galletas. barquillos y tostadas'];;2023-08-26\n"
        "70452Q7;5.25;Champú de manzanilla sin jabón;Riberal;1.05;€/100 ML.);['Droguería', 'Cabello'];;2023-08-26\n")


@pytest.fixture()
def snapdir(tmp_path):
    for day, name, text in (("20230826", "20230826_0828_prices.csv", HEADER + ROWS),
                            ("20230826", "20230826_0839_prices.csv", HEADER + ROWS),
                            ("20230902", "20230902_0858_prices.csv",
                             HEADER + "55021;6.45;Queso curado de oveja ;Montalba;12.9;€/PIEZA);['Quesos'];;2023-09-02\n"),
                            ("20230911", "20230911_1958_prices.csv", "\n")):
        d = tmp_path / day
        d.mkdir(exist_ok=True)
        (d / name).write_text(text, encoding="utf-8")
    return str(tmp_path)


def test_read_snapshots_by_header_name(spark, snapdir):
    df = Sn.read_snapshots(spark, snapdir, "*_prices.csv", with_source=True)
    assert df.count() == 5                                   # two identical captures, one empty file
    r = df.where("product_id = '70452Q7'").first()           # non-numeric id stays text
    assert (r.price, r.unit_price, r.discount, r.date) == (5.25, 1.05, None, dt.date(2023, 8, 26))
    assert r.product == "Champú de manzanilla sin jabón" and r.units == "€/100 ML.)"
    first = df.where("product_id = '70451'").first()
    assert first.product.endswith(" ")                        # trailing space kept unless strip=True
    assert Sn.read_snapshots(spark, snapdir, "*_prices.csv", strip=True).where(
        "product_id = '70451'").first().product == "Galletas de jengibre y miel"


def test_columns_are_found_by_each_files_header(spark, tmp_path):
    (tmp_path / "x_prices.csv").write_text("date;product;product_id;price;ts_load\n2023-01-01;a;7;1.0;2023-01-02 03:04:05\n")
    (tmp_path / "y_prices.csv").write_text(HEADER + "8;2.0;b;c;1.0;u;[];;2023-01-01\n")
    got = Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv")
    assert sorted((r.product_id, r.price, r.product, r.brand) for r in got.collect()) == [("7", 1.0, "a", None), ("8", 2.0, "b", "c")]


def test_rows_without_a_header_fail_loudly(spark, tmp_path):
    (tmp_path / "x_prices.csv").write_text("1.0;7;a;b;1.0;u;[];;2023-01-01\n")
    with pytest.raises(Exception, match="no header row"):
        Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv").collect()


def test_bad_numbers_become_null_under_ansi(spark, tmp_path):
    (tmp_path / "y_prices.csv").write_text(HEADER + "1;20%;a;b;x;u;[];;not-a-date\n")
    r = Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv").first()
    assert (r.price, r.unit_price, r.date) == (None, None, None)


def test_write_snapshots_round_trip(spark, snapdir, tmp_path):
    df = Sn.read_snapshots(spark, snapdir, "*_prices.csv")
    out = str(tmp_path / "out")
    Sn.write_snapshots(df, out)
    assert sorted(d for d in os.listdir(out) if d.startswith("snapshot=")) == [
        "snapshot=20230826", "snapshot=20230902"]
    back = Sn.read_snapshots(spark, out, "*.csv")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_write_table_skips_empty_and_adds_ids(spark, tmp_path):
    path = str(tmp_path / "t")
    empty = spark.createDataFrame([], "k string")
    assert T.write_table(empty, path) is False
    assert T.write_table(spark.createDataFrame([("b",), ("a",)], "k string"), path, id_column="id") is True
    existing = spark.read.parquet(path)
    T.write_table(spark.createDataFrame([("c",)], "k string"), path, "append", id_column="id", existing=existing)
    assert sorted((r.k, r.id) for r in spark.read.parquet(path).collect()) == [("a", 1), ("b", 2), ("c", 3)]


def test_overwrite_partitions_is_dynamic(spark, tmp_path):
    path = str(tmp_path / "fact")
    cur = spark.createDataFrame([(1, 2022), (2, 2023)], "v int, year int")
    T.write_table(cur, path, "overwrite", partition_by=["year"])
    T.overwrite_partitions(spark.createDataFrame([(9, 2023), (8, 2024)], "v int, year int"), path, ["year"])
    assert sorted((r.v, r.year) for r in spark.read.parquet(path).collect()) == [(1, 2022), (8, 2024), (9, 2023)]


def test_replace_table_it_was_computed_from(spark, tmp_path):
    path = str(tmp_path / "dim")
    T.write_table(spark.createDataFrame([(1, "a")], "id int, k string"), path, "overwrite")
    cur = spark.read.parquet(path)
    T.replace_table(cur.withColumn("k", F.upper("k")), path)
    assert spark.read.parquet(path).first().k == "A"


def test_trim_strings_and_schema_table(spark):
    df = spark.createDataFrame([("ab  ", 1)], "c string, n int")
    assert T.trim_strings(df).first().c == "ab"
    assert [tuple(r) for r in T.schema_table(df).collect()] == [("c", "string", True), ("n", "int", True)]


def test_decimal_comma_export(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.6, 10000000.5)], "id int, price double, big double")
    assert tuple(X.decimal_comma(df, 2).first()) == (1, "2,60", "10000000,50")
    out = str(tmp_path / "exp")
    X.export_csv(df, out, single_file=True)
    text = "".join(open(os.path.join(out, f), encoding="utf-8").read() for f in os.listdir(out) if f.endswith(".csv"))
    assert text.splitlines() == ["id;price;big", "1;2,6;10000000,5"]


def test_export_keeps_all_digits_in_plain_notation(spark):
    values = [0.1234567, 0.0, -5.0, 1.25e-7, 123456789.125, 3.0e10, None, 1.2345678901234e-12]
    got = [r.v for r in X.decimal_comma(spark.createDataFrame([(v,) for v in values], "v double")).collect()]
    assert got == ["0,1234567", "0,0", "-5,0", "0,000000125", "123456789,125", "30000000000,0", None, "0,0000000000012345678901234"]


def test_backup_table_under_dated_name(spark, tmp_path):
    src = str(tmp_path / "producto_dim")
    T.write_table(spark.createDataFrame([(1, "a")], "id int, k string"), src, "overwrite")
    out = T.backup_table(spark, src, str(tmp_path / "producto_dim"), dt.date(2023, 9, 14))
    assert out.endswith("producto_dim_20230914") and spark.read.parquet(out).count() == 1


def test_capture_time_from_file_name(spark, snapdir):
    df = Sn.read_snapshots(spark, snapdir, "*_prices.csv", with_capture_time=True)
    got = sorted({(r.product_id, r.capture_ts) for r in df.where("product_id = '70451'").collect()})
    assert got == [("70451", dt.datetime(2023, 8, 26, 8, 28)), ("70451", dt.datetime(2023, 8, 26, 8, 39))]


def test_catalogue_inspection(spark):
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("sw_probe_view")
    names = {r.name for r in T.catalog_tables(spark).collect()}
    assert "sw_probe_view" in names
    T.create_schema(spark, "sw_probe_db")
    assert "sw_probe_db" in {d.name for d in spark.catalog.listDatabases()}


def test_forty_columns_in_headers_of_any_order(spark, tmp_path):
    more = [f"x{i}" for i in range(38)]
    (tmp_path / "a_prices.csv").write_text(";".join([*more, "product_id", "price", "date"]) + "\n" + ";".join(["v"] * 38 + ["7", "1.5", "2023-01-01"]) + "\n")
    (tmp_path / "b_prices.csv").write_text(";".join(["date", *more, "price", "product_id"]) + "\n" + ";".join(["2023-01-02", *["w"] * 38, "2.5", "8"]) + "\n")
    got = Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv")
    assert sorted((r.product_id, r.price, r.date) for r in got.collect()) == [("7", 1.5, dt.date(2023, 1, 1)), ("8", 2.5, dt.date(2023, 1, 2))]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2 and "Join" not in plan  # a scan for each layout, each file once


def test_headers_of_many_small_and_one_split_file(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}_prices.csv").write_text("\n\n" + HEADER + f"{i};1.0;a;b;1.0;u;[];;2023-01-01\n")
    (tmp_path / "big_prices.csv").write_text(HEADER + "big;1.0;a;b;1.0;u;[];;2023-01-01\n" * 20000)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
        heads = Sn.file_headers(spark, str(tmp_path), "*_prices.csv").collect()
        assert len(heads) == 31 and {tuple(r.names) for r in heads} == {tuple(HEADER.strip().split(";"))}
        got = Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv")
        assert got.count() == 20030 and got.select("product_id").distinct().count() == 31
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


def test_a_header_may_come_again_but_not_another_one(spark, tmp_path):
    row = "7;1.0;a;b;1.0;u;[];;2023-01-01\n"
    (tmp_path / "a_prices.csv").write_text(HEADER + row + HEADER + row)
    assert Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv").count() == 2
    (tmp_path / "b_prices.csv").write_text(HEADER + row + "price;product_id;product;brand;unit_price;units;categories;discount;date\n1.0;7;a;b;1.0;u;[];;2023-01-01\n")
    with pytest.raises(Exception, match="no header row"):
        Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv").collect()


def test_no_files_no_rows(spark, tmp_path):
    (tmp_path / "a_prices.csv").write_text("\n")
    got = Sn.read_snapshots(spark, str(tmp_path), "*_prices.csv", with_source=True, with_capture_time=True)
    assert got.count() == 0 and got.columns[-2:] == ["source_file", "capture_ts"]


def test_a_replacement_that_was_cut_off_is_finished(spark, tmp_path):
    path = str(tmp_path / "t")
    old, new = (spark.createDataFrame([(v, 1)], "v string, part int") for v in ("old", "new"))
    T.write_table(old, path, "overwrite", partition_by=["part"])
    new.write.parquet(path + "_pending")  # complete, but not carried out
    os.remove(next(str(p) for p in (tmp_path / "t" / "part=1").iterdir() if p.name.endswith(".parquet")))  # the overwrite had begun
    assert T.recover_table(spark, path, ["part"], dynamic=True) is True
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("new", 1)] and not os.path.exists(path + "_pending")
    old.write.parquet(path + "_pending")
    os.remove(path + "_pending/_SUCCESS")  # its content was not complete
    assert T.recover_table(spark, path, ["part"], dynamic=True) is False
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("new", 1)]


def test_literal_rows_bear_the_record_schema_and_join_a_table(spark):
    from shelfwatch import schemas
    from shelfwatch.operators import dml
    record = ("Galletas", "70451", "Almenar", 3.15, "['Dulces']", 12.6, "€/KILO", None, dt.date(2023, 8, 26), dt.datetime(2023, 8, 26, 8))
    rows = Sn.literal_rows(spark, [record, (None,) * len(record)])
    assert rows.schema == schemas.PRODUCT_RECORD
    assert [tuple(r) for r in rows.collect()] == [record, (None,) * len(record)]
    assert Sn.literal_rows(spark, []).collect() == []
    assert dml.bag_diff(rows, Sn.literal_rows(spark, [record])).count() == 1


def test_reading_snapshots_copies_no_file_name_into_rows_and_trims_as_before(spark, tmp_path):
    from shelfwatch.functions import text as tx
    line = "product_id;price;product;brand;unit_price;units;categories;discount;date\n"
    (tmp_path / "20240101_0900_prices.csv").write_text(line + "1;2.5;\u00a0 a b\u2003;b ;1;u;c;;2024-01-01\n" + line + "2;1;\u3000;b;1;u\x85;c;;2024-01-01\n", encoding="utf-8")
    got = Sn.read_snapshots(spark, str(tmp_path), strip=True)
    assert "_metadata" not in got._jdf.queryExecution().optimizedPlan().toString() and "file_path" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r.product_id, r["product"], r.brand, r.units) for r in got.collect()) == [("1", "a b", "b", "u"), ("2", "", "b", "u\x85")]
    edges = ["", " ", "\t", "\n", "\x0b", "\r\n", "\x85", "\u00a0", "\u1680", "\u180e", "\u200a", "\u200b", "\u2028", "\u2029", "\u202f", "\u205f", "\u3000", "\x1c", "\ufeff"]
    texts = [(f"{a}{m}{b}{c}",) for a in edges for m in ("", "x y") for b in edges for c in edges[:8]] + [(None,)]
    both = spark.createDataFrame(texts, "t string").select("t", tx.trim_decoded("t").alias("a"), tx.trim_all("t").alias("b"))
    assert both.where("not (a <=> b)").collect() == []
