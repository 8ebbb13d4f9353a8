"""Resumable page ingest: availableNow file stream with keyed appends."""

import os

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from shelfwatch import schemas
from shelfwatch.sources import pages as Pg
from shelfwatch.streaming.ingest import ingest_pages, ingested
from tests.test_pages import PAGES


def test_ingest_once_and_resume(spark, tmp_path):
    src, rec, rej, ck = (str(tmp_path / n) for n in ("in", "rec", "rej", "ck"))
    df = spark.createDataFrame(PAGES, Pg.PAGE_SCHEMA)
    df.where("page_id <= 5").repartition(3).write.parquet(src)
    n = ingest_pages(spark, src, rec, rej, ck, "2024-01-01", Pg.SHOP_RULES, 1)
    assert n == 3
    assert ingest_pages(spark, src, rec, rej, ck, "2024-01-01", Pg.SHOP_RULES) == 0   # nothing new
    df.where("page_id > 5").write.mode("append").parquet(src)
    ingest_pages(spark, src, rec, rej, ck, "2024-01-01", Pg.SHOP_RULES)
    got = spark.read.parquet(rec)
    assert sorted(r.page_id for r in got.collect()) == [1, 4, 5, 6, 7, 8, 9]
    assert sorted(r.page_id for r in spark.read.parquet(rej).collect()) == [2, 3]
    # a new checkpoint (full reload) replays every file; keyed appends add nothing twice
    ingest_pages(spark, src, rec, rej, str(tmp_path / "ck2"), "2024-01-01", Pg.SHOP_RULES)
    assert spark.read.parquet(rec).count() == 7
    assert spark.read.parquet(rec).where(F.col("date") == "2024-01-01").count() == 7


def test_files_of_one_name_in_two_folders_are_both_kept(spark, tmp_path):
    rec, rej = (str(tmp_path / n) for n in ("rec", "rej"))
    df = spark.createDataFrame(PAGES, Pg.PAGE_SCHEMA)
    for k, some in enumerate(("page_id <= 5", "page_id > 5")):
        df.where(some).coalesce(1).write.parquet(str(tmp_path / f"w{k}"))
        (tmp_path / f"in{k}").mkdir()
        next((tmp_path / f"w{k}").glob("part-*.parquet")).rename(tmp_path / f"in{k}" / "pages.parquet")
    for run in range(2):  # the second replays both files
        for k in range(2):
            ingest_pages(spark, str(tmp_path / f"in{k}"), rec, rej, str(tmp_path / f"ck{run}{k}"), "2024-01-01", Pg.SHOP_RULES)
        assert sorted(r.page_id for r in spark.read.parquet(rec).collect()) == [1, 4, 5, 6, 7, 8, 9]
        assert sorted(r.page_id for r in spark.read.parquet(rej).collect()) == [2, 3]


def test_the_file_written_last_counts(spark, tmp_path):
    src, rec, rej = (str(tmp_path / n) for n in ("in", "rec", "rej"))
    df = spark.createDataFrame(PAGES, Pg.PAGE_SCHEMA).where("page_id in (1, 4)").coalesce(1)
    for name, price, when in (("b", "1,11", 2_000), ("a", "2,22", 3_000), ("c", "3,33", 1_000)):
        df.withColumn("html", F.regexp_replace("html", r"\d+,\d+", price)).write.parquet(str(tmp_path / f"w{name}"))
        os.makedirs(src, exist_ok=True)
        target = os.path.join(src, f"{name}.parquet")
        next((tmp_path / f"w{name}").glob("part-*.parquet")).rename(target)
        os.utime(target, (1_700_000_000 + when, 1_700_000_000 + when))
    ingest_pages(spark, src, rec, rej, str(tmp_path / "ck"), "2024-01-01", Pg.SHOP_RULES)
    schema = StructType([StructField("page_id", LongType()), *schemas.PRODUCT_RECORD.fields])
    assert [(r.page_id, r.price) for r in ingested(spark, rec, schema).orderBy("page_id").collect()] == [(1, 2.22), (4, 2.22)]
