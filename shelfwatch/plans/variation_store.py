"""Price variation kept on storage, batch by batch.

``<base>/variation`` holds the rows of ``variation.price_variation``,
partitioned by product bucket and batch; ``<base>/last`` holds, for every batch,
the last observation of each product: number, date and price. A batch of new
observations is numbered by itself and continues from there, so the history is
not read. Only products that got observations earlier than their last one (late
dates) are numbered anew from their stored rows, and only their buckets are
rewritten.

A batch is one replacement of partitions, finished by the next run if it was
cut off (``tables.recover_table``), and then a new version of ``last``. A batch
that is run again starts from the version before it and replaces its own rows,
so it may be repeated after a loss at any point, as long as no later batch ran.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from shelfwatch.functions.numeric import pct_change_2dp
from shelfwatch.operators.sequence import sequence_with_previous
from shelfwatch.session import stage_table
from shelfwatch.sources import buckets as B
from shelfwatch.sources import tables as T

PARTS = [B.BUCKET, "batch"]
OBSERVED = ["id_producto", "product", "date", "unit_price"]
ROWS = StructType([StructField("id_producto", IntegerType()), StructField("product", StringType()), StructField("date", DateType()),
                   StructField("unit_price", DoubleType()), StructField("num", LongType()), StructField("prev", DoubleType()),
                   StructField(B.BUCKET, StringType()), StructField("batch", IntegerType())])
LAST = StructType([*[f for f in ROWS.fields if f.name in OBSERVED], StructField("num", LongType()), StructField("batch", IntegerType())])
ORDER = ["date", "unit_price", "product"]


def paths(base: str) -> tuple[str, str]:
    return f"{base.rstrip('/')}/variation", f"{base.rstrip('/')}/last"


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    if not T.path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _place(prefix: str = "") -> Column:
    """A row's place among the observations of its product: the order of ``sequence_with_previous``, nulls last."""
    return F.struct(*[x for c in ORDER for x in (F.col(prefix + c).isNull(), F.col(prefix + c))])


def add_batch(spark: SparkSession, base: str, observed: DataFrame, batch: int, buckets: int = B.BUCKETS, on_write=None) -> int:
    """Add observations ``(id_producto, product, date, unit_price)`` as batch number ``batch``; returns
    how many buckets were rewritten for late dates.

    Batches are numbered upwards; only the last one may be run again. Rows
    without a product id are left out. The names of the buckets of late
    products reach the driver, and no rows. ``on_write`` is called with the
    name of each table that was written.
    """
    rows_at, last_at = paths(base)
    done = on_write or (lambda name: None)
    T.recover_table(spark, rows_at, PARTS, dynamic=True)
    versions = _read(spark, last_at, LAST).where(F.col("batch") < batch)
    newest = versions.agg(F.max("batch")).first()[0]
    last = versions.where(F.col("batch") == (newest if newest is not None else -1)).drop("batch")
    stored = _read(spark, rows_at, ROWS).where(F.col("batch") < batch)
    n = B.bucket_count(stored, buckets)
    new = stage_table(observed.select(*OBSERVED).where("id_producto IS NOT NULL").withColumn(B.BUCKET, B.bucket_of("id_producto", n)), "batch")

    before = last.select("id_producto", F.col("num").alias("_num"), F.col("unit_price").alias("_price"), _place().alias("_place"))
    first = new.groupBy("id_producto", B.BUCKET).agg(F.min(_place()).alias("_first"))
    late = stage_table(first.join(before.hint("merge"), "id_producto").where(F.col("_first") < F.col("_place")).select("id_producto", B.BUCKET), "late")
    touched = [r[0] for r in late.select(B.BUCKET).distinct().collect()]
    here = F.col(B.BUCKET).isin(touched)

    # products whose rows all come after their last one: numbered by themselves, then moved behind it
    fresh = sequence_with_previous(new.join(late.select("id_producto").hint("merge"), "id_producto", "left_anti"), "id_producto", ORDER, "unit_price", "num", "prev")
    fresh = fresh.join(before.drop("_place").hint("merge"), "id_producto", "left").select(
        *OBSERVED, (F.col("num") + F.coalesce("_num", F.lit(0))).alias("num"),
        F.when(F.col("num") == 1, F.col("_price")).otherwise(F.col("prev")).alias("prev"), B.BUCKET, F.lit(batch).alias("batch"))
    content = fresh
    if touched:
        # late products anew from all their rows, which keep their batch; the others of their buckets as they are
        old = stored.where(here)
        ids = late.select("id_producto").hint("merge")
        whole = old.join(ids, "id_producto", "left_semi").select(*OBSERVED, *PARTS).unionByName(
            new.join(ids, "id_producto", "left_semi").withColumn("batch", F.lit(batch)))
        again = sequence_with_previous(whole, "id_producto", ORDER, "unit_price", "num", "prev")
        content = content.unionByName(again.select(*content.columns)).unionByName(
            old.join(ids, "id_producto", "left_anti").select(*content.columns))
    content = stage_table(content, "variation")
    T.replace_table(content.select(*ROWS.fieldNames()).repartition(*PARTS), rows_at, PARTS, dynamic=True)
    done("variation")

    ends = content.groupBy("id_producto").agg(F.max(F.struct("num", *[c for c in OBSERVED if c != "id_producto"])).alias("r"))
    ends = ends.select("id_producto", "r.product", "r.date", "r.unit_price", "r.num")
    carried = last.join(ends.select("id_producto").hint("merge"), "id_producto", "left_anti")
    version = carried.select(*OBSERVED, "num").unionByName(ends.select(*OBSERVED, "num")).withColumn("batch", F.lit(batch))
    T.overwrite_partitions(version, last_at, ["batch"])
    done("last")
    if newest is not None and T.path_exists(spark, f"{last_at}/batch={newest}"):
        for old_version in [r[0] for r in versions.where(F.col("batch") < newest).select("batch").distinct().collect()]:
            T.remove_path(spark, f"{last_at}/batch={old_version}")  # this batch may be run again from ``newest``
    return len(touched)


def read_variation(spark: SparkSession, base: str) -> DataFrame:
    """All rows in the form of ``variation.price_variation``."""
    return _read(spark, paths(base)[0], ROWS).select(
        "id_producto", "product", "date", "unit_price", F.col("num").cast("int").alias("num"),
        F.when(F.col("num") > 1, F.col("num") - 1).cast("int").alias("num2"),
        (F.col("unit_price") - F.col("prev")).alias("variacion"), pct_change_2dp("unit_price", "prev").alias("por_variacion"))
