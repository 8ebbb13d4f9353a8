"""Resumable page ingest with Structured Streaming.

Page dumps (parquet files of ``page_id, url, html``) land in a folder; a file
stream with a checkpoint processes each file once, in micro-batches of
``max_files_per_trigger`` files, and ``trigger(availableNow=True)`` stops when
the backlog is done. A stopped run continues where the checkpoint says;
a full reload starts over with a fresh checkpoint folder.

Each micro-batch extracts the product fields and writes accepted records and
rejects to two parquet tables partitioned by run date and source file (its name
and a hash of its whole path, as files of several folders may bear one name). A
micro-batch replaces the partitions of the files it holds (dynamic partition
overwrite), so a file replayed after a failure, or by a full reload with a new
checkpoint, adds nothing twice, whatever its page ids, and nothing that was
stored is read back. ``ingested`` reads such a table with one row per page, that of the latest file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampType

from shelfwatch.plans.capture import product_fields, split_records
from shelfwatch.sources.pages import PAGE_SCHEMA, SHOP_RULES, PageRules
from shelfwatch.sources.tables import path_exists


def _replace_files(df: DataFrame, path: str) -> None:
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("date", "source_file").parquet(path))


def source_file() -> Column:
    """Name of a row's file, then a hash of its whole path; sorts as the name does."""
    return F.concat_ws("-", "_metadata.file_name", F.substring(F.sha2(F.col("_metadata.file_path"), 256), 1, 32)).alias("source_file")


def captured() -> Column:
    """When a row's file was written."""
    return F.col("_metadata.file_modification_time").alias("captured")


def ingested(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of a table written by ``ingest_pages``: a page id that came in
    several times on a run date counts once (the file written last, of those the
    first by name, then the least row); rows without a page id are all kept. Empty if nothing was written."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(StructType([*schema.fields, StructField("source_file", StringType()), StructField("captured", TimestampType())])).parquet(path)
    cols = schema.fieldNames()
    known = rows.where("page_id IS NOT NULL").groupBy("date", "page_id").agg(
        F.min(F.struct((-F.coalesce(F.unix_micros("captured"), F.lit(0))).alias("age"), "source_file", *[c for c in cols if c not in ("date", "page_id")])).alias("r"))
    return known.select("date", "page_id", "r.*").select(*cols).unionByName(rows.where("page_id IS NULL").select(*cols))


def ingest_pages(spark: SparkSession, source_dir: str, records_path: str, rejects_path: str,
                 checkpoint_dir: str, run_date, rules: PageRules = SHOP_RULES,
                 max_files_per_trigger: int = 16, load_ts=None) -> int:
    """Process every page file not yet seen by ``checkpoint_dir``; returns the
    number of micro-batches run. A full reload uses a new ``checkpoint_dir``
    (checkpoints are never deleted here)."""
    pages = (spark.readStream.schema(PAGE_SCHEMA)
             .option("maxFilesPerTrigger", max_files_per_trigger)
             .parquet(source_dir).select("*", source_file(), captured()))
    # the expression of the fields is large: made once a stream, not once a batch
    stream = product_fields(pages, rules, run_date, load_ts)
    batches = []

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()  # written twice (records, rejects): the pages are read and parsed once
        try:
            ok, bad = split_records(batch, ("page_id", "source_file", "captured"))
            _replace_files(ok, records_path)
            _replace_files(bad, rejects_path)
        finally:
            batch.unpersist()
        batches.append(epoch_id)

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_dir)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return len(batches)
