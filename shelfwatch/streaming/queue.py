"""Page capture driven by the work queue: a resumable queue on storage.

The queue ``(id_producto, url_product, index)`` is stored in cuts of ``cut``
consecutive indexes (``<base>/queue/cut=<n>``), of a multiple of that in a
longer queue, so that it has at most ``CUTS`` folders. Page files arrive in a folder;
each micro-batch of the file stream is joined with the stored queue by URL, and
what a page gives, record or reject, is stored under its queue index, in
partitions of cut and micro-batch. Only when a micro-batch is stored its
entries are purged: the queue's cuts that it touched are replaced by what is
left of them. At the end of a run ``<base>/progress`` holds the high-water
mark, the index up to which all is done, and the open gaps below the largest
done index.

A job lost between write and purge purges first when it comes back; a
micro-batch that is replayed replaces its own partitions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfwatch import schemas
from shelfwatch.operators.keys import with_global_rank
from shelfwatch.plans.capture import product_fields, split_records
from shelfwatch.session import stage_table
from shelfwatch.sources import tables as T
from shelfwatch.sources.pages import PAGE_SCHEMA, SHOP_RULES, PageRules
from shelfwatch.streaming.ingest import source_file

#: queue entries of a cut, as many as the capture job flushes at a time
CUT = 500
#: cuts that a queue has at most: making, listing and replacing a folder costs the same however few rows it holds
CUTS = 128
QUEUE = StructType([StructField("id_producto", StringType()), StructField("url_product", StringType()),
                    StructField("index", LongType()), StructField("cut", LongType())])
RECORD = StructType([StructField("index", LongType()), *schemas.PRODUCT_RECORD.fields, StructField("reject_reason", StringType()),
                     StructField("source_file", StringType()), StructField("cut", LongType()), StructField("taken", LongType())])
PROGRESS = "mark bigint, gap_from bigint, gap_to bigint"


def queue_paths(base: str) -> dict[str, str]:
    return {n: f"{base.rstrip('/')}/{n}" for n in ("queue", "records", "progress", "checkpoint")}


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if T.path_exists(spark, path) else spark.createDataFrame([], schema)


def open_entries(spark: SparkSession, base: str) -> DataFrame:
    """What is left of the queue."""
    return _read(spark, queue_paths(base)["queue"], QUEUE)


def create_queue(queue: DataFrame, base: str, cut: int = CUT) -> None:
    """Store a work queue ``(id_producto, url_product, index)``; its indexes start at 0.

    A cut holds ``cut`` indexes, or as many times that as keep the number of cuts to ``CUTS``."""
    top = queue.select(F.max("index").cast("bigint")).scalar()
    width = cut * F.greatest(F.lit(1).cast("bigint"), F.ceil((top + 1) / (cut * CUTS)))
    cuts = queue.select("id_producto", "url_product", F.col("index").cast("bigint").alias("index"),
                        F.floor(F.col("index") / width).cast("bigint").alias("cut"))
    cuts.repartition("cut").write.partitionBy("cut").parquet(queue_paths(base)["queue"])


def records(spark: SparkSession, base: str) -> DataFrame:
    """Records and rejects (``reject_reason`` not null), one row for each index, ordered by index: the page
    that was taken last, of several the one whose file comes last by name."""
    rows = _read(spark, queue_paths(base)["records"], RECORD)
    cols = [c for c in RECORD.fieldNames() if c not in ("index", "taken", "cut", "source_file")]
    last = rows.groupBy("index").agg(F.max(F.struct("taken", "source_file", *cols)).alias("r"))
    return last.select("index", *[f"r.{c}" for c in cols]).orderBy("index")


def purge(spark: SparkSession, base: str, cuts: list[int] | None = None) -> None:
    """Remove the entries whose index is stored from the queue, of the named cuts or of all."""
    p = queue_paths(base)
    T.recover_table(spark, p["queue"], ["cut"], dynamic=True)
    done = _read(spark, p["records"], RECORD).select("cut", "index").distinct()
    here = open_entries(spark, base)
    if cuts is None:
        cuts = [r[0] for r in here.join(done, ["cut", "index"], "left_semi").select("cut").distinct().collect()]
    if not cuts:
        return
    mine = F.col("cut").isin(cuts)
    left = stage_table(here.where(mine).join(done.where(mine), ["cut", "index"], "left_anti").select(*QUEUE.fieldNames()), "left")
    T.replace_table(left.repartition("cut"), p["queue"], ["cut"], dynamic=True)
    kept = {r[0] for r in left.select("cut").distinct().collect()}
    for c in cuts:
        if c not in kept:  # nothing of the cut is left
            T.remove_path(spark, f"{p['queue']}/cut={c}")


def store_progress(spark: SparkSession, base: str) -> None:
    p = queue_paths(base)
    T.replace_table(progress_of(open_entries(spark, base), _read(spark, p["records"], RECORD)).coalesce(1), p["progress"])


def progress_of(queue: DataFrame, stored: DataFrame) -> DataFrame:
    """``(mark, gap_from, gap_to)``: a row with the mark alone, and one for each range of open indexes below the largest done one.

    The mark is the last index before the first open one. What is open below
    the largest done index is far less than what is done, and only that is ranked."""
    top = stored.select(F.max("index")).scalar()
    below = with_global_rank(queue.select("index").where(F.col("index") < top), ["index"], "_r")
    gaps = below.groupBy((F.col("index") - F.col("_r")).alias("_island")).agg(F.min("index").alias("gap_from"), F.max("index").alias("gap_to"))
    mark = F.coalesce(queue.select(F.min("index") - 1).scalar(), top, F.lit(-1).cast("bigint")).alias("mark")
    none = F.lit(None).cast("bigint")
    return queue.sparkSession.range(1).select(mark, none.alias("gap_from"), none.alias("gap_to")).unionByName(gaps.select(mark, "gap_from", "gap_to"))


def progress(spark: SparkSession, base: str) -> DataFrame:
    """The progress as last stored."""
    path = queue_paths(base)["progress"]
    return spark.read.schema(PROGRESS).parquet(path) if T.path_exists(spark, path) else spark.createDataFrame([], PROGRESS)


def process_queue(spark: SparkSession, base: str, pages_dir: str, run_date, rules: PageRules = SHOP_RULES, cut: int = CUT,
                  max_files_per_trigger: int = 16, load_ts=None, reload: bool = False,
                  on_write: Callable[[str], None] | None = None) -> int:
    """Capture all page files of ``pages_dir`` that were not yet taken, for the queue at ``base``; returns the number of micro-batches.

    Pages whose URL is not in the queue are left alone, and so are those of
    entries that are done. An entry without a page stays open until its page
    arrives. ``reload`` takes all files anew from the start, with a new
    checkpoint, for entries that are still open. ``on_write`` is called with
    "records" and "queue" after each is written.
    """
    p = queue_paths(base)
    done = on_write or (lambda name: None)
    purge(spark, base)  # what a lost run stored but did not purge
    turn = 0  # of full reloads
    while T.path_exists(spark, f"{p['checkpoint']}/{turn + (0 if reload else 1)}"):
        turn += 1
    stream = (spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(pages_dir).select("*", source_file()))
    batches = []

    def write_batch(batch: DataFrame, epoch: int) -> None:
        entries = open_entries(spark, base).select(F.col("url_product").alias("url"), "index", "cut")
        taken = batch.join(entries, "url").withColumn("taken", F.lit(turn * 1_000_000_000 + epoch).cast("bigint"))
        hit = stage_table(product_fields(taken, rules, run_date, load_ts), "taken")  # parsed once; without the pages' text
        cuts = [r[0] for r in hit.select("cut").distinct().collect()]
        ok, bad = split_records(hit, ("index", "taken", "cut", "source_file"))
        both = ok.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)
        if cuts:
            T.overwrite_partitions(both.select(*RECORD.fieldNames()).repartition("cut"), p["records"], ["cut", "taken"])
            done("records")
            purge(spark, base, cuts)
            done("queue")
        batches.append(epoch)

    q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", f"{p['checkpoint']}/{turn}").trigger(availableNow=True).start())
    q.awaitTermination()
    store_progress(spark, base)
    return len(batches)
