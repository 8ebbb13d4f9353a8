"""Dimensions stored in buckets by key hash, so that a merge rewrites only what changed.

A bucketed table is a parquet folder partitioned by ``bucket``, whose value
names the bucket and how many there are (``7-of-64``). A merge finds the
buckets that hold a key with other attributes, or get a new one, by a join on
(bucket, key) of the batch with the columns compared; only those are read in
full and replaced by a dynamic overwrite. Files of all other buckets stay as
they are. A merge that was cut off is finished by the next one
(``tables.recover_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfwatch.operators import dml
from shelfwatch.session import stage_table
from shelfwatch.sources import tables as T

BUCKET = "bucket"
BUCKETS = 64


def bucket_of(key: str, buckets: int) -> Column:
    """Bucket of a key, by the hash of its text."""
    number = F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets))
    return F.concat(number.cast("string"), F.lit(f"-of-{buckets}"))


def stored_schema(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(BUCKET, StringType())])


def read_buckets(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The stored rows with their bucket, in ``schema``'s column order."""
    return spark.read.schema(stored_schema(schema)).parquet(path).select(*schema.fieldNames(), BUCKET)


def bucket_count(stored: DataFrame, default: int = BUCKETS) -> int:
    """How many buckets a stored table was made with; ``default`` for an empty one."""
    row = stored.select(BUCKET).first()
    return default if row is None else int(row[0].rsplit("-", 1)[1])


def merge_buckets(spark: SparkSession, path: str, schema: StructType, source: DataFrame, key: str, set_cols: Sequence[str],
                  id_col: str | None = None, order_cols: Sequence[str] | None = None, start: Column | int | None = None,
                  ts_col: str = "ts_load", load_ts=None, buckets: int = BUCKETS) -> list[str]:
    """Upsert ``source`` into the bucketed table at ``path``; returns the buckets that were rewritten.

    As ``dml.upsert`` with ``only_changed``: matched rows whose ``set_cols``
    differ take the new values and load time, unseen keys get ids after
    ``start`` (default: the largest stored id) in the order of ``order_cols``.
    Rows of ``source`` without a key are left out; a key that occurs twice in
    it and in the table fails the merge. ``buckets`` counts for an empty table
    only. The names of the rewritten buckets reach the driver, no rows do.
    """
    T.recover_table(spark, path, [BUCKET], dynamic=True)
    stored = read_buckets(spark, path, schema)
    n = bucket_count(stored, buckets)
    batch = stage_table(source.where(F.col(key).isNotNull()).withColumn(BUCKET, bucket_of(key, n)), "merge")
    old = stored.select(BUCKET, key, F.lit(True).alias("_known"), *[F.col(c).alias(f"_old_{c}") for c in set_cols])
    differs = F.col("_known").isNull()
    for c in set_cols:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"_old_{c}"))
    touched = [r[0] for r in batch.join(old.hint("merge"), [BUCKET, key], "left").where(differs).select(BUCKET).distinct().collect()]
    if not touched:
        return []
    if id_col is not None and start is None:
        start = dml.last_id(stored, id_col)
    here = F.col(BUCKET).isin(touched)
    new = dml.upsert(stored.where(here).drop(BUCKET), batch.where(here).drop(BUCKET), key, set_cols, id_col, order_cols,
                     ts_col, load_ts, only_changed=True, start=start)
    T.replace_table(new.withColumn(BUCKET, bucket_of(key, n)).repartition(BUCKET), path, [BUCKET], dynamic=True)
    return sorted(touched)
