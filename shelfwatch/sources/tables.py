"""Table reads and writes (path-based parquet or catalog tables).

Writes are guarded by ``isEmpty()`` (one row fetched) instead of ``count()``
(a full pass). Replacing a table that the new content was computed from goes
a table staged in the shared checkpoint folder first, which cuts the
lineage to the old files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfwatch.operators.keys import assign_ids, last_id
from shelfwatch.session import remove_path


def trim_strings(df: DataFrame) -> DataFrame:
    """Trim spaces of every string column in one projection."""
    return df.select(*[F.trim(F.col(f.name)).alias(f.name) if isinstance(f.dataType, StringType)
                       else F.col(f.name) for f in df.schema.fields])


def read_table(spark: SparkSession, name_or_path: str, trim: bool = True) -> DataFrame:
    """Catalog table (``db.table``) or parquet path; string columns trimmed
    (tables migrated from blank-padded ``character(n)`` columns)."""
    df = spark.read.parquet(name_or_path) if "/" in name_or_path else spark.read.table(name_or_path)
    return trim_strings(df) if trim else df


def raw_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    return read_table(spark, name_or_path, trim=False)


def write_table(df: DataFrame, target: str, mode: str = "append",
                partition_by: Sequence[str] | None = None, id_column: str | None = None,
                id_order: Sequence[str] | None = None, existing: DataFrame | None = None,
                skip_empty: bool = True) -> bool:
    """Write ``df`` to a parquet path or catalog table; skip when empty.

    With ``id_column`` consecutive ids are added after the largest id of
    ``existing`` (or 0). Returns whether something was written."""
    if skip_empty:
        from shelfwatch.session import stage_table
        df = stage_table(df, "write")  # worked out once: for the test and for the write
        if df.isEmpty():
            return False
    if id_column is not None:
        start = last_id(existing, id_column) if existing is not None else 0
        df = assign_ids(df, id_column, id_order, start=start)
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.parquet(target)
    else:
        w.format("parquet").saveAsTable(target)
    return True


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop(spark, path)
    return fs.exists(p)


def _pending(target: str) -> str:
    return f"{target.rstrip('/')}_pending"


def _put(df: DataFrame, target: str, partition_by: Sequence[str] | None, dynamic: bool) -> None:
    if dynamic:
        overwrite_partitions(df, target, partition_by or [])
    else:
        write_table(df, target, "overwrite", partition_by, skip_empty=False)


def recover_table(spark: SparkSession, target: str, partition_by: Sequence[str] | None = None, dynamic: bool = False) -> bool:
    """Finish a ``replace_table`` of a path that was cut off; returns whether there was one to finish.

    A replacement whose new content was complete is carried out again, whatever
    of the target it had replaced; an incomplete one is dropped, as it had not
    touched the target yet."""
    pending = _pending(target)
    if not path_exists(spark, pending):
        return False
    whole = path_exists(spark, f"{pending}/_SUCCESS")
    if whole:
        _put(spark.read.parquet(pending), target, partition_by, dynamic)
    remove_path(spark, pending)
    return whole


def replace_table(df: DataFrame, target: str, partition_by: Sequence[str] | None = None,
                  attempts: int = 3, dynamic: bool = False) -> None:
    """Overwrite ``target`` with ``df`` even when ``df`` was computed from it.

    The new content of a path is first written beside it (``<target>_pending``)
    and overwrites it from there, so a job lost between the two, or within the
    overwrite, loses nothing: ``recover_table`` with the same arguments, which
    also runs here first, finishes it. With ``dynamic`` only the partitions that
    ``df`` holds are replaced. A catalog table is staged in the checkpoint folder."""
    spark = df.sparkSession
    if "/" not in target:
        from shelfwatch.session import stage_table
        staged = stage_table(df, "replace")
    else:
        recover_table(spark, target, partition_by, dynamic)
        df.write.parquet(_pending(target))
        staged = spark.read.schema(df.schema).parquet(_pending(target))
    for attempt in range(attempts):
        try:
            _put(staged, target, partition_by, dynamic)
            break
        except Exception:  # noqa: BLE001
            if attempt == attempts - 1:
                raise
    if "/" in target:
        remove_path(spark, _pending(target))


def backup_table(spark: SparkSession, source: str, target_base: str, day=None) -> str:
    """Copy a table under a dated name (``<target_base>_<yyyymmdd>``); returns
    the new path. Executors copy the files' rows; nothing goes to the driver."""
    import datetime as _dt
    tag = (day or _dt.date.today()).strftime("%Y%m%d")
    target = f"{target_base}_{tag}"
    write_table(raw_table(spark, source), target, "errorifexists", skip_empty=False)
    return target


def overwrite_partitions(df: DataFrame, target: str, partition_by: Sequence[str]) -> None:
    """Reload by partition: partitions present in ``df`` are replaced, all
    others kept (dynamic partition overwrite; the session default is static,
    which would drop every other partition)."""
    w = (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(*partition_by))
    if "/" in target:
        w.parquet(target)
    else:
        w.format("parquet").insertInto(target, overwrite=True)


def create_tables(spark: SparkSession, base: str, catalogue: dict[str, StructType],
                  partitioning: dict[str, Sequence[str]] | None = None) -> dict[str, str]:
    """Create empty parquet tables (schema only) under ``base``; returns paths."""
    partitioning = partitioning or {}
    paths = {}
    for name, schema in catalogue.items():
        path = f"{base.rstrip('/')}/{name}"
        w = spark.createDataFrame([], schema).write.mode("overwrite")
        if name in partitioning:
            w = w.partitionBy(*partitioning[name])
        w.parquet(path)
        paths[name] = path
    return paths


def create_schema(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {db}")


def catalog_tables(spark: SparkSession, db: str | None = None) -> DataFrame:
    """Tables of a database as a DataFrame (name, database, type, temporary)."""
    rows = [(t.name, t.database, t.tableType, t.isTemporary) for t in spark.catalog.listTables(db)]
    return spark.createDataFrame(rows, "name string, database string, tableType string, isTemporary boolean")


def schema_table(df: DataFrame) -> DataFrame:
    """The schema of ``df`` as rows (column, type, nullable)."""
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column string, type string, nullable boolean")
