"""Daily snapshot files: ``;``-separated CSV with a header, one file per
capture run, one folder per day (``<yyyymmdd>/<yyyymmdd>_<hhmm>_prices.csv``).

Columns are bound by header name, never by position: each file's own header row
says where a column stands, so files of different layouts (the capture job's and
the loader's) are read together, however many columns they have. The headers
are taken from the first lines of the files; then the files of each layout are
read by a scan of their own with that layout's columns, so the body is parsed
once and only the columns asked for. A file with rows but no header fails
loudly. Values are converted with ``try_cast`` (ANSI-safe: a bad number becomes
null, it does not stop the job). Files holding only a newline are tolerated.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from shelfwatch import schemas
from shelfwatch.functions.text import trim_decoded

# Header of the snapshot files as written by the capture job.
SNAPSHOT_HEADER = ["product_id", "price", "product", "brand", "unit_price", "units", "categories",
                   "discount", "date"]


# Header of the files as the loader declares them.
LOADED_HEADER = [f.name for f in schemas.SNAPSHOT_LOADED.fields]


def file_headers(spark: SparkSession, path: str, pattern: str = "*.csv", sep: str = ";") -> DataFrame:
    """``(file_path, names)``: the cells of the first line that isn't blank of every file under ``path``.

    Every file is one task, which stops at that line, so no more than the first
    buffers of a file are read. Files without such a line give no row."""
    def first_lines(batches):
        import pyarrow as pa
        for b in batches:
            for line, file, start in zip(*(c.to_pylist() for c in b.columns)):
                if start != 0:
                    return  # a later block of the file
                line = line.lstrip("\ufeff")
                if line.strip():
                    names = [c.strip() for c in next(csv.reader([line], delimiter=sep))]
                    yield pa.RecordBatch.from_pydict({"file_path": [file], "names": [names]})
                    return

    conf = spark.conf
    apart, whole, rows = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes", "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = {k: conf.get(k) for k in (apart, rows)}
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(conf.get(whole))
    try:
        conf.set(apart, str(size))  # a file that is opened fills a partition: no two in one task
        conf.set(rows, "64")
        lines = (spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(path)
                 .select("value", "_metadata.file_path", "_metadata.file_block_start"))
        found = lines.mapInArrow(first_lines, "file_path string, names array<string>").collect()  # as many rows as files are listed
    finally:
        for k, v in usual.items():
            conf.set(k, v)
    return spark.createDataFrame([tuple(r) for r in found], "file_path string, names array<string>")


def read_snapshots(spark: SparkSession, path: str, pattern: str = "*.csv", sep: str = ";",
                   schema: StructType = schemas.SNAPSHOT, with_source: bool = False, strip: bool = False,
                   with_capture_time: bool = False, marks: Sequence[str] = ("product_id", "price")) -> DataFrame:
    """All snapshot files under ``path`` (recursively) as one typed DataFrame
    in ``schema``'s column order; a column that a file lacks is null. A file's
    first line that isn't blank is its header and must hold the names ``marks``.
    The header may come again within a file (captures that were concatenated);
    another header there fails the job. ``strip`` trims all whitespace from
    text; ``with_source`` adds the file path; ``with_capture_time`` adds
    ``capture_ts`` parsed from a ``<yyyymmdd>_<hhmm>_…`` file name (null when
    the name does not follow it), which tells two captures of a day apart.

    The driver holds what it lists anyway, the files' paths, with one header per layout."""
    layouts: dict[tuple[str, ...], list[str]] = {}
    for r in file_headers(spark, path, pattern, sep).collect():
        if not set(marks) <= set(r["names"]):
            raise ValueError(f"no header row in {r['file_path']}")
        layouts.setdefault(tuple(r["names"]), []).append(r["file_path"])
    parts = [_read_layout(spark, files, names, sep, schema, with_source, strip, with_capture_time, marks)
             for names, files in sorted(layouts.items())]
    if not parts:
        empty = StructType(list(schema.fields))
        for name, kind, wanted in (("source_file", "string", with_source), ("capture_ts", "timestamp", with_capture_time)):
            empty = empty.add(name, kind) if wanted else empty
        return spark.createDataFrame([], empty)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _read_layout(spark: SparkSession, files: list[str], names: Sequence[str], sep: str, schema: StructType, with_source: bool,
                 strip: bool, with_capture_time: bool, marks: Sequence[str]) -> DataFrame:
    """The files whose header is ``names``."""
    text_schema, at = StructType(), {}
    for i, n in enumerate(names):
        at.setdefault(n, f"c{i}")  # the first of equal names
        text_schema = text_schema.add(f"c{i}", StringType())
    lines = (spark.read.schema(text_schema)
             .option("header", False).option("sep", sep).option("encoding", "UTF-8").option("mode", "PERMISSIVE")
             .csv(files))
    first = [F.col(at[m]) for m in marks]
    is_header = F.lit(True)
    for m, c in zip(marks, first):  # a plain search first: the expression is worked out for few rows
        is_header = is_header & F.coalesce(F.contains(c, F.lit(m)), F.lit(False)) & F.coalesce(F.trim(F.regexp_replace(c, "^\ufeff", "")) == m, F.lit(False))
    other = F.lit(True)  # every mark's cell holds a name of some column: the header of another layout
    for c in first:
        other = other & F.coalesce(F.trim(c).isin([*names, *schema.fieldNames()]), F.lit(False))
    blank = F.lit(True)
    for m in marks:
        blank = blank & F.col(at[m]).isNull()
    if len(names) > len(marks):  # a row may lack the marks and still hold something
        blank = blank & F.coalesce(*[F.col(c) for c in text_schema.names]).isNull()
    rows = lines.where(~is_header & ~blank)
    out = []
    for f in schema.fields:
        c = F.col(at[f.name]) if f.name in at else F.lit(None).cast("string")
        if f.name == marks[0]:  # the file's name as a function: as a metadata column it would be copied into every row
            c = F.when(other, F.raise_error(F.concat(F.lit("no header row of this layout in "), F.input_file_name())).cast("string")).otherwise(c)
        if isinstance(f.dataType, StringType):
            out.append((trim_decoded(c) if strip else c).alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    if with_source:
        out.append(F.col("_metadata.file_path").alias("source_file"))
    if with_capture_time:
        stamp = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{8}_\d{4})_", 1)
        out.append(F.try_to_timestamp(F.nullif(stamp, F.lit("")), F.lit("yyyyMMdd_HHmm")).alias("capture_ts"))
    return rows.select(*out)


def write_snapshots(df: DataFrame, path: str, folder_col=None, sep: str = ";",
                    header: Sequence[str] = SNAPSHOT_HEADER, mode: str = "overwrite", files: int = 8) -> None:
    """Write snapshot rows as ``;`` CSV with header, one folder per value of
    ``folder_col`` (default: the capture day, ``yyyyMMdd``), up to ``files``
    files per folder, so a large folder is written by that many tasks."""
    folder = F.date_format("date", "yyyyMMdd") if folder_col is None else \
        (F.col(folder_col) if isinstance(folder_col, str) else folder_col)
    out = df.select(*[F.col(c) for c in header], folder.alias("snapshot"))
    (out.repartition("snapshot", F.pmod(F.xxhash64(*header), F.lit(files))).write.mode(mode).partitionBy("snapshot")
     .option("header", True).option("sep", sep)
     # the writer trims values by default; snapshots keep them as captured
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: StructType = schemas.PRODUCT_RECORD) -> DataFrame:
    """Literal rows → DataFrame with an explicit schema (test fixtures, manual entries)."""
    return spark.createDataFrame(list(rows), schema)
