"""The load job: snapshot files → warehouse tables (parquet) → CSV export.

Order matters: dates, then products, then facts (which look up both
dimensions), with the daily index. New dates and facts are appended; of the
product dimension, stored in buckets by key, those with changed or new products
are rewritten; of the index the days with new facts are summed again.
Re-running the job on the same files appends nothing.

A job may be lost at any point. New ids start after both the stored sequence
and the largest stored id, replaced tables are finished by the next run
(``tables.recover_table``), and facts are compared with what is stored, so a
rerun, with more files or without, ends where an undisturbed job does.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.operators import dml
from shelfwatch.operators.keys import advance_seq, last_id, last_seq
from shelfwatch.plans import warehouse as W
from shelfwatch.session import release_shuffles, staged
from shelfwatch.sources import buckets as B
from shelfwatch.sources import export as X
from shelfwatch.sources import tables as T
from shelfwatch.sources.snapshots import read_snapshots


# Dimensions whose surrogate ids are handed out from the sequence table.
SEQUENCED = ["date_dim", "producto_dim"]


def table_paths(base: str) -> dict[str, str]:
    return {name: f"{base.rstrip('/')}/{name}" for name in schemas.WAREHOUSE}


def create_warehouse(spark: SparkSession, base: str, load_ts=None) -> dict[str, str]:
    """Empty warehouse tables (schema only; the fact partitioned by year) and
    the sequence table seeded with one row per dimension at id 0."""
    stored = schemas.WAREHOUSE | {"producto_dim": B.stored_schema(schemas.PRODUCT_DIM)}
    paths = T.create_tables(spark, base, stored, schemas.PARTITIONING | {"producto_dim": [B.BUCKET]})
    ts = load_ts if load_ts is not None else _dt.datetime.now()
    seeded = dml.insert_rows(spark, W.empty(spark, schemas.SEQUENCES), [(name, 0, ts) for name in SEQUENCED])
    T.write_table(seeded, paths["sequences_cfg"], "overwrite")
    return paths


def _read(spark: SparkSession, path: str, schema) -> DataFrame:
    return T.trim_strings(spark.read.schema(schema).parquet(path).select(*schema.fieldNames()))


def open_warehouse(spark: SparkSession, base: str) -> W.Warehouse:
    p = table_paths(base)
    return W.Warehouse(_read(spark, p["date_dim"], schemas.DATE_DIM),
                       _read(spark, p["producto_dim"], schemas.PRODUCT_DIM),
                       _read(spark, p["producto_dia_fact"], schemas.PRICE_FACT),
                       _read(spark, p["precio_dia_agg_norm_fact"], schemas.PRICE_INDEX))


def recover(spark: SparkSession, base: str) -> None:
    """Finish the replacements that a lost job left behind."""
    p = table_paths(base)
    T.recover_table(spark, p["producto_dim"], [B.BUCKET], dynamic=True)
    for name in ("sequences_cfg", "precio_dia_agg_norm_fact"):
        T.recover_table(spark, p[name])


def load_dataset(spark: SparkSession, dataset: DataFrame, base: str, load_ts=None,
                 on_write: Callable[[str], None] | None = None) -> dict[str, bool]:
    """Load one snapshot DataFrame into the warehouse at ``base``; returns
    which tables received rows. New ids continue from the sequence table or the
    largest stored id, whichever is larger; the sequence table is advanced after
    the dimensions are written. ``on_write`` is called with the name of each
    table that was written, when it was."""
    p = table_paths(base)
    done = on_write or (lambda name: None)
    seqs = lambda: _read(spark, p["sequences_cfg"], schemas.SEQUENCES)
    after = lambda name, table, id_col: F.greatest(last_seq(seqs(), name), last_id(table, id_col))
    recover(spark, base)
    wh = open_warehouse(spark, base)
    dates = W.new_dates(dataset, wh.date_dim, load_ts, start=after("date_dim", wh.date_dim, "id_date"))
    wrote = {"date_dim": T.write_table(dates, p["date_dim"], "append")}
    if wrote["date_dim"]:
        done("date_dim")
    changed = B.merge_buckets(spark, p["producto_dim"], schemas.PRODUCT_DIM, W.latest_products(dataset), "product_id",
                              W.PRODUCT_ATTRS, "id_producto", ["product_id"], after("producto_dim", wh.product_dim, "id_producto"),
                              load_ts=load_ts)
    if changed:
        done("producto_dim")
    wh = open_warehouse(spark, base)
    seq = advance_seq(advance_seq(seqs(), "date_dim", wh.date_dim, "id_date", load_ts),
                      "producto_dim", wh.product_dim, "id_producto", load_ts)
    if not seq.select("table_name", "id").exceptAll(seqs().select("table_name", "id")).isEmpty():
        T.replace_table(seq, p["sequences_cfg"])
        done("sequences_cfg")
    release_shuffles(spark)
    with staged(W.new_facts(dataset, wh.product_dim, wh.date_dim, wh.fact, load_ts), "facts") as facts:
        release_shuffles(spark)
        wrote["producto_dia_fact"] = not facts.isEmpty()
        if wrote["producto_dia_fact"]:
            # the index first: if the job ends before the facts are stored, a rerun finds them new and sums their days again
            T.replace_table(W.updated_price_index(wh.index, wh.fact, facts, load_ts), p["precio_dia_agg_norm_fact"])
            done("precio_dia_agg_norm_fact")
            T.write_table(facts, p["producto_dia_fact"], "append", partition_by=["year"], skip_empty=False)
            done("producto_dia_fact")
    return wrote


def sequences(spark: SparkSession, base: str) -> DataFrame:
    return _read(spark, table_paths(base)["sequences_cfg"], schemas.SEQUENCES)


def export_warehouse(spark: SparkSession, base: str, export_dir: str) -> dict[str, str]:
    wh = open_warehouse(spark, base)
    return X.export_tables({"date_dim": wh.date_dim, "producto_dim": wh.product_dim,
                            "producto_dia_fact": wh.fact, "precio_dia_agg_norm_fact": wh.index},
                           export_dir)


def run(spark: SparkSession, snapshot_dir: str, base: str, export_dir: str | None = None,
        load_ts=None, pattern: str = "*.csv") -> dict[str, bool]:
    """Read every snapshot under ``snapshot_dir``, load, optionally export.
    The text files are parsed once into a staged parquet table that the three
    load steps read; it goes when they are done."""
    with staged(read_snapshots(spark, snapshot_dir, pattern), "snapshot") as dataset:
        wrote = load_dataset(spark, dataset, base, load_ts)
    release_shuffles(spark)
    if export_dir:
        export_warehouse(spark, base, export_dir)
    return wrote
