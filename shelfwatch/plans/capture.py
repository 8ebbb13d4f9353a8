"""Product capture: pages → product records (accepted / rejected) and the
work queue of product URLs, as one distributed plan per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions import text as tx
from shelfwatch.operators import dml
from shelfwatch.operators.keys import with_global_rank
from shelfwatch.operators.quality import completeness_split
from shelfwatch.sources.pages import SHOP_RULES, PageRules, extract_fields, page_links, sitemap_file_urls, sitemap_urls

# A record is stored only when all of these are present.
REQUIRED = ["price", "product", "brand", "unit_price", "units"]
RECORD_COLS = [f.name for f in schemas.PRODUCT_RECORD.fields]


def product_fields(pages: DataFrame, rules: PageRules = SHOP_RULES, run_date=None, load_ts=None) -> DataFrame:
    """One product record per page, complete or not, with its load time; ``pages`` may be a stream."""
    return extract_fields(pages, rules, run_date=run_date).withColumn("ts_load", dml._ts(load_ts))


def split_records(fields: DataFrame, keep_cols=("page_id",)) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) of what ``product_fields`` returned."""
    keep = [c for c in keep_cols if c in fields.columns]
    ok, bad = completeness_split(fields, REQUIRED)
    return ok.select(*keep, *RECORD_COLS), bad.select(*keep, *RECORD_COLS, "reject_reason")


def capture_products(pages: DataFrame, rules: PageRules = SHOP_RULES, run_date=None, load_ts=None,
                     keep_cols=("page_id",)) -> tuple[DataFrame, DataFrame]:
    """(records, rejects). Records follow the product record schema (plus
    ``keep_cols``); rejects carry ``reject_reason`` (the missing fields)."""
    return split_records(product_fields(pages, rules, run_date, load_ts), keep_cols)


def queue_from_links(links: DataFrame, url_col: str = "href", order_cols=("page_id", "pos"),
                     only_products: bool = True) -> DataFrame:
    """Work queue (id_producto, url_product, index) from discovered URLs:
    product URLs only (``…/p/<digits>``), id = from the first digit on,
    index = running position in discovery order (bigint, 0-based)."""
    src = links.where(tx.is_product_url(url_col)) if only_products else links
    ranked = with_global_rank(src, list(order_cols), "_r")
    return ranked.select(tx.url_digits_tail(url_col).alias("id_producto"), F.col(url_col).alias("url_product"),
                         (F.col("_r") - 1).alias("index"))


def queue_from_sitemap(sitemap: DataFrame, xml_col: str = "xml", key_col: str | None = None) -> DataFrame:
    """Work queue from sitemap documents (``<loc>`` entries in document order)."""
    locs = sitemap_urls(sitemap, xml_col, key_col)
    return queue_from_links(locs, "url", ("doc", "pos"))


def queue_from_sitemap_files(spark: SparkSession, path: str) -> DataFrame:
    """Work queue from stored sitemap documents, whose text is split over tasks (``<loc>`` entries in document order, documents by path)."""
    return queue_from_links(sitemap_file_urls(spark, path), "url", ("doc", "block", "row", "pos"))


def pending(queue: DataFrame, done_upto: int | None = None) -> DataFrame:
    """Queue entries still to process: after the last flushed index."""
    return queue if done_upto is None else dml.delete_where(queue, F.col("index") <= done_upto)


__all__ = ["capture_products", "product_fields", "split_records", "queue_from_links", "queue_from_sitemap", "queue_from_sitemap_files", "pending", "page_links", "REQUIRED"]
