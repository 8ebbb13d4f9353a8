"""Warehouse load: date dimension, product dimension (type 1), daily price
fact and the normalised daily price index, from a snapshot DataFrame.

Each step returns DataFrames (new rows and/or the new table content); nothing
is collected. ``load_warehouse`` chains them in dependency order (facts look
up the updated dimensions).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch import schemas
from shelfwatch.functions.numeric import money_sum, safe_div
from shelfwatch.functions.text import first_category
from shelfwatch.operators import dml
from shelfwatch.operators.keys import assign_ids, last_id
from shelfwatch.operators.latest import latest_per_key
from shelfwatch.session import stage_table

PRODUCT_ATTRS = ["product", "units", "brand", "categories", "categoria", "date"]


def _ts(load_ts) -> Column:
    return dml._ts(load_ts)


def empty(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)


# --- date dimension -----------------------------------------------------------

def new_dates(dataset: DataFrame, date_dim: DataFrame, load_ts=None, start=None) -> DataFrame:
    """Dates of the batch not yet in the dimension, with year, load time and
    consecutive ids (date order) after ``start`` (the last id handed out, e.g.
    ``keys.last_seq``) or, by default, the largest existing id."""
    # both sides are sets, so EXCEPT ALL is a plain (null-safe) anti-join here
    fresh = dml.set_diff(dataset.select("date").where(F.col("date").isNotNull()).distinct(),
                         date_dim.select("date"))
    fresh = fresh.withColumn("year", F.year("date")).withColumn("ts_load", _ts(load_ts))
    first = start if start is not None else last_id(date_dim, "id_date")
    ids = assign_ids(fresh, "id_date", ["date"], start=first)
    return dml.conform(ids, date_dim)


def update_date_dim(dataset: DataFrame, date_dim: DataFrame, load_ts=None) -> DataFrame:
    return date_dim.unionByName(new_dates(dataset, date_dim, load_ts))


# --- product dimension ----------------------------------------------------------

def latest_products(dataset: DataFrame) -> DataFrame:
    """Latest version of every product in the batch plus its first category."""
    cols = ["product_id", "product", "units", "brand", "categories", "date"]
    # a record without product id cannot become a dimension member
    latest = latest_per_key(dataset.select(*cols).where(F.col("product_id").isNotNull()), ["product_id"], ["date"])
    return latest.withColumn("categoria", first_category("categories")).select(
        "product_id", "product", "units", "brand", "categories", "categoria", "date")


def update_product_dim(dataset: DataFrame, product_dim: DataFrame, load_ts=None,
                       only_changed: bool = False, start=None) -> DataFrame:
    """New content of the product dimension: matched products take the latest
    attributes (id kept), unseen products get the next ids (product_id order)
    after ``start`` or the largest existing id."""
    return dml.upsert(product_dim, latest_products(dataset), "product_id", PRODUCT_ATTRS,
                      id_col="id_producto", order_cols=["product_id"], load_ts=load_ts,
                      only_changed=only_changed, start=start)


def changed_products(dataset: DataFrame, product_dim: DataFrame, load_ts=None) -> DataFrame:
    """Batch products already in the dimension whose attributes differ."""
    cols = ["product_id", *PRODUCT_ATTRS, "id_producto"]
    present = latest_products(dataset).join(product_dim.select("product_id", "id_producto").hint("merge"),
                                            "product_id", "inner")
    return dml.changed_rows(present, product_dim, cols, load_ts=load_ts)


# --- fact -------------------------------------------------------------------------

def lookup_keys(dataset: DataFrame, product_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Batch rows with surrogate keys; unmatched products/dates keep null keys
    (they still count in sums, not in ``count(id_producto)``)."""
    prod = latest_per_key(product_dim.select("product_id", "date", "id_producto"),
                          ["product_id"], ["date"]).select("product_id", "id_producto")
    # No hint: the planner broadcasts the date dimension (one row per day)
    # from its size estimate; AQE re-plans with runtime sizes otherwise.
    # The product dimension grows with the data and is not sent through the driver.
    dates = date_dim.select("date", "id_date", "year")
    return (dataset.join(prod.hint("merge"), "product_id", "left")
            .join(dates, "date", "left")
            .select("price", "unit_price", "discount", "id_producto", "id_date", "year"))


def new_facts(dataset: DataFrame, product_dim: DataFrame, date_dim: DataFrame,
              fact: DataFrame, load_ts=None, key=None) -> DataFrame:
    """Facts of the batch not already stored (bag difference, as the original
    loader; ``key`` switches to a keyed anti-join). Only stored years that
    occur in the batch are compared (partition pruning on ``year``)."""
    batch = lookup_keys(dataset, product_dim, date_dim)
    years = batch.select(F.col("year").alias("_y")).distinct()
    # Years of the batch: a handful of rows. Facts without a date are compared too.
    stored = fact.join(F.broadcast(years), fact["year"].eqNullSafe(years["_y"]), "left_semi")
    rows = dml.append_unseen(stored, batch, key=key, load_ts=load_ts,
                             compare_cols=["price", "unit_price", "discount", "id_producto", "id_date", "year"])
    return dml.conform(rows, fact)


def build_fact(dataset: DataFrame, product_dim: DataFrame, date_dim: DataFrame, load_ts=None) -> DataFrame:
    out = lookup_keys(dataset, product_dim, date_dim).withColumn("ts_load", _ts(load_ts))
    return out.select(*[c.name for c in schemas.PRICE_FACT.fields]).select(
        *[F.col(f.name).cast(f.dataType) for f in schemas.PRICE_FACT.fields])


# --- daily index ----------------------------------------------------------------

def daily_totals(fact: DataFrame) -> DataFrame:
    """Per day: price totals (exact sums), number of products (non-null keys) and averages per product."""
    return (fact.groupBy("id_date")
            .agg(money_sum("price").alias("sum_price"),
                 money_sum("unit_price").alias("sum_unit_price"),
                 F.count("id_producto").alias("num_products"))
            .withColumn("sum_price_ponderado", safe_div("sum_price", "num_products"))
            .withColumn("sum_unit_price_ponderado", safe_div("sum_unit_price", "num_products")))


def daily_price_index(fact: DataFrame, load_ts=None) -> DataFrame:
    """Per day: totals and averages (``daily_totals``), and min-max scaling of
    the averages over all days (null when all days are equal)."""
    return scaled_index(daily_totals(fact), load_ts)


def updated_price_index(index: DataFrame, fact: DataFrame, new_facts: DataFrame, load_ts=None) -> DataFrame:
    """The index of ``fact`` and ``new_facts`` together, where ``index`` is that
    of ``fact``: only days with new facts are summed again, from the stored
    years they lie in; then all days are scaled anew. Days that ``index``
    already counts with their new facts come out the same."""
    cols = ["id_date", "id_producto", "price", "unit_price"]
    days = new_facts.select(F.col("id_date").alias("_d")).distinct()
    years = new_facts.select(F.col("year").alias("_y")).distinct()  # a handful of rows
    stored = (fact.join(F.broadcast(years), fact["year"].eqNullSafe(years["_y"]), "left_semi")
              .join(days, F.col("id_date").eqNullSafe(F.col("_d")), "left_semi"))
    untouched = index.join(days, index["id_date"].eqNullSafe(days["_d"]), "left_anti")
    totals = daily_totals(stored.select(*cols).unionByName(new_facts.select(*cols)))
    # one row per day, read for the days and for each of their bounds: summed once
    return scaled_index(stage_table(totals.unionByName(untouched.select(*totals.columns)), "totals"), load_ts)


def scaled_index(daily: DataFrame, load_ts=None) -> DataFrame:
    """The index rows of daily totals."""
    # Global min/max of the daily averages: one-row scalar subqueries over the
    # (one row per day) aggregate.
    bounds = daily.agg(F.min("sum_price_ponderado").alias("lo_p"), F.max("sum_price_ponderado").alias("hi_p"),
                       F.min("sum_unit_price_ponderado").alias("lo_u"),
                       F.max("sum_unit_price_ponderado").alias("hi_u"))
    lo_p, hi_p = bounds.select("lo_p").scalar(), bounds.select("hi_p").scalar()
    lo_u, hi_u = bounds.select("lo_u").scalar(), bounds.select("hi_u").scalar()
    return daily.select(
        "id_date", "sum_price", "sum_unit_price", "num_products", "sum_price_ponderado",
        "sum_unit_price_ponderado",
        safe_div(F.col("sum_price_ponderado") - lo_p, hi_p - lo_p).alias("sum_price_norm"),
        safe_div(F.col("sum_unit_price_ponderado") - lo_u, hi_u - lo_u).alias("sum_unit_price_norm"),
        _ts(load_ts).alias("ts_load"))


# --- whole load -------------------------------------------------------------------

@dataclass
class Warehouse:
    date_dim: DataFrame
    product_dim: DataFrame
    fact: DataFrame
    index: DataFrame | None = None

    @classmethod
    def empty(cls, spark: SparkSession) -> "Warehouse":
        return cls(empty(spark, schemas.DATE_DIM), empty(spark, schemas.PRODUCT_DIM),
                   empty(spark, schemas.PRICE_FACT), empty(spark, schemas.PRICE_INDEX))


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Stage ``df`` as a table in the shared checkpoint folder (``session.stage_table``)."""
    return stage_table(df, name)


def initial_load(dataset: DataFrame, load_ts=None, stage: bool = True) -> Warehouse:
    """First load into an empty warehouse: ids numbered from 1, no comparisons
    against stored rows. With ``stage`` the dimensions are materialised
    (``materialize``) before the fact looks them up, as a loader writing them
    to tables would."""
    ts = _ts(load_ts)
    dates = dataset.select("date").distinct().where(F.col("date").isNotNull())
    date_dim = dml.conform(assign_ids(dates.withColumn("year", F.year("date")).withColumn("ts_load", ts),
                                      "id_date", ["date"]), empty(dataset.sparkSession, schemas.DATE_DIM))
    prods = latest_products(dataset).withColumn("ts_load", ts)
    product_dim = dml.conform(assign_ids(prods, "id_producto", ["product_id"]),
                              empty(dataset.sparkSession, schemas.PRODUCT_DIM))
    if stage:
        date_dim, product_dim = materialize(date_dim, "date_dim"), materialize(product_dim, "product_dim")
    fact = build_fact(dataset, product_dim, date_dim, load_ts)
    return Warehouse(date_dim, product_dim, fact, daily_price_index(fact, load_ts))


def load_warehouse(dataset: DataFrame, wh: Warehouse, load_ts=None) -> Warehouse:
    """Dates, then products, then facts (looking up the updated dimensions),
    then the index over all facts. Returns the new table contents; appending
    only the new fact rows keeps the fact write incremental."""
    date_dim = update_date_dim(dataset, wh.date_dim, load_ts)
    product_dim = update_product_dim(dataset, wh.product_dim, load_ts)
    fact = wh.fact.unionByName(new_facts(dataset, product_dim, date_dim, wh.fact, load_ts))
    return Warehouse(date_dim, product_dim, fact, daily_price_index(fact, load_ts))
