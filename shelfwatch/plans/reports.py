"""Reports: product price history and coverage by date / month / year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def product_history(fact: DataFrame, date_dim: DataFrame, product_dim: DataFrame,
                    where: Column) -> DataFrame:
    """Price, date and product name of the products selected by ``where``
    (a predicate on product-dimension columns, e.g. ``col('product') == 'x'``),
    in date order."""
    prod = product_dim.where(where).select("id_producto", "product")
    dates = date_dim.select("id_date", "date")
    return (fact.select("id_producto", "id_date", "price")
            .join(prod, "id_producto").join(dates, "id_date")
            .select("id_producto", "price", "date", "product")
            .orderBy("date", "id_producto", "price"))


def coverage_by_date(obs: DataFrame, key: str = "product_id", date_col: str = "date",
                     approx: bool = False) -> DataFrame:
    """Per date: distinct products observed and observations."""
    distinct = F.approx_count_distinct(key) if approx else F.count_distinct(key)
    return (obs.where(F.col(date_col).isNotNull())
            .groupBy(date_col)
            .agg(distinct.alias("n_products"), F.count(F.lit(1)).alias("n_obs"))
            .orderBy(date_col))


def coverage_by_month(obs: DataFrame, date_col: str = "date") -> DataFrame:
    """Observations per (year, month), latest first (null dates last)."""
    return (obs.groupBy(F.year(date_col).alias("year"), F.month(date_col).alias("month"))
            .agg(F.count(F.lit(1)).alias("n_obs"))
            .orderBy(F.col("year").desc_nulls_last(), F.col("month").desc_nulls_last()))


def coverage_by_year(obs: DataFrame, date_col: str = "date") -> DataFrame:
    return (obs.groupBy(F.year(date_col).alias("year"))
            .agg(F.count(F.lit(1)).alias("n_obs"))
            .orderBy(F.col("year").desc_nulls_last()))
