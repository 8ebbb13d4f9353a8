"""Registered queries over the benchmark tables and their SQL oracles.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
SQL (DuckDB dialect) computes the same rows independently, usually the way
the original pipeline wrote it (self-join, global ``row_number``, EXCEPT ALL).
Load timestamps are fixed and left out of the compared output.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import LongType, StringType, StructField, StructType

from shelfwatch import schemas
from shelfwatch.operators import dml
from shelfwatch.operators.sequence import sequence_with_previous
from shelfwatch.plans import observations as O
from shelfwatch.plans import reports, variation, warehouse as W
from shelfwatch.session import release_shuffles, scratch_path, stage_table
from shelfwatch.sources import tables as T

LOAD_TS = _dt.datetime(2024, 1, 1, 6, 0, 0)
EXISTING_BEFORE, INCOMING_FROM = "1999-01-01", "1998-01-01"


def _obs(spark: SparkSession, sf: str) -> DataFrame:
    return O.observations(spark, sf)


_LOADED: dict = {}


def _loaded(spark: SparkSession, sf: str, name: str, build):
    """Load once per Spark application and input folder, like a warehouse
    that is loaded by one job and queried by many: the tables are staged as
    parquet in the checkpoint folder and later queries read those files."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _LOADED:
        _LOADED[key] = build()
    return _LOADED[key]


def _fresh(spark: SparkSession, sf: str) -> W.Warehouse:
    def build():
        wh = W.initial_load(_obs(spark, sf), LOAD_TS)
        fact = stage_table(wh.fact, "fact")
        return W.Warehouse(wh.date_dim, wh.product_dim, fact, W.daily_price_index(fact, LOAD_TS))
    return _loaded(spark, sf, "fresh", build)


def _incremental(spark: SparkSession, sf: str):
    """(existing warehouse, incoming batch) for the incremental-load cases."""
    def build():
        existing, incoming = O.split_batches(_obs(spark, sf), EXISTING_BEFORE, INCOMING_FROM)
        wh0 = W.initial_load(existing, LOAD_TS)
        return W.Warehouse(wh0.date_dim, wh0.product_dim, stage_table(wh0.fact, "fact0")), incoming
    return _loaded(spark, sf, "incremental", build)


# --- SQL building blocks ----------------------------------------------------------

CATEGORIA_SQL = r"regexp_extract(categories, '^\[''([^'']*)''', 1)"

OBS_SQL = """obs AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS product_id,
         l.l_extendedprice AS price,
         p.p_name AS product,
         p.p_brand AS brand,
         CASE WHEN CAST(l.l_quantity AS BIGINT) > 0 THEN
           CAST((2 * CAST(floor(l.l_extendedprice * 100 + 0.5) AS BIGINT) + CAST(l.l_quantity AS BIGINT))
                // (2 * CAST(l.l_quantity AS BIGINT)) AS DOUBLE) / CAST(100 AS DOUBLE) END AS unit_price,
         p.p_type AS units,
         '[''' || p.p_type || ''', ''' || p.p_name || ''']' AS categories,
         l.l_discount + CAST(0 AS DOUBLE) AS discount,
         CAST(l.l_shipdate AS DATE) AS date
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)"""


def latest_sql(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT product_id, product, units, brand, categories, date, {CATEGORIA_SQL} AS categoria FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id
                                 ORDER BY date DESC, product, units, brand, categories) AS rn
    FROM {src} WHERE product_id IS NOT NULL) x WHERE rn = 1)"""


def wh_sql(p: str, src: str, product_filter: str = "TRUE") -> str:
    """CTEs of an initial warehouse load from observation CTE ``src``, names
    prefixed with ``p``; ids numbered from 1 in date / product_id order."""
    return f"""{p}date_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY date) AS INTEGER) AS id_date, date,
         CAST(year(date) AS INTEGER) AS year
  FROM (SELECT DISTINCT date FROM {src} WHERE date IS NOT NULL) d),
{latest_sql(p + "latest", src)},
{p}product_dim AS (
  SELECT CAST(row_number() OVER (ORDER BY product_id) AS INTEGER) AS id_producto,
         product, brand, categories, product_id, date, categoria, units
  FROM {p}latest WHERE {product_filter}),
{p}fact AS (
  SELECT pd.id_producto, dd.id_date, o.price, o.unit_price, o.discount, dd.year
  FROM {src} o LEFT JOIN {p}product_dim pd ON pd.product_id = o.product_id
               LEFT JOIN {p}date_dim dd ON dd.date = o.date)"""


WAREHOUSE_SQL = OBS_SQL + ",\n" + wh_sql("", "obs")

# Incremental case: the warehouse holds dates before 1999; the batch starts in 1998.
INCREMENTAL_SQL = OBS_SQL + f""",
existing_obs AS (SELECT * FROM obs WHERE date < DATE '{EXISTING_BEFORE}'),
incoming AS (SELECT * FROM obs WHERE date >= DATE '{INCOMING_FROM}'),
""" + wh_sql("e_", "existing_obs") + """,
new_dates AS (
  SELECT date FROM (SELECT DISTINCT date FROM incoming) n
  EXCEPT ALL SELECT DISTINCT date FROM e_date_dim),
dd1 AS (
  SELECT id_date, date, year FROM e_date_dim
  UNION ALL
  SELECT CAST((SELECT coalesce(max(id_date), 0) FROM e_date_dim) + row_number() OVER (ORDER BY date) AS INTEGER),
         date, CAST(year(date) AS INTEGER) FROM new_dates),
""" + latest_sql("in_latest", "incoming") + """,
pd_upd AS (
  SELECT e.id_producto,
         CASE WHEN n.product_id IS NULL THEN e.product ELSE n.product END AS product,
         CASE WHEN n.product_id IS NULL THEN e.brand ELSE n.brand END AS brand,
         CASE WHEN n.product_id IS NULL THEN e.categories ELSE n.categories END AS categories,
         e.product_id,
         CASE WHEN n.product_id IS NULL THEN e.date ELSE n.date END AS date,
         CASE WHEN n.product_id IS NULL THEN e.categoria ELSE n.categoria END AS categoria,
         CASE WHEN n.product_id IS NULL THEN e.units ELSE n.units END AS units
  FROM e_product_dim e LEFT JOIN in_latest n ON n.product_id = e.product_id),
pd_ins AS (
  SELECT CAST((SELECT coalesce(max(id_producto), 0) FROM e_product_dim)
              + row_number() OVER (ORDER BY product_id) AS INTEGER) AS id_producto,
         product, brand, categories, product_id, date, categoria, units
  FROM in_latest n WHERE NOT EXISTS (SELECT 1 FROM e_product_dim e WHERE e.product_id = n.product_id)),
pd1 AS (SELECT * FROM pd_upd UNION ALL SELECT * FROM pd_ins),
batch_fact AS (
  SELECT pd.id_producto, dd.id_date, o.price, o.unit_price, o.discount, dd.year
  FROM incoming o LEFT JOIN pd1 pd ON pd.product_id = o.product_id
                  LEFT JOIN dd1 dd ON dd.date = o.date)"""

def variation_sql(unit_price: str = "f.unit_price") -> str:
    """CTE ``variacion``: each observation with the one before it (window functions);
    the ratio is rounded half up as it prints."""
    return WAREHOUSE_SQL + f""",
priced AS (
  SELECT f.id_producto, pd.product, dd.date, {unit_price} AS unit_price
  FROM fact f JOIN product_dim pd ON pd.id_producto = f.id_producto JOIN date_dim dd ON dd.id_date = f.id_date),
placed AS (
  SELECT *, row_number() OVER w AS place, lag(unit_price) OVER w AS earlier
  FROM priced WINDOW w AS (PARTITION BY id_producto ORDER BY date, unit_price, product)),
variacion AS (
  SELECT id_producto, product, date, unit_price, CAST(place AS INTEGER) AS num,
         CASE WHEN place > 1 THEN CAST(place - 1 AS INTEGER) END AS num2, unit_price - earlier AS variacion,
         CASE WHEN earlier <> 0 THEN
           CAST((round(CAST(CAST(unit_price / earlier AS VARCHAR) AS DECIMAL(38, 18)), 2) - 1) * 100 AS DOUBLE) END AS por_variacion
  FROM placed)"""


VARIATION_SQL = variation_sql()


def index_sql(fact: str) -> str:
    return f"""daily AS (
  SELECT id_date,
         CAST(CAST(sum(CAST(CAST(price AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE) AS sum_price,
         CAST(CAST(sum(CAST(CAST(unit_price AS VARCHAR) AS DECIMAL(28, 10))) AS VARCHAR) AS DOUBLE) AS sum_unit_price,
         count(id_producto) AS num_products
  FROM {fact} GROUP BY id_date),
pond AS (
  SELECT *, CASE WHEN num_products = 0 THEN NULL ELSE sum_price / num_products END AS sum_price_ponderado,
            CASE WHEN num_products = 0 THEN NULL ELSE sum_unit_price / num_products END AS sum_unit_price_ponderado
  FROM daily),
b AS (SELECT min(sum_price_ponderado) lo_p, max(sum_price_ponderado) hi_p,
             min(sum_unit_price_ponderado) lo_u, max(sum_unit_price_ponderado) hi_u FROM pond)
SELECT id_date, sum_price, sum_unit_price, num_products, sum_price_ponderado, sum_unit_price_ponderado,
       CASE WHEN hi_p - lo_p = 0 THEN NULL ELSE (sum_price_ponderado - lo_p) / (hi_p - lo_p) END AS sum_price_norm,
       CASE WHEN hi_u - lo_u = 0 THEN NULL ELSE (sum_unit_price_ponderado - lo_u) / (hi_u - lo_u) END AS sum_unit_price_norm
FROM pond, b"""


FACT_COLS = "id_producto, id_date, price, unit_price, discount, year"

# --- queries: warehouse and variation ----------------------------------------------


def q_price_variation(spark, sf):
    wh = _fresh(spark, sf)
    return variation.price_variation(wh.fact, wh.product_dim, wh.date_dim)


def q_price_variation_latest(spark, sf):
    wh = _fresh(spark, sf)
    return variation.price_variation(wh.fact, wh.product_dim, wh.date_dim,
                                     latest_only=True, changes_only=True)


def q_price_index_daily(spark, sf):
    return _fresh(spark, sf).index.drop("ts_load")


def q_price_index_with_missing_keys(spark, sf):
    """Facts looked up against a product dimension lacking the ECONOMY
    products: their facts keep a null product key, count in the sums but
    not in ``num_products``."""
    obs = _obs(spark, sf)
    wh = _fresh(spark, sf)
    partial_dim = wh.product_dim.where(F.col("units") != "ECONOMY")
    fact = W.build_fact(obs, partial_dim, wh.date_dim, LOAD_TS)
    return W.daily_price_index(fact, LOAD_TS).drop("ts_load")


def q_date_dim_new(spark, sf):
    wh0, incoming = _incremental(spark, sf)
    return W.update_date_dim(incoming, wh0.date_dim, LOAD_TS).drop("ts_load")


def q_product_latest(spark, sf):
    return W.latest_products(_obs(spark, sf))


def q_product_dim_upsert(spark, sf):
    wh0, incoming = _incremental(spark, sf)
    return W.update_product_dim(incoming, wh0.product_dim, LOAD_TS).drop("ts_load")


def q_product_dim_changed(spark, sf):
    wh0, incoming = _incremental(spark, sf)
    return W.changed_products(incoming, wh0.product_dim, LOAD_TS).drop("ts_load")


def _updated_dims(spark, sf, wh0: W.Warehouse, incoming: DataFrame):
    return _loaded(spark, sf, "updated_dims", lambda: (
        W.materialize(W.update_product_dim(incoming, wh0.product_dim, LOAD_TS), "product_dim1"),
        W.materialize(W.update_date_dim(incoming, wh0.date_dim, LOAD_TS), "date_dim1")))


def q_price_fact_new(spark, sf):
    wh0, incoming = _incremental(spark, sf)
    pd1, dd1 = _updated_dims(spark, sf, wh0, incoming)
    return W.new_facts(incoming, pd1, dd1, wh0.fact, LOAD_TS).drop("ts_load")


def q_fact_reload_partition(spark, sf):
    """Store the existing facts partitioned by year, reload the batch's years
    by dynamic partition overwrite, read the table back."""
    wh0, incoming = _incremental(spark, sf)
    pd1, dd1 = _updated_dims(spark, sf, wh0, incoming)
    path = scratch_path(spark, "fact")
    T.write_table(wh0.fact, path, "overwrite", partition_by=["year"], skip_empty=False)
    batch = W.build_fact(incoming, pd1, dd1, LOAD_TS)
    T.overwrite_partitions(batch, path, ["year"])
    return spark.read.parquet(path).drop("ts_load")


def q_delete_where(spark, sf):
    return dml.delete_where(_obs(spark, sf), F.col("discount") == 0.0)


def q_update_where(spark, sf):
    return dml.update_where(_obs(spark, sf), F.col("brand") == "Brand#13", {"discount": 0.25})


def q_product_history(spark, sf):
    wh = _fresh(spark, sf)
    return reports.product_history(wh.fact, wh.date_dim, wh.product_dim,
                                   F.col("product") == "red widget")


def q_history_preview(spark, sf):
    """The first ten rows of the product price history (the notebook's
    ``show(10)``): a top-k report, the limit is the feature."""
    from shelfwatch.operators.quality import preview
    return preview(q_product_history(spark, sf), 10, ["date", "id_producto", "price"])


def q_coverage_by_date(spark, sf):
    return reports.coverage_by_date(_obs(spark, sf))


def q_coverage_by_month(spark, sf):
    return reports.coverage_by_month(_obs(spark, sf))


def q_coverage_by_year(spark, sf):
    return reports.coverage_by_year(_obs(spark, sf))


QUERIES = {
    "price_variation": q_price_variation,
    "price_variation_latest": q_price_variation_latest,
    "price_index_daily": q_price_index_daily,
    "price_index_with_missing_keys": q_price_index_with_missing_keys,
    "date_dim_new": q_date_dim_new,
    "product_latest": q_product_latest,
    "product_dim_upsert": q_product_dim_upsert,
    "product_dim_changed": q_product_dim_changed,
    "price_fact_new": q_price_fact_new,
    "fact_reload_partition": q_fact_reload_partition,
    "delete_where": q_delete_where,
    "update_where": q_update_where,
    "product_history": q_product_history,
    "history_preview": q_history_preview,
    "coverage_by_date": q_coverage_by_date,
    "coverage_by_month": q_coverage_by_month,
    "coverage_by_year": q_coverage_by_year,
}

OBS_COLS = "product_id, price, product, brand, unit_price, units, categories, discount, date"

ORACLE = {
    "price_variation": "WITH " + VARIATION_SQL + "\nSELECT * FROM variacion ORDER BY id_producto, num",
    "price_variation_latest": "WITH " + VARIATION_SQL + """
SELECT * FROM variacion
WHERE date = (SELECT max(date) FROM variacion)
  AND variacion IS NOT NULL AND variacion != 0
ORDER BY id_producto, num""",
    "price_index_daily": "WITH " + WAREHOUSE_SQL + ",\n" + index_sql("fact"),
    "price_index_with_missing_keys": "WITH " + OBS_SQL + ",\n" + wh_sql("", "obs", "units != 'ECONOMY'")
    + ",\n" + index_sql("fact"),
    "date_dim_new": "WITH " + INCREMENTAL_SQL + "\nSELECT * FROM dd1",
    "product_latest": "WITH " + OBS_SQL + ",\n" + latest_sql("l", "obs") + "\nSELECT * FROM l",
    "product_dim_upsert": "WITH " + INCREMENTAL_SQL + "\nSELECT * FROM pd1",
    "product_dim_changed": "WITH " + INCREMENTAL_SQL + """
SELECT n.product_id, n.product, n.units, n.brand, n.categories, n.categoria, n.date, e.id_producto
FROM in_latest n JOIN e_product_dim e ON e.product_id = n.product_id
EXCEPT ALL
SELECT product_id, product, units, brand, categories, categoria, date, id_producto FROM e_product_dim""",
    "price_fact_new": "WITH " + INCREMENTAL_SQL + f"""
SELECT {FACT_COLS} FROM batch_fact
EXCEPT ALL
SELECT {FACT_COLS} FROM e_fact WHERE year IN (SELECT DISTINCT year FROM batch_fact)""",
    "fact_reload_partition": "WITH " + INCREMENTAL_SQL + f"""
SELECT {FACT_COLS} FROM e_fact
WHERE NOT EXISTS (SELECT 1 FROM batch_fact b WHERE b.year = e_fact.year)
UNION ALL
SELECT {FACT_COLS} FROM batch_fact""",
    "delete_where": "WITH " + OBS_SQL + f"\nSELECT {OBS_COLS} FROM obs WHERE NOT coalesce(discount = 0.0, false)",
    "update_where": "WITH " + OBS_SQL + """
SELECT product_id, price, product, brand, unit_price, units, categories,
       CASE WHEN coalesce(brand = 'Brand#13', false) THEN CAST(0.25 AS DOUBLE) ELSE discount END AS discount,
       date
FROM obs""",
    "product_history": "WITH " + WAREHOUSE_SQL + """
SELECT f.id_producto, f.price, dd.date, pd.product
FROM fact f JOIN product_dim pd ON pd.id_producto = f.id_producto
            JOIN date_dim dd ON dd.id_date = f.id_date
WHERE pd.product = 'red widget'
ORDER BY dd.date, f.id_producto, f.price""",
    "history_preview": "WITH " + WAREHOUSE_SQL + """
SELECT f.id_producto, f.price, dd.date, pd.product
FROM fact f JOIN product_dim pd ON pd.id_producto = f.id_producto
            JOIN date_dim dd ON dd.id_date = f.id_date
WHERE pd.product = 'red widget'
ORDER BY dd.date, f.id_producto, f.price, pd.product
LIMIT 10""",
    "coverage_by_date": "WITH " + OBS_SQL + """
SELECT date, count(DISTINCT product_id) AS n_products, count(*) AS n_obs
FROM obs WHERE date IS NOT NULL GROUP BY date ORDER BY date""",
    "coverage_by_month": "WITH " + OBS_SQL + """
SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n_obs
FROM obs GROUP BY 1, 2 ORDER BY 1 DESC NULLS LAST, 2 DESC NULLS LAST""",
    "coverage_by_year": "WITH " + OBS_SQL + """
SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS n_obs
FROM obs GROUP BY 1 ORDER BY 1 DESC NULLS LAST""",
}


# --- quality and statistics ---------------------------------------------------------

from shelfwatch.operators import quality as Qy, stats as St  # noqa: E402
from shelfwatch.plans import migration  # noqa: E402

DIGITS = 6


def _round_all(df: DataFrame, cols, digits: int = DIGITS) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def q_duplicates_by_key(spark, sf):
    return Qy.duplicate_keys(_obs(spark, sf), ["product_id", "date"])


def q_duplicate_rows(spark, sf):
    return Qy.rows_with_duplicate_keys(_obs(spark, sf), ["product_id", "date"])


def q_profile_nulls(spark, sf):
    return Qy.profile_columns(_obs(spark, sf))


def q_describe_numeric(spark, sf):
    return St.describe_numeric(_obs(spark, sf), ["price", "unit_price", "discount"], digits=DIGITS,
                              decimal_scale=2)


def q_describe_mixed(spark, sf):
    return Qy.describe_categorical(_obs(spark, sf), ["product_id", "product", "brand", "units", "categories"])


def q_quantiles_iqr(spark, sf):
    f = St.iqr_fences(_obs(spark, sf), "unit_price")
    return _round_all(f, [c for c in f.columns if c != "n"])


def q_outliers_far(spark, sf):
    return St.outliers_above(_obs(spark, sf), "unit_price")


def q_boxplot_whiskers(spark, sf):
    return _round_all(St.boxplot_whiskers(_obs(spark, sf), "unit_price"), ["q1", "median", "q3"])


def _trimmed(spark, sf):
    """The cleaned series (rows at most q3 + 3·IQR of unit price), staged once
    per session: the outlier report describes it and tests it for normality."""
    return _loaded(spark, sf, "trimmed", lambda: St.trimmed(_obs(spark, sf), "unit_price", stage=True))


def q_trimmed_describe(spark, sf):
    return St.describe_numeric(_trimmed(spark, sf), ["unit_price"], digits=DIGITS,
                              decimal_scale=2)


def q_histogram_obs_per_product(spark, sf):
    per = _obs(spark, sf).groupBy("product_id").agg(F.count(F.lit(1)).alias("n_obs"))
    return St.histogram(per, "n_obs", 10)


def q_density_price(spark, sf):
    d = St.density(_obs(spark, sf), "price", 1000)
    return d.select("i", F.round("x", DIGITS).alias("x"), F.round("density", 15).alias("density"))


def q_normality_price(spark, sf):
    return St.normality_test(_trimmed(spark, sf), "unit_price", digits=DIGITS)


def q_ids_concat(spark, sf):
    return Qy.ids_concat(_obs(spark, sf), "date", "product_id")


def q_migration_cleanup(spark, sf):
    return migration.clean_history(_obs(spark, sf), LOAD_TS).drop("ts_load")


QUERIES.update({
    "duplicates_by_key": q_duplicates_by_key,
    "duplicate_rows": q_duplicate_rows,
    "profile_nulls": q_profile_nulls,
    "describe_numeric": q_describe_numeric,
    "describe_mixed": q_describe_mixed,
    "quantiles_iqr": q_quantiles_iqr,
    "outliers_far": q_outliers_far,
    "boxplot_whiskers": q_boxplot_whiskers,
    "trimmed_describe": q_trimmed_describe,
    "histogram_obs_per_product": q_histogram_obs_per_product,
    "density_price": q_density_price,
    "normality_price": q_normality_price,
    "ids_concat": q_ids_concat,
    "migration_cleanup": q_migration_cleanup,
})


def _describe_sql(src: str, cols) -> str:
    parts = []
    for c in cols:
        # mean of cent values, rounded half up to 6 decimals in integer arithmetic
        mean = (f"CAST((20000 * sum(CAST(round({c} * 100) AS BIGINT)) + count({c})) // (2 * count({c})) AS DOUBLE)"
                " / CAST(1000000 AS DOUBLE)")
        parts.append(f"""SELECT '{c}' AS "column", count({c}) AS count, {mean} AS mean,
       round(stddev_samp({c}), {DIGITS}) AS std, min({c}) AS min,
       round(quantile_cont({c}, 0.25), {DIGITS}) AS q25, round(quantile_cont({c}, 0.5), {DIGITS}) AS q50,
       round(quantile_cont({c}, 0.75), {DIGITS}) AS q75, max({c}) AS max FROM {src}""")
    return "\nUNION ALL\n".join(parts)


FENCES_SQL = """fences AS (
  SELECT count(unit_price) AS n, quantile_cont(unit_price, 0.25) AS q1, quantile_cont(unit_price, 0.5) AS median,
         quantile_cont(unit_price, 0.75) AS q3
  FROM obs WHERE unit_price IS NOT NULL),
f2 AS (SELECT *, q3 - q1 AS iqr, q3 + 3.0 * (q3 - q1) AS far_out,
              q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM fences)"""

_PROFILE_TYPES = [("product_id", "string"), ("price", "double"), ("product", "string"), ("brand", "string"),
                  ("unit_price", "double"), ("units", "string"), ("categories", "string"),
                  ("discount", "double"), ("date", "date")]
_MIXED = ["product_id", "product", "brand", "units", "categories"]

NORMALITY_SQL = OBS_SQL + ",\n" + FENCES_SQL + """,
t AS (SELECT unit_price AS v FROM obs, f2 WHERE unit_price <= far_out),
mu AS (SELECT CAST(count(v) AS DOUBLE) AS n, avg(v) AS mu FROM t),
mom AS (SELECT n, avg(power(v - mu, 2)) AS m2, avg(power(v - mu, 3)) AS m3, avg(power(v - mu, 4)) AS m4
        FROM t, mu GROUP BY n),
g AS (SELECT n, m3 / power(m2, 1.5) AS g1, m4 / (m2 * m2) AS b2 FROM mom),
sk AS (SELECT *, g1 * sqrt(((n + 1) * (n + 3)) / (6.0 * (n - 2))) AS y0,
              (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9)) AS beta2
       FROM g),
sk2 AS (SELECT *, -1 + sqrt(2 * (beta2 - 1)) AS w2 FROM sk),
sk3 AS (SELECT *, 1 / sqrt(0.5 * ln(w2)) AS delta, sqrt(2.0 / (w2 - 1)) AS alpha,
               CASE WHEN y0 = 0 THEN 1.0 ELSE y0 END AS y FROM sk2),
ku AS (SELECT *, delta * ln(y / alpha + sqrt(power(y / alpha, 2) + 1)) AS z_skew,
              3.0 * (n - 1) / (n + 1) AS e,
              24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5)) AS varb2,
              6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
                * sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3))) AS sb1
       FROM sk3),
ku2 AS (SELECT *, (b2 - e) / sqrt(varb2) AS xk,
               6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / power(sb1, 2))) AS a FROM ku),
ku3 AS (SELECT *, 1 - 2 / (9.0 * a) AS term1, 1 + xk * sqrt(2 / (a - 4.0)) AS denom FROM ku2),
ku4 AS (SELECT *, CASE WHEN denom = 0 THEN 'NaN'::DOUBLE
                       ELSE sign(denom) * power((1 - 2.0 / a) / abs(denom), 1 / 3.0) END AS term2 FROM ku3),
res AS (SELECT CAST(n AS BIGINT) AS n, g1 AS skew, b2 AS kurtosis, z_skew,
               (term1 - term2) / sqrt(2 / (9.0 * a)) AS z_kurt FROM ku4)
SELECT n, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis, round(z_skew, 6) AS z_skew,
       round(z_kurt, 6) AS z_kurt, round(power(z_skew, 2) + power(z_kurt, 2), 6) AS k2,
       round(exp(-(power(z_skew, 2) + power(z_kurt, 2)) / 2), 6) AS p_value
FROM res"""

ORACLE.update({
    "duplicates_by_key": "WITH " + OBS_SQL + """
SELECT product_id, date, count(*) AS n FROM obs
WHERE product_id IS NOT NULL AND date IS NOT NULL GROUP BY product_id, date HAVING count(*) >= 2""",
    "duplicate_rows": "WITH " + OBS_SQL + f""",
d AS (SELECT product_id, date FROM obs WHERE product_id IS NOT NULL AND date IS NOT NULL
      GROUP BY product_id, date HAVING count(*) >= 2)
SELECT {OBS_COLS} FROM obs o
WHERE EXISTS (SELECT 1 FROM d WHERE d.product_id = o.product_id AND d.date = o.date)
ORDER BY product_id, date""",
    "profile_nulls": "WITH " + OBS_SQL + "\n" + "\nUNION ALL\n".join(
        f"""SELECT '{c}' AS "column", '{t}' AS dtype, count(*) AS n_rows, count({c}) AS n_non_null,
       count(*) - count({c}) AS n_null FROM obs""" for c, t in _PROFILE_TYPES),
    "describe_numeric": "WITH " + OBS_SQL + "\n" + _describe_sql("obs", ["price", "unit_price", "discount"]),
    "describe_mixed": "WITH " + OBS_SQL + """,
pairs AS (""" + "\nUNION ALL\n".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM obs" for c in _MIXED) + """),
counts AS (SELECT col, value, count(*) AS cnt FROM pairs WHERE value IS NOT NULL GROUP BY col, value),
ranked AS (SELECT *, row_number() OVER (PARTITION BY col ORDER BY cnt DESC, value) AS rn FROM counts)
SELECT col AS "column", CAST(sum(cnt) AS BIGINT) AS count, count(*) AS "unique",
       max(CASE WHEN rn = 1 THEN value END) AS top, max(CASE WHEN rn = 1 THEN cnt END) AS freq
FROM ranked GROUP BY col""",
    "quantiles_iqr": "WITH " + OBS_SQL + ",\n" + FENCES_SQL + """
SELECT n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
       round(far_out, 6) AS far_out, round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence
FROM f2""",
    "outliers_far": "WITH " + OBS_SQL + ",\n" + FENCES_SQL + f"""
SELECT {OBS_COLS} FROM obs, f2 WHERE unit_price > far_out ORDER BY unit_price""",
    "boxplot_whiskers": "WITH " + OBS_SQL + ",\n" + FENCES_SQL + """
SELECT round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       min(CASE WHEN unit_price >= lower_fence THEN unit_price END) AS whisker_low,
       max(CASE WHEN unit_price <= upper_fence THEN unit_price END) AS whisker_high,
       count(CASE WHEN unit_price < lower_fence THEN 1 END) AS n_below,
       count(CASE WHEN unit_price > upper_fence THEN 1 END) AS n_above
FROM obs, f2 WHERE unit_price IS NOT NULL GROUP BY q1, median, q3""",
    "trimmed_describe": "WITH " + OBS_SQL + ",\n" + FENCES_SQL + """,
t AS (SELECT obs.* FROM obs, f2 WHERE unit_price <= far_out)
""" + _describe_sql("t", ["unit_price"]),
    "histogram_obs_per_product": "WITH " + OBS_SQL + """,
c AS (SELECT product_id, CAST(count(*) AS DOUBLE) AS v FROM obs GROUP BY product_id),
mm AS (SELECT min(v) AS lo0, max(v) AS hi0 FROM c),
p AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo,
             CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM mm),
p2 AS (SELECT lo, hi, (hi - lo) / CAST(10 AS DOUBLE) AS step FROM p),
b0 AS (SELECT v, lo, hi, step, least(greatest(CAST(floor((v - lo) / step) AS BIGINT), 0), 9) AS b0 FROM c, p2),
b1 AS (SELECT *, CASE WHEN v < (CASE WHEN b0 = 10 THEN hi ELSE b0 * step + lo END) THEN b0 - 1 ELSE b0 END AS b1 FROM b0),
b2 AS (SELECT CASE WHEN b1 < 9 AND v >= (CASE WHEN b1 + 1 = 10 THEN hi ELSE (b1 + 1) * step + lo END)
                   THEN b1 + 1 ELSE b1 END AS bin FROM b1),
cnt AS (SELECT bin, count(*) AS n FROM b2 GROUP BY bin),
grid AS (SELECT CAST(i AS BIGINT) AS bin, lo, hi, step FROM generate_series(0, 9) t(i), p2)
SELECT CAST(g.bin AS INTEGER) AS bin,
       CASE WHEN g.bin = 10 THEN hi ELSE g.bin * step + lo END AS lower,
       CASE WHEN g.bin + 1 = 10 THEN hi ELSE (g.bin + 1) * step + lo END AS upper,
       coalesce(cnt.n, 0) AS n
FROM grid g LEFT JOIN cnt ON cnt.bin = g.bin""",
    "density_price": "WITH " + OBS_SQL + """,
vals AS (SELECT price AS v FROM obs WHERE price IS NOT NULL),
st AS (SELECT count(*) AS n, stddev_samp(v) AS sd, min(v) AS mn, max(v) AS mx FROM vals),
p AS (SELECT n, sd * pow(CAST(n AS DOUBLE), -0.2) AS bw, mn - (mx - mn) * 0.5 AS lo, mx + (mx - mn) * 0.5 AS hi FROM st),
g AS (SELECT CAST(i AS INTEGER) AS i,
             CASE WHEN i = 999 THEN hi ELSE i * ((hi - lo) / CAST(999 AS DOUBLE)) + lo END AS x
      FROM generate_series(0, 999) t(i), p)
SELECT g.i, round(g.x, 6) AS x,
       round(sum(exp(-0.5 * ((g.x - vals.v) / p.bw) * ((g.x - vals.v) / p.bw))) / (p.n * p.bw * sqrt(2 * pi())), 15) AS density
FROM g, vals, p GROUP BY g.i, g.x, p.n, p.bw""",
    "normality_price": "WITH " + NORMALITY_SQL,
    "ids_concat": "WITH " + OBS_SQL + """
SELECT date, string_agg(DISTINCT product_id, ',' ORDER BY product_id) AS ids
FROM obs WHERE product_id IS NOT NULL GROUP BY date""",
    "migration_cleanup": "WITH " + OBS_SQL + f"""
SELECT DISTINCT {OBS_COLS} FROM obs WHERE product IS NOT NULL AND price IS NOT NULL""",
})


# --- pages, files, export, streaming ------------------------------------------------

from shelfwatch.functions import text as tx  # noqa: E402
from shelfwatch.plans import capture, etl  # noqa: E402
from shelfwatch.sources import export as X, pages as Pg, snapshots as Sn  # noqa: E402
from shelfwatch.streaming.ingest import ingest_pages, ingested  # noqa: E402

RUN_DATE = "2024-01-01"


def _pages(spark, sf):
    return O.read_table(spark, sf, "pages")


def q_page_product_fields(spark, sf):
    return Pg.extract_fields(_pages(spark, sf), Pg.GENERIC_RULES, run_date=RUN_DATE)


def q_page_rejects(spark, sf):
    _, bad = capture.capture_products(_pages(spark, sf), Pg.GENERIC_RULES, run_date=RUN_DATE, load_ts=LOAD_TS)
    return bad.drop("ts_load")


def q_page_list(spark, sf):
    return capture.queue_from_links(Pg.page_links(_pages(spark, sf)), only_products=False)


def q_url_ids(spark, sf):
    return _pages(spark, sf).select("page_id", "url", tx.url_last_segment("url").alias("product_id"),
                                    tx.url_digits_tail("url").alias("product_id_digits"),
                                    tx.is_product_url("url").alias("is_product_url"))


def q_export_decimal_comma(spark, sf):
    return X.decimal_comma(_fresh(spark, sf).fact.drop("ts_load"), 2)


def q_csv_snapshot_roundtrip(spark, sf):
    """Write the observations as monthly snapshot folders of ``;`` CSV, read
    them back by header name."""
    path = scratch_path(spark, "snapshots")
    Sn.write_snapshots(_obs(spark, sf), path, F.date_format("date", "yyyyMM"))
    return Sn.read_snapshots(spark, path, "*.csv", strip=True)


def q_ingest_available_now(spark, sf):
    """Pages split into files by id range, ingested by the file stream in
    one-file micro-batches; records and rejects read back."""
    src = scratch_path(spark, "pages-in")
    _pages(spark, sf).repartitionByRange(4, "page_id").write.parquet(src)
    rec, rej, ck = (scratch_path(spark, n) for n in ("records", "rejects", "ingest-ckpt"))
    ingest_pages(spark, src, rec, rej, ck, RUN_DATE, Pg.GENERIC_RULES, 1, LOAD_TS)
    # a second run with the same checkpoint finds nothing new
    ingest_pages(spark, src, rec, rej, ck, RUN_DATE, Pg.GENERIC_RULES, 1, LOAD_TS)
    return _ingested(spark, rec, rej)


def _ingested(spark, rec, rej):
    """Records and rejects read back, rejects with their reason."""
    record = StructType([StructField("page_id", LongType()), *schemas.PRODUCT_RECORD.fields])
    reject = StructType([*record.fields, StructField("reject_reason", StringType())])
    ok = ingested(spark, rec, record).withColumn("reject_reason", F.lit(None).cast("string"))
    return ok.unionByName(ingested(spark, rej, reject)).drop("ts_load")


def _etl_run(spark, sf):
    """Snapshots on storage → load job twice (the second run adds nothing),
    with a decimal-comma CSV export; loaded once per session and input. The
    export, as large as the snapshots, comes last: it isn't on the disk while
    the loads shuffle."""
    def build():
        snaps, base, out = (scratch_path(spark, n) for n in ("wh-snap", "wh", "wh-export"))
        Sn.write_snapshots(_obs(spark, sf), snaps, F.date_format("date", "yyyy"))
        release_shuffles(spark)
        etl.create_warehouse(spark, base, LOAD_TS)
        etl.run(spark, snaps, base, None, LOAD_TS)
        etl.run(spark, snaps, base, out, LOAD_TS)
        return base
    return _loaded(spark, sf, "etl", build)


def q_warehouse_reload_idempotent(spark, sf):
    return etl.open_warehouse(spark, _etl_run(spark, sf)).fact.drop("ts_load")


def q_sequences_after_load(spark, sf):
    return etl.sequences(spark, _etl_run(spark, sf)).drop("ts_load")


QUERIES.update({
    "page_product_fields": q_page_product_fields,
    "page_rejects": q_page_rejects,
    "page_list": q_page_list,
    "url_ids": q_url_ids,
    "export_decimal_comma": q_export_decimal_comma,
    "csv_snapshot_roundtrip": q_csv_snapshot_roundtrip,
    "ingest_available_now": q_ingest_available_now,
    "warehouse_reload_idempotent": q_warehouse_reload_idempotent,
    "sequences_after_load": q_sequences_after_load,
})


def _lit(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def _sql_html_text(x: str) -> str:
    c = f"regexp_replace({x}, '<[^>]*>', '', 'g')"
    for ent, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                    ("&nbsp;", "\u00a0"), ("&#160;", "\u00a0"), ("&euro;", "€"), ("&#8364;", "€"),
                    ("&amp;", "&")):
        c = f"replace({c}, {_lit(ent)}, {_lit(ch)})"
    return c


def _sql_trim_all(x: str) -> str:
    return f"regexp_replace({x}, {_lit(r'^[\s\p{Z}]+|[\s\p{Z}]+$')}, '', 'g')"


def _sql_clean(x: str) -> str:
    return _sql_trim_all(f"replace(regexp_replace({x}, {_lit(r'[\r\n\t]')}, '', 'g'), ',', '.')")


def _sql_elements(html: str, rule) -> str:
    scope = html
    if len(rule) > 2 and rule[2]:
        scope = f"coalesce(regexp_extract_all({html}, {_lit(tx.element_pattern(rule[2]))}, 1)[1], '')"
    return f"list_transform(regexp_extract_all({scope}, {_lit(tx.element_pattern(rule[0], rule[1]))}, 1), lambda x: {_sql_html_text('x')})"


def _sql_first(html: str, rule) -> str:
    return f"({_sql_elements(html, rule)})[1]"


def _sql_price(x: str) -> str:
    m = f"regexp_replace(nullif(regexp_extract({x}, {_lit(tx.PRICE_PATTERN)}, 0), ''), '\\.', '', 'g')"
    return f"TRY_CAST(replace({m}, ',', '.') AS DOUBLE)"


def _sql_quote(x: str) -> str:
    return (f"CASE WHEN contains({x}, '''') AND NOT contains({x}, '\"') THEN '\"' || {x} || '\"' "
            f"ELSE '''' || replace(replace({x}, '\\', '\\\\'), '''', '\\''') || '''' END")


def _fields_sql(rules) -> str:
    title = _sql_first("html", rules.title)
    unit = _sql_first("html", rules.unit_price)
    crumbs = f"list_transform({_sql_elements('html', rules.categories)}, lambda y: {_sql_clean('y')})"
    return f"""fields AS (
  SELECT page_id, url,
         nullif(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '') AS product_id,
         {_sql_clean(title)} AS product,
         regexp_extract_all({_sql_clean(title)}, {_lit(tx.BRAND_PATTERN)})[2] AS brand,
         {_sql_price(_sql_first('html', rules.price))} AS price,
         CASE WHEN len({crumbs}) > 0 THEN
           '[' || array_to_string(list_transform({crumbs}, lambda z: {_sql_quote('z')}), ', ') || ']' END AS categories,
         {_sql_price(unit)} AS unit_price,
         nullif({_sql_trim_all(f"regexp_extract({unit}, {_lit(tx.UNIT_LABEL_PATTERN)}, 0)")}, '') AS units,
         TRY_CAST(nullif(regexp_extract({_sql_first('html', rules.discount)}, {_lit(tx.DISCOUNT_PATTERN)}, 1), '')
                  AS DOUBLE) AS discount,
         DATE '{RUN_DATE}' AS date
  FROM pages)"""


REJECT_SQL = """nullif(concat_ws(',', CASE WHEN price IS NULL THEN 'price' END, CASE WHEN product IS NULL THEN 'product' END,
       CASE WHEN brand IS NULL THEN 'brand' END, CASE WHEN unit_price IS NULL THEN 'unit_price' END,
       CASE WHEN units IS NULL THEN 'units' END), '')"""
RECORD_SQL = "page_id, product, product_id, brand, price, categories, unit_price, units, discount, date"
LINKS_SQL = f"""links AS (
  SELECT page_id, unnest(l) AS href, unnest(range(len(l))) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, {_lit(Pg.LINK_PATTERN)}, 1) AS l FROM pages) t)"""

ORACLE.update({
    "page_product_fields": "WITH " + _fields_sql(Pg.GENERIC_RULES) + "\nSELECT * FROM fields",
    "page_rejects": "WITH " + _fields_sql(Pg.GENERIC_RULES) + f"""
SELECT {RECORD_SQL}, {REJECT_SQL} AS reject_reason FROM fields WHERE {REJECT_SQL} IS NOT NULL""",
    "page_list": "WITH " + LINKS_SQL + """
SELECT nullif(regexp_extract(href, '\\d.*', 0), '') AS id_producto, href AS url_product,
       row_number() OVER (ORDER BY page_id, pos) - 1 AS "index"
FROM links""",
    "url_ids": """SELECT page_id, url,
       nullif(string_split(regexp_replace(url, '[?#].*$', ''), '/')[-1], '') AS product_id,
       nullif(regexp_extract(url, '\\d.*', 0), '') AS product_id_digits,
       coalesce(regexp_matches(url, '.+/p/\\d+'), false) AS is_product_url
FROM pages""",
    "export_decimal_comma": "WITH " + WAREHOUSE_SQL + """
SELECT id_producto, id_date,
       replace(CAST(CAST(price AS DECIMAL(38,2)) AS VARCHAR), '.', ',') AS price,
       replace(CAST(CAST(unit_price AS DECIMAL(38,2)) AS VARCHAR), '.', ',') AS unit_price,
       replace(CAST(CAST(discount AS DECIMAL(38,2)) AS VARCHAR), '.', ',') AS discount,
       year
FROM fact""",
    "csv_snapshot_roundtrip": "WITH " + OBS_SQL + f"\nSELECT {OBS_COLS} FROM obs",
    "ingest_available_now": "WITH " + _fields_sql(Pg.GENERIC_RULES) + f"""
SELECT {RECORD_SQL}, {REJECT_SQL} AS reject_reason FROM fields""",
    "warehouse_reload_idempotent": "WITH " + WAREHOUSE_SQL + f"\nSELECT {FACT_COLS} FROM fact",
    "sequences_after_load": "WITH " + WAREHOUSE_SQL + """
SELECT 'date_dim' AS table_name, CAST(coalesce(max(id_date), 0) AS BIGINT) AS id FROM date_dim
UNION ALL
SELECT 'producto_dim' AS table_name, CAST(coalesce(max(id_producto), 0) AS BIGINT) AS id FROM product_dim""",
})


# --- inputs that the tables as given don't hold -----------------------------------------
# Three and more decimals, missing dates, unseen products, null and repeated rows,
# product pages that pass, several file layouts, replays.


def q_price_variation_fine(spark, sf):
    """Prices with more than two decimals: an eighth of the unit price."""
    wh = _fresh(spark, sf)
    return variation.price_variation(wh.fact.withColumn("unit_price", F.col("unit_price") / 8), wh.product_dim, wh.date_dim)


def q_price_index_fine(spark, sf):
    fact = _fresh(spark, sf).fact
    return W.daily_price_index(fact.withColumns({c: F.col(c) / 8 for c in ("price", "unit_price")}), LOAD_TS).drop("ts_load")


def q_export_full_precision(spark, sf):
    fact = _fresh(spark, sf).fact.drop("ts_load")
    return X.decimal_comma(fact.withColumns({c: F.col(c) / 128 for c in ("price", "unit_price")}))


def q_fact_reload_null_dates(spark, sf):
    """A batch with undated rows, loaded twice: the second load adds nothing."""
    wh = _fresh(spark, sf)
    batch = _obs(spark, sf).withColumn("date", F.when(F.col("product_id").cast("int") % 10 != 0, F.col("date")))
    once = stage_table(W.build_fact(batch, wh.product_dim, wh.date_dim, LOAD_TS), "once")
    again = W.new_facts(batch, wh.product_dim, wh.date_dim, once, LOAD_TS)
    return once.unionByName(again).drop("ts_load")


def q_sequence_hot_key(spark, sf):
    """One key holds a third of the rows."""
    rows = O.read_table(spark, sf, "lineitem").select(
        F.when(F.col("l_orderkey") % 3 == 0, F.lit(0)).otherwise(F.col("l_partkey")).cast("bigint").alias("k"),
        F.col("l_shipdate").cast("date").alias("d"), F.col("l_extendedprice").alias("v"))
    return sequence_with_previous(rows, "k", ["d", "v"], "v")


def q_product_dim_insert(spark, sf):
    """A dimension that lacks every fifth product: those are inserted after the last id."""
    existing, incoming = O.split_batches(_obs(spark, sf), EXISTING_BEFORE, INCOMING_FROM)
    known = W.initial_load(existing.where(F.col("product_id").cast("int") % 5 != 0), LOAD_TS)
    return W.update_product_dim(incoming, known.product_dim, LOAD_TS).drop("ts_load")


def _dirty(spark, sf):
    obs, n = _obs(spark, sf), F.col("product_id").cast("int")
    dirty = obs.withColumn("product", F.when(n % 7 != 0, F.col("product"))).withColumn("price", F.when(n % 11 != 0, F.col("price")))
    return dirty.unionByName(dirty.where(n % 13 == 0))


def q_migration_cleanup_dirty(spark, sf):
    return migration.clean_history(_dirty(spark, sf), LOAD_TS).drop("ts_load")


def q_profile_nulls_dirty(spark, sf):
    return Qy.profile_columns(_dirty(spark, sf))


def q_snapshot_two_layouts(spark, sf):
    """Odd months in the capture job's layout, even months in the loader's, read together."""
    path, obs = scratch_path(spark, "layouts"), _obs(spark, sf)
    month = F.date_format("date", "yyyyMM")
    odd = F.month("date") % 2 == 1
    Sn.write_snapshots(obs.where(odd), f"{path}/capture", month)
    Sn.write_snapshots(obs.where(~odd).withColumn("ts_load", F.lit(LOAD_TS).cast("timestamp")), f"{path}/loader", month, header=Sn.LOADED_HEADER)
    return Sn.read_snapshots(spark, path, "*.csv", strip=True)


def _shop_pages(spark, sf):
    """A product page per part: every fourth title has one capitalised word, every fifth page no price."""
    k = F.col("p_partkey")
    text = lambda c, d: F.replace(c.cast(f"decimal(12,{d})").cast("string"), F.lit("."), F.lit(","))
    title = F.when(k % 4 == 0, F.concat(F.upper(F.substring("p_name", 1, 1)), F.substring(F.col("p_name"), F.lit(2), F.length("p_name")))).otherwise(F.initcap("p_name"))
    html = F.concat(F.lit('<h1 class="big product-title">'), title, F.lit("</h1>"),
                    F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("<p class='buy-box__active-price'>"), text(F.col("p_retailprice"), 2), F.lit(" €</p>"))),
                    F.lit('<p class="buy-box__price-per-unit">('), text(F.col("p_retailprice") / 8, 3), F.lit(' €/KILO)</p>'),
                    F.lit('<span class="breadcrumb-item__link">All, together</span><span class="breadcrumb-item__link">'), F.col("p_type"), F.lit("</span>"),
                    F.when(k % 3 == 0, F.concat(F.lit('<span class="product_details_promotion_description">Save '), F.col("p_size").cast("string"), F.lit("% today</span>"))).otherwise(F.lit("")))
    return O.read_table(spark, sf, "part").select(k.cast("bigint").alias("page_id"), F.concat(F.lit("https://shop.example/all/p/"), k.cast("string")).alias("url"), html.alias("html"))


def q_shop_page_records(spark, sf):
    ok, bad = capture.capture_products(_shop_pages(spark, sf), Pg.SHOP_RULES, run_date=RUN_DATE, load_ts=LOAD_TS)
    return ok.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad).drop("ts_load")


def q_ingest_replay(spark, sf):
    """Shop pages with repeated and missing page ids, ingested twice with new checkpoints."""
    pages = _shop_pages(spark, sf)
    pages = pages.unionByName(pages.where("page_id % 10 = 1")).withColumn("page_id", F.when(F.col("page_id") % 9 != 0, F.col("page_id")))
    src, rec, rej = (scratch_path(spark, n) for n in ("pages-in", "records", "rejects"))
    pages.repartitionByRange(3, "url").write.parquet(src)
    for n in ("ck1", "ck2"):
        ingest_pages(spark, src, rec, rej, scratch_path(spark, n), RUN_DATE, Pg.SHOP_RULES, 1, LOAD_TS)
    return _ingested(spark, rec, rej)


def q_sitemap_queue(spark, sf):
    """Work queue from sitemaps of a hundred entries, every third of which is no product."""
    k = F.col("p_partkey")
    url = F.concat(F.lit("https://shop.example/"), F.when(k % 3 == 0, F.lit("help/")).otherwise(F.lit("all/p/")), k.cast("string"))
    part = O.read_table(spark, sf, "part").select(F.floor(k / 100).alias("doc"), F.struct(k, F.concat(F.lit("<url><loc> "), url, F.lit(" </loc></url>")).alias("x")).alias("e"))
    maps = part.groupBy("doc").agg(F.concat(F.lit("<urlset>"), F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["x"]), ""), F.lit("</urlset>")).alias("xml"))
    return capture.queue_from_sitemap(maps, "xml", "doc")


QUERIES.update({
    "price_variation_fine": q_price_variation_fine,
    "price_index_fine": q_price_index_fine,
    "export_full_precision": q_export_full_precision,
    "fact_reload_null_dates": q_fact_reload_null_dates,
    "sequence_hot_key": q_sequence_hot_key,
    "product_dim_insert": q_product_dim_insert,
    "migration_cleanup_dirty": q_migration_cleanup_dirty,
    "profile_nulls_dirty": q_profile_nulls_dirty,
    "snapshot_two_layouts": q_snapshot_two_layouts,
    "shop_page_records": q_shop_page_records,
    "ingest_replay": q_ingest_replay,
    "sitemap_queue": q_sitemap_queue,
})

DIRTY_SQL = OBS_SQL.replace("obs AS (", "clean AS (") + """,
dirty AS (
  SELECT product_id, CASE WHEN CAST(product_id AS INTEGER) % 11 <> 0 THEN price END AS price,
         CASE WHEN CAST(product_id AS INTEGER) % 7 <> 0 THEN product END AS product,
         brand, unit_price, units, categories, discount, date FROM clean),
obs AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE CAST(product_id AS INTEGER) % 13 = 0)"""

# The fields of the pages, from the columns that the pages were made of.
SHOP_SQL = f"""shop AS (
  SELECT p_partkey AS k, CAST(p_partkey AS BIGINT) AS page_id, CAST(p_partkey AS VARCHAR) AS product_id,
         upper(p_name[1]) || p_name[2:instr(p_name, ' ')] ||
           CASE WHEN p_partkey % 4 = 0 THEN p_name[instr(p_name, ' ') + 1] ELSE upper(p_name[instr(p_name, ' ') + 1]) END ||
           p_name[instr(p_name, ' ') + 2:] AS product,
         CASE WHEN p_partkey % 4 <> 0 THEN upper(p_name[instr(p_name, ' ') + 1]) || p_name[instr(p_name, ' ') + 2:] END AS brand,
         CASE WHEN p_partkey % 5 <> 0 THEN CAST(CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(12, 2)) AS DOUBLE) END AS price,
         '[''All. together'', ''' || p_type || ''']' AS categories,
         CAST(CAST(CAST(p_retailprice / 8 AS VARCHAR) AS DECIMAL(12, 3)) AS DOUBLE) AS unit_price,
         '€/KILO)' AS units, CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) END AS discount, DATE '{RUN_DATE}' AS date,
         nullif(concat_ws(',', CASE WHEN p_partkey % 5 = 0 THEN 'price' END, CASE WHEN p_partkey % 4 = 0 THEN 'brand' END), '') AS reject_reason
  FROM part)"""
SHOP_COLS = "product, product_id, brand, price, categories, unit_price, units, discount, date, reject_reason"

ORACLE.update({
    "price_variation_fine": "WITH " + variation_sql("f.unit_price / 8") + "\nSELECT * FROM variacion",
    "price_index_fine": "WITH " + WAREHOUSE_SQL + ",\nfine AS (SELECT id_producto, id_date, price / 8 AS price, unit_price / 8 AS unit_price FROM fact),\n" + index_sql("fine"),
    "export_full_precision": "WITH " + WAREHOUSE_SQL + """
SELECT id_producto, id_date, replace(CAST(price / 128 AS VARCHAR), '.', ',') AS price,
       replace(CAST(unit_price / 128 AS VARCHAR), '.', ',') AS unit_price, replace(CAST(discount AS VARCHAR), '.', ',') AS discount, year FROM fact""",
    "fact_reload_null_dates": "WITH " + WAREHOUSE_SQL + """,
undated AS (SELECT * REPLACE (CASE WHEN CAST(product_id AS INTEGER) % 10 <> 0 THEN date END AS date) FROM obs)
SELECT pd.id_producto, dd.id_date, o.price, o.unit_price, o.discount, dd.year
FROM undated o LEFT JOIN product_dim pd ON pd.product_id = o.product_id LEFT JOIN date_dim dd ON dd.date = o.date""",
    "sequence_hot_key": """
WITH r AS (SELECT CAST(CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_partkey END AS BIGINT) AS k, CAST(l_shipdate AS DATE) AS d, l_extendedprice AS v FROM lineitem)
SELECT *, row_number() OVER w AS num, lag(v) OVER w AS prev FROM r WINDOW w AS (PARTITION BY k ORDER BY d, v)""",
    "product_dim_insert": "WITH " + INCREMENTAL_SQL.replace(
        f"date < DATE '{EXISTING_BEFORE}'", f"date < DATE '{EXISTING_BEFORE}' AND CAST(product_id AS INTEGER) % 5 <> 0") + "\nSELECT * FROM pd1",
    "migration_cleanup_dirty": ORACLE["migration_cleanup"].replace(OBS_SQL, DIRTY_SQL),
    "profile_nulls_dirty": ORACLE["profile_nulls"].replace(OBS_SQL, DIRTY_SQL),
    "snapshot_two_layouts": ORACLE["csv_snapshot_roundtrip"],
    "shop_page_records": "WITH " + SHOP_SQL + f"\nSELECT page_id, {SHOP_COLS} FROM shop",
    "ingest_replay": "WITH " + SHOP_SQL + f"""
SELECT CASE WHEN page_id % 9 <> 0 THEN page_id END AS page_id, {SHOP_COLS} FROM shop
UNION ALL SELECT NULL, {SHOP_COLS} FROM shop WHERE page_id % 9 = 0 AND page_id % 10 = 1""",
    "sitemap_queue": """
SELECT CAST(p_partkey AS VARCHAR) AS id_producto, 'https://shop.example/all/p/' || p_partkey AS url_product,
       row_number() OVER (ORDER BY p_partkey) - 1 AS index
FROM part WHERE p_partkey % 3 <> 0""",
})


#: inputs that several queries share, staged once per application and folder
STAGED = {
    "warehouse": _fresh,
    "incremental": _incremental,
    "updated_dims": lambda spark, sf: _updated_dims(spark, sf, *_incremental(spark, sf)),
    "trimmed": _trimmed,
    "load_job": _etl_run,
}
