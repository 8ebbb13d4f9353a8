
import datetime as dt

from pyspark.sql import Window, functions as F

from shelfwatch.plans import reports, warehouse as W
from shelfwatch.plans import variation as V

TS = dt.datetime(2024, 1, 1)
D = dt.date


def test_flat_index_has_null_norm_not_error(spark):
    # D11: max = min of the daily averages -> null, ANSI does not raise
    fact = spark.createDataFrame([(1, 1, 2.0, 1.0, 0.0, 2023, TS), (2, 1, 2.0, 1.0, 0.0, 2023, TS)],
                                 "id_producto int, id_date int, price double, unit_price double, discount double, "
                                 "year int, ts_load timestamp")
    r = W.daily_price_index(fact, TS).first()
    assert (r.sum_price, r.num_products, r.sum_price_norm) == (4.0, 2, None)


def test_text_ids_compare_without_cast_errors(spark):
    # D2: '10789P4' is a valid product id; comparisons stay on text or try_cast
    df = spark.createDataFrame([("10789P4",), ("291364",)], "product_id string")
    assert df.where(F.col("product_id").try_cast("int") < 300000).count() == 1
    assert df.where(F.col("product_id") == "10789P4").count() == 1


def test_same_day_ties_give_repeatable_numbering(spark):
    # D7: two prices the same day are ordered by price, not arbitrarily
    obs = spark.createDataFrame(
        [("p", D(2023, 8, 26), 3.0), ("p", D(2023, 8, 26), 2.0), ("p", D(2023, 9, 2), 2.5)],
        "product_id string, date date, unit_price double")
    fact = obs.select(F.lit(1).alias("id_producto"), F.lit(None).cast("int").alias("id_date"), "unit_price", "date")
    dd = obs.select("date").distinct().select(F.dense_rank().over(Window.orderBy("date")).alias("id_date"), "date")
    fact = fact.drop("id_date").join(dd, "date").select("id_producto", "id_date", "unit_price")
    pd_ = spark.createDataFrame([(1, "x")], "id_producto int, product string")
    got = [(r.num, r.unit_price, r.variacion, r.por_variacion) for r in V.price_variation(fact, pd_, dd).collect()]
    assert got == [(1, 2.0, None, None), (2, 3.0, 1.0, 50.0), (3, 2.5, -0.5, -17.0)]


def test_coverage_sorts_null_dates_last(spark):
    # D20: descending order with nulls last, as the notebooks' pandas sort
    obs = spark.createDataFrame([("a", D(2023, 8, 26)), ("b", None), ("a", D(2023, 9, 2))],
                                "product_id string, date date")
    rows = [(r.year, r.month) for r in reports.coverage_by_month(obs).collect()]
    assert rows == [(2023, 9), (2023, 8), (None, None)]
