"""Summaries that are kept per day and merged for any span: quantile sketches,
distinct-count sketches and central moments.

A day's summary is one small row, made by one grouped aggregate with map-side
partials. Months, years or any other span of days are answered from these rows,
without the observations.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.stats import normality_of

#: size of a quantile sketch; the rank error of a quantile is below RANK_ERROR with 99 % confidence, merged or not
KLL_K, RANK_ERROR = 400, 0.0075
#: a distinct-count sketch has 2**LG_K registers: relative standard error 1.04 / sqrt(2**LG_K), here 0.8 %
LG_K = 14


def _name(by) -> list:
    return [by] if isinstance(by, (str, Column)) else list(by)


def quantile_sketches(df: DataFrame, by, col: str) -> DataFrame:
    """One KLL sketch per value of ``by``: by, n, low, high, sketch. Nulls are left out."""
    v = F.col(col).cast("double")
    return df.where(v.isNotNull()).groupBy(*_name(by)).agg(
        F.count(F.lit(1)).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"), F.kll_sketch_agg_double(v, F.lit(KLL_K)).alias("sketch"))


def merge_quantile_sketches(sketches: DataFrame, by) -> DataFrame:
    """The sketches of the rows of one ``by`` as one; counts and extremes stay exact."""
    return sketches.groupBy(*_name(by)).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
                                            F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("sketch"))


def sketched_quantiles(sketches: DataFrame, probs: Sequence[float]) -> DataFrame:
    """``quantiles``: the value of each probability, of rank within RANK_ERROR of it."""
    got = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in probs]))
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], got.alias("quantiles"))


def distinct_sketches(df: DataFrame, by, col: str) -> DataFrame:
    """One HyperLogLog sketch of the values of ``col`` per value of ``by``: by, sketch. Nulls are left out."""
    return df.where(F.col(col).isNotNull()).groupBy(*_name(by)).agg(F.hll_sketch_agg(col, LG_K).alias("sketch"))


def merge_distinct_sketches(sketches: DataFrame, by) -> DataFrame:
    """The sketch of the union: values that several rows saw count once."""
    return sketches.groupBy(*_name(by)).agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_distinct(sketches: DataFrame) -> DataFrame:
    return sketches.select(*[c for c in sketches.columns if c != "sketch"], F.hll_sketch_estimate("sketch").alias("n_distinct"))


def moments(df: DataFrame, by, col: str) -> DataFrame:
    """Central moments per value of ``by``: by, n, mean, m2, m3, m4 (sums of powers of the distance from the mean)."""
    v = F.col(col).cast("double")
    g = df.where(v.isNotNull()).groupBy(*_name(by)).agg(F.count(F.lit(1)).alias("n"), F.avg(v).alias("mean"), F.var_pop(v).alias("_v"),
                                                          F.skewness(v).alias("_s"), F.kurtosis(v).alias("_k"))
    spread = F.col("_v") > 0
    return g.withColumns({"m2": F.col("n") * F.col("_v"),
                          "m3": F.when(spread, F.col("n") * F.col("_s") * F.pow("_v", F.lit(1.5))).otherwise(F.lit(0.0)),
                          "m4": F.when(spread, F.col("n") * (F.col("_k") + 3) * F.col("_v") * F.col("_v")).otherwise(F.lit(0.0))}).drop("_v", "_s", "_k")


def merge_moments(parts: DataFrame, by) -> DataFrame:
    """The moments of the rows of one ``by`` together, moved to their common mean."""
    keyed = parts.select(F.struct(*_name(by)).alias("_by"), "n", "mean", "m2", "m3", "m4")
    mean = keyed.groupBy("_by").agg(F.sum("n").alias("_n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("_mean"))
    d, n = F.col("mean") - F.col("_mean"), F.col("n")
    # a struct of nulls equals another one: spans without a name are one span
    return keyed.join(mean, "_by").groupBy("_by", "_n", "_mean").agg(
        F.sum(F.col("m2") + n * d * d).alias("m2"),
        F.sum(F.col("m3") + 3 * d * F.col("m2") + n * d * d * d).alias("m3"),
        F.sum(F.col("m4") + 4 * d * F.col("m3") + 6 * d * d * F.col("m2") + n * d * d * d * d).alias("m4"),
    ).select("_by.*", F.col("_n").alias("n"), F.col("_mean").alias("mean"), "m2", "m3", "m4")


def normality_of_moments(parts: DataFrame, digits: int | None = None) -> DataFrame:
    """The normality test of rows of moments, as ``stats.normality_test`` of their observations."""
    v = F.col("m2") / F.col("n")
    return normality_of(parts.select(F.col("n").cast("double").alias("n"), (F.col("m3") / F.col("n") / F.pow(v, F.lit(1.5))).alias("g1"),
                                     (F.col("m4") / F.col("n") / (v * v)).alias("b2")), digits)
