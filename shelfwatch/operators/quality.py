"""Data-quality operators: duplicate keys, completeness rules, column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwatch.operators.keys import with_global_rank


def _keys(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def duplicate_keys(df: DataFrame, keys, min_count: int = 2, count_col: str = "n") -> DataFrame:
    """Keys occurring at least ``min_count`` times, with their count. Null keys
    are not grouped (as pandas ``groupby``). Counting aggregates map-side."""
    k = _keys(keys)
    notnull = F.lit(True)
    for c in k:
        notnull = notnull & F.col(c).isNotNull()
    return (df.where(notnull).groupBy(*k).agg(F.count(F.lit(1)).alias(count_col))
            .where(F.col(count_col) >= min_count))


def rows_with_duplicate_keys(df: DataFrame, keys, min_count: int = 2, ordered: bool = True) -> DataFrame:
    """All rows whose key is duplicated (membership via a semi-join), sorted by key."""
    k = _keys(keys)
    out = df.join(duplicate_keys(df, k, min_count).select(*k), k, "left_semi")
    return out.orderBy(*k, *[c for c in df.columns if c not in k]) if ordered else out


def completeness_split(df: DataFrame, required: Sequence[str],
                       reason_col: str = "reject_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): a record is accepted only when every ``required``
    column is non-null; rejects carry the list of missing fields."""
    missing = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in required])
    tagged = df.withColumn(reason_col, F.nullif(missing, F.lit("")))
    accepted = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    rejected = tagged.where(F.col(reason_col).isNotNull())
    return accepted, rejected


def profile_columns(df: DataFrame) -> DataFrame:
    """Long format, one row per column: column, dtype, n_rows, n_non_null,
    n_null — from a single aggregation pass."""
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(c)).alias(f"_nn_{i}") for i, c in enumerate(df.columns)]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', '{t}', `_nn_{i}`" for i, (c, t) in enumerate(df.dtypes))
    long = one.selectExpr("_rows", f"stack({len(df.columns)}, {stack}) AS (column, dtype, n_non_null)")
    return long.select("column", "dtype", F.col("_rows").alias("n_rows"), "n_non_null",
                       (F.col("_rows") - F.col("n_non_null")).alias("n_null"))


def describe_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pandas-style describe of text columns: column, count (non-null), unique,
    top (most frequent; ties → smallest value), freq.

    The columns are unpivoted to (column, value) and counted in one grouped
    aggregation (map-side combine), then reduced per column."""
    cols = list(cols)
    pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                                    F.col(c).cast("string").alias("value"))
                                           for c in cols])).alias("p")).select("p.column", "p.value")
    counts = pairs.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("cnt"))
    best = F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("value").alias("value")))
    per = counts.groupBy("column").agg(F.sum("cnt").alias("count"), F.count(F.lit(1)).alias("unique"),
                                       best.alias("b"))
    return per.select("column", "count", "unique", F.col("b.value").alias("top"),
                      (-F.col("b.neg")).alias("freq"))


def ids_concat(df: DataFrame, group_cols, id_col: str, out_col: str = "ids", sep: str = ",",
               distinct: bool = True) -> DataFrame:
    """Per group, the ids joined into one sorted, ``sep``-separated string.
    The output holds every id of a group by definition; with ``distinct`` the
    partial aggregate keeps one copy per id and task."""
    g = _keys(group_cols)
    ids = F.col(id_col).cast("string")
    coll = F.collect_set(ids) if distinct else F.collect_list(ids)
    return df.where(F.col(id_col).isNotNull()).groupBy(*g).agg(
        F.concat_ws(sep, F.sort_array(coll)).alias(out_col))


def id_chunks(df: DataFrame, group_cols, id_col: str, size: int = 10_000, out_col: str = "ids", sep: str = ",") -> DataFrame:
    """``ids_concat`` cut into cells of bounded size: group, ``part`` (from 0,
    gapless) and at most ``size`` sorted, distinct ids as one string.

    All ids are numbered in one global order by group and id, and a cell holds
    those whose number falls into one range of ``size``. So a group's ids are
    spread over as many tasks as it has cells, and only its first and last cell
    may be shorter. The cells of a group, joined by ``part``, are the string of
    ``ids_concat``. Null ids are left out, null groups are a group."""
    g = _keys(group_cols)
    ids = df.where(F.col(id_col).isNotNull()).select(*g, F.col(id_col).cast("string").alias("_id")).distinct()
    ranked = with_global_rank(ids, [*g, "_id"], "_rank").withColumn("_cell", F.floor((F.col("_rank") - 1) / size))
    cells = ranked.groupBy(*g, "_cell").agg(F.concat_ws(sep, F.array_sort(F.collect_list("_id"))).alias(out_col))
    first = ranked.groupBy(*g).agg(F.min("_cell").alias("_first")).select(*[F.col(c).alias(f"_g_{c}") for c in g], "_first")
    same = F.lit(True)
    for c in g:
        same = same & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return cells.join(first, same).select(*g, (F.col("_cell") - F.col("_first")).alias("part"), out_col)


def join_chunks(chunks: DataFrame, group_cols, out_col: str = "ids", sep: str = ",") -> DataFrame:
    """The cells of ``id_chunks`` joined to one string per group, for an export that needs it whole."""
    parts = F.array_sort(F.collect_list(F.struct("part", F.col(out_col).alias("s"))))
    return chunks.groupBy(*_keys(group_cols)).agg(F.concat_ws(sep, F.transform(parts, lambda x: x["s"])).alias(out_col))


def preview(df: DataFrame, n: int = 10, order_cols: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows in a total order (``order_cols``, then every other
    column as tie-break): a distributed top-k (each task keeps ``n`` rows)."""
    order = list(order_cols or [])
    order += [c for c in df.columns if c not in order]
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
