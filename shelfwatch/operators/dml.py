"""Table maintenance as DataFrame rewrites (no transactional table format).

Each function returns the new content of a table; ``shelfwatch.sources.tables``
writes it to a fresh location (Spark refuses to overwrite a path it reads).
Merges are joins on the key: both sides shuffle by the key once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwatch.operators.keys import assign_ids, last_id


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def _ts(load_ts) -> Column:
    if load_ts is None:
        return F.current_timestamp()
    return load_ts if isinstance(load_ts, Column) else F.lit(load_ts).cast("timestamp")


def bag_diff(batch: DataFrame, existing: DataFrame, chunk: int = 100_000) -> DataFrame:
    """Rows of ``batch`` not matched one-for-one in ``existing`` (EXCEPT ALL:
    multiplicity kept, nulls equal).

    Both sides are counted together (+1 and -1) in one aggregation with map-side
    partial sums, so many copies of one row cost one row per task and nulls
    group as equal. The surplus copies are regenerated in chunks of at most
    ``chunk`` rows hashed over tasks: a row repeated a billion times is not
    emitted by one task (Spark's own EXCEPT ALL replicates each distinct row in
    a single task)."""
    cols = batch.columns
    both = batch.withColumn("_w", F.lit(1).cast("bigint")).unionAll(existing.select(*cols, F.lit(-1).cast("bigint").alias("_w")))
    counts = both.groupBy(*cols).agg(F.sum("_w").alias("_n"))
    # the union may have widened a type; rows that are left come from the batch
    surplus = counts.where(F.col("_n") > 0).select(*[F.col(c).cast(t).alias(c) for c, t in batch.dtypes], "_n")
    chunks = surplus.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"),
                                                      F.floor((F.col("_n") - 1) / chunk).cast("bigint"))).alias("_ch"))
    spread = chunks.repartition(*cols, "_ch")
    lo = F.col("_ch") * chunk + 1
    hi = F.least(F.col("_n"), (F.col("_ch") + 1) * chunk)
    return spread.select(*cols, F.explode(F.sequence(lo, hi)).alias("_k")).drop("_k")


def set_diff(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Distinct rows of ``batch`` absent from ``existing`` (EXCEPT DISTINCT)."""
    return batch.subtract(existing.select(*batch.columns))


def not_in_target(batch: DataFrame, target: DataFrame, key) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``target`` (anti-join; a
    null key never matches, so such rows are kept)."""
    k = _keys(key)
    return batch.join(target.select(*k).hint("merge"), k, "left_anti")


def _unique_source(source: DataFrame, key: list[str]) -> DataFrame:
    """One row per key with a check column that fails the job (as a MERGE
    does) when a key that matches the target occurs more than once in the
    source. Grouping aggregates map-side, so a hot key costs one row per task."""
    rest = [c for c in source.columns if c not in key]
    g = source.groupBy(*key).agg(F.count(F.lit(1)).alias("_sw_n"),
                                 *[F.first(c).alias(c) for c in rest])
    return (g.withColumn("_sw_chk", F.when(F.col("_sw_n") > 1,
                                           F.raise_error(F.lit("merge source has a duplicate key")))
                         .otherwise(F.lit(None)))
            .drop("_sw_n"))


def merge_update(target: DataFrame, source: DataFrame, key, set_cols: Sequence[str],
                 ts_col: str | None = "ts_load", load_ts=None, only_changed: bool = False,
                 check_unique: bool = True) -> DataFrame:
    """MERGE … WHEN MATCHED UPDATE SET set_cols (SCD type 1).

    Target rows whose key is in ``source`` take the source values of
    ``set_cols`` and a new ``ts_col``; other rows are unchanged. With
    ``only_changed`` a matched row is rewritten (and stamped) only if a set
    column differs (null-safe)."""
    k = _keys(key)
    src = source.select(*k, *[F.col(c).alias(f"_sw_new_{c}") for c in set_cols])
    if check_unique:
        src = _unique_source(src, k)
    src = src.withColumn("_sw_hit", F.lit(True))
    j = target.join(src.hint("merge"), k, "left")  # as large as the batch: not through the driver
    hit = F.coalesce(F.col("_sw_hit"), F.lit(False))
    if only_changed:
        differs = F.lit(False)
        for c in set_cols:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_sw_new_{c}"))
        hit = hit & differs
    if check_unique:
        hit = hit & F.col("_sw_chk").isNull()
    out = []
    for c in target.columns:
        if c in set_cols:
            out.append(F.when(hit, F.col(f"_sw_new_{c}")).otherwise(F.col(c)).alias(c))
        elif ts_col is not None and c == ts_col:
            out.append(F.when(hit, _ts(load_ts)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def insert_new(target: DataFrame, batch: DataFrame, key, id_col: str | None = None,
               order_cols: Sequence | None = None, start: Column | int | None = None,
               ts_col: str | None = "ts_load", load_ts=None) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``target``, with consecutive new
    ids after the largest id of ``target`` and a load time, in ``target``'s
    column layout (missing columns null). A null key is in no target, so rows
    without a key are inserted whenever they come: filter them if a batch may
    come twice."""
    new = not_in_target(batch, target, key)
    if id_col is not None:
        first = start if start is not None else last_id(target, id_col)
        new = assign_ids(new, id_col, order_cols or [_keys(key)[0]], start=first,
                         id_type=dict(target.dtypes).get(id_col, "int"))
    if ts_col is not None and ts_col in target.columns:
        new = new.withColumn(ts_col, _ts(load_ts))
    return conform(new, target)


def upsert(target: DataFrame, source: DataFrame, key, set_cols: Sequence[str],
           id_col: str | None = None, order_cols: Sequence | None = None,
           ts_col: str | None = "ts_load", load_ts=None, only_changed: bool = False,
           start: Column | int | None = None) -> DataFrame:
    """Update matched keys (``merge_update``) and insert the rest
    (``insert_new``, ids after ``start`` or the largest id); the new content
    of the target table."""
    updated = merge_update(target, source, key, set_cols, ts_col, load_ts, only_changed)
    inserted = insert_new(target, source, key, id_col, order_cols, start, ts_col, load_ts)
    return updated.unionByName(inserted)


def changed_rows(batch: DataFrame, target: DataFrame, cols: Sequence[str],
                 ts_col: str | None = "ts_load", load_ts=None) -> DataFrame:
    """Rows of ``batch`` (restricted to ``cols``) not present as such in
    ``target``: the change detector, EXCEPT ALL semantics."""
    out = bag_diff(batch.select(*cols), target.select(*cols))
    return out.withColumn(ts_col, _ts(load_ts)) if ts_col else out


def delete_where(df: DataFrame, predicate: Column | str) -> DataFrame:
    """DELETE WHERE predicate: rows where it is true go; false or null stay."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    return df.where(~F.coalesce(p, F.lit(False)))


def delete_all(df: DataFrame) -> DataFrame:
    """Empty table, same schema."""
    return df.where(F.lit(False))


def update_where(df: DataFrame, predicate: Column | str, assignments: Mapping[str, Column | object]) -> DataFrame:
    """UPDATE … SET col = value WHERE predicate (null predicate: unchanged)."""
    p = F.expr(predicate) if isinstance(predicate, str) else predicate
    hit = F.coalesce(p, F.lit(False))
    out = []
    for c, t in df.dtypes:
        if c in assignments:
            v = assignments[c]
            v = v if isinstance(v, Column) else F.lit(v)
            out.append(F.when(hit, v.cast(t)).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


def insert_rows(spark: SparkSession, df: DataFrame, rows: Sequence[Sequence]) -> DataFrame:
    """INSERT INTO … VALUES rows (literal rows in the table's schema)."""
    return df.unionByName(spark.createDataFrame(list(rows), df.schema))


def append_unseen(target: DataFrame, batch: DataFrame, key=None,
                  ts_col: str | None = "ts_load", load_ts=None,
                  compare_cols: Sequence[str] | None = None) -> DataFrame:
    """The rows of ``batch`` to append to ``target``.

    Without ``key``: bag difference on ``compare_cols`` (default: the batch
    columns), as the original loader did. With ``key``: keyed, idempotent
    anti-join (a rerun of the same batch appends nothing)."""
    if key is not None:
        out = not_in_target(batch, target, key)
    else:
        cols = list(compare_cols or batch.columns)
        out = bag_diff(batch.select(*cols), target.select(*cols))
    return out.withColumn(ts_col, _ts(load_ts)) if ts_col else out


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """Select ``like``'s columns in order and types; missing ones as null."""
    have = set(df.columns)
    return df.select(*[(F.col(c) if c in have else F.lit(None)).cast(t).alias(c) for c, t in like.dtypes])


def reload_partitions(current: DataFrame, batch: DataFrame, partition_cols: Sequence[str]) -> DataFrame:
    """Content after a dynamic partition overwrite: partitions present in
    ``batch`` are replaced by the batch rows, the others kept (semantics of
    ``partitionOverwriteMode=dynamic``; ``sources.tables.overwrite_partitions``
    performs it on storage)."""
    parts = batch.select(*partition_cols).distinct()
    kept = current.join(parts, list(partition_cols), "left_anti")
    return kept.unionByName(batch.select(*current.columns))
