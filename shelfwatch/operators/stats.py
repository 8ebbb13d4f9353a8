"""Distribution statistics: summaries, exact quantiles, outlier fences,
histogram, Gaussian density estimate and the D'Agostino–Pearson normality test.

Exact quantiles never gather the values of a column in one task (Spark's
``percentile`` keeps a value→count map per group, merged in one task): each
quantile is bracketed by approximate ones, and only the values inside the
brackets are range-sorted and given cumulative counts in parallel
(``value_ranks``). ``approx=True`` switches to
``percentile_approx`` (one pass, bounded memory) for very large inputs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwatch.session import stage_table


def _pname(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"q{s}"


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


def quantiles(df: DataFrame, col: str, probs: Sequence[float], approx: bool = False,
              accuracy: int = 10000) -> DataFrame:
    """One row: ``n`` and one column per probability (``q25``, ``q50``…),
    linear interpolation between closest ranks (``(n-1)·p``), nulls ignored."""
    if approx:
        vals = df.select(F.col(col).cast("double").alias("v")).where(F.col("v").isNotNull())
        qs = F.percentile_approx("v", list(probs), accuracy)
        return vals.agg(F.count(F.lit(1)).alias("n"), qs.alias("_q")).select(
            "n", *[F.col("_q")[i].alias(_pname(p)) for i, p in enumerate(probs)])
    return column_quantiles(df, [col], probs).drop("column")


#: relative error of the approximate quantiles that bracket the exact ones, and errors taken on either side
ACCURACY, MARGIN = 10_000, 8


def _brackets(long: DataFrame, probs: Sequence[float]) -> DataFrame:
    """One row per column of ``long(column, v)``: ``n`` and, per probability i, values ``_from<i>`` and ``_to<i>``
    between which its quantile lies.

    An approximate quantile misses its rank by at most n/ACCURACY, so those at
    MARGIN errors below and above enclose both closest ranks once an error is
    a row or more; with fewer rows the bracket is the whole column."""
    off = MARGIN / ACCURACY
    wanted = [x for p in probs for x in (max(0.0, p - off), min(1.0, p + off))]
    got = long.groupBy("column").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("_min"), F.max("v").alias("_max"),
                                     F.percentile_approx("v", wanted, ACCURACY).alias("_q"))
    few = F.col("n") <= ACCURACY
    out = []
    for i, p in enumerate(probs):
        out += [F.when(few | F.lit(p <= off), F.col("_min")).otherwise(F.col("_q")[2 * i]).alias(f"_from{i}"),
                F.when(few | F.lit(p >= 1 - off), F.col("_max")).otherwise(F.col("_q")[2 * i + 1]).alias(f"_to{i}")]
    return got.select("column", "n", *out)


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles of several columns: one row per column with ``column``,
    ``n`` and one field per probability.

    A first pass brackets each quantile between two approximate ones
    (``_brackets``). In the second pass a value outside all brackets takes the
    place of the nearest bracket edge below it (the lowest edge if there is
    none), which leaves the ranks inside brackets as they are; so nearly all
    rows collapse map-side, and only the values inside brackets are shuffled,
    sorted and given cumulative counts (``value_ranks``). Only the values
    holding the wanted ranks are kept."""
    names = [_pname(p) for p in probs]
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                         for c in cols])).alias("_e")).select("_e.column", "_e.v")
    long = long.where(F.col("v").isNotNull())
    found = stage_table(_brackets(long, probs), "brackets")
    edges = [(F.col(f"_from{i}"), F.col(f"_to{i}")) for i in range(len(probs))]
    v = F.col("v")
    inside, below, lowest = F.lit(False), F.lit(None).cast("double"), F.lit(None).cast("double")
    for lo, hi in edges:  # greatest and least skip nulls
        inside = inside | v.between(lo, hi)
        below = F.greatest(below, F.when(hi < v, hi))
        lowest = F.least(lowest, lo)
    narrowed = long.join(F.broadcast(found.drop("n")), "column").select(
        "column", F.when(inside, v).otherwise(F.coalesce(below, lowest)).alias("v"))
    ranked = value_ranks(narrowed, "v", "column")
    # One row per column (bounded by the number of columns): its count and the
    # rows of the columns sorted before it.
    before = Window.orderBy(F.col("column").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    span = found.select("column", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_s"))
    r = ranked.join(F.broadcast(span), "column")
    first, last = F.col("_cum") - F.col("_s") - F.col("_c") + 1, F.col("_cum") - F.col("_s")
    flags, hs = [], []
    for i, p in enumerate(probs):
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h) + 1, F.ceil(h) + 1
        flags += [((first <= lo) & (lo <= last)).alias(f"_lo{i}"), ((first <= hi) & (hi <= last)).alias(f"_hi{i}")]
        hs.append(h)
    marked = r.select("column", "n", "v", *flags)
    any_flag = F.lit(False)
    for i in range(len(probs)):
        any_flag = any_flag | F.col(f"_lo{i}") | F.col(f"_hi{i}")
    aggs = []
    for i, name in enumerate(names):
        aggs.append(F.max(F.when(F.col(f"_lo{i}"), F.col("v"))).alias(f"{name}_lo"))
        aggs.append(F.max(F.when(F.col(f"_hi{i}"), F.col("v"))).alias(f"{name}_hi"))
    got = marked.where(any_flag).groupBy("column", "n").agg(*aggs)
    out = [F.col("column"), F.col("n")]
    for name, p in zip(names, probs):
        h = (F.col("n") - 1).cast("double") * F.lit(float(p))
        lo_v, hi_v = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((lo_v + (hi_v - lo_v) * (h - F.floor(h))).alias(name))
    return got.select(*out)


def value_ranks(vals: DataFrame, col: str, group: str | None = None) -> DataFrame:
    """Distinct values of ``col`` (per ``group`` if given) with their count
    ``_c`` and the cumulative count ``_cum`` in ascending (group, value)
    order: the value holds ranks ``_cum - _c + 1 … _cum`` of the whole sorted
    input. Identical values collapse map-side before the range sort, so a
    value held by a third of the rows is one row; running counts come from a
    window inside each range partition plus one offset per partition (a
    table bounded by the partition count)."""
    keys = [group, col] if group else [col]
    vc = vals.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c"))
    tagged = (vc.orderBy(*[F.col(k).asc_nulls_last() for k in keys])
              .withColumn("_m", F.monotonically_increasing_id())
              .select(*keys, "_c", F.shiftright("_m", 33).alias("_p"),
                      F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)).alias("_i")))
    tagged = stage_table(tagged, "ranks")  # both reads below see the same partitions
    w = Window.partitionBy("_p").orderBy("_i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = tagged.select(*keys, "_c", "_p", F.sum("_c").over(w).alias("_cs"))
    per = tagged.groupBy("_p").agg(F.sum("_c").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = per.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (local.join(F.broadcast(offs), "_p")
            .select(*keys, "_c", (F.col("_off") + F.col("_cs")).alias("_cum")))


def iqr_fences(df: DataFrame, col: str, far: float = 3.0, near: float = 1.5,
               approx: bool = False) -> DataFrame:
    """One row: q1, median, q3, iqr, the far-out threshold ``q3 + far·iqr`` and
    the box-plot fences ``q1 - near·iqr`` / ``q3 + near·iqr``."""
    q = quantiles(df, col, [0.25, 0.5, 0.75], approx)
    iqr = F.col("q75") - F.col("q25")
    return q.select("n", F.col("q25").alias("q1"), F.col("q50").alias("median"), F.col("q75").alias("q3"),
                    iqr.alias("iqr"), (F.col("q75") + F.lit(far) * iqr).alias("far_out"),
                    (F.col("q25") - F.lit(near) * iqr).alias("lower_fence"),
                    (F.col("q75") + F.lit(near) * iqr).alias("upper_fence"))


def staged_fences(df: DataFrame, col: str, far: float = 3.0, near: float = 1.5,
                  approx: bool = False) -> DataFrame:
    """``iqr_fences`` computed once and stored (one row) in the checkpoint
    folder, so several thresholds read it without re-ranking the column."""
    return stage_table(iqr_fences(df, col, far, near, approx), "fences")


def outliers_above(df: DataFrame, col: str, far: float = 3.0, approx: bool = False) -> DataFrame:
    """Rows whose ``col`` exceeds ``q3 + far·iqr``, sorted by ``col``."""
    thr = iqr_fences(df, col, far, approx=approx).select("far_out").scalar()
    return df.where(F.col(col) > thr).orderBy(col, *[c for c in df.columns if c != col])


def outside_whiskers(df: DataFrame, col: str, whis: float = 1.5, approx: bool = False) -> DataFrame:
    """Rows whose ``col`` lies beyond a box-plot whisker, with ``side`` (``below`` or ``above``), sorted by ``col``."""
    f = staged_fences(df, col, near=whis, approx=approx)
    lo, hi = f.select("lower_fence").scalar(), f.select("upper_fence").scalar()
    v = F.col(col)
    side = F.when(v < lo, F.lit("below")).when(v > hi, F.lit("above"))
    return df.withColumn("side", side).where("side IS NOT NULL").orderBy(col, *[c for c in df.columns if c != col])


def trimmed(df: DataFrame, col: str, far: float = 3.0, approx: bool = False,
            stage: bool = False) -> DataFrame:
    """Rows whose ``col`` is at most ``q3 + far·iqr`` (the cleaned series).
    ``stage`` stores the result in the checkpoint folder, so further
    statistics on it do not re-derive the threshold."""
    thr = iqr_fences(df, col, far, approx=approx).select("far_out").scalar()
    out = df.where(F.col(col) <= thr)
    return stage_table(out, "trimmed") if stage else out


def boxplot_whiskers(df: DataFrame, col: str, whis: float = 1.5, approx: bool = False) -> DataFrame:
    """One row: the box (q1, median, q3) and the whiskers — the furthest data
    points within ``whis·iqr`` of the box — plus counts beyond each whisker."""
    f = staged_fences(df, col, near=whis, approx=approx)
    lo, hi = f.select("lower_fence").scalar(), f.select("upper_fence").scalar()
    v = F.col(col)
    marked = df.where(v.isNotNull()).select(v.alias("v"), (v >= lo).alias("in_lo"), (v <= hi).alias("in_hi"))
    w = marked.agg(
        F.min(F.when(F.col("in_lo"), F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("in_hi"), F.col("v"))).alias("whisker_high"),
        F.count(F.when(~F.col("in_lo"), 1)).alias("n_below"),
        F.count(F.when(~F.col("in_hi"), 1)).alias("n_above"))
    # two one-row results combined without a join: union, then max per column
    box = f.select("q1", "median", "q3")
    cols = ["q1", "median", "q3", "whisker_low", "whisker_high", "n_below", "n_above"]
    return box.unionByName(w, allowMissingColumns=True).agg(*[F.max(c).alias(c) for c in cols])


def describe_numeric(df: DataFrame, cols: Sequence[str], digits: int | None = None,
                     approx: bool = False, decimal_scale: int | None = None) -> DataFrame:
    """Long-format summary: column, count, mean, std (sample), min, q25, q50,
    q75, max — one row per column, from one aggregation pass and one ranking
    pass over all columns.

    With ``decimal_scale`` (e.g. 2 for money) the mean is computed in exact
    decimal arithmetic (scale + 4 digits, half up), so it does not depend on
    summation order."""
    cols = list(cols)
    aggs = []
    for i, c in enumerate(cols):
        v = F.col(c).cast("double")
        mean = F.avg(v) if decimal_scale is None else \
            F.avg(F.col(c).cast(f"decimal(28,{decimal_scale})")).cast("double")
        aggs += [F.count(v).alias(f"count_{i}"), mean.alias(f"mean_{i}"), F.stddev_samp(v).alias(f"std_{i}"),
                 F.min(v).alias(f"min_{i}"), F.max(v).alias(f"max_{i}")]
    one = df.agg(*aggs)
    stack = ", ".join(f"'{c}', count_{i}, mean_{i}, std_{i}, min_{i}, max_{i}" for i, c in enumerate(cols))
    base = one.selectExpr(f"stack({len(cols)}, {stack}) AS (column, count, mean, std, min, max)")
    if approx:
        parts = [quantiles(df, c, [0.25, 0.5, 0.75], approx=True).select(F.lit(c).alias("column"), "q25", "q50", "q75")
                 for c in cols]
        q = parts[0]
        for p in parts[1:]:
            q = q.unionByName(p)
    else:
        q = column_quantiles(df, cols, [0.25, 0.5, 0.75]).drop("n")
    # per-column rows combined without a join: union, then max per column
    names = ["count", "mean", "std", "min", "max", "q25", "q50", "q75"]
    both = base.unionByName(q, allowMissingColumns=True).groupBy("column").agg(
        *[F.max(x).alias(x) for x in names])
    return both.select("column", "count", _r(F.col("mean"), digits).alias("mean"),
                       _r(F.col("std"), digits).alias("std"), "min",
                       _r(F.col("q25"), digits).alias("q25"), _r(F.col("q50"), digits).alias("q50"),
                       _r(F.col("q75"), digits).alias("q75"), "max")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram over [min, max] (last bin closed), every bin
    listed: bin, lower, upper, n. Bin membership follows the edges exactly."""
    v = F.col(col).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull())
    mm = vals.agg(F.min("v").alias("lo0"), F.max("v").alias("hi0"))

    def bounds(lo0, hi0):
        lo = F.when(lo0 == hi0, lo0 - 0.5).otherwise(lo0)
        hi = F.when(lo0 == hi0, hi0 + 0.5).otherwise(hi0)
        return lo.alias("_lo"), hi.alias("_hi")

    def edge(i):
        step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
        return F.when(i == bins, F.col("_hi")).otherwise(i * step + F.col("_lo"))

    # the bounds enter the rows once, as columns (one scalar subquery)
    lo0, hi0 = mm.select("lo0").scalar(), mm.select("hi0").scalar()
    x = F.col("v")
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    b0 = F.least(F.greatest(F.floor((x - F.col("_lo")) / step), F.lit(0)), F.lit(bins - 1))
    counted = (vals.select("v", *bounds(lo0, hi0))
               .withColumn("b0", b0)
               .withColumn("b1", F.when(x < edge(F.col("b0")), F.col("b0") - 1).otherwise(F.col("b0")))
               .withColumn("bin", F.when((F.col("b1") < bins - 1) & (x >= edge(F.col("b1") + 1)),
                                         F.col("b1") + 1).otherwise(F.col("b1")).cast("int"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    # The bin table has ``bins`` rows, derived from the one-row min/max.
    grid = mm.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
                     *bounds(F.col("lo0"), F.col("hi0")))
    return (grid.join(counted, "bin", "left")
            .select(F.col("bin").cast("int").alias("bin"),
                    edge(F.col("bin")).alias("lower"), edge(F.col("bin") + 1).alias("upper"),
                    F.coalesce(F.col("n"), F.lit(0)).alias("n")))


# --- Gaussian kernel density ------------------------------------------------------

_SQRT_2PI = math.sqrt(2.0 * math.pi)


def _kde_partials(points: int):
    def run(batches):
        acc = None
        meta = None
        for pdf in batches:
            if pdf.empty:
                continue
            if meta is None:
                meta = tuple(float(pdf[c].iat[0]) for c in ("lo", "hi", "bw", "n"))
                lo, hi, _, _ = meta
                grid = np.linspace(lo, hi, points)
                acc = np.zeros(points)
            bw = meta[2]
            x = pdf["v"].to_numpy(dtype=float)
            w = pdf["w"].to_numpy(dtype=float)
            for s in range(0, len(x), 2048):   # one bounded (grid x chunk) buffer, updated in place
                z = grid[:, None] - x[None, s:s + 2048]
                z /= bw
                np.square(z, out=z)
                z *= -0.5
                np.exp(z, out=z)
                acc += z @ w[s:s + 2048]
        if acc is not None:
            lo, hi, bw, n = meta
            yield pd.DataFrame({"i": np.arange(points, dtype=np.int32), "s": acc,
                                "lo": lo, "hi": hi, "bw": bw, "n": n})
    return run


def density(df: DataFrame, col: str, points: int = 1000) -> DataFrame:
    """Gaussian kernel density (Scott's bandwidth ``std·n^(-1/5)``, sample
    std) on ``points`` equally spaced values from ``min - range/2`` to
    ``max + range/2``: columns i, x, density.

    Work is vectorised per partition over distinct values with their counts
    (repeated prices are evaluated once); each task returns one partial sum
    per grid point and a grouped sum combines them."""
    v = F.col(col).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull())
    st = vals.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                  F.min("v").alias("mn"), F.max("v").alias("mx"))
    n, sd = st.select("n").scalar(), st.select("sd").scalar()
    mn, mx = st.select("mn").scalar(), st.select("mx").scalar()
    bw = sd * F.pow(n.cast("double"), F.lit(-0.2))
    lo, hi = mn - (mx - mn) * 0.5, mx + (mx - mn) * 0.5
    # The kernel sums cost (grid points x distinct values) CPU but little
    # data, so size-based coalescing would leave one task doing all of it:
    # spread the distinct values over every core (hash on v: deterministic).
    cores = max(1, df.sparkSession.sparkContext.defaultParallelism)
    weighted = (vals.groupBy("v").agg(F.count(F.lit(1)).cast("double").alias("w"))
                .repartition(cores, "v")
                .select("v", "w", lo.alias("lo"), hi.alias("hi"), bw.alias("bw"), n.cast("double").alias("n")))
    partial = weighted.mapInPandas(_kde_partials(points), "i int, s double, lo double, hi double, bw double, n double")
    # the grid parameters travel with the partial sums (equal in every row)
    sums = partial.groupBy("i").agg(F.sum("s").alias("s"), *[F.max(c).alias(c) for c in ("lo", "hi", "bw", "n")])
    step = (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))
    x = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(F.col("i") * step + F.col("lo"))
    return sums.select("i", x.alias("x"),
                       (F.col("s") / (F.col("n") * F.col("bw") * F.lit(_SQRT_2PI))).alias("density"))


#: bins per bandwidth, and bandwidths beyond which a kernel counts as 0 (its height there is below 1e-15 of its top)
BINS_PER_BANDWIDTH, REACH = 512, 8.5


def density_binned(df: DataFrame, col: str, points: int = 1000) -> DataFrame:
    """``density`` in linear time, in expressions alone: columns i, x, density.

    Values are put into bins of 1/512 bandwidth by linear binning (a value
    between two bin centres counts for each by its nearness), and every
    occupied bin adds its kernel to the grid points within REACH bandwidths.
    One pass over the values with map-side sums; the rest depends on occupied
    bins and points, not on how many distinct values there are. The error is at
    most (1/512)**2 / 8 < 5e-7 of the kernel's top, and so below 1e-6 of the
    largest density."""
    v = F.col(col).cast("double")
    vals = df.select(v.alias("v")).where(F.col("v").isNotNull())
    st = vals.agg(F.count(F.lit(1)).cast("double").alias("n"), F.stddev_samp("v").alias("sd"), F.min("v").alias("mn"), F.max("v").alias("mx"))
    st = st.select("n", (F.col("sd") * F.pow("n", F.lit(-0.2))).alias("bw"), (F.col("mn") - (F.col("mx") - F.col("mn")) * 0.5).alias("lo"),
                   (F.col("mx") + (F.col("mx") - F.col("mn")) * 0.5).alias("hi"))
    st = stage_table(st, "spread")  # one row, read by both steps
    n, bw, lo, hi = (st.select(c).scalar() for c in st.columns)
    place = vals.select(((F.col("v") - lo) / bw * BINS_PER_BANDWIDTH).alias("p")).where(F.col("p").isNotNull())
    low = F.floor("p")
    halves = F.array(F.struct(low.alias("bin"), (1 - (F.col("p") - low)).alias("w")), F.struct((low + 1).alias("bin"), (F.col("p") - low).alias("w")))
    bins = place.select(F.inline(halves)).groupBy("bin").agg(F.sum("w").alias("w"))
    step = (hi - lo) / F.lit(float(points - 1))
    at = bins.select((F.col("bin") / F.lit(float(BINS_PER_BANDWIDTH))).alias("u"), "w", (step / bw).alias("h"))  # in bandwidths from lo
    first = F.greatest(F.lit(0), F.ceil((F.col("u") - REACH) / F.col("h"))).cast("int")
    last = F.least(F.lit(points - 1), F.floor((F.col("u") + REACH) / F.col("h"))).cast("int")
    near = at.withColumn("first", first).withColumn("last", last).where("first <= last").select(
        "u", "w", "h", F.explode(F.sequence("first", "last")).alias("i"))
    sums = near.groupBy("i").agg(F.sum(F.col("w") * F.exp(-0.5 * F.pow(F.col("i") * F.col("h") - F.col("u"), 2))).alias("s"))
    grid = st.select(F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"), "n", "bw", "lo", "hi").where("bw > 0")
    x = F.when(F.col("i") == points - 1, F.col("hi")).otherwise(F.col("i") * ((F.col("hi") - F.col("lo")) / F.lit(float(points - 1))) + F.col("lo"))
    return grid.join(sums, "i", "left").select(
        "i", x.alias("x"), (F.coalesce("s", F.lit(0.0)) / (F.col("n") * F.col("bw") * F.lit(_SQRT_2PI))).alias("density"))


# --- D'Agostino–Pearson K² ---------------------------------------------------------

def normality_test(df: DataFrame, col: str, digits: int | None = None) -> DataFrame:
    """One row: n, skew (biased g1), kurtosis (Pearson b2), z_skew, z_kurt,
    k2 = z_skew² + z_kurt², p_value = exp(-k2/2) (χ² with 2 d.f.).

    Moments come from Spark's one-pass ``skewness``/``kurtosis`` aggregates
    (population forms), so the test needs a single scan."""
    v = F.col(col).cast("double")
    return normality_of(df.agg(F.count(v).cast("double").alias("n"), F.skewness(v).alias("g1"),
                               (F.kurtosis(v) + 3.0).alias("b2")), digits)


def normality_of(m: DataFrame, digits: int | None = None) -> DataFrame:
    """The normality test of every row of ``m(n, g1, b2)``: count, skewness and kurtosis."""
    n, g1, b2 = F.col("n"), F.col("g1"), F.col("b2")
    sqrt, log, pw = F.sqrt, F.log, F.pow
    # skewness z-score
    y = g1 * sqrt(((n + 1) * (n + 3)) / (6.0 * (n - 2)))
    beta2 = (3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.lit(-1.0) + sqrt(2 * (beta2 - 1))
    delta = 1 / sqrt(0.5 * log(w2))
    alpha = sqrt(2.0 / (w2 - 1))
    y = F.when(y == 0, F.lit(1.0)).otherwise(y)
    z_skew = delta * log(y / alpha + sqrt(pw(y / alpha, 2) + 1))
    # kurtosis z-score
    e = 3.0 * (n - 1) / (n + 1)
    varb2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1.0) * (n + 3) * (n + 5))
    xk = (b2 - e) / sqrt(varb2)
    sb1 = (6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
           * sqrt((6.0 * (n + 3) * (n + 5)) / (n * (n - 2) * (n - 3))))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + sqrt(1 + 4.0 / pw(sb1, 2)))
    term1 = 1 - 2 / (9.0 * a)
    denom = 1 + xk * sqrt(2 / (a - 4.0))
    term2 = F.when(denom == 0, F.lit(float("nan"))).otherwise(
        F.signum(denom) * pw((1 - 2.0 / a) / F.abs(denom), 1 / 3.0))
    z_kurt = (term1 - term2) / sqrt(2 / (9.0 * a))
    out = m.select(n.cast("bigint").alias("n"), g1.alias("skew"), b2.alias("kurtosis"),
                   z_skew.alias("z_skew"), z_kurt.alias("z_kurt"))
    out = out.select("*", (pw(F.col("z_skew"), 2) + pw(F.col("z_kurt"), 2)).alias("k2"))
    out = out.select("*", F.exp(-F.col("k2") / 2).alias("p_value"))
    if digits is not None:
        out = out.select("n", *[F.round(c, digits).alias(c) for c in out.columns if c != "n"])
    return out
