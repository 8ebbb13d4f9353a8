"""Mergeable summaries and the binned density against direct computations."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwatch.operators import stats as St, summaries as Su


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(5)
    rows = [(int(d), float(np.exp(rng.normal(2, 0.7))), int(rng.integers(0, 900))) for d in rng.integers(0, 40, 6000)]
    rows += [(40, 5.0, 1), (41, 2.0, 1), (41, 2.0, None), (42, None, 5), (None, 3.0, 7)]
    return spark.createDataFrame(rows, "day int, v double, k int").repartition(6).cache()


def test_merged_quantile_sketches_stay_within_their_error(table):
    daily = Su.quantile_sketches(table, "day", "v")
    merged = Su.merge_quantile_sketches(daily, (F.floor(F.col("day") / 20)).alias("span"))
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    for r in Su.sketched_quantiles(merged, probs).collect():
        mine = np.sort([x.v for x in table.where(F.floor(F.col("day") / 20).eqNullSafe(F.lit(r.span))).collect() if x.v is not None])
        assert (r.n, r.low, r.high) == (len(mine), mine[0], mine[-1])
        for p, q in zip(probs, r.quantiles):
            lo, hi = np.searchsorted(mine, q, "left") / len(mine), np.searchsorted(mine, q, "right") / len(mine)
            assert lo - Su.RANK_ERROR - 1 / len(mine) <= p <= hi + Su.RANK_ERROR + 1 / len(mine)


def test_merged_distinct_sketches(table):
    merged = Su.sketched_distinct(Su.merge_distinct_sketches(Su.distinct_sketches(table, "day", "k"), F.lit(1).alias("all"))).first()
    want = table.select("k").distinct().where("k IS NOT NULL").count()
    assert abs(merged.n_distinct - want) <= 0.04 * want


def test_merged_moments_give_the_direct_test(table):
    parts = Su.merge_moments(Su.moments(table, "day", "v"), F.lit(1).alias("all"))
    got, want = Su.normality_of_moments(parts).first(), St.normality_test(table, "v").first()
    for c in want.asDict():
        assert got[c] == pytest.approx(want[c], rel=1e-9)
    halves = Su.merge_moments(Su.moments(table, "day", "v"), (F.col("day") % 2).alias("odd"))
    again = Su.merge_moments(halves, F.lit(1).alias("all")).first()
    assert again.m4 == pytest.approx(parts.first().m4, rel=1e-9) and halves.count() == 3


def test_binned_density_is_the_direct_sum(table):
    a = {r.i: r for r in St.density(table, "v", 200).collect()}
    b = {r.i: r for r in St.density_binned(table, "v", 200).collect()}
    top = max(r.density for r in a.values())
    assert a.keys() == b.keys()
    assert max(abs(a[i].density - b[i].density) for i in a) <= 1e-6 * top and all(a[i].x == b[i].x for i in a)


def test_binned_density_of_nothing_and_of_one_value(spark):
    assert St.density_binned(spark.createDataFrame([], "v double"), "v").count() == 0
    assert St.density_binned(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v").count() == 0
