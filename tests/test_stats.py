"""Statistics against numpy references."""

import math

import numpy as np
import pytest

from shelfwatch.operators import quality as Qy, stats as St


@pytest.fixture(scope="module")
def values():
    rng = np.random.default_rng(7)
    x = np.round(np.concatenate([rng.lognormal(1.0, 0.6, 1500), [250.0, 400.0, 3.0, 3.0]]), 2)
    return x


@pytest.fixture(scope="module")
def vdf(spark, values):
    return spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(7)


def test_exact_quantiles_match_numpy(vdf, values):
    got = St.quantiles(vdf, "v", [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]).first()
    want = np.percentile(values, [0, 10, 25, 50, 75, 100])
    assert got.n == len(values)
    for name, w in zip(["q0", "q10", "q25", "q50", "q75", "q100"], want):
        assert got[name] == pytest.approx(w, rel=1e-12)


def test_exact_quantiles_of_columns_longer_than_the_sketch(spark):
    n, ps = 60_000, [0.0003, 0.25, 0.2501, 0.5, 0.9, 0.9998]
    rng = np.random.default_rng(5)
    cols = {"a": rng.normal(size=n), "b": np.where(rng.random(n) < 0.4, 7.0, np.round(rng.lognormal(2, 1, n), 1)),
            "c": np.sort(rng.random(n))}
    df = spark.createDataFrame(list(zip(*[c.tolist() for c in cols.values()])), "a double, b double, c double").repartition(9)
    got = {r["column"]: r for r in St.column_quantiles(df, list(cols), ps).collect()}
    for name, x in cols.items():
        assert got[name]["n"] == n
        assert [got[name][St._pname(p)] for p in ps] == pytest.approx(np.percentile(x, [100 * p for p in ps]), rel=1e-12)


def test_approx_quantiles_close(vdf, values):
    got = St.quantiles(vdf, "v", [0.5], approx=True).first()
    assert abs(got.q50 - np.median(values)) / np.median(values) < 0.02


def test_fences_outliers_whiskers(vdf, values):
    q1, q3 = np.percentile(values, [25, 75])
    iqr = q3 - q1
    f = St.iqr_fences(vdf, "v").first()
    assert f.far_out == pytest.approx(q3 + 3 * iqr)
    out = [r.v for r in St.outliers_above(vdf, "v").collect()]
    assert out == sorted(v for v in values if v > q3 + 3 * iqr)
    w = St.boxplot_whiskers(vdf, "v").first()
    inside = values[(values >= q1 - 1.5 * iqr) & (values <= q3 + 1.5 * iqr)]
    assert (w.whisker_low, w.whisker_high) == (inside.min(), inside.max())
    assert w.n_above == int((values > q3 + 1.5 * iqr).sum())


def test_histogram_matches_numpy(spark, vdf, values):
    got = St.histogram(vdf, "v", 10).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=10)
    assert [r.n for r in got] == list(counts)
    assert [r.lower for r in got] == pytest.approx(list(edges[:-1]))
    one = spark.createDataFrame([(5.0,), (5.0,)], "v double")
    assert [r.n for r in St.histogram(one, "v", 10).orderBy("bin").collect()] == list(np.histogram([5.0, 5.0], 10)[0])


def test_density_matches_direct_sum(vdf, values):
    got = St.density(vdf, "v", 50).orderBy("i").collect()
    n, sd = len(values), values.std(ddof=1)
    bw = sd * n ** -0.2
    lo, hi = values.min() - (values.max() - values.min()) / 2, values.max() + (values.max() - values.min()) / 2
    grid = np.linspace(lo, hi, 50)
    want = np.exp(-0.5 * ((grid[:, None] - values[None, :]) / bw) ** 2).sum(axis=1) / (n * bw * math.sqrt(2 * math.pi))
    assert [r.x for r in got] == pytest.approx(list(grid))
    assert [r.density for r in got] == pytest.approx(list(want), rel=1e-9)


def _k2(x):
    n = len(x)
    d = x - x.mean()
    m2, m3, m4 = (d ** 2).mean(), (d ** 3).mean(), (d ** 4).mean()
    g1, b2 = m3 / m2 ** 1.5, m4 / m2 ** 2
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = -1 + math.sqrt(2 * (beta2 - 1))
    delta, alpha = 1 / math.sqrt(0.5 * math.log(w2)), math.sqrt(2.0 / (w2 - 1))
    zs = delta * math.log(y / alpha + math.sqrt((y / alpha) ** 2 + 1))
    e = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    xk = (b2 - e) / math.sqrt(var)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + math.sqrt(1 + 4.0 / sb1 ** 2))
    den = 1 + xk * math.sqrt(2 / (a - 4.0))
    zk = ((1 - 2 / (9.0 * a)) - math.copysign(abs((1 - 2.0 / a) / den) ** (1 / 3), den)) / math.sqrt(2 / (9.0 * a))
    return zs, zk, zs * zs + zk * zk


def test_normality_matches_formula_and_separates(spark, vdf, values):
    r = St.normality_test(vdf, "v").first()
    zs, zk, k2 = _k2(values)
    assert (r.z_skew, r.z_kurt, r.k2) == pytest.approx((zs, zk, k2), rel=1e-9)
    assert r.p_value < 1e-6                                   # log-normal with outliers
    rng = np.random.default_rng(3)
    normal = spark.createDataFrame([(float(v),) for v in rng.normal(10, 2, 3000)], "v double")
    assert St.normality_test(normal, "v").first().p_value > 0.01


def test_describe_and_profile(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("a", 3.0), (None, 2.0)], "s string, x double")
    d = St.describe_numeric(df, ["x"]).first()
    assert (d["count"], d.mean, d["min"], d.q50, d["max"]) == (3, 2.0, 1.0, 2.0, 3.0)
    prof = {r.column: (r.dtype, r.n_rows, r.n_non_null, r.n_null) for r in Qy.profile_columns(df).collect()}
    assert prof == {"s": ("string", 4, 3, 1), "x": ("double", 4, 3, 1)}
    m = Qy.describe_categorical(df, ["s"]).first()
    assert (m["count"], m.unique, m.top, m.freq) == (3, 2, "a", 2)
    tie = spark.createDataFrame([("b",), ("a",)], "s string")
    assert Qy.describe_categorical(tie, ["s"]).first().top == "a"    # tie -> smallest value


def test_duplicates_and_ids_concat(spark):
    df = spark.createDataFrame([("1", "d1"), ("1", "d1"), ("2", "d1"), (None, "d1"), (None, "d1")], "p string, d string")
    assert [tuple(r) for r in Qy.duplicate_keys(df, ["p", "d"]).collect()] == [("1", "d1", 2)]
    assert Qy.rows_with_duplicate_keys(df, ["p", "d"]).count() == 2
    assert Qy.ids_concat(df, "d", "p").first().ids == "1,2"
    ok, bad = Qy.completeness_split(df, ["p"])
    assert (ok.count(), bad.first().reject_reason) == (3, "p")


def test_preview_is_top_k_in_total_order(spark):
    df = spark.createDataFrame([(3, "c"), (1, "b"), (1, "a"), (None, "z")], "k int, v string")
    assert [tuple(r) for r in Qy.preview(df, 3, ["k"]).collect()] == [(1, "a"), (1, "b"), (3, "c")]
