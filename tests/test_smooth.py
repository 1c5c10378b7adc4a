import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratalake import dims
from stratalake.operators import blocks, series, smooth


def frame(spark, values, key="a"):
    return spark.createDataFrame([(key, float(i), None if v is None else float(v)) for i, v in enumerate(values)], "k string, t double, v double")


def run(spark, values, **options):
    return smooth.smooth(frame(spark, values), ["k"], ["t"], "v", **options).orderBy("t").toPandas()


@pytest.mark.parametrize("n", [1, 2, 10, 11, 12, 40])
def test_median_and_short_series(spark, n):
    values = list(np.random.default_rng(n).normal(size=n))
    got = run(spark, values)
    want = pd.Series(values).rolling(11, center=True, min_periods=1).median()
    np.testing.assert_allclose(got["median"], want, rtol=1e-12)
    assert got.savgol.notna().all() == (n >= 11) and got.savgol.isna().all() == (n < 11)


def test_savgol_keeps_quadratics_and_constants(spark):
    t = np.arange(30.0)
    np.testing.assert_allclose(run(spark, list(3 * t * t - 2 * t + 7)).savgol, 3 * t * t - 2 * t + 7, atol=1e-8)
    got = run(spark, [4.5] * 15)
    np.testing.assert_allclose(got["median"], 4.5)
    np.testing.assert_allclose(got.savgol, 4.5)


def test_savgol_against_polynomial_fits(spark):
    v = np.random.default_rng(3).normal(size=25)
    want = []
    for i in range(25):
        start = min(max(i - 5, 0), 14)
        want.append(np.polyval(np.polyfit(np.arange(11) - (i - start), v[start : start + 11], 2), 0))
    np.testing.assert_allclose(run(spark, list(v)).savgol, want, atol=1e-9)


def test_interior_weights():
    middle = [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]
    np.testing.assert_allclose(dims.savgol_weights()[5], np.array(middle) / 429, atol=1e-12)
    with pytest.raises(ValueError):
        dims.savgol_weights(10, 2)


@pytest.mark.parametrize("block", [1, 7, 50])
def test_blocks_give_the_plain_result(spark, block):
    rng = np.random.default_rng(block)
    rows = [(k, float(t), i, float(rng.normal())) for k, n in (("a", 60), ("b", 5), ("c", 1)) for i, t in enumerate(np.sort(rng.integers(0, 20, n)))]
    df = spark.createDataFrame(rows, "k string, t double, id int, v double")
    a, b = (smooth.smooth(df, ["k"], ["t", "id"], "v", block_rows=x).orderBy("k", "t", "id").toPandas() for x in (None, block))
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, atol=1e-9)


def test_nulls_in_the_value(spark):
    got = run(spark, [1.0, None, 3.0] + [5.0] * 20)
    assert got["median"][0] == 5.0 and got.savgol.isna().sum() == 7 and len(got) == 23


def test_empty(spark):
    assert smooth.smooth(frame(spark, [0.0]).where("false"), ["k"], ["t"], "v", block_rows=10).count() == 0


def test_variants(spark):
    got = smooth.smoothing_variants(frame(spark, [1.0] * 12), ["k"], ["t"], "v", ["t"]).groupBy("variant").agg(F.count("*").alias("n")).collect()
    assert {r.variant: r.n for r in got} == {"unsmoothed": 12, "smooth11": 12, "savgol11p2": 12}


def odd_series(spark, n=400):
    """Null keys, null and tied orders, and an outlier far from all else."""
    rows = [(k, None if i % 50 == 0 else float(i // 100), i, float(i % 13)) for k in ("a", None) for i in range(n)] + [("a", 1e12, -1, 5.0)]
    return spark.createDataFrame(rows, "k string, t double, id int, v double")


def test_blocks_keep_nulls_ties_and_outliers(spark):
    df = odd_series(spark)
    a, b = (smooth.smooth(df, ["k"], ["t", "id"], "v", block_rows=x).orderBy("k", "t", "id").toPandas() for x in (None, 16))
    assert len(b) == 801
    pd.testing.assert_frame_equal(a, b[a.columns], check_exact=False, atol=1e-9)
    for f in (lambda x: series.with_sequence(df, ["k"], ["t", "id"], block_rows=x), lambda x: series.find_gaps(df, ["k"], ["t", "id"], 0.5, "t", "v", block_rows=x)):
        assert sorted(map(str, f(None).collect())) == sorted(map(str, f(16).select(*f(None).columns).collect()))


def test_parts_are_balanced(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(blocks, "stored", lambda df, name: seen.append(df) or df.persist())
    df = odd_series(spark, 2000)
    blocks.with_position(df, ["k"], ["t", "id"], 100, df.count()).count()
    sizes = [r["count"] for r in seen[0].groupBy("_part").count().collect()]
    seen[0].unpersist()
    assert len(sizes) > 30 and max(sizes) < 300


@pytest.mark.parametrize("window", [23, 101])
@pytest.mark.parametrize("block", [None, 40])
def test_wide_windows_against_the_plain_ones(spark, window, block):
    rng = np.random.default_rng(window)
    rows = [(k, i, None if rng.random() < 0.004 else float(1e6 + rng.normal()), f"{k}{i}") for k, n in (("a", 300), (None, 150), ("c", 22), ("d", 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, t int, v double, other string")
    got = smooth.smooth(df, ["k"], ["t"], "v", window=window, block_rows=block).toPandas()
    assert list(got.columns) == ["k", "t", "v", "other", "median", "savgol"] and sorted(got.other) == sorted(r[3] for r in rows)
    hat = np.array(dims.savgol_weights(window, 2))
    for key, mine in got.groupby("k", dropna=False):
        mine = mine.sort_values("t")
        v, n, mid = mine.v.to_numpy(), len(mine), window // 2
        np.testing.assert_array_equal(mine["median"], [np.nanmedian(v[max(0, i - mid) : i + mid + 1]) for i in range(n)])
        starts = [min(max(i - mid, 0), n - window) for i in range(n)]
        want = [hat[i - s] @ (v[s : s + window] - 1e6) + 1e6 if n >= window else np.nan for i, s in enumerate(starts)]  # the matrix is exact to some 1e-13 of the values
        np.testing.assert_allclose(mine.savgol.astype(float), want, rtol=0, atol=1e-9)


def test_even_wide_median_and_wrong_fits(spark):
    df = spark.createDataFrame([("a", i, float(i * i % 17)) for i in range(60)], "k string, t int, v double")
    got = smooth.rolling_median(df, ["k"], ["t"], "v", window=24).orderBy("t").toPandas()
    np.testing.assert_array_equal(got["median"], [np.median(got.v[max(0, i - 12) : i + 12]) for i in range(60)])
    with pytest.raises(ValueError):
        smooth.savgol(df, ["k"], ["t"], "v", window=24)
    assert smooth.smooth(df.where("false"), ["k"], ["t"], "v", window=101).count() == 0


def test_only_long_keys_are_cut(spark):
    df = spark.createDataFrame([("a", i) for i in range(50)] + [(None, i) for i in range(30)] + [("b", 1)], "k string, t int")
    short, long, n = blocks.split_long(df, ["k"], 20)
    assert n == 80 and long.count() == 80 and [r.k for r in short.collect()] == ["b"]
    assert blocks.split_long(df, ["k"], 50)[1] is None and blocks.split_long(df, ["k"], None)[1] is None
