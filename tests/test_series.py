"""Golden decomposition (FIXTURES 3a) and forecast sanity."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import series

OBSERVED = [
    2857.59, 8781.07, 9951.8, 19801.25, 25416.56, 30582.13, 28540.83, 36774.35, 48148.15, 47086.28, 56753.26,
    61676.34, 80133.83, 70524.34, 73731.94, 102383.07, 99810.96, 115536.16, 114806.1, 114346.13, 125265.23,
    137286.62, 139813.62, 177654.77, 179728.16, 156337.96, 156238.52, 188685.94, 203447.03, 213925.23, 207891.26,
    212056.63, 236031.17, 252866.57, 269423.32, 324959.53, 335497.14, 286892.48, 284104.13, 349648.98, 349512.56,
    397101.34, 398544.63, 455589.9, 476780.7, 516231.11, 598502.76, 739415.69, 837464.43, 23336.18,
]
TREND_HEAD = [34583.9775, 40376.457083333335, 45606.599166666674]
TREND_TAIL = 463167.5466666667
SEASONAL = [0.9245019156921519, 0.8778414849531343, 1.0506511853550384, 1.0007393097124144, 1.037976915035349,
            0.9254366394552364, 0.9498833149219178, 1.0119307581958366, 0.9825562392486186, 0.9969607159849885,
            1.104651983523304, 1.13686953792201]


def _dates(n, start=dt.date(2020, 12, 1)):
    out, y, m = [], start.year, start.month
    for _ in range(n):
        out.append(dt.date(y, m, 1))
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame(list(zip(_dates(len(OBSERVED)), OBSERVED)), "date date, value double")


def test_decomposition_matches_published(golden):
    d = series.decompose(golden).orderBy("date").collect()
    assert all(r.trend is None for r in d[:6]) and all(r.trend is None for r in d[-6:])
    for got, want in zip([r.trend for r in d[6:9]], TREND_HEAD):
        assert got == pytest.approx(want, rel=1e-14)
    assert d[-7].trend == pytest.approx(TREND_TAIL, rel=1e-14)
    for r in d[6:-6]:
        assert r.residual == pytest.approx(r.observed / r.seasonal / r.trend, rel=1e-14)


def test_seasonal_indices_match_published(golden):
    si = series.seasonal_indices(series.decompose(golden)).orderBy("month").collect()
    for got, want in zip([r.seasonal_index for r in si], SEASONAL):
        assert got == pytest.approx(want, rel=1e-13)
    assert [r.month_name for r in si][:3] == ["Jan", "Feb", "Mar"]


def test_forecasts_have_horizon_and_bands(golden):
    ar = series.forecast_ar(golden).collect()
    assert len(ar) == 12 and all(r.lower <= r.forecast <= r.upper for r in ar)
    st = series.forecast_seasonal_trend(golden)
    assert st.where("is_forecast").count() == 12 and st.where("NOT is_forecast").count() == len(OBSERVED)
    m = series.holdout_metrics(golden).collect()
    assert {r.model for r in m} == {"seasonal_trend", "ar"} and all(r.mae >= 0 for r in m)


def test_many_series_in_one_job(spark, golden):
    from pyspark.sql import functions as F

    two = golden.withColumn("k", F.lit("a")).unionByName(golden.withColumn("k", F.lit("b")))
    d = series.decompose(two, ["k"])
    a = {r.date: r.trend for r in d.where("k = 'a'").collect()}
    b = {r.date: r.trend for r in d.where("k = 'b'").collect()}
    assert a == b


def test_arma_grid_picks_min_aic(golden):
    fc, aic = series.forecast_arma_grid(golden)
    rows = aic.collect()
    assert {(r.p, r.q) for r in rows} <= set(series.ARMA_ORDERS) and rows
    best = min(rows, key=lambda r: (r.aic, r.p + r.q, r.p))
    f = fc.orderBy("step").collect()
    assert len(f) == 12 and {(r.p, r.q) for r in f} == {(best.p, best.q)}
    assert all(r.lower <= r.forecast <= r.upper for r in f)


def test_short_series_is_additive_with_half_period(spark):
    vals = [10.0, 12.0, 9.0, 14.0, 11.0, 13.0, 10.0, 15.0, 12.0, 14.0]
    df = spark.createDataFrame(list(zip(_dates(len(vals)), vals)), "date date, value double")
    d = series.decompose(df).orderBy("date").collect()
    assert {r.model for r in d} == {"additive"} and {r.period for r in d} == {5}
    # odd period 5: plain 5-point centred mean, 2 NULLs at each end
    assert [r.trend is None for r in d] == [True, True] + [False] * 6 + [True, True]
    assert d[2].trend == pytest.approx(sum(vals[0:5]) / 5)
    for r in d[2:-2]:
        assert r.observed == pytest.approx(r.trend + r.seasonal + r.residual)


def test_month_over_month_and_cumulative_match_published(spark):
    # published monthly business summary, first four months (revenue, active customers -> MoM %, cumulative)
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from tidemark.functions.core import pct_change

    rows = [("2020-12", 2857.5899999999997, 3), ("2021-01", 8781.07, 16), ("2021-02", 9951.8, 23), ("2021-03", 19801.25, 48)]
    df = spark.createDataFrame(rows, "month string, revenue double, active_customers long")
    w = Window.orderBy("month")
    out = df.select(
        "month",
        pct_change("revenue", w).alias("revenue_mom"),
        pct_change("active_customers", w).alias("customer_mom"),
        F.sum(F.col("revenue").cast("decimal(38,4)")).over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("double").alias("cum"),
    ).orderBy("month").collect()
    assert out[0].revenue_mom is None  # the reference fills it with 0 afterwards
    assert out[1].revenue_mom == 207.28935921528281 and out[1].customer_mom == 433.3333333333333
    assert out[2].revenue_mom == 13.332429874719143 and out[2].customer_mom == 43.75
    assert out[3].revenue_mom == 98.9715428364718 and out[3].customer_mom == 108.69565217391303
    assert [r.cum for r in out] == pytest.approx([2857.59, 11638.66, 21590.46, 41391.71], abs=1e-9)


def _series(spark, values, start=dt.date(2020, 1, 1)):
    return spark.createDataFrame(list(zip(_dates(len(values), start), map(float, values))), "date date, value double")


def _many(spark, by_key):
    rows = [(k, d, float(v)) for k, values in by_key.items() for d, v in zip(_dates(len(values), dt.date(2020, 1, 1)), values)]
    return spark.createDataFrame(rows, "k string, date date, value double")


WAVE = [100, 110, 95, 105, 90, 115, 100, 108, 97, 103, 92, 113]
AWKWARD = {
    "one": [5.0],
    "three": [1.0, 2.0, 4.0],
    "nine": [3, 5, 4, 6, 5, 7, 6, 8, 7],
    "eighteen": (WAVE * 2)[:18],
    "twentyfive": (WAVE * 3)[:25],
    "long": [v * (1 + 0.01 * i) for i, v in enumerate(WAVE * 3)],
    "constant": [7.0] * 30,
    "zero month": [0 if i % 12 == 3 else v for i, v in enumerate(WAVE * 3)],
    "zero start": [0.0] * 14 + [50.0 + i for i in range(22)],
}


def test_every_series_gets_a_forecast(spark):
    df = _many(spark, AWKWARD)
    for fc in (series.forecast_ar(df, ["k"], 6), series.forecast_seasonal_trend(df, ["k"], 6).where("is_forecast")):
        rows = fc.collect()
        got = {k: [r.forecast for r in sorted(rows, key=lambda r: r.date) if r.k == k] for k in AWKWARD}
        for k, values in got.items():
            assert len(values) == 6 and all(v is not None for v in values), k
        # forecasts stay near the level of the series
        assert all(85 < v < 120 for v in got["eighteen"] + got["twentyfive"])
        assert got["constant"] == pytest.approx([7.0] * 6)
        assert all(v == pytest.approx(5.0) for v in got["one"])
    st = series.stationarity(df, ["k"]).collect()
    # the rows of the regression and the lags before them are all changes of the series
    assert {r.k: r.n_obs + (r.lags or 0) for r in st if r.adf_statistic is not None} == {r.k: len(AWKWARD[r.k]) - 1 for r in st if r.adf_statistic is not None}
    assert {r.k for r in st} == set(AWKWARD)
    assert {r.k for r in st if r.adf_statistic is None} >= {"one", "three", "constant"}


def test_a_series_alone_and_among_others_is_the_same(spark):
    df = _many(spark, AWKWARD)
    rows = lambda d: {r.date: (r.forecast, r.lower, r.upper) for r in d.collect()}
    for k in ("eighteen", "long"):
        one = _series(spark, AWKWARD[k])
        for f in (series.forecast_ar, series.forecast_seasonal_trend):
            assert rows(f(one)) == rows(f(df, ["k"]).where(f"k = '{k}'").drop("k"))


def test_additive_offsets_are_added(spark):
    values = (WAVE * 2)[:18]
    df = _series(spark, values)
    fit = {r.date: r.forecast for r in series.forecast_seasonal_trend(df, horizon=3).collect()}
    d = {r.date: r for r in series.decompose(df).collect()}
    assert {r.model for r in d.values()} == {"additive"} and {r.period for r in d.values()} == {9}
    dates = sorted(d)
    level = [fit[x] - d[x].seasonal for x in dates]
    steps = [b - a for a, b in zip(level, level[1:])]
    assert steps == pytest.approx([steps[0]] * len(steps))  # what is left is a line
    ahead = sorted(x for x in fit if x > dates[-1])
    assert fit[ahead[0]] == pytest.approx(level[-1] + steps[0] + d[dates[18 - 9]].seasonal)
    si = {r.month: r.seasonal_index for r in series.seasonal_indices(series.decompose(_series(spark, [1, 2, 3]))).collect()}
    assert set(si.values()) == {0.0}


def test_zero_first_trend_is_null(spark):
    g = series.trend_growth(series.decompose(_series(spark, AWKWARD["zero start"]))).first()
    assert g.trend_start == 0.0 and g.trend_growth_pct is None


def test_holdout_reports_short_series(spark):
    m = {(r.k, r.model): r for r in series.holdout_metrics(_many(spark, AWKWARD), ["k"]).collect()}
    assert len(m) == 2 * len(AWKWARD)
    assert m["three", "ar"].mae is None and m["long", "seasonal_trend"].mape < 10
    assert m["constant", "ar"].mae == pytest.approx(0.0, abs=1e-9)


def test_arma_grid_reports_every_series(spark):
    fc, aic = series.forecast_arma_grid(_many(spark, AWKWARD), ["k"], 4)
    rows = fc.collect()
    assert {k: sum(r.k == k for r in rows) for k in AWKWARD} == {k: 4 for k in AWKWARD}
    status = {r.k: r.status for r in rows}
    assert status["constant"] == "constant" and status["nine"] == "short" and status["long"] == "ok"
    assert all(r.forecast is not None for r in rows)
    assert {r.k for r in aic.where("aic is null").collect()} <= {"constant", "one", "three"}


def test_white_noise_mostly_picks_the_mean_model(spark):
    import numpy as np

    rng = np.random.default_rng(5)
    by_key = {f"s{i}": rng.normal(1000, 100, 80).tolist() for i in range(20)}
    df = _many(spark, by_key)
    zero = df.select("k").distinct().selectExpr("k", "0 as d")
    picked = [(r.p, r.q) for r in series.forecast_arma_grid(df, ["k"], 1, zero)[0].collect()]
    assert picked.count((0, 0)) >= 10 and sum(q == 3 for _, q in picked) <= 4


def test_arma_grid_needs_no_package_on_the_workers(tmp_path):
    import os
    import subprocess
    import sys

    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import os, sys
sys.path.insert(0, {here!r})
from tidemark.session import local_session
from tidemark.operators import series
spark = local_session(2)
df = spark.sql("select add_months(date'2020-01-01', cast(id as int)) date, 100 + 10 * sin(id) + rand(3) value from range(40)")
assert series.forecast_arma_grid(df)[0].count() == 12
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=300)


def _adf(y):
    """The augmented test by numpy least squares: (statistic, lags, rows)."""
    import numpy as np

    y = np.asarray(y, float)
    n, dy = len(y), np.diff(y)

    def fit(lags, start):
        t = np.arange(start, n)
        x = np.column_stack([np.ones(len(t)), y[t - 1], *(dy[t - 1 - i] for i in range(1, lags + 1))])
        beta, _, _, _ = np.linalg.lstsq(x, dy[t - 1], rcond=None)
        sse = ((dy[t - 1] - x @ beta) ** 2).sum()
        return beta[1], sse, x

    most = min(int(np.ceil(12 * (n / 100) ** 0.25)), n // 2 - 2)
    rows = n - 1 - most
    aic = [rows * np.log(fit(p, most + 1)[1] / rows) + 2 * (p + 2) for p in range(most + 1)]
    lags = int(np.argmin(aic))
    slope, sse, x = fit(lags, lags + 1)
    rows = len(x)
    se = np.sqrt(sse / (rows - lags - 2) * np.linalg.inv(x.T @ x)[1, 1])
    return slope / se, lags, rows


def test_augmented_dickey_fuller_equals_plain_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(11)
    noise = rng.normal(size=(4, 90))
    ar3 = list(noise[0][:3])
    for e in noise[0][3:]:
        ar3.append(0.5 * ar3[-1] - 0.3 * ar3[-2] + 0.4 * ar3[-3] + e)
    by_key = {
        "walk": 1e6 + 1e4 * noise[1].cumsum(),
        "still": 50 + noise[2],
        "ar3": np.array(ar3),
        "season": 100 + 20 * np.sin(np.arange(60) * np.pi / 6) + noise[3][:60],
        "short": noise[3][:9],
        "four": np.array([1.0, 5.0, 2.0, 3.0]),
    }
    got = {r.k: r for r in series.stationarity(_many(spark, {k: v.tolist() for k, v in by_key.items()}), ["k"]).collect()}
    for k, y in by_key.items():
        t, lags, rows = _adf(y)
        assert (got[k].lags, got[k].n_obs) == (lags, rows), k
        assert got[k].adf_statistic == pytest.approx(t, rel=1e-6), k
        assert got[k].d == (0 if got[k].p_value < 0.05 else 1)
    assert got["still"].d == 0 and got["walk"].d == 1 and got["season"].lags > 0


def test_p_values_at_known_statistics(spark):
    # the response surface crosses 1, 5 and 10 % near the tabled values of large samples
    df = spark.createDataFrame([(-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10), (-20.0, 0.0), (3.0, 1.0), (None, None)], "t double, p double")
    for r in df.withColumn("got", series.df_p_value(df["t"])).collect():
        assert (r.got is None) if r.p is None else r.got == pytest.approx(r.p, abs=1.5e-3)
    import math

    from tidemark.functions.regression import normal_cdf

    for r in spark.range(-80, 81).selectExpr("id / 10 AS x").select("x", normal_cdf(F.col("x")).alias("p")).collect():
        assert r.p == pytest.approx(0.5 * math.erfc(-r.x / math.sqrt(2)), abs=1e-12)


def test_an_empty_series_has_no_statistic(spark):
    empty = spark.createDataFrame([], "date date, value double")
    row = series.stationarity(empty).collect()[0]
    assert (row.n_obs, row.lags, row.adf_statistic, row.p_value, row.d) == (0, None, None, None, 1)
    assert series.stationarity(empty.selectExpr("'a' k", "*"), ["k"]).count() == 0


def test_arma_regression_equals_plain_least_squares(spark):
    import numpy as np

    rng = np.random.default_rng(21)
    y = 1e5 + 1e3 * rng.normal(size=70).cumsum()
    one = spark.createDataFrame([(0,)], "d int")
    fc, aic = series.forecast_arma_grid(_series(spark, y.tolist()), (), 5, one)
    n, m = 70, 7
    x = np.column_stack([np.ones(n - m), *(y[m - i : n - i] for i in range(1, m + 1))])
    e = np.r_[np.zeros(m), y[m:] - x @ np.linalg.lstsq(x, y[m:], rcond=None)[0]]
    want, fits = {}, {}
    for p, q in series.ARMA_ORDERS:
        t = np.arange(m + 3, n)
        x = np.column_stack([np.ones(len(t)), *(y[t - i] for i in range(1, p + 1)), *(e[t - j] for j in range(1, q + 1))])
        beta = np.linalg.lstsq(x, y[t], rcond=None)[0]
        resid = y[t] - x @ beta
        want[p, q] = len(t) * np.log(resid @ resid / len(t)) + 2 * (p + q + 1)
        fits[p, q] = beta, resid
    got = {(r.p, r.q): r.aic for r in aic.collect()}
    assert got == pytest.approx(want, rel=1e-7)
    p, q = best = min(want, key=want.get)
    rows = fc.orderBy("step").collect()
    assert {(r.p, r.q) for r in rows} == {best}
    beta, resid = fits[best]
    past, shocks = list(y), list(resid)
    for r in rows:
        past.append(beta[0] + sum(beta[i] * past[-i] for i in range(1, p + 1)) + sum(beta[p + j] * shocks[-j] for j in range(1, q + 1)))
        shocks.append(0.0)
        assert r.forecast == pytest.approx(past[-1], rel=1e-7)
    assert rows[0].upper - rows[0].forecast == pytest.approx(1.96 * np.sqrt(resid @ resid / len(resid)), rel=1e-6)


def test_arma_grid_runs_no_python(spark):
    plan = series.forecast_arma_grid(_series(spark, WAVE * 3), (), 3)[0]._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan
    empty = spark.createDataFrame([], "k string, date date, value double")
    assert [f.count() for f in series.forecast_arma_grid(empty, ["k"])] == [0, 0]
