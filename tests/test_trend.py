"""The bent trend: planted changes of slope, straight lines, awkward series."""

import numpy as np
import pytest
from test_series import AWKWARD, WAVE, _many, _series

from tidemark.operators import series, trend


def bent(n=72, at=40, before=5.0, after=-8.0, noise=3.0, seed=2, season=True):
    t = np.arange(n)
    y = 500 + before * t + (after - before) * np.maximum(t - at, 0) + noise * np.random.default_rng(seed).normal(size=n)
    return (y * (1 + 0.1 * np.sin(t * np.pi / 6) if season else 1)).tolist()


def test_a_planted_change_of_slope_is_found(spark):
    df = _many(spark, {"bent": bent(), "line": bent(after=5.0), "up": bent(at=20, before=0.0, after=6.0, seed=3)})
    got = {}
    for r in trend.change_points(series.decompose(df, ["k"]), ["k"]).collect():
        got.setdefault(r.k, []).append((r.date, r.slope_before, r.slope_after))
    assert "line" not in got
    for k, at, before, after in (("bent", 40, 5, -8), ("up", 20, 0, 6)):
        date, b, a = max(got[k], key=lambda c: abs(c[2] - c[1]))
        months = (date.year - 2020) * 12 + date.month - 1
        assert abs(months - at) <= 4 and b == pytest.approx(before, abs=1.5) and a == pytest.approx(after, abs=1.5)


def test_the_last_slope_goes_on(spark):
    y = bent(noise=0.5)
    df = _series(spark, y[:66])
    error = {}
    for name, f in (("bent", trend.forecast_bent_trend), ("line", series.forecast_seasonal_trend)):
        ahead = [r.forecast for r in f(df, (), 6).where("is_forecast").orderBy("date").collect()]
        error[name] = np.abs(np.array(ahead) - y[66:]).mean()
    assert error["bent"] < 0.2 * error["line"]


def test_without_change_it_is_the_line(spark):
    df = _series(spark, [v + 2.0 * i for i, v in enumerate(WAVE * 4)])
    assert trend.change_points(series.decompose(df)).count() == 0
    rows = lambda f: {r.date: (r.forecast, r.lower, r.upper, r.is_forecast) for r in f.collect()}
    a, b = rows(trend.forecast_bent_trend(df)), rows(series.forecast_seasonal_trend(df))
    assert a.keys() == b.keys()
    for d in a:
        assert a[d] == pytest.approx(b[d], rel=1e-9)


def test_every_series_gets_a_forecast_alone_or_among_others(spark):
    df = _many(spark, AWKWARD)
    rows = trend.forecast_bent_trend(df, ["k"], 6).collect()
    for k, values in AWKWARD.items():
        mine = [r for r in rows if r.k == k]
        assert len(mine) == len(values) + 6 and sum(r.is_forecast for r in mine) == 6
        assert all(r.forecast is not None for r in mine)
        assert all((r.lower is None) == (len(values) == 1) for r in mine)
    one = {r.date: r.forecast for r in trend.forecast_bent_trend(_series(spark, AWKWARD["long"]), (), 6).collect()}
    assert one == {r.date: r.forecast for r in rows if r.k == "long"}
    empty = df.where("false")
    assert trend.forecast_bent_trend(empty, ["k"]).count() == 0 and trend.forecast_bent_trend(empty.drop("k")).count() == 0
