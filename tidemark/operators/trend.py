"""A trend that bends (F8): change points of the slope, found by forward selection.

The deseasonalised series is a line plus hinges max(0, t - change) at up to 25 candidates,
spread over the first four fifths of the series.  The hinge that lowers the squared error
most is taken in, one after another, as long as the Bayesian information criterion of two
more parameters (where, how much) improves.  A series is one row of arrays, its Gram matrix
is added up once, and taking a hinge in is one sweep of it, so all series are one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.regression import gram, sweep_one, swept
from tidemark.operators.series import Z95, _grouped, decompose
from tidemark.session import stage_parquet

CANDIDATES, MOST = 25, 5
#: Points below which the trend stays a line.
FEWEST = 12


def _taken(g: Column, gram_: Column, n: Column, last: Column, most: int) -> Column:
    """``g``, swept on the line, swept on the hinges that are worth it."""

    def step(acc: Column, best: Column) -> Column:
        sse, least = acc[last][last], 1e-12 * gram_[last][last]
        better = (sse > least) & (n * F.log(sse / F.greatest(sse - best["gain"], least)) > 2 * F.log(n))
        return F.when(better, sweep_one(acc, -best["at"])).otherwise(acc)

    def one(acc: Column, _: Column) -> Column:
        gain = lambda k: F.when(acc[k][k] > 1e-9 * gram_[k][k], acc[k][last] * acc[k][last] / acc[k][k]).otherwise(0.0)
        # the greatest gain, the first of equal ones; an array of one, so that it is worked out once
        best = F.array_max(F.transform(F.sequence(F.lit(2), last - 1), lambda k: F.struct(gain(k).alias("gain"), (-k).alias("at"))))
        return F.transform(F.array(best), lambda b: step(acc, b))[0]

    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), g, one)


def bent_trend(parts: DataFrame, keys: Sequence[str] = (), candidates: int = CANDIDATES, most: int = MOST) -> DataFrame:
    """One row a series of a decomposition: its months, and the trend as start, slope and bends.

    ``_rows`` are its (date, observed, season) in order, ``_bends`` the (position, change of
    slope a month) taken in, ``_start`` and ``_slope`` the line before the first.  A series
    under twelve points, or without error left, keeps its line.
    """
    keys = list(keys)
    mult = F.col("model") == "multiplicative"
    season = F.coalesce("seasonal", F.when(mult, 1.0).otherwise(0.0))
    level = F.when(mult, F.when(season != 0, F.col("observed") / season)).otherwise(F.col("observed") - season)
    month = F.struct("date", "observed", season.alias("season"), level.alias("level"))
    df = _grouped(parts, keys, [F.array_sort(F.collect_list(month)).alias("_rows"), F.max(mult).alias("_mult"), F.max("period").alias("_period")])
    df = df.where(F.size("_rows") > 0).withColumn("_n", F.size("_rows"))
    n, rows = F.col("_n"), F.col("_rows")
    hist = F.floor(n * 4 / 5).cast("int")
    df = df.withColumn("_k", F.when(n < FEWEST, 0).otherwise(F.least(F.lit(candidates), hist - 1)))
    k, span = F.col("_k"), F.greatest(n - 1, F.lit(1))
    spread = F.transform(F.sequence(F.lit(1), k), lambda i: F.floor((2 * i * (hist - 1) + k) / (2 * k)).cast("int"))
    df = df.withColumn("_at", F.when(k > 0, spread).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_top", F.aggregate(F.transform(rows, lambda r: F.coalesce(F.abs(r["level"]), F.lit(0.0))), F.lit(0.0), lambda a, v: F.greatest(a, v)))
    scale = F.when(F.col("_top") > 0, F.col("_top")).otherwise(1.0)
    hinges = lambda t: F.transform("_at", lambda c: F.greatest(t - c, F.lit(0)) / span)
    line = lambda t: F.array(F.lit(1.0), t / span)
    points = F.transform(F.sequence(F.lit(0), n - 1), lambda t: F.struct(t.alias("t"), rows[t]["level"].alias("y")))
    seen = F.transform(F.filter(points, lambda r: r["y"].isNotNull()), lambda r: F.concat(line(r["t"]), hinges(r["t"]), F.array(r["y"] / scale)))
    df = df.withColumn("_seen", seen).withColumn("_g", gram(F.col("_seen"), k + 3)).withColumn("_line", swept(F.col("_g"), F.lit(2)))
    last = k + 2
    taken = _taken(F.col("_line"), F.col("_g"), F.size("_seen").cast("double"), last, most)
    df = df.withColumn("_s", F.when(k > 0, taken).otherwise(F.col("_line")))
    s = F.col("_s")
    value = lambda i: F.when(s[i][i] < 0, s[i][last] * scale).otherwise(0.0)
    bends = F.transform("_at", lambda c, i: F.struct(c.alias("at"), (value(i + 2) / span).alias("change")))
    return df.select(
        *keys, "_rows", "_mult", "_period", "_n", value(F.lit(0)).alias("_start"), (value(F.lit(1)) / span).alias("_slope"),
        F.filter(F.zip_with(bends, F.transform("_at", lambda c, i: s[i + 2][i + 2] < 0), lambda b, used: F.when(used, b)), lambda b: b.isNotNull()).alias("_bends"),
    )


def change_points(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(date, slope_before, slope_after): where the trend bends, in the series' units a month."""
    # staged: the explode's filter would be pushed under the model and work it out again an element
    bent = stage_parquet(bent_trend(parts, keys), "trend").withColumn("_b", F.explode("_bends"))
    earlier = F.aggregate(F.filter("_bends", lambda b: b["at"] < F.col("_b.at")), F.col("_slope"), lambda a, b: a + b["change"])
    return bent.select(*keys, F.col("_rows")[F.col("_b.at")]["date"].alias("date"), earlier.alias("slope_before"), (earlier + F.col("_b.change")).alias("slope_after"))


def forecast_bent_trend(series: DataFrame, keys: Sequence[str] = (), horizon: int = 12, decomposition: DataFrame | None = None) -> DataFrame:
    """F8: bent trend times (or plus) the seasonal component, history and ``horizon`` months ahead.

    The last slope goes on.  The season of a month ahead is that of its place in the period;
    the band is 1.96 times the standard deviation of the residuals (none for a single point).
    """
    keys = list(keys)
    parts = decomposition if decomposition is not None else decompose(series, keys)
    # staged: inside the months' lambda the model would be worked out again for each of them
    m = stage_parquet(bent_trend(parts, keys), "trend")
    bends = lambda t: F.aggregate("_bends", F.lit(0.0), lambda a, b: a + b["change"] * F.greatest(t - b["at"], F.lit(0)))
    trend = lambda t: F.col("_start") + F.col("_slope") * t + bends(t)
    # the season of a place beyond the series is that of the same place in the first period
    place = lambda t: F.when(t < F.col("_n"), t).otherwise(t % F.greatest(F.col("_period"), F.lit(1)))
    season = lambda t: F.col("_rows")[place(t)]["season"]
    value = lambda t: F.when(F.col("_mult"), trend(t) * season(t)).otherwise(trend(t) + season(t))
    m = m.withColumn("_fit", F.transform(F.sequence(F.lit(0), F.col("_n") + horizon - 1), value))
    errors = F.zip_with("_rows", F.slice("_fit", F.lit(1), F.col("_n")), lambda r, f: (r["observed"] - f) * (r["observed"] - f))
    m = m.withColumn("_sd", F.when(F.col("_n") > 1, F.sqrt(F.aggregate(errors, F.lit(0.0), lambda a, v: a + v) / (F.col("_n") - 1))))
    out = m.select("*", F.posexplode("_fit").alias("_t", "forecast"))
    first = F.col("_rows")[0]["date"]
    return out.select(
        *keys, F.add_months(first, F.col("_t")).alias("date"), "forecast",
        (F.col("forecast") - Z95 * F.col("_sd")).alias("lower"), (F.col("forecast") + Z95 * F.col("_sd")).alias("upper"),
        (F.col("_t") >= F.col("_n")).alias("is_forecast"),
    )
