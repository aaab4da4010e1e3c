"""Monthly revenue series: decomposition, stationarity, forecasts, validation.

Re-aimed for Spark: every operator takes ``keys`` (series key columns; empty =
the single company series) and runs partitioned by them, so a thousand series
are one job.  Series are aggregates (one row per month), so per-series windows
and bounded ``collect_list`` folds are small; nothing is collected to the
driver.

Floating sums inside a series are taken in sorted order (``osum``) so the
result is bit-for-bit independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.calendar import month_start
from tidemark.functions.core import money, money_sum, safe_div
from tidemark.functions.regression import gram, normal_cdf, swept
from tidemark.operators.features import customer_months
from tidemark.session import stage_parquet

# Month names, the 95 % normal quantile, and for the Dickey-Fuller test with a
# constant the MacKinnon (2010) response surface of the 5 % value and the MacKinnon (1994)
# surface of the p-value: polynomials in the statistic up to -1.61 and above it, and the
# statistics beyond which it is 0 or 1.
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
Z95 = 1.96
DF_CRIT_5PCT = (-2.86154, -2.8903, -4.234, -40.04)
DF_P_LOW = (2.1659, 1.4412, 0.038269)
DF_P_HIGH = (1.7339, 0.93202, -0.12745, -0.010368)
DF_P_SPLIT, DF_P_ZERO, DF_P_ONE = -1.61, -18.83, 2.74
MAX_HALF_WINDOW = 6  # period 12 -> 2x12 centred moving average


def osum(x: Column) -> Column:
    """Sum of a bounded group in ascending value order (deterministic bits); NULL if empty."""
    arr = F.array_sort(F.collect_list(x))
    return F.when(F.size(arr) > 0, F.aggregate(arr, F.lit(0.0), lambda acc, v: acc + v))


def omean(x: Column) -> Column:
    return safe_div(osum(x), F.count(x))


def _w(keys: Sequence[str]) -> Window:
    # One row per month per series: a per-series window is bounded by the calendar.
    return Window.partitionBy(*keys).orderBy("date") if keys else Window.orderBy("date")


def monthly_series(transactions: DataFrame, keys: Sequence[str] = (), value: str = "amount") -> DataFrame:
    """gap-free monthly Completed revenue per series (missing months = 0)."""
    keys = list(keys)
    per = (
        transactions.where(F.col("transaction_status") == "Completed")
        .groupBy(*keys, month_start(F.col("transaction_date")).alias("date"))
        .agg(money_sum(value).alias("value"))
    )
    bounds = per.groupBy(*keys).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    spine = bounds.select(
        *keys, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("date")
    )
    return spine.join(per, [*keys, "date"], "left").select(
        *keys, "date", F.coalesce(F.col("value"), F.lit(0.0)).alias("value")
    )


def _with_positions(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    n = series.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")) if keys else series.agg(F.count(F.lit(1)).alias("n"))
    df = series.withColumn("pos", (F.row_number().over(_w(keys)) - 1).cast("int"))
    df = df.join(n, keys) if keys else df.crossJoin(F.broadcast(n))
    # at least two full years -> multiplicative, period 12; else additive, period n // 2 (<= 12).
    return df.withColumn("period", F.when(F.col("n") >= 24, F.lit(12)).otherwise(F.least(F.lit(12), F.floor(F.col("n") / 2))).cast("int")).withColumn(
        "multiplicative", F.col("n") >= 24
    )


def decompose(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """classical decomposition per series (``seasonal_decompose`` semantics).

    trend = centred moving average of length ``period`` (2 x p MA for even p),
    NULL for the first and last p/2 points; seasonal = mean detrended value per
    position class, normalised (divided by / minus the mean of the class
    means); residual = observed / seasonal / trend (or observed - trend -
    seasonal).  Series shorter than 4 points get NULL components.
    """
    keys = list(keys)
    w = _w(keys)
    df = _with_positions(series, keys)
    p = F.col("period")
    h = F.floor(p / 2)
    even = (p % 2) == 0
    total = F.lit(0.0)
    for k in range(-MAX_HALF_WINDOW, MAX_HALF_WINDOW + 1):
        yk = F.col("value") if k == 0 else (F.lag("value", -k).over(w) if k < 0 else F.lead("value", k).over(w))
        wk = F.when(F.lit(abs(k)) > h, F.lit(0.0)).when(even & (F.lit(abs(k)) == h), F.lit(0.5)).otherwise(F.lit(1.0))
        total = total + F.coalesce(yk, F.lit(0.0)) * wk
    valid = (p >= 2) & (F.col("pos") >= h) & (F.col("pos") <= F.col("n") - 1 - h)
    df = df.withColumn("trend", F.when(valid, total / p))
    df = df.withColumn(
        "_det",
        F.when(F.col("multiplicative"), safe_div(F.col("value"), F.col("trend"))).otherwise(F.col("value") - F.col("trend")),
    ).withColumn("_cls", F.col("pos") % F.greatest(p, F.lit(1)))
    cls = df.groupBy(*keys, "_cls").agg(omean(F.col("_det")).alias("_cm"))
    norm = cls.groupBy(*keys).agg(omean(F.col("_cm")).alias("_cmm")) if keys else cls.agg(omean(F.col("_cm")).alias("_cmm"))
    cls = cls.join(norm, keys) if keys else cls.crossJoin(F.broadcast(norm))
    df = df.join(cls.select(*keys, "_cls", "_cm", "_cmm"), [*keys, "_cls"], "left")
    seasonal = F.when(F.col("multiplicative"), safe_div(F.col("_cm"), F.col("_cmm"))).otherwise(F.col("_cm") - F.col("_cmm"))
    df = df.withColumn("seasonal", F.when(p >= 2, seasonal))
    resid = F.when(
        F.col("multiplicative"), safe_div(safe_div(F.col("value"), F.col("seasonal")), F.col("trend"))
    ).otherwise(F.col("_det") - F.col("seasonal"))
    return df.select(
        *keys,
        "date",
        F.col("value").alias("observed"),
        "trend",
        "seasonal",
        resid.alias("residual"),
        "period",
        F.when(F.col("multiplicative"), "multiplicative").otherwise("additive").alias("model"),
    )


def seasonal_indices(decomposition: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """mean seasonal component per calendar month.

    Factors for a multiplicative decomposition, offsets for an additive one; a
    month without one gets the neutral value (1.0 or 0.0).
    """
    keys = list(keys)
    per = decomposition.groupBy(*keys, F.month("date").alias("month")).agg(omean(F.col("seasonal")).alias("_si"))
    months = decomposition.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    names = F.create_map(*[x for i, n in enumerate(MONTH_NAMES, 1) for x in (F.lit(i), F.lit(n))])
    neutral = F.when(F.max("model") == "additive", F.lit(0.0)).otherwise(F.lit(1.0)).alias("_neutral")
    base = (decomposition.groupBy(*keys).agg(neutral) if keys else decomposition.agg(neutral)).crossJoin(F.broadcast(months))
    return base.join(per, [*keys, "month"], "left").select(
        *keys, "month", names[F.col("month")].alias("month_name"), F.coalesce("_si", "_neutral").alias("seasonal_index")
    )


def trend_growth(decomposition: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """growth of the trend from its first to its last defined value, in % (NULL from a zero start)."""
    keys = list(keys)
    t = decomposition.where(F.col("trend").isNotNull())
    aggs = [
        F.min_by("trend", "date").alias("trend_start"),
        F.max_by("trend", "date").alias("trend_end"),
        F.count(F.lit(1)).alias("_nt"),
    ]
    g = t.groupBy(*keys).agg(*aggs) if keys else t.agg(*aggs)
    return g.where(F.col("_nt") > 1).select(
        *keys, "trend_start", "trend_end", ((safe_div(F.col("trend_end"), F.col("trend_start")) - 1) * 100).alias("trend_growth_pct")
    )


def _ols(y: Column, x: Column) -> list[Column]:
    """Per-group sums for least squares of y on x (sorted-order sums) over the rows that have both."""
    both = y.isNotNull() & x.isNotNull()
    y, x = F.when(both, y), F.when(both, x)
    return [
        F.count(y).alias("_n"),
        osum(x).alias("_sx"),
        osum(y).alias("_sy"),
        osum(x * x).alias("_sxx"),
        osum(x * y).alias("_sxy"),
        osum(y * y).alias("_syy"),
    ]


def _ols_fit(df: DataFrame) -> DataFrame:
    """Least squares from the sums; without spread in x the slope is 0 and the fit is the mean."""
    n, sx, sy, sxx, sxy, syy = (F.col(c) for c in ["_n", "_sx", "_sy", "_sxx", "_sxy", "_syy"])
    cxx = sxx - safe_div(sx * sx, n)
    cxy = sxy - safe_div(sx * sy, n)
    cyy = syy - safe_div(sy * sy, n)
    return (
        df.withColumn("slope", F.coalesce(safe_div(cxy, cxx), F.lit(0.0)))
        .withColumn("intercept", safe_div(sy - F.col("slope") * sx, n))
        .withColumn("sse", F.greatest(cyy - F.col("slope") * cxy, F.lit(0.0)))
        .withColumn("cxx", cxx)
    )


def _grouped(df: DataFrame, keys: Sequence[str], aggs: list[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs) if keys else df.agg(*aggs)


def _series_array(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row a series: its values in the order of their dates, one a month, so bounded by the calendar."""
    values = F.transform(F.array_sort(F.collect_list(F.struct("date", "value"))), lambda r: r["value"])
    return _grouped(series, keys, [values.alias("_y")])


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        out = F.lit(c) + x * out
    return out


def df_p_value(t: Column) -> Column:
    """p-value of a Dickey-Fuller statistic with a constant."""
    z = F.when(t <= DF_P_SPLIT, _polynomial(t, DF_P_LOW)).otherwise(_polynomial(t, DF_P_HIGH))
    return F.when(t > DF_P_ONE, 1.0).when(t < DF_P_ZERO, 0.0).when(t.isNotNull(), normal_cdf(z))


def stationarity(series: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """augmented Dickey-Fuller test (constant) -> differencing order d.

    dy_t on a constant, y_{t-1} and dy_{t-1} .. dy_{t-lags}.  ``lags`` has the least AIC
    (a tie: the fewest) of 0 .. min(ceil(12 (n/100)^(1/4)), n/2 - 2), all compared on the rows
    that the longest has; the test then takes all rows that its own lags leave (``n_obs``).
    The statistic is the t value of y_{t-1}; ``critical_value_5pct`` and ``p_value`` are
    MacKinnon's; d = 0 if p < 0.05.  A series too short (under four points) or too flat for
    the test has no statistic, p-value or lags, and d = 1.  Every series is one row of
    arrays and all its regressions are sweeps of two Gram matrices.
    """
    keys = list(keys)
    mean = F.aggregate("_y", F.lit(0.0), lambda a, v: a + v) / F.col("_n")
    df = _series_array(series, keys).withColumn("_n", F.size("_y"))
    # centred and scaled: the test doesn't depend on either, its arithmetic does
    df = df.withColumn("_c", F.when(F.col("_n") > 0, F.transform("_y", lambda v: v - mean)))
    df = df.withColumn("_top", F.aggregate("_c", F.lit(0.0), lambda a, v: F.greatest(a, F.abs(v))))
    df = df.withColumn("_z", F.when(F.col("_top") > 0, F.transform("_c", lambda v: v / F.col("_top"))))
    most = F.least(F.ceil(12 * F.pow(F.col("_n") / 100, F.lit(0.25))), F.floor(F.col("_n") / 2) - 2).cast("int")
    df = df.withColumn("_max", F.when((most >= 0) & F.col("_z").isNotNull(), most))
    z = F.col("_z")
    steps = F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda t: z[t] - z[t - 1])
    df = df.withColumn("_dz", F.when(F.col("_max").isNotNull(), steps))
    dz = F.col("_dz")

    def observations(lags: Column) -> Column:
        earlier = lambda t: F.reverse(F.slice(dz, t - lags, lags))
        return F.transform(F.sequence(lags + 1, F.col("_n") - 1), lambda t: F.concat(F.array(F.lit(1.0), z[t - 1]), earlier(t), F.array(dz[t - 1])))

    df = df.withColumn("_g", F.when(F.col("_max").isNotNull(), gram(observations(F.col("_max")), F.col("_max") + 3)))
    last = F.col("_max") + 2
    rows = F.col("_n") - 1 - F.col("_max")
    sse = lambda p: F.greatest(swept(F.col("_g"), p + 2)[last][last], F.lit(1e-24))
    aic = F.transform(F.sequence(F.lit(0), F.col("_max")), lambda p: F.struct((rows * F.log(sse(p) / rows) + 2 * (p + 2)).alias("aic"), p.alias("lags")))
    df = df.withColumn("_lags", F.array_min(aic)["lags"])
    lags = F.col("_lags")
    df = df.withColumn("_h", F.when(lags.isNotNull(), gram(observations(lags), lags + 3)))
    df = df.withColumn("_s", F.when(lags.isNotNull(), swept(F.col("_h"), lags + 2)))
    n = (F.col("_n") - 1 - F.coalesce(lags, F.lit(0))).cast("bigint")
    corner = F.col("_s")[lags + 2][lags + 2]
    fits = (F.col("_s")[1][1] < 0) & (corner > 1e-12 * F.col("_h")[lags + 2][lags + 2])
    t = F.when(fits, F.col("_s")[1][lags + 2] / F.sqrt(corner / (n - lags - 2) * -F.col("_s")[1][1]))
    out = df.select(*keys, F.greatest(n, F.lit(0)).alias("n_obs"), F.when(t.isNotNull(), lags).alias("lags"), t.alias("adf_statistic"))
    m = F.col("n_obs").cast("double")
    a0, a1, a2, a3 = DF_CRIT_5PCT
    crit = F.lit(a0) + safe_div(F.lit(a1), m) + safe_div(F.lit(a2), m * m) + safe_div(F.lit(a3), m * m * m)
    out = out.withColumn("critical_value_5pct", crit).withColumn("p_value", df_p_value(F.col("adf_statistic")))
    return out.withColumn("d", F.when(F.col("p_value") < 0.05, 0).otherwise(1))


def forecast_ar(series: DataFrame, keys: Sequence[str] = (), horizon: int = 12, d: DataFrame | None = None) -> DataFrame:
    """F7 (base): AR(1) with drift on the d-times differenced series, h-step forecasts with 95 % bands.

    z = y (d = 0) or dy (d = 1); z_t = c + phi z_{t-1} + e; mu = c / (1 - phi).
    d = 0: y(T+h) = mu + phi^h (y_T - mu);
    d = 1: y(T+h) = y_T + h mu + (z_T - mu) phi (1 - phi^h) / (1 - phi).
    Variance sigma^2 * sum_{k<h} psi_k^2 with psi_k = phi^k (d = 0) or
    (1 - phi^(k+1)) / (1 - phi) (d = 1).  ``d`` defaults to the F6 test.
    A series without a regression (under four points) is carried on at its last
    value; with two residuals or fewer it has no band.
    """
    keys = list(keys)
    w = _w(keys)
    dd = d if d is not None else stationarity(series, keys).select(*keys, "d")
    base = series.join(dd, keys) if keys else series.crossJoin(F.broadcast(dd))
    base = base.withColumn("_dy", F.col("value") - F.lag("value").over(w))
    base = base.withColumn("z", F.when(F.col("d") == 1, F.col("_dy")).otherwise(F.col("value")))
    base = base.withColumn("_zl", F.lag("z").over(w))
    fit = _ols_fit(_grouped(base, keys, _ols(F.col("z"), F.col("_zl"))))
    last = _grouped(
        base,
        keys,
        [
            F.max("date").alias("_T"),
            F.max_by("value", "date").alias("_yT"),
            F.max_by("z", "date").alias("_zT"),
            F.first("d").alias("_d"),
        ],
    )
    m = fit.join(last, keys) if keys else fit.crossJoin(last)
    phi, c = F.col("slope"), F.coalesce(F.col("intercept"), F.lit(0.0))
    m = m.withColumn("_zT", F.coalesce("_zT", F.lit(0.0)))
    m = m.withColumn("_mu", safe_div(c, 1 - phi)).withColumn("_s2", F.when(F.col("_n") > 2, safe_div(F.col("sse"), F.col("_n") - 2)))
    steps = m.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    hh = F.col("step").cast("double")
    ph = F.pow(phi, hh)
    y0 = F.col("_mu") + ph * (F.col("_yT") - F.col("_mu"))
    y1 = F.col("_yT") + hh * F.col("_mu") + (F.col("_zT") - F.col("_mu")) * phi * safe_div(1 - ph, 1 - phi)
    # sum_{k<h} psi_k^2 in closed form
    r2 = phi * phi
    s0 = safe_div(1 - F.pow(r2, hh), 1 - r2)  # sum phi^(2k)
    s1 = safe_div(hh - 2 * phi * safe_div(1 - ph, 1 - phi) + r2 * s0, (1 - phi) * (1 - phi))
    var = F.col("_s2") * F.when(F.col("_d") == 1, s1).otherwise(s0)
    fc = F.when(F.col("_d") == 1, y1).otherwise(y0)
    half = F.lit(Z95) * F.sqrt(F.greatest(var, F.lit(0.0)))
    return steps.select(
        *keys,
        F.add_months(F.col("_T"), F.col("step")).alias("date"),
        "step",
        fc.alias("forecast"),
        F.when(var.isNotNull(), fc - half).alias("lower"),
        F.when(var.isNotNull(), fc + half).alias("upper"),
    )


def forecast_seasonal_trend(
    series: DataFrame, keys: Sequence[str] = (), horizon: int = 12, decomposition: DataFrame | None = None
) -> DataFrame:
    """F8: linear trend on the deseasonalised series with the seasonal component, history + horizon.

    The component of a position class comes from F3 (pass ``decomposition`` to
    reuse one): factors divide and multiply in a multiplicative model, offsets
    are taken off and put back in an additive one; without one (under four
    points) the trend stands alone.  The band is +-1.96 x the in-sample residual
    standard deviation (none for a single point).
    """
    keys = list(keys)
    parts = decomposition if decomposition is not None else decompose(series, keys)
    w = _w(keys)
    df = parts.withColumn("pos", (F.row_number().over(w) - 1).cast("int")).withColumn("_mult", F.col("model") == "multiplicative")
    neutral = F.when(F.col("_mult"), F.lit(1.0)).otherwise(F.lit(0.0))
    df = df.withColumn("_cls", F.col("pos") % F.greatest(F.col("period"), F.lit(1))).withColumn("_s", F.coalesce("seasonal", neutral))
    ds = F.when(F.col("_mult"), safe_div(F.col("observed"), F.col("_s"))).otherwise(F.col("observed") - F.col("_s"))
    fit = _ols_fit(_grouped(df, keys, [
        *_ols(ds, F.col("pos").cast("double")),
        F.max("date").alias("_T"), F.count(F.lit(1)).alias("_nn"), F.max("period").alias("_p"), F.max("_mult").alias("_mult"),
        # one component a class: at most twelve
        F.map_from_entries(F.array_distinct(F.collect_list(F.struct("_cls", "_s")))).alias("_by_cls"),
    ]))
    line = lambda x: F.col("intercept") + F.col("slope") * x
    with_season = lambda x, sea: F.when(F.col("_mult"), line(x) * sea).otherwise(line(x) + sea)
    model = fit.select(*keys, "slope", "intercept", "_T", "_nn", "_p", "_by_cls", F.col("_mult").alias("_m"))
    fitted = (df.join(model, keys) if keys else df.crossJoin(F.broadcast(model))).withColumn("fitted", with_season(F.col("pos"), F.col("_s")))
    sd = _grouped(fitted, keys, [F.sqrt(safe_div(osum((F.col("observed") - F.col("fitted")) ** 2), F.count("observed") - 1)).alias("_sd")])
    future = (model.join(sd, keys) if keys else model.crossJoin(F.broadcast(sd))).withColumn("_mult", F.col("_m")).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))
    )
    at = (F.col("_nn") - 1 + F.col("step")).cast("int")
    future = future.withColumn("date", F.add_months(F.col("_T"), F.col("step"))).withColumn(
        "fitted", with_season(at, F.try_element_at("_by_cls", at % F.greatest(F.col("_p"), F.lit(1))))
    )
    hist = fitted.join(sd, keys) if keys else fitted.crossJoin(F.broadcast(sd))
    cols = lambda flag: [
        *keys,
        "date",
        F.col("fitted").alias("forecast"),
        (F.col("fitted") - Z95 * F.col("_sd")).alias("lower"),
        (F.col("fitted") + Z95 * F.col("_sd")).alias("upper"),
        F.lit(flag).alias("is_forecast"),
    ]
    return hist.select(*cols(False)).unionByName(future.select(*cols(True)))


def holdout_metrics(series: DataFrame, keys: Sequence[str] = (), holdout: int = 3) -> DataFrame:
    """fit both models without the last ``holdout`` points; MAE, RMSE, MAPE (%) on them.

    The training series and its decomposition are staged, so the models read
    small tables instead of repeating the plan under them.  A series of
    ``holdout`` points or fewer has no training part: its row has NULL errors.
    """
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy(F.desc("date")) if keys else Window.orderBy(F.desc("date"))
    r = stage_parquet(series.withColumn("_rk", F.row_number().over(w)), "holdout")
    train = r.where(F.col("_rk") > holdout).drop("_rk")
    test = r.where(F.col("_rk") <= holdout).select(*keys, "date", F.col("value").alias("actual"))
    parts = stage_parquet(decompose(train, keys), "holdout-parts")
    st = forecast_seasonal_trend(train, keys, holdout, parts).where("is_forecast").select(*keys, "date", "forecast", F.lit("seasonal_trend").alias("model"))
    ar = forecast_ar(train, keys, holdout).select(*keys, "date", "forecast", F.lit("ar").alias("model"))
    models = F.explode(F.array(F.lit("seasonal_trend"), F.lit("ar"))).alias("model")
    j = test.select(*keys, "date", "actual", models).join(st.unionByName(ar), [*keys, "date", "model"], "left")
    err = F.col("forecast") - F.col("actual")
    return j.groupBy(*keys, "model").agg(
        omean(F.abs(err)).alias("mae"),
        F.sqrt(omean(err * err)).alias("rmse"),
        (omean(safe_div(F.abs(err), F.greatest(F.abs(F.col("actual")), F.lit(2.220446049250313e-16)))) * 100).alias("mape"),
    )


def model_comparison(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """metric x model table plus the best model by MAPE (tie -> ar)."""
    keys = list(keys)
    long = metrics.select(*keys, "model", F.expr("stack(3, 'MAE', mae, 'RMSE', rmse, 'MAPE (%)', mape) AS (metric, value)"))
    wide = long.groupBy(*keys, "metric").pivot("model", ["seasonal_trend", "ar"]).agg(F.first("value"))
    best = _grouped(
        metrics, keys, [F.min_by("model", F.struct(F.col("mape"), F.when(F.col("model") == "ar", 0).otherwise(1))).alias("best_model")]
    )
    return wide.join(best, keys) if keys else wide.crossJoin(best)


def combined_forecast(seasonal_fc: DataFrame, ar_fc: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """ensemble (mean) of the two forecasts on future dates, calendar columns, running total."""
    keys = list(keys)
    st = seasonal_fc.where("is_forecast").select(*keys, "date", F.col("forecast").alias("forecast_seasonal"))
    ar = ar_fc.select(*keys, "date", F.col("forecast").alias("forecast_ar"))
    j = st.join(ar, [*keys, "date"], "inner")
    ens = (F.col("forecast_seasonal") + F.col("forecast_ar")) / 2
    w = _w(keys).rowsBetween(Window.unboundedPreceding, 0)
    return j.select(
        *keys,
        "date",
        "forecast_seasonal",
        "forecast_ar",
        ens.alias("forecast_ensemble"),
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.quarter("date").alias("quarter"),
    ).withColumn("cumulative_forecast", F.sum(money("forecast_ensemble")).over(w).cast("double"))


def forecast_totals(combined: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """total and mean of the 12-month ensemble forecast."""
    keys = list(keys)
    return _grouped(
        combined,
        keys,
        [
            money_sum("forecast_ensemble").alias("forecasted_revenue_total"),
            safe_div(money_sum("forecast_ensemble"), F.count("forecast_ensemble")).alias("avg_monthly_forecast"),
        ],
    )


# ---------------------------------------------------------------- F7 grid: ARMA(p, q) by AIC
ARMA_ORDERS = [(p, q) for p in range(4) for q in range(4)]


def _lagged(values: Column, t: Column, lags: Column) -> Column:
    """values[t - 1] .. values[t - lags]."""
    return F.reverse(F.slice(values, t - lags + 1, lags))


def _coefficient(s: Column, i: Column, last: Column) -> Column:
    """Coefficient ``i`` of a swept matrix; 0 for a column that hangs on earlier ones."""
    return F.when(s[i][i] < 0, s[i][last]).otherwise(0.0)


def _dot(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: a * b), F.lit(0.0), lambda a, v: a + v)


def _no_rows() -> Column:
    return F.array().cast("array<array<double>>")


def forecast_arma_grid(
    series: DataFrame, keys: Sequence[str] = (), horizon: int = 12, d: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """F7 grid: ARMA(p, q), p, q in 0..3, per series on the F6 difference order; best by AIC.

    Hannan-Rissanen least squares as sweeps of Gram matrices: one for the long
    autoregression, whose residuals stand for the shocks, and one an order; each (series,
    order) is a row of arrays bounded by the calendar, so all of them are one job without
    Python.  All orders of a series are estimated on the same rows, its last n - s, so their
    AICs compare; ties go to fewer parameters.  A regressor that hangs on earlier ones has
    coefficient 0.  Every series is reported: ``status`` is ``ok``, ``short`` (too few points
    for the grid: the mean model on all of them) or ``constant`` (no variance is left: AIC is
    NULL, and comes first).

    Returns (forecast of the best order with dates, AIC table of all orders).
    """
    keys = list(keys)
    dd = d if d is not None else stationarity(series, keys).select(*keys, "d")
    values = _series_array(series, keys)
    last_date = _grouped(series, keys, [F.max("date").alias("_T")])
    df = values.join(last_date, keys).join(dd, keys) if keys else values.crossJoin(last_date).crossJoin(F.broadcast(dd))
    df = df.where(F.size("_y") > 0)
    y, size = F.col("_y"), F.size("_y")
    change = F.when(size > 1, F.transform(F.sequence(F.lit(1), size - 1), lambda t: y[t] - y[t - 1])).otherwise(F.array().cast("array<double>"))
    df = df.withColumn("_x", F.when(F.col("d") == 1, change).otherwise(y)).withColumn("_n", F.size("_x"))
    mean = F.when(F.col("_n") > 0, F.aggregate("_x", F.lit(0.0), lambda a, v: a + v) / F.col("_n")).otherwise(0.0)
    df = df.withColumn("_mean", mean)
    df = df.withColumn("_top", F.aggregate(F.transform("_x", lambda v: F.abs(v - F.col("_mean"))), F.lit(0.0), lambda a, v: F.greatest(a, v)))
    df = df.withColumn("_z", F.transform("_x", lambda v: F.when(F.col("_top") > 0, (v - F.col("_mean")) / F.col("_top")).otherwise(0.0)))
    n, z = F.col("_n"), F.col("_z")
    df = df.withColumn("_m", F.greatest(F.lit(1), F.least(F.lit(7), F.floor(n / 4))).cast("int"))
    m = F.col("_m")
    df = df.withColumn("_short", n - m - 3 < 8).withColumn("_start", F.when(F.col("_short"), 0).otherwise(m + 3))

    # shocks: residuals of the long autoregression, 0 before it starts
    one = F.array(F.lit(1.0))
    long_rows = F.transform(F.sequence(m, n - 1), lambda t: F.concat(one, _lagged(z, t, m), F.array(z[t])))
    df = df.withColumn("_lr", F.when(~F.col("_short"), long_rows).otherwise(_no_rows()))
    df = df.withColumn("_ls", F.when(~F.col("_short"), swept(gram(F.col("_lr"), m + 2), m + 1)))
    df = df.withColumn("_lb", F.transform(F.sequence(F.lit(0), m), lambda i: _coefficient(F.col("_ls"), i, m + 1)))
    shocks = F.transform("_lr", lambda r: r[m + 1] - _dot(F.slice(r, F.lit(1), m + 1), F.col("_lb")))
    df = df.withColumn("_e", F.concat(F.array_repeat(F.lit(0.0), m), shocks))

    orders = F.array(*[F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p, q in ARMA_ORDERS])
    df = df.withColumn("_o", F.explode(F.when(F.col("_short"), F.slice(orders, 1, 1)).otherwise(orders)))
    df = df.withColumn("p", F.col("_o.p")).withColumn("q", F.col("_o.q"))
    p, q, e, start = F.col("p"), F.col("q"), F.col("_e"), F.col("_start")
    rows = F.transform(F.sequence(start, n - 1), lambda t: F.concat(one, _lagged(z, t, p), _lagged(e, t, q), F.array(z[t])))
    df = df.withColumn("_r", F.when(n > start, rows).otherwise(_no_rows()))
    df = df.withColumn("_g", gram(F.col("_r"), p + q + 2)).withColumn("_s", swept(F.col("_g"), p + q + 1))
    last, used = p + q + 1, F.col("_n") - F.col("_start")
    df = df.withColumn("_b", F.transform(F.sequence(F.lit(0), p + q), lambda i: _coefficient(F.col("_s"), i, last)))
    df = df.withColumn("_flat", ~(F.col("_s")[last][last] > 1e-12 * F.col("_g")[last][last]))
    df = df.withColumn("_v", F.when(F.col("_flat"), 0.0).otherwise(F.col("_s")[last][last] / used * F.col("_top") * F.col("_top")))
    df = df.withColumn("aic", F.when(~F.col("_flat"), used * F.log("_v") + 2 * (p + q + 1)))
    df = df.withColumn("status", F.when(F.col("_flat"), "constant").when(F.col("_short"), "short").otherwise("ok"))

    # without an AIC (no variance) the fewest parameters win
    fitted = stage_parquet(df.select(*keys, "p", "q", "status", "aic", "d", "_T", "_y", "_z", "_r", "_b", "_v", "_mean", "_top"), "arma")
    rank = F.struct(F.coalesce("aic", F.lit(float("-inf"))), F.col("p") + F.col("q"), "p")
    rest = [c for c in fitted.columns if c not in keys]
    best = _grouped(fitted, keys, [F.min_by(F.struct(*rest), rank).alias("_best")]).select(*keys, "_best.*")

    # ahead: three lags of each kind, 0 beyond the order
    p, q, b, three = F.col("p"), F.col("q"), F.col("_b"), F.sequence(F.lit(1), F.lit(3))
    best = best.withColumn("_phi", F.transform(three, lambda i: F.when(i <= p, F.get(b, i)).otherwise(0.0)))
    best = best.withColumn("_theta", F.transform(three, lambda j: F.when(j <= q, F.get(b, p + j)).otherwise(0.0)))
    residual = lambda r: F.element_at(r, -1) - _dot(F.slice(r, F.lit(1), p + q + 1), b)
    end = F.slice(F.concat(F.array_repeat(F.lit(0.0), 3), F.transform("_r", residual)), -3, 3)
    best = best.withColumn("_back", F.reverse(end))
    best = best.withColumn("_last", F.slice(F.concat(F.array_repeat(F.lit(0.0), 3), F.col("_z")), -3, 3))
    phi, theta, back = F.col("_phi"), F.col("_theta"), F.col("_back")
    from_past = lambda acc: _dot(phi, F.reverse(F.slice(acc, -3, 3)))
    still = lambda k: F.aggregate(three, F.lit(0.0), lambda a, j: a + F.when(j >= k, theta[j - 1] * F.get(back, j - k)).otherwise(0.0))
    step = lambda acc, k: F.concat(acc, F.array(b[0] + from_past(acc) + still(k)))
    ahead = F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), F.col("_last"), step), 4, horizon)
    best = best.withColumn("_ahead", F.transform(ahead, lambda v: F.col("_mean") + F.col("_top") * v))
    # psi weights, integrated once for a differenced series
    weight = lambda acc, k: F.concat(acc, F.array(from_past(acc) + F.coalesce(F.get(theta, k - 1), F.lit(0.0))))
    zero_one = F.array(F.lit(0.0), F.lit(0.0), F.lit(1.0))
    steps = F.filter(F.sequence(F.lit(0), F.lit(horizon - 1)), lambda k: k > 0)
    best = best.withColumn("_psi", F.slice(F.aggregate(steps, zero_one, weight), 3, horizon))
    running = lambda c: F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda k: F.aggregate(F.slice(c, F.lit(1), k), F.lit(0.0), lambda a, v: a + v))
    best = best.withColumn("_w", F.when(F.col("d") == 1, running(F.col("_psi"))).otherwise(F.col("_psi")))
    best = best.withColumn("_var", running(F.transform("_w", lambda v: v * v)))
    level = F.element_at("_y", -1)
    best = best.withColumn("_fc", F.when(F.col("d") == 1, F.transform(running(F.col("_ahead")), lambda v: level + v)).otherwise(F.col("_ahead")))
    fc = best.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    at = F.col("step") - 1
    half = Z95 * F.sqrt(F.col("_v") * F.col("_var")[at])
    value = F.col("_fc")[at]
    fc = fc.select(
        *keys, F.add_months(F.col("_T"), F.col("step")).alias("date"), "step", "p", "q", "status",
        value.alias("forecast"), (value - half).alias("lower"), (value + half).alias("upper"),
    )
    return fc, fitted.select(*keys, "p", "q", "status", "aic")


def monthly_series_by(transactions: DataFrame, customers: DataFrame, dim: str) -> DataFrame:
    """F1 for many series: gap-free monthly Completed revenue per value of a customer attribute.

    Transactions are first reduced to (customer, month) by a partial aggregate,
    then joined to the attribute, so the fact table is never shuffled by
    customer alone.
    """
    per = (
        customer_months(transactions)
        .join(customers.select("customer_id", dim), "customer_id")
        .groupBy(dim, F.col("month").alias("date"))
        .agg(F.sum("revenue").cast("double").alias("value"))
    )
    bounds = per.groupBy(dim).agg(F.min("date").alias("_lo"), F.max("date").alias("_hi"))
    spine = bounds.select(dim, F.explode(F.sequence("_lo", "_hi", F.expr("interval 1 month"))).alias("date"))
    return spine.join(per, [dim, "date"], "left").select(dim, "date", F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))
