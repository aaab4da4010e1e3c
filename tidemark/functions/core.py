"""Expression helpers: exact money sums, guarded ratios, flags, scalar joins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Money is summed as a decimal so that totals do not depend on partition order
# (double addition is not associative).  Sums are exact for values of up to 12
# decimals and totals under 1e26; a larger total raises an error.
MONEY_TYPE = "decimal(38,12)"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def money(x: Column | str) -> Column:
    """Round a money value to the exact decimal grid used for sums."""
    return _c(x).cast(MONEY_TYPE)


def money_sum(x: Column | str) -> Column:
    """Order-independent sum of a DOUBLE money column, returned as DOUBLE."""
    return F.sum(money(x)).cast("double")


def money_avg(x: Column | str) -> Column:
    """Mean as exact sum / non-null count (NULL for an empty group)."""
    return safe_div(money_sum(x), F.count(_c(x)))


def safe_div(num: Column, den: Column) -> Column:
    """num / den as DOUBLE; NULL when den is 0 or NULL (ANSI-safe)."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def ratio(num: Column, den: Column, default: float | Column | None = None, *, when_positive: bool = True) -> Column:
    """``np.where(den > 0, num / den, default)``: guarded ratio with a default."""
    d = F.lit(default) if default is not None and not isinstance(default, Column) else default
    cond = den > 0 if when_positive else den != 0
    out = F.when(cond, num.cast("double") / den.cast("double"))
    return out.otherwise(d) if d is not None else out


def flag(cond: Column) -> Column:
    """Boolean condition as 0/1 INT, NULL counting as 0 (NaN compares False)."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def nan_to_zero(x: Column | str) -> Column:
    """Replace NULL, NaN and +-inf by 0."""
    c = _c(x).cast("double")
    bad = F.isnan(c) | (c == float("inf")) | (c == float("-inf"))
    return F.when(c.isNull() | bad, F.lit(0.0)).otherwise(c)


def scalar_join(df: DataFrame, scalars: DataFrame) -> DataFrame:
    """Attach a 1-row aggregate to every row.

    ``scalars`` must be a global aggregate (no grouping keys), so it has exactly
    one row: broadcasting it is bounded by construction.  Keeps one lazy plan
    instead of collecting the scalar to the driver or using an unpartitioned
    window (which would put every row in one task).
    """
    return df.crossJoin(F.broadcast(scalars))


def summarise(df: DataFrame, keys: Iterable[str], metrics: Mapping[str, Column]) -> DataFrame:
    """groupBy(keys).agg(named metrics) — the reference's many small summaries."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in metrics.items()])


# Derived doubles (costs, ratios) are summed on a fine decimal grid for the
# same reason as money: the total must not depend on merge order.
FINE_TYPE = "decimal(38,9)"


def fsum(x: Column | str) -> Column:
    """Order-independent sum of a derived DOUBLE column (9-decimal grid)."""
    return F.sum(_c(x).cast(FINE_TYPE)).cast("double")


def favg(x: Column | str) -> Column:
    """Order-independent mean of a DOUBLE column; NULL for an empty group."""
    return safe_div(fsum(x), F.count(_c(x)))


def share_pct(part: Column, total: Column) -> Column:
    """part / total * 100, NULL when the total is 0."""
    return safe_div(part, total) * 100


def pct_change(x: Column | str, window) -> Column:
    """``pandas.pct_change() * 100`` = (x / previous x - 1) * 100 over an ordered window;
    NULL for the first row and when the previous value is 0."""
    c = _c(x)
    return (safe_div(c, F.lag(c).over(window)) - 1) * 100
