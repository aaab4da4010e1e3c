"""Calendar helpers: month starts, integer month differences, month spines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_start(d: Column) -> Column:
    """First day of the month as DATE."""
    return F.trunc(d, "MM")


def month_label(d: Column) -> Column:
    """Period text 'yyyy-MM'."""
    return F.date_format(d, "yyyy-MM")


def month_diff(later: Column, earlier: Column) -> Column:
    """Whole-month difference of the calendar months (Period subtraction)."""
    return (F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))


def month_spine(bounds: DataFrame, lo: str, hi: str, out: str = "month") -> DataFrame:
    """Explode one row per month start between two DATE columns (inclusive).

    ``bounds`` is tiny (one row per series), so the spine is bounded by the
    number of series times the number of months.
    """
    return bounds.withColumn(
        out,
        F.explode(F.sequence(month_start(F.col(lo)), month_start(F.col(hi)), F.expr("interval 1 month"))),
    )
