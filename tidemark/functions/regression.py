"""Least squares inside one row: arrays of observations, Gram matrices, sweeps.

For regressions of bounded size on bounded groups (a series of months): a group's
observations are one array, and many groups are one job without Python.  Sweeping the Gram
matrix of the regressors and, last, the response on its first k columns gives the fit on
these k regressors: coefficients in the response's column, the residual sum of squares in the
corner and minus the inverse of their Gram matrix in the block.  Nested models share it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A pivot below this share of its column's sum of squares is a combination of earlier columns.
COLLINEAR = 1e-12
#: Terms of the series of the normal distribution; enough up to eight deviations.
CDF_TERMS = 120


def gram(rows: Column, width: Column) -> Column:
    """Gram matrix of ``rows``, an array of arrays of ``width`` numbers, added in the order of the rows."""
    places = F.sequence(F.lit(0), width - 1)
    cell = lambda i, j: F.aggregate(rows, F.lit(0.0), lambda acc, r: acc + r[i] * r[j])
    return F.transform(places, lambda i: F.transform(places, lambda j: cell(i, j)))


def sweep_one(g: Column, k: Column) -> Column:
    """``g`` swept on column ``k``."""

    def cell(row: Column, i: Column, x: Column, j: Column) -> Column:
        d = g[k][k]
        return F.when((i == k) & (j == k), -1 / d).when((i == k) | (j == k), x / d).otherwise(x - row[k] * g[k][j] / d)

    return F.transform(g, lambda row, i: F.transform(row, lambda x, j: cell(row, i, x, j)))


def swept(g: Column, upto: Column) -> Column:
    """``g`` swept on its columns 0 to ``upto`` - 1 (at least one), without those that hang on earlier ones."""
    one = lambda acc, k: F.when(acc[k][k] <= COLLINEAR * g[k][k], acc).otherwise(sweep_one(acc, k))
    return F.aggregate(F.sequence(F.lit(0), upto - 1), g, one)


def normal_cdf(x: Column) -> Column:
    """The normal distribution by its series 1/2 + density * (x + x^3/3 + x^5/15 + ...)."""
    near = F.greatest(F.least(x, F.lit(8.0)), F.lit(-8.0))
    tail = F.aggregate(F.sequence(F.lit(CDF_TERMS), F.lit(1), F.lit(-1)), F.lit(1.0), lambda acc, k: 1 + near * near / (2 * k + 1) * acc)
    return F.greatest(F.least(0.5 + near * tail * F.exp(-near * near / 2) * 0.3989422804014327, F.lit(1.0)), F.lit(0.0))
