"""Sums of components and guarded ratios."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from civiclake.functions import as_column


def sum_components(cols, *, fill_null: float = 0.0) -> Column:
    return reduce(add, [F.coalesce(as_column(c), F.lit(fill_null)) for c in cols])


def compute_rate(numerator, denominator, *, scale: float = 1.0, null_on_zero: bool = True,
                 round_digits: int | None = 4) -> Column:
    """``numerator * scale / denominator``. Over zero it is null, or with ``null_on_zero=False``
    what floating-point division gives: infinity with the numerator's sign, NaN for 0/0."""
    top = as_column(numerator).cast("double") * F.lit(float(scale))
    bottom = as_column(denominator).cast("double")
    rate = F.try_divide(top, bottom)
    if round_digits is not None:
        rate = F.round(rate, round_digits)
    if null_on_zero:
        return rate
    return F.when(
        bottom == 0,
        F.when(top == 0, F.lit(float("nan"))).when(top > 0, F.lit(float("inf"))).when(top < 0, F.lit(float("-inf"))),
    ).otherwise(rate)


def ratio(top: Column, bottom: Column, digits: int, scale: float = 1.0) -> Column:
    """Rounded ``scale * top / bottom`` of aggregates, null over zero."""
    return F.round(F.lit(float(scale)) * top / F.nullif(bottom, F.lit(0)), digits)


def filled(col) -> Column:
    return F.coalesce(as_column(col), F.lit(0))
