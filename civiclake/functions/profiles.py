"""Measurements over a depth profile kept as two JSON number arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from civiclake.functions import as_column


def parse_numbers(col) -> Column:
    """JSON number array as an array; null when unreadable."""
    return F.from_json(as_column(col), "array<double>")


def area_under(depths, seconds) -> Column:
    """Trapezoid area under depth over time of two parsed arrays, in depth-minutes, to two digits;
    null for unequal or single-point profiles."""
    d, t = as_column(depths), as_column(seconds)

    def slab(total: Column, i: Column) -> Column:
        return total + (d[i - 1] + d[i]) / 2.0 * ((t[i] - t[i - 1]) / 60.0)

    area = F.aggregate(F.sequence(F.lit(1), F.size(d) - 1), F.lit(0.0), slab)
    return F.when((F.size(d) >= 2) & (F.size(d) == F.size(t)), F.round(area, 2))


def profile_area(depths, seconds) -> Column:
    """:func:`area_under` of two JSON texts, each parsed once (the one-element array holds them)."""
    parsed = F.array(F.struct(parse_numbers(depths).alias("d"), parse_numbers(seconds).alias("t")))
    return F.transform(parsed, lambda p: area_under(p["d"], p["t"]))[0]


def sample_count(numbers) -> Column:
    numbers = as_column(numbers)
    return F.when(numbers.isNotNull(), F.size(numbers))


def profile_sample_count(depths) -> Column:
    return sample_count(parse_numbers(depths))
