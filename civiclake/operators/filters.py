"""Predicates that reach the Parquet scan."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, functions as F

from civiclake.functions import as_column


def time_window(col, start, end) -> Column:
    """Half-open range ``start <= col < end``."""
    col = as_column(col)
    return (col >= start) & (col < end)


def partition_equals(col, key) -> Column:
    return as_column(col) == F.lit(key)


def partition_filter(col, *, kind: str = "time", key: str | None = None, window: tuple | None = None) -> Column:
    """Filter of one partition: a time window or an equal key; nothing given keeps every row."""
    if kind == "time":
        return time_window(col, *window) if window else F.lit(True)
    if kind == "equality":
        return partition_equals(col, key) if key is not None else F.lit(True)
    raise ValueError(f"unknown partition filter {kind!r}")


def criterion(rule: dict) -> Column:
    """``{name, type: range, start, end}`` (ends included) or ``{name, type: value, value}``."""
    if rule["type"] == "range":
        return F.col(rule["name"]).between(rule["start"], rule["end"])
    if rule["type"] == "value":
        return F.col(rule["name"]) == F.lit(rule["value"])
    raise ValueError(f"unknown criterion type {rule['type']!r}")


def apply_criteria(df: DataFrame, criteria: list[dict], extra: list[dict] = ()) -> DataFrame:
    """Rows meeting every criterion."""
    rules = [criterion(r) for r in [*criteria, *extra]]
    return df.where(reduce(and_, rules)) if rules else df


def contains_any(col, words: list[str]) -> Column:
    """Case-insensitive: any of the words occurs in the text."""
    text = F.lower(as_column(col))
    found = [F.contains(text, F.lit(word.lower())) for word in words]
    return reduce(or_, found) if found else F.lit(False)
