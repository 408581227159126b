"""Completeness flags."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame

from civiclake.functions import as_column


def all_present(cols) -> Column:
    return reduce(and_, [as_column(c).isNotNull() for c in cols])


def any_present(cols) -> Column:
    return reduce(or_, [as_column(c).isNotNull() for c in cols])


def add_completeness_flags(df: DataFrame, *, date_col: str | None = None, lat_col: str | None = None,
                           lon_col: str | None = None, geo_id_cols: list[str] | None = None,
                           custom_flags: dict[str, list[str]] | None = None) -> DataFrame:
    flags: dict[str, Column] = {}
    if date_col:
        flags["has_date"] = all_present([date_col])
    if lat_col and lon_col:
        flags["has_location"] = all_present([lat_col, lon_col])
    if geo_id_cols:
        flags["has_geo_ids"] = any_present(geo_id_cols)
    flags.update({name: all_present(cols) for name, cols in (custom_flags or {}).items()})
    return df.withColumns(flags) if flags else df
