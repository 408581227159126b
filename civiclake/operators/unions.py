"""Unions, unpivot and year-routed sources."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def diagonal_concat(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def vertical_concat(frames: list[DataFrame]) -> DataFrame:
    """Union of frames of one and the same schema; a different one is an error."""
    layouts = {tuple((f.name, f.dataType.simpleString()) for f in df.schema.fields) for df in frames}
    if len(layouts) > 1:
        raise ValueError("vertical concat needs equal schemas")
    return reduce(DataFrame.unionByName, frames)


def relaxed_concat(frames: list[DataFrame]) -> DataFrame:
    """Union of equally named columns, each widened to the common type of all frames."""
    names = frames[0].columns
    if any(df.columns != names for df in frames):
        raise ValueError("relaxed concat needs equal column names")
    # Let Spark's own union coercion find the common types.
    return reduce(DataFrame.union, frames)


def unpivot_values(df: DataFrame, ids: list[str], values: list[str], *, value: str, source: str | None = None) -> DataFrame:
    """One row per non-null value column, in a single scan."""
    long = df.unpivot(ids, values, source or "__source", value).where(F.col(value).isNotNull())
    return long if source else long.drop("__source")


@dataclass(frozen=True)
class YearSource:
    """A source serving the years from ``year_start`` to ``year_end`` (open-ended when None)."""

    name: str
    year_start: int
    year_end: int | None = None
    layer: str = "landing"
    grain: str = "monthly_to_yearly"

    def covers(self, year: Column) -> Column:
        started = year >= self.year_start
        return started if self.year_end is None else started & (year <= self.year_end)


def active_source(sources: list[YearSource], year: int) -> YearSource | None:
    """First source serving a year."""
    for s in sources:
        if s.year_start <= year and (s.year_end is None or year <= s.year_end):
            return s
    return None


def route_column(sources: list[YearSource], year) -> Column:
    """Name of the source serving a year; null when there is none."""
    year = F.col(year) if isinstance(year, str) else year
    return F.coalesce(*[F.when(s.covers(year), F.lit(s.name)) for s in sources], F.lit(None).cast(T.StringType()))


def year_routed_union(frames: dict[str, DataFrame], sources: list[YearSource], year_col: str = "year") -> DataFrame:
    """Union in which every year comes from exactly one source. The year ranges are plain
    comparisons, so each scan is filtered (and partition-pruned) on its own."""
    taken: list[YearSource] = []
    parts = []
    for s in sources:
        year = F.col(year_col).cast("int")
        mine = s.covers(year)
        for earlier in taken:
            mine = mine & ~earlier.covers(year)
        parts.append(frames[s.name].where(mine).withColumn("source", F.lit(s.name)))
        taken.append(s)
    return diagonal_concat(parts)
