"""One configuration for derived columns: how they are made and how they are described."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, functions as F, types as T

from civiclake.functions.flags import add_completeness_flags
from civiclake.functions.geo import add_borough_key, add_location_flag
from civiclake.functions.temporal import (NEW_YORK, add_record_timestamp, add_temporal_columns, enforce_timezone)


def derived(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, True, {"comment": f"[Derived] {comment}"})


_TEXT, _INT, _BOOL, _TS = T.StringType(), T.IntegerType(), T.BooleanType(), T.TimestampType()

# Part of add_temporal_columns -> (column suffix, type, comment).
_TEMPORAL = {
    "year": ("year", _INT, "calendar year"),
    "month": ("month", _INT, "month, 1 to 12"),
    "quarter": ("quarter", _INT, "quarter, 1 to 4"),
    "day_of_week": ("day_of_week", _TEXT, "weekday name"),
    "fiscal_year": ("fiscal_year", _INT, "fiscal year, starting in July"),
    "season": ("season", _TEXT, "meteorological season"),
    "year_month_key": ("year_month", _TEXT, "year and month, YYYY-MM"),
    "hour": ("hour", _INT, "hour, 0 to 23"),
    "is_overnight": ("is_overnight", _BOOL, "true from 22:00 to 05:59"),
}


def borough_columns(*, key: bool = True, code: bool = False, canonical_name: bool = False) -> list[T.StructField]:
    known = (
        (key, derived("borough_key", _TEXT, "borough join key in lower case, e.g. staten_island")),
        (code, derived("borough_code", _INT, "borough code, 1 to 5")),
        (canonical_name, derived("borough_name", _TEXT, "borough name")),
    )
    return [column for wanted, column in known if wanted]


def location_columns(alias: str = "has_location") -> list[T.StructField]:
    return [derived(alias, _BOOL, "latitude and longitude are present and inside the city bounds")]


def district_columns(alias: str = "community_district_key") -> list[T.StructField]:
    return [derived(alias, _TEXT, "community district key: borough code and two-digit district")]


def parcel_columns(alias: str = "bbl") -> list[T.StructField]:
    return [derived(alias, _TEXT, "ten-digit borough, block and lot id")]


def record_timestamp_columns() -> list[T.StructField]:
    return [derived("record_timestamp", _TS, "instant of the record's main date"),
            derived("record_date_precision", _TEXT, "precision of record_timestamp: year, month, day or datetime")]


def temporal_columns(*, prefix: str = "", **parts: bool) -> list[T.StructField]:
    wanted = {"year": True, "month": True, "quarter": True, **parts}
    return [derived(prefix + suffix, kind, f"{text} of record_timestamp")
            for part, (suffix, kind, text) in _TEMPORAL.items() if wanted.get(part)]


def completeness_columns(*, date_col: str | None = None, lat_col: str | None = None, lon_col: str | None = None,
                         geo_id_cols: list[str] | None = None,
                         custom_flags: dict[str, list[str]] | None = None) -> list[T.StructField]:
    columns = []
    if date_col:
        columns.append(derived("has_date", _BOOL, f"{date_col} is present"))
    if lat_col and lon_col:
        columns.append(derived("has_location", _BOOL, f"{lat_col} and {lon_col} are present"))
    if geo_id_cols:
        columns.append(derived("has_geo_ids", _BOOL, f"any of {', '.join(geo_id_cols)} is present"))
    for name, needed in (custom_flags or {}).items():
        columns.append(derived(name, _BOOL, f"all of {', '.join(needed)} are present"))
    return columns


def duplicate_columns(count_col: str = "_dedup_count", rank_out_col: str = "_dedup_rank") -> list[T.StructField]:
    return [derived(count_col, T.LongType(), "rows sharing the key columns"),
            derived(rank_out_col, _INT, "rank within the key, 1 = preferred row")]


@dataclass(frozen=True)
class BoroughConfig:
    source_col: str
    key: bool = True
    code: bool = False
    canonical_name: bool = False

    def columns(self) -> list[T.StructField]:
        return borough_columns(key=self.key, code=self.code, canonical_name=self.canonical_name)

    def apply(self, df: DataFrame) -> DataFrame:
        return add_borough_key(df, **asdict(self))


@dataclass(frozen=True)
class LocationConfig:
    lat_col: str = "latitude"
    lon_col: str = "longitude"

    def columns(self) -> list[T.StructField]:
        return location_columns()

    def apply(self, df: DataFrame) -> DataFrame:
        return add_location_flag(df, self.lat_col, self.lon_col)


@dataclass(frozen=True)
class TimestampConfig:
    source_col: str
    precision: str = "day"
    tz: str = NEW_YORK

    def columns(self) -> list[T.StructField]:
        return record_timestamp_columns()

    def apply(self, df: DataFrame) -> DataFrame:
        return add_record_timestamp(df, F.col(self.source_col), self.precision, tz=self.tz)


@dataclass(frozen=True)
class TemporalConfig:
    year: bool = True
    month: bool = True
    quarter: bool = True
    day_of_week: bool = False
    fiscal_year: bool = False
    season: bool = False
    year_month_key: bool = False
    hour: bool = False
    is_overnight: bool = False
    tz: str = NEW_YORK

    def columns(self) -> list[T.StructField]:
        return temporal_columns(**{p: v for p, v in asdict(self).items() if p != "tz"})

    def apply(self, df: DataFrame) -> DataFrame:
        return add_temporal_columns(df, **asdict(self))


@dataclass(frozen=True)
class CompletenessConfig:
    """Coordinates are left to :class:`LocationConfig`, which makes ``has_location``."""

    date_col: str | None = None
    geo_id_cols: list[str] | None = None
    custom_flags: dict[str, list[str]] | None = None

    def columns(self) -> list[T.StructField]:
        return completeness_columns(**asdict(self))

    def apply(self, df: DataFrame) -> DataFrame:
        return add_completeness_flags(df, **asdict(self))


@dataclass(frozen=True)
class StandardEnrichments:
    """The usual derived columns, applied in this order: time zones, borough, location, record
    timestamp, calendar parts, completeness flags."""

    borough: BoroughConfig | None = None
    location: LocationConfig | None = None
    timestamp: TimestampConfig | None = None
    temporal: TemporalConfig | None = None
    completeness: CompletenessConfig | None = None
    timezone_columns: list[str] | None = None
    extra_columns: list[T.StructField] = field(default_factory=list)
    tz: str = NEW_YORK

    def _steps(self):
        timestamp = self.timestamp and replace(self.timestamp, tz=self.tz)
        temporal = self.temporal and replace(self.temporal, tz=self.tz)
        steps = (self.borough, self.location, timestamp, temporal, self.completeness)
        return [s for s in steps if s is not None]

    def build_derived_columns(self) -> list[T.StructField]:
        columns = [c for step in self._steps() for c in step.columns()] + list(self.extra_columns)
        names = [c.name for c in columns]
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"derived columns are named twice: {repeated}")
        return columns

    def build_transform_fn(self) -> Callable[[DataFrame], DataFrame]:
        def enrich(df: DataFrame) -> DataFrame:
            df = enforce_timezone(df, self.timezone_columns or [], target_tz=self.tz)
            for step in self._steps():
                df = step.apply(df)
            return df

        return enrich
