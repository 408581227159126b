"""Date and time functions.

Timestamps are instants and the session zone is UTC; ``timestamp_ntz`` and ``date`` are wall time.
Every calendar function therefore takes the zone whose calendar it speaks of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from civiclake.functions import as_column

NEW_YORK = "America/New_York"
PRECISIONS = ("year", "month", "day", "datetime")
DURATION_UNITS = {
    "hours": 3_600_000_000,
    "minutes": 60_000_000,
    "seconds": 1_000_000,
    "milliseconds": 1_000,
    "microseconds": 1,
}


def localize(wall: Column, tz: str, *, unless: Column | None = None) -> Column:
    """Instant of a wall time in ``tz``: null inside the skipped hour, the later instant in the
    doubled hour. Accepts timestamp_ntz, date or a timestamp holding wall time as UTC. Where
    ``unless`` holds, the value is an instant already and kept.

    The first condition uses the value twice, which lets Spark share one evaluation of it."""
    wall = wall.cast("timestamp")
    instant = F.to_utc_timestamp(wall, tz)
    later = instant + F.expr("INTERVAL 1 HOUR")
    kept = F.lit(None).cast("timestamp") if unless is None else F.when(unless, wall)
    resolved = F.when(F.from_utc_timestamp(instant, tz) != wall, kept)
    if unless is not None:
        resolved = resolved.when(unless, wall)
    return resolved.when(F.from_utc_timestamp(later, tz) == wall, later).otherwise(instant)


def local_wall_time(instant: Column, tz: str) -> Column:
    return F.from_utc_timestamp(instant, tz)


def wall_time(df: DataFrame, col: str, tz: str) -> Column:
    """Wall time of a column whatever its type."""
    c = F.col(col)
    return local_wall_time(c, tz) if isinstance(df.schema[col].dataType, T.TimestampType) else c


def parse_string_date(col, fmt: str, *, pre_replace: dict[str, str] | None = None, suffix: str | None = None) -> Column:
    """Date out of text after literal replacements and an added suffix; unreadable -> null."""
    from civiclake.functions.coerce import try_parse

    text = as_column(col).cast("string")
    for old, new in (pre_replace or {}).items():
        text = F.replace(text, F.lit(old), F.lit(new))
    if suffix:
        text = F.concat(text, F.lit(suffix))
    return F.to_date(try_parse(text, fmt))


def add_record_timestamp(df: DataFrame, source, precision: str, *, tz: str = NEW_YORK) -> DataFrame:
    """Add ``record_timestamp`` (instant) and ``record_date_precision``. Integers are years."""
    if precision not in PRECISIONS:
        raise ValueError(f"precision must be one of {PRECISIONS}, got {precision!r}")
    source = as_column(source)
    kind = df.select(source.alias("source")).schema["source"].dataType
    if isinstance(kind, T.TimestampType):
        instant = source
    elif isinstance(kind, T.IntegralType):
        instant = localize(F.make_date(source.cast("int"), F.lit(1), F.lit(1)), tz)
    elif isinstance(kind, (T.DateType, T.TimestampNTZType)):
        instant = localize(source, tz)
    else:
        instant = localize(source.try_cast("timestamp_ntz"), tz)
    return df.withColumns({"record_timestamp": instant, "record_date_precision": F.lit(precision)})


def day_name(wall: Column) -> Column:
    return F.coalesce(F.date_format(wall, "EEEE"), F.lit("Unknown"))


def fiscal_year(wall: Column) -> Column:
    """Fiscal year starting in July."""
    return F.year(F.add_months(F.to_date(wall), 6))


def season(wall: Column) -> Column:
    """Meteorological season: one month ahead, seasons are quarters."""
    quarter = F.quarter(F.add_months(F.to_date(wall), 1))
    return (F.when(quarter == 1, "winter").when(quarter == 2, "spring").when(quarter == 3, "summer")
            .when(quarter == 4, "fall").otherwise("unknown"))


def is_overnight(wall: Column) -> Column:
    return ~F.hour(wall).between(6, 21)


CALENDAR_PARTS = {
    "year": F.year,
    "month": F.month,
    "quarter": F.quarter,
    "day_of_week": day_name,
    "fiscal_year": fiscal_year,
    "season": season,
    "year_month": lambda wall: F.date_format(wall, "yyyy-MM"),
    "hour": F.hour,
    "is_overnight": is_overnight,
}


def add_temporal_columns(
    df: DataFrame,
    date_col: str = "record_timestamp",
    *,
    year: bool = True,
    month: bool = True,
    quarter: bool = True,
    day_of_week: bool = False,
    fiscal_year: bool = False,
    season: bool = False,
    year_month_key: bool = False,
    hour: bool = False,
    is_overnight: bool = False,
    prefix: str = "",
    tz: str = NEW_YORK,
) -> DataFrame:
    """Add the requested calendar columns, named ``{prefix}{part}``, all in one projection."""
    wanted = {
        "year": year, "month": month, "quarter": quarter, "day_of_week": day_of_week,
        "fiscal_year": fiscal_year, "season": season, "year_month": year_month_key,
        "hour": hour, "is_overnight": is_overnight,
    }
    wall = wall_time(df, date_col, tz)
    added = {prefix + part: CALENDAR_PARTS[part](wall) for part, on in wanted.items() if on}
    return df.withColumns(added) if added else df


def compute_duration(start, end, *, unit: str = "hours", round_digits: int | None = 2) -> Column:
    """Whole units from start to end as a double, truncated toward zero."""
    if unit not in DURATION_UNITS:
        raise ValueError(f"unit must be one of {list(DURATION_UNITS)}, got {unit!r}")
    micros = F.timestamp_diff("MICROSECOND", as_column(start), as_column(end))
    # Both sides are longs: integer division truncates toward zero.
    whole = F.call_function("div", micros, F.lit(DURATION_UNITS[unit]).cast("long")).cast("double")
    return whole if round_digits is None else F.round(whole, round_digits)


def negative_duration(start, end) -> Column:
    return F.coalesce(as_column(end) < as_column(start), F.lit(False))


def duration_columns(start: str, end: str, *, unit: str = "hours", alias: str | None = None,
                     round_digits: int | None = 2, flag_negative: bool = False,
                     flag_alias: str = "is_temporal_error") -> list[Column]:
    """Named duration column and, on request, the flag for an end before its start."""
    columns = [compute_duration(start, end, unit=unit, round_digits=round_digits)
               .alias(alias or f"{start}_to_{end}_{unit}")]
    if flag_negative:
        columns.append(negative_duration(start, end).alias(flag_alias))
    return columns


def enforce_timezone(df: DataFrame, cols: list[str], *, target_tz: str = NEW_YORK) -> DataFrame:
    """Turn wall-time and text columns into instants of ``target_tz``; instants stay, absent names are skipped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {}
    for name in cols:
        if name not in types or isinstance(types[name], T.TimestampType):
            continue
        changed[name] = localize(_as_wall(name, types[name]), target_tz)
    return df.withColumns(changed) if changed else df


def _as_wall(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.col(name)
    return F.col(name).cast("string").try_cast("timestamp_ntz")


def impute_interval(df: DataFrame, start: str, end: str, minutes: str, flag: str = "has_imputed_timestamp") -> DataFrame:
    """Fill a missing start or end from the other one and a length in minutes, and flag such rows."""
    length = F.make_dt_interval(secs=(F.col(minutes) * 60).cast("decimal(18,6)"))
    filled_start = F.coalesce(F.col(start), F.col(end) - length)
    return df.withColumns({
        flag: F.col(start).isNull() | F.col(end).isNull(),
        start: filled_start,
        end: F.coalesce(F.col(end), filled_start + length),
    })


def partition_windows(bounds: DataFrame, kind: str, start, end, *, tz: str = NEW_YORK, end_offset: int = 0) -> DataFrame:
    """Yearly or monthly partitions between the ``start`` and ``end`` dates of each row of ``bounds``:
    those complete at ``end`` plus ``end_offset`` more. Windows are instants, half open."""
    if kind not in ("yearly", "monthly"):
        raise ValueError(f"unknown partition kind {kind!r}")
    step, unit, pattern = (12, "YEAR", "yyyy") if kind == "yearly" else (1, "MONTH", "yyyy-MM")
    first = F.to_date(F.trunc(F.to_date(as_column(start)), unit))
    stop = F.add_months(F.to_date(F.trunc(F.to_date(as_column(end)), unit)), step * end_offset)
    starts = F.filter(
        F.when(first < stop, F.sequence(first, stop, F.expr(f"INTERVAL {step} MONTH"))),
        lambda d: d < stop,
    )
    day = F.col("day")
    return bounds.select(F.explode(starts).alias("day")).select(
        F.date_format(day, pattern).alias("partition_key"),
        localize(day, tz).alias("window_start"),
        localize(F.add_months(day, step), tz).alias("window_end"),
    )


def timestamp_literal(value) -> str:
    """``YYYY-MM-DD HH:MM:SS`` with a ``±HH:MM`` offset when the datetime is aware."""
    return value.isoformat(sep=" ", timespec="seconds")
