"""Positions in an order, worked out without ever moving a whole group (or table) to one task.

A random sample of bounded size shows the keys that hold much of the table. Their rows fall into ranges of the order
whose borders are literal values. A row's range depends on nothing but its own values, so any task that is repeated
places it alike and nothing has to be written in between. Each range is numbered by itself; the counts of the ranges
that share a key, two per border at most, supply the offsets. The input is read twice, and once more for the counts
of such keys: write an expensive one first.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, FractionalType, IntegralType, LongType, NumericType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

from civiclake.functions import as_column

_RANGE, _BASE, _WHOLE = "__range", "__base", "__whole"
#: Ranges of each shuffle partition, and sampled rows of each range.
RANGES, SAMPLED = 4, 48


@dataclass(frozen=True)
class By:
    """One column of an order. Nulls come first when ascending and last when descending, unless told otherwise."""

    column: str | Column
    descending: bool = False
    nulls_last: bool | None = None

    @property
    def last(self) -> bool:
        return self.descending if self.nulls_last is None else self.nulls_last

    @property
    def sort(self) -> Column:
        c = as_column(self.column)
        if self.descending:
            return c.desc_nulls_last() if self.last else c.desc_nulls_first()
        return c.asc_nulls_last() if self.last else c.asc_nulls_first()

    def rising(self, kind: DataType) -> list[Column] | None:
        """Columns that, compared as they are with nulls first, never fall along the order; None if there are none."""
        c = as_column(self.column)
        flags = [c.isNull()] if self.last else [c.isNotNull()] if self.descending else []  # a null alone comes first
        if isinstance(kind, (TimestampType, TimestampNTZType)):
            c, kind = F.unix_micros(c.cast("timestamp")), LongType()
        elif isinstance(kind, DateType):
            c, kind = F.unix_date(c), LongType()
        elif isinstance(kind, BooleanType):
            c, kind = c.cast("int"), LongType()
        if not self.descending and isinstance(kind, (NumericType, StringType)):
            return [*flags, c]
        if isinstance(kind, IntegralType):
            return [*flags, F.bitwise_not(c)]
        if isinstance(kind, NumericType):  # NaN, the largest, comes first
            return [*flags, *([~F.isnan(c)] if isinstance(kind, FractionalType) and not isinstance(kind, DecimalType) else []), -c]
        return None


def desc(column: str | Column, nulls_last: bool = True) -> By:
    return By(column, True, nulls_last)


def _as_order(order: list) -> list[By]:
    return [o if isinstance(o, By) else By(o) for o in order]


def _ascending(row: tuple) -> list:
    """Sort key of a row's values as Spark orders them: nulls first, NaN last."""
    return [(v is not None, v != v, 0 if v is None or v != v else v) for v in row]


def _literal(value, kind: DataType) -> str:
    """A value as SQL text."""
    text = "NULL" if value is None else f"X'{value.encode().hex()}'" if isinstance(value, str) else f"'{value}'"
    return f"CAST({text} AS {kind.simpleString()})"


@dataclass(frozen=True)
class Ranges:
    """Consecutive ranges of an order; ``borders`` are the first rows of all but the first range. A descending column
    of text or one of a nested type, and what follows it, divides no range."""

    columns: list[Column]
    borders: list[tuple]
    types: list[DataType]
    width: int = 0  # columns that tell the keys
    whole: bool = True  # whether these tell all of them

    @staticmethod
    def of(df: DataFrame, by: list[By], keys: int = 0) -> Ranges:
        """Ranges of about one size, from a random sample that the driver sorts out. Where the first ``keys`` columns
        are keys that are placed each by itself, only borders inside a key that holds two or more of them stay."""
        kinds = df.select(*[as_column(b.column).alias(f"c{k}") for k, b in enumerate(by)]).schema
        columns: list[Column] = []
        width = told = 0
        for b, field in zip(by, kinds):
            more = b.rising(field.dataType)
            if more is None:
                break
            columns += more
            told += 1
            width = len(columns) if told <= keys else width
        if not columns:
            return Ranges([], [], [])
        count = RANGES * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        values = df.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)])
        rows = sorted(map(tuple, values.orderBy(F.rand(7)).limit(count * SAMPLED).collect()), key=_ascending)
        picked = dict.fromkeys(rows[k * len(rows) // count] for k in range(1, count)) if rows else {}
        held = Counter(b[:width] for b in picked)
        borders = [b for b in picked if not keys or held[b[:width]] > 1]
        return Ranges(columns, borders, [f.dataType for f in values.schema], width, told >= keys)

    def number(self, df: DataFrame) -> DataFrame:
        """The frame with the number of each row's range, by a tree of comparisons with the borders."""
        names = [f"__c{k}" for k in range(len(self.columns))]
        row = f"named_struct({', '.join(f"'{n}', {n}" for n in names)})"

        def among(first: int, end: int) -> str:
            if first == end:
                return str(first)
            middle = (first + end) // 2
            border = ", ".join(f"'{n}', {_literal(v, t)}" for n, v, t in zip(names, self.borders[middle], self.types))
            return f"CASE WHEN {row} >= named_struct({border}) THEN {among(middle + 1, end)} ELSE {among(first, middle)} END"

        if not self.borders:
            return df.withColumn(_RANGE, F.lit(0))
        keyed = df.withColumns(dict(zip(names, self.columns)))
        return keyed.withColumn(_RANGE, F.expr(among(0, len(self.borders)))).drop(*names)

    def divided(self, df: DataFrame) -> DataFrame:
        """The rows whose key a border may divide."""
        schema = StructType([StructField(f"__k{k}", t) for k, t in enumerate(self.types[: self.width])])
        held = df.sparkSession.createDataFrame(list({b[: self.width] for b in self.borders}), schema)
        same = reduce(and_, [c.eqNullSafe(F.col(f"__k{k}")) for k, c in enumerate(self.columns[: self.width])], F.lit(True))
        return df.join(F.broadcast(held), same, "left_semi")


def _same(keys: list[str]) -> Column:
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
    return same


def grouped_position(df: DataFrame, keys: list[str], order: list, *, position: str = "position",
                     group_size: str | None = None) -> DataFrame:
    """Add the 1-based position of each row within its key under ``order`` (and the key's row count).
    ``order`` holds names, expressions, :class:`By` or :func:`desc`, and should end in a unique column to make ties
    repeatable."""
    order = _as_order(order)
    ranges = Ranges.of(df, [*map(By, keys), *order], len(keys))
    ranged = ranges.number(df)
    piece = Window.partitionBy(_RANGE, *keys)
    here = F.row_number().over(piece.orderBy(*[o.sort for o in order])).cast("long")
    placed = ranged.withColumn(position, here)
    if group_size:
        placed = placed.withColumn(_WHOLE, F.count("*").over(piece))
    if not ranges.borders:
        return placed.select(*df.columns, position, *([F.col(_WHOLE).alias(group_size)] if group_size else []))
    # Only keys of borders lie in several ranges: two pairs of range and key for each border at most.
    pieces = ranges.divided(ranged).groupBy(_RANGE, *keys).agg(F.count("*").alias("__n"))
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        F.col(_RANGE).alias("__in"), *[F.col(k).alias(f"__o_{k}") for k in keys],
        F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias(_BASE), F.sum("__n").over(whole).alias("__all"))
    joined = placed.join(F.broadcast(offsets) if ranges.whole else offsets, (F.col(_RANGE) == F.col("__in")) & _same(keys), "left")
    added = [(F.col(position) + F.coalesce(_BASE, F.lit(0))).alias(position)]
    if group_size:
        added.append(F.coalesce("__all", _WHOLE).alias(group_size))
    return joined.select(*df.columns, *added)


def table_position(df: DataFrame, order: list, *, position: str = "position") -> DataFrame:
    """Add the 1-based position of each row in the whole table under ``order``."""
    order = _as_order(order)
    ranged = Ranges.of(df, order).number(df)
    here = F.row_number().over(Window.partitionBy(_RANGE).orderBy(*[o.sort for o in order])).cast("long")
    counts = ranged.groupBy(F.col(_RANGE).alias("__in")).agg(F.count("*").alias("__n"))
    before = Window.orderBy("__in").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("__in", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias(_BASE))  # a row for each range
    joined = ranged.withColumn(position, here).join(F.broadcast(offsets), F.col(_RANGE) == F.col("__in"))
    return joined.select(*df.columns, (F.col(position) + F.col(_BASE)).alias(position))


def page_index(df: DataFrame, order: list, limit: int, *, offset: str = "row_offset", page: str = "page") -> DataFrame:
    """Zero-based row offset under ``order`` and the page of ``limit`` rows it falls in."""
    row = F.col(offset)
    return (table_position(df, order, position=offset)
            .withColumn(offset, row - 1)
            .withColumn(page, F.call_function("div", row, F.lit(limit))))


def page_plan(paged: DataFrame, limit: int, *, page: str = "page", offset: str = "row_offset",
              first: dict[str, str] | None = None) -> DataFrame:
    """One row per page: its offset, its rows, whether it is the last, short one, and values of its first row, given
    as ``{name: column}``."""
    opening = [F.min_by(c, offset).alias(name) for name, c in (first or {}).items()]
    return paged.groupBy(page).agg(F.count("*").alias("rows"), *opening).select(
        page, (F.col(page) * limit).alias("page_offset"), "rows", (F.col("rows") < limit).alias("is_final"), *(first or {}))


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, *, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of each key. Spark limits every map partition to ``k`` rows per key before
    the shuffle, so a hot key sends little."""
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*[as_column(o) for o in order])))
    return ranked.where(F.col(rank) <= k)


#: Histogram buckets of a doubling of the value.
_FINE = 256


def _bucket(value: Column) -> Column:
    """A whole number that never falls when the value rises; NaN comes last."""
    size = F.floor(F.log2(1 + F.abs(value)) * _FINE)
    return F.when(F.isnan(value) | (value == float("inf")), 1 << 20).when(value == float("-inf"), -(1 << 20)).when(value < 0, -1 - size).otherwise(size).cast("int")


def grouped_quantiles(df: DataFrame, keys: list[str], value: str | dict[str, dict[str, float]],
                      quantiles: dict[str, float] | None = None) -> DataFrame:
    """Exact interpolated quantiles per key (median is 0.5), without gathering or sorting a key.

    A histogram counts the values of each key; the buckets that hold the two positions around each quantile are
    picked from it, and a second pass counts the distinct values of these buckets alone. Several columns, given as
    ``{column: {name: quantile}}``, are unpivoted and counted together."""
    wanted = value if isinstance(value, dict) else {value: quantiles}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(wanted)]))
    stacked = df.select(*keys, pairs.alias("__pair")).select(*keys, F.col("__pair.i").alias("__which"), F.col("__pair.v").alias("__value"))
    stacked = stacked.where("__value IS NOT NULL").withColumn("__bucket", _bucket(F.col("__value")))
    group = Window.partitionBy(*keys, "__which")
    until = group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = stacked.groupBy(*keys, "__which", "__bucket").agg(F.count("*").alias("__count"))
    counts = counts.withColumns({"__ahead": F.coalesce(F.sum("__count").over(until), F.lit(0)), "__total": F.sum("__count").over(group)})

    def targets(which: int, q: float) -> tuple[Column, Column, Column]:
        """Zero-based positions around a quantile and the share of the upper one."""
        target = F.lit(float(q)) * (F.col("__total") - 1)
        return F.floor(target), F.floor(target) + 1, target - F.floor(target)

    def held(at: Column, count: str) -> Column:
        return (F.col("__ahead") <= at) & (at < F.col("__ahead") + F.col(count))

    asked = [(which, name, q) for which, names in enumerate(wanted.values()) for name, q in names.items()]
    some = F.lit(False)
    for which, _, q in asked:
        low, high, _ = targets(which, q)
        some = some | ((F.col("__which") == which) & (held(low, "__count") | held(high, "__count")))
    picked = counts.where(some).select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.col("__which").alias("__w"), F.col("__bucket").alias("__b"), F.col("__ahead").alias("__start"), "__total")
    inside = stacked.join(picked, (F.col("__which") == F.col("__w")) & (F.col("__bucket") == F.col("__b")) & _same(keys))
    values = inside.groupBy(*keys, "__which", "__bucket", "__value").agg(F.count("*").alias("__n"), F.first("__start").alias("__start"), F.first("__total").alias("__total"))
    lower = Window.partitionBy(*keys, "__which", "__bucket").orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("__ahead", F.col("__start") + F.coalesce(F.sum("__n").over(lower), F.lit(0)))
    aggregates = []
    for which, name, q in asked:
        low, high, share = targets(which, q)
        weight = F.when(held(low, "__n"), 1 - share).otherwise(0.0) + F.when(held(high, "__n"), share).otherwise(0.0)
        aggregates.append(F.sum(F.when((F.col("__which") == which) & (weight > 0), weight * F.col("__value"))).alias(name))
    return values.groupBy(*keys).agg(*aggregates)
