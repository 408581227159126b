"""Duplicate markers."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from civiclake.operators.ordering import By, grouped_position, top_per_group


def _direction(rank_col: str, descending: bool):
    col = F.col(rank_col)
    return col.desc_nulls_last() if descending else col.asc_nulls_last()


def add_duplicate_markers(df: DataFrame, *, key_cols: list[str], rank_col: str, tiebreak: list[str],
                          count_col: str = "_dedup_count", rank_out_col: str = "_dedup_rank",
                          descending: bool = True) -> DataFrame:
    """Rows per key and the ordinal rank within the key (1 = preferred); rows without a rank value
    get none. Equal rank values are ordered by ``tiebreak``, which should end in a unique column: it also lets a
    key with one rank value be spread over many tasks."""
    placed = grouped_position(df, key_cols, [By(rank_col, descending, nulls_last=True), *tiebreak],
                              position=rank_out_col, group_size=count_col)
    ranked = F.when(F.col(rank_col).isNotNull(), F.col(rank_out_col).cast("int"))
    return placed.select(*df.columns, count_col, ranked.alias(rank_out_col))


def keep_preferred(df: DataFrame, *, key_cols: list[str], rank_col: str, tiebreak: list[str],
                   descending: bool = True) -> DataFrame:
    """The rank-1 row of each key; needs no full ranking, so each task keeps one row per key."""
    ranked = top_per_group(df.where(F.col(rank_col).isNotNull()), key_cols,
                           [_direction(rank_col, descending), *tiebreak], 1, rank="__rank")
    return ranked.drop("__rank")


def count_per_key(df: DataFrame, key_cols: list[str], count_col: str = "_dedup_count") -> DataFrame:
    """Rows per key next to every row: aggregate first, then join the counts back (null is a key
    like any other). A hot key is split by the adaptive skew join, its count being a single row."""
    counts = df.groupBy(*[F.col(k).alias(f"__{k}") for k in key_cols]).agg(F.count("*").alias(count_col))
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key_cols])
    return df.join(counts, same, "left").drop(*[f"__{k}" for k in key_cols])


def distinct_sorted(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)
