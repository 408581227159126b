"""Column order and row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def reorder_columns(df: DataFrame, priority: list[str]) -> DataFrame:
    """Listed columns first (absent ones ignored), the rest in their order."""
    front = [c for c in priority if c in df.columns]
    return df.select(front + [c for c in df.columns if c not in front])


def with_row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """Unique row ids, not dense, added without a shuffle. Materialize the result before using the
    ids in two places."""
    return df.select(F.monotonically_increasing_id().alias(name), "*")
