"""Column functions; every one is built from Spark expressions and runs inside codegen."""

from pyspark.sql import Column, functions as F


def as_column(value) -> Column:
    """A column name or a Column, as a Column."""
    return F.col(value) if isinstance(value, str) else value


def strip(text: Column) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
