"""What tables and columns there are."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from civiclake.sources.storage import file_list

_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
DEFAULT_CATALOG = "spark_catalog"
DEFAULT_SCHEMA = "default"


def check_identifier(name: str, what: str = "name") -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"{what}={name!r} is not a plain SQL identifier")
    return name


def parse_table_ref(ref: str) -> tuple[str, str, str]:
    """``table``, ``schema.table`` or ``catalog.schema.table`` with defaults for what is left out."""
    parts = ref.rsplit(".", 2)
    missing = (DEFAULT_CATALOG, DEFAULT_SCHEMA)[: 3 - len(parts)]
    return (*missing, *parts)  # type: ignore[return-value]


def _rows(spark: SparkSession, rows: list[Row], schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def full_name(spark: SparkSession, ref: str) -> str | None:
    """Name under which Spark knows a reference (a temporary view keeps its own); None if unknown."""
    catalog, schema, table = (check_identifier(p) for p in parse_table_ref(ref))
    if ref == table and spark.catalog.tableExists(table):
        return table
    full = f"{catalog}.{schema}.{table}"
    return full if spark.catalog.tableExists(full) else None


def _table(spark: SparkSession, ref: str) -> DataFrame | None:
    name = full_name(spark, ref)
    return spark.table(name) if name else None


def list_tables(spark: SparkSession, schema: str | None = None) -> DataFrame:
    """catalog, schema, name and number of columns of tables and views."""
    rows = []
    for t in spark.catalog.listTables(schema):
        namespace = t.namespace[0] if t.namespace else None
        ref = f"{namespace}.{t.name}" if namespace else t.name
        rows.append(Row(t.catalog, namespace, t.name, len(spark.table(ref).columns)))
    return _rows(spark, rows, "catalog string, schema string, name string, columns int")


def list_stored_tables(spark: SparkSession, base: str, pattern: str = "*.parquet") -> DataFrame:
    """Tables stored under a folder with their files and size in MB, from file listings alone."""
    marker = f"/{base.rstrip('/').rsplit('/', 1)[-1]}/"
    files = file_list(spark, base, pattern)
    table = F.split(F.substring_index("path", marker, -1), "/")[0]
    return files.groupBy(table.alias("table")).agg(
        F.count("*").alias("files"), F.round(F.sum("length") / (1024.0 * 1024.0), 2).alias("size_mb"))


def describe(spark: SparkSession, ref: str, *, with_comments: bool = False) -> DataFrame:
    """Column names and types (and comments) of a table; no rows for an unknown one."""
    df = _table(spark, ref)
    schema = "column_index int, column_name string, column_type string"
    fields = df.schema.fields if df is not None else []
    columns = _rows(spark, [Row(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)], schema)
    if with_comments:
        columns = columns.join(column_comments(spark, ref), "column_name", "left")
    order = ["column_name", "column_type"] + (["comment"] if with_comments else [])
    return columns.orderBy("column_index").select(order)


def column_comments(spark: SparkSession, ref: str, *, include_empty: bool = True) -> DataFrame:
    """Comment of every column, in column order."""
    df = _table(spark, ref)
    fields = df.schema.fields if df is not None else []
    rows = [Row(f.name, f.metadata.get("comment")) for f in fields]
    return _rows(spark, [r for r in rows if include_empty or r[1]], "column_name string, comment string")


def table_comments(spark: SparkSession, schema: str | None = None, *, include_empty: bool = False) -> DataFrame:
    """Comments of the stored tables of one schema or of all."""
    schemas = [check_identifier(schema, "schema")] if schema else [d.name for d in spark.catalog.listDatabases()]
    rows = [Row(s, t.name, t.description) for s in schemas for t in spark.catalog.listTables(s) if not t.isTemporary]
    kept = [r for r in rows if include_empty or r[2]]
    return _rows(spark, kept, "schema_name string, table_name string, comment string").orderBy("schema_name", "table_name")
