"""Clean and analytics layers: Parquet tables, flat or in hive folders."""

from __future__ import annotations

import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from civiclake.operators.unions import diagonal_concat
from civiclake.sources.storage import has_file, log, partition_path, partition_values, write_by_columns, write_partition


def write_table(df: DataFrame, root: str, key: str | None = None, **options) -> str:
    """Replace a flat table or one of its partitions."""
    return write_partition(df, root, "parquet", key, **options)


def write_batches(df: DataFrame, root: str, key: str | None = None, *, rows_per_file: int = 1_000_000) -> str:
    """As :func:`write_table`, in files of bounded size."""
    return write_partition(df, root, "parquet", key, maxRecordsPerFile=rows_per_file)


def write_hive(df: DataFrame, root: str, timestamp_col: str | None = None, *, grain: str = "monthly", **options) -> str:
    """Write ``year=`` or ``year=/month=`` folders; the columns come from ``timestamp_col`` when
    given. Only partitions present in the frame are replaced."""
    if grain not in ("yearly", "monthly"):
        raise ValueError(f"unknown grain {grain!r}")
    columns = ["year", "month"] if grain == "monthly" else ["year"]
    if timestamp_col:
        patterns = {"year": "yyyy", "month": "MM"}
        df = df.withColumns({c: F.date_format(timestamp_col, patterns[c]) for c in columns})
    return write_by_columns(df, root, "parquet", columns, **options)


def _has_files(spark: SparkSession, path: str) -> bool:
    return has_file(spark, path, ".parquet")


def read_table(spark: SparkSession, root: str, keys: list[str] | None = None, *, merge_schema: bool = True,
               schema: T.StructType | str | None = None) -> DataFrame:
    """Table or some of its partitions; files may lack columns others have (read as null). With a declared
    ``schema`` (hive columns may be left out) no footer is opened before the query runs; without one the
    schemas of all files are merged. A missing partition is a warning, nothing at all an error."""
    wanted = [partition_path(root, k) for k in keys] if keys else [root]
    found = [p for p in wanted if _has_files(spark, p)]
    for path in sorted(set(wanted) - set(found)):
        log.warning("no Parquet files under %s", path)
    if not found:
        raise FileNotFoundError(f"no Parquet files for {keys or 'any partition'} under {root}")
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", merge_schema)
    return reader.option("basePath", root).parquet(*found)


def load_partitions(spark: SparkSession, root: str, keys: list[str], *,
                    cast_overrides: dict[str, str] | None = None) -> DataFrame | None:
    """Chosen partitions, missing ones skipped; None when there are none. With ``cast_overrides`` each
    partition is read by itself and cast first, for columns whose type changed over time."""
    found = []
    for key in keys:
        if _has_files(spark, partition_path(root, key)):
            found.append(key)
        else:
            log.warning("partition %s is missing under %s", key, root)
    if not found:
        return None
    if not cast_overrides:
        return read_table(spark, root, found)
    frames = []
    for key in found:
        part = read_table(spark, root, [key])
        frames.append(part.withColumns({c: F.col(c).cast(t) for c, t in cast_overrides.items() if c in part.columns}))
    return diagonal_concat(frames)


def read_glob(spark: SparkSession, pattern: str, *, hive_partitioning: bool = False, union_by_name: bool = True,
              base_path: str | None = None) -> DataFrame:
    """Files of a path or glob; hive columns only on request, schemas merged by name by default."""
    reader = spark.read.option("mergeSchema", union_by_name)
    if hive_partitioning:
        fixed = re.split(r"[*?\[{]", pattern)[0]
        reader = reader.option("basePath", base_path or fixed.rsplit("/", 1)[0])
    else:
        reader = reader.option("recursiveFileLookup", True)
    return reader.parquet(pattern)


def combine_slices(df: DataFrame, target: str, keys: list[str]) -> str:
    """Selected hive slices of a table as one zstd Parquet table. The slices are one pruned scan: a
    folder per key is read, nothing else."""
    slices = [reduce(and_, [F.col(c) == F.lit(v) for c, v in partition_values(k).items()]) for k in keys]
    return write_table(df.where(reduce(or_, slices)), target, compression="zstd")
