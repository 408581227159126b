"""Where the files of a table and partition live, on any file system Spark can reach."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

log = logging.getLogger("civiclake")

_YEAR = re.compile(r"\d{4}")
_YEAR_MONTH = re.compile(r"(\d{4})-(\d{2})(-\d{2})?")


def partition_values(key: str | None) -> dict[str, str]:
    """Hive columns of a partition key: ``2024`` -> year, ``2024-05`` or ``2024-05-17`` -> year and
    month; anything else has none."""
    if key and _YEAR.fullmatch(key):
        return {"year": key}
    month = _YEAR_MONTH.fullmatch(key or "")
    return {"year": month[1], "month": month[2]} if month else {}


def partition_path(root: str, key: str | None = None) -> str:
    """Directory of a partition: ``year=/month=`` for time keys, else a folder named by the key."""
    if not key:
        return root
    values = partition_values(key)
    tail = "/".join(f"{k}={v}" for k, v in values.items()) if values else key
    return f"{root.rstrip('/')}/{tail}"


def _resolve(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names anything."""
    fs, hadoop = _resolve(spark, pattern)
    found = fs.globStatus(hadoop)
    return found is not None and len(found) > 0


def has_file(spark: SparkSession, root: str, mark: str) -> bool:
    """Whether a file with ``mark`` in its name lies anywhere below a directory; stops at the first."""
    fs, hadoop = _resolve(spark, root)
    if not fs.exists(hadoop):
        return False
    files = fs.listFiles(hadoop, True)
    while files.hasNext():
        name = files.next().getPath().getName()
        if mark in name and name[0] not in "._":
            return True
    return False


def child_names(spark: SparkSession, root: str) -> list[str]:
    """Sorted names directly under a directory; none when it does not exist."""
    fs, hadoop = _resolve(spark, root)
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop)) if fs.exists(hadoop) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _resolve(spark, path)
    return fs.delete(hadoop, True)


def file_list(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Path and size of every file below a directory (contents are not read)."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root).select("path", "length"))


def storage_report(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """Number of files and their size in MB."""
    return file_list(spark, root, pattern).agg(
        F.count("*").alias("files"),
        F.round(F.coalesce(F.sum("length"), F.lit(0)) / (1024.0 * 1024.0), 2).alias("total_size_mb"))


def write_partition(df: DataFrame, root: str, fmt: str, key: str | None = None, **options) -> str:
    """Replace one partition's folder (the whole table when there is no key); the others stay. An
    empty frame clears it. Hive columns live in the folder name only."""
    target = partition_path(root, key)
    hive = [c for c in partition_values(key) if c in df.columns]
    df.drop(*hive).write.mode("overwrite").format(fmt).options(**options).save(target)
    return target


def write_by_columns(df: DataFrame, root: str, fmt: str, partition_cols: list[str], **options) -> str:
    """Write many hive partitions at once; only those present in the frame are replaced. The
    rebalance hint gathers a partition's rows into files of a good size, and splits a partition
    that holds much of the table over several tasks."""
    (df.hint("rebalance", *partition_cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_cols).format(fmt).options(**options).save(root))
    return root
