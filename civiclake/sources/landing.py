"""Landing layer: gzip CSV shards in which every column is text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from civiclake.contracts import build_landing_schema
from civiclake.sources.storage import (file_list, has_file, log, matches, partition_path, storage_report, write_by_columns,
                                       write_partition)

CORRUPT = "_corrupt_record"

READ_OPTIONS = {
    "header": True,
    "multiLine": True,  # quoted fields may hold line breaks; gzip is not splittable anyway
    "quote": '"',
    "escape": '"',
    # Names in the header must agree with the schema, which is applied by position.
    "enforceSchema": False,
    "pathGlobFilter": "*.csv*",
}
WRITE_OPTIONS = {
    "header": True,
    "compression": "gzip",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}
ROWS_PER_SHARD = 500_000


def _paths(spark: SparkSession, root: str, keys: list[str] | None) -> list[str]:
    wanted = [partition_path(root, k) for k in keys] if keys else [root]
    return [p for p in wanted if matches(spark, p)]


def landing_columns(spark: SparkSession, root: str, paths: list[str]) -> list[str]:
    """Column names in the header of the first shard."""
    reader = spark.read.options(**READ_OPTIONS).option("basePath", root).option("recursiveFileLookup", True)
    return reader.csv(paths).columns


def _reader(spark: SparkSession, root: str, **options):
    return spark.read.options(**READ_OPTIONS).option("basePath", root).options(**options)


def _has_shards(spark: SparkSession, paths: list[str]) -> bool:
    return any(has_file(spark, p, ".csv") for p in paths)


def scan_landing(spark: SparkSession, root: str, keys: list[str] | None = None, *, contract: dict | None = None,
                 schema: T.StructType | None = None) -> DataFrame:
    """All shards of the table, or of some partitions, as text columns (plus hive columns); rows
    that are not well formed are skipped. Nothing there -> an empty frame and a warning."""
    paths = _paths(spark, root, keys)
    if not paths or not _has_shards(spark, paths):
        log.warning("no landing shards under %s for %s", root, keys or "the whole table")
        return spark.createDataFrame([], schema or build_landing_schema(contract or {}))
    schema = schema or T.StructType([T.StructField(c, T.StringType()) for c in landing_columns(spark, root, paths)])
    return _reader(spark, root, mode="DROPMALFORMED").schema(schema).csv(paths)


def scan_landing_marked(spark: SparkSession, root: str, keys: list[str] | None = None) -> DataFrame | None:
    """Every record of every shard as text columns (plus hive columns); ``_corrupt_record`` holds the text of
    those that are not well formed and is null for the others. None without shards."""
    paths = _paths(spark, root, keys)
    if not paths or not _has_shards(spark, paths):
        return None
    names = landing_columns(spark, root, paths)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, CORRUPT]])
    return _reader(spark, root, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).schema(schema).csv(paths)


def scan_landing_records(spark: SparkSession, root: str, keys: list[str] | None = None) -> DataFrame | None:
    """Every record of every shard: its file and whether it is well formed. None without shards."""
    records = scan_landing_marked(spark, root, keys)
    if records is None:
        return None
    # The shard's own columns come first, then the mark, then the hive columns.
    hive = records.columns[records.columns.index(CORRUPT) + 1:]
    # Spark refuses a scan of the corrupt column alone; a zero-length piece of the first column
    # keeps that one in the scan without changing the test.
    broken = F.concat_ws("", F.col(CORRUPT), F.substring(F.col(f"`{records.columns[0]}`"), 1, 0)) != ""
    return records.select(F.col("_metadata.file_path").alias("file_path"),
                          F.col("_metadata.file_name").alias("file_name"), *hive, (~broken).alias("parsed"))


def write_landing(df: DataFrame, root: str, key: str | None = None, *, partition_cols: list[str] | None = None,
                  rows_per_shard: int = ROWS_PER_SHARD) -> str:
    """Write text shards of at most ``rows_per_shard`` rows, replacing the partition's old shards:
    one named partition, or every partition found in ``partition_cols``."""
    text = df.select([F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])
    options = {**WRITE_OPTIONS, "maxRecordsPerFile": rows_per_shard}
    if partition_cols:
        return write_by_columns(text, root, "csv", partition_cols, **options)
    return write_partition(text, root, "csv", key, **options)


def landing_report(spark: SparkSession, root: str, key: str | None = None) -> DataFrame:
    """Shards and size of what was written."""
    return storage_report(spark, partition_path(root, key), "*.csv.gz").withColumnRenamed("files", "batches")


def landing_files(spark: SparkSession, root: str) -> DataFrame:
    return file_list(spark, root, "*.csv*")


def fixed_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Declared columns in declared order: absent ones null, others left out."""
    return df.select([F.col(f"`{c}`").cast("string").alias(c) if c in df.columns
                      else F.lit(None).cast("string").alias(c) for c in columns])
