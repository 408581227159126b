"""JSON record pages, the landing form of REST responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from civiclake.sources.storage import log, matches, partition_path, write_partition


def write_pages(df: DataFrame, root: str, key: str | None = None, *, records_per_page: int = 50_000) -> str:
    """One JSON-lines file per page of at most ``records_per_page`` records; old pages are replaced."""
    return write_partition(df, root, "json", key, maxRecordsPerFile=records_per_page, ignoreNullFields=False)


def scan_pages(spark: SparkSession, root: str, key: str | None = None, *, schema=None, multi_line: bool = False,
               with_file_name: bool = False, pattern: str = "*.json") -> DataFrame:
    """Records of all pages. ``multi_line`` reads pages that hold one JSON array or object each. The
    file name keeps the page order: sort by it where the order matters."""
    path = partition_path(root, key)
    if not matches(spark, f"{path}/{pattern}"):
        log.warning("no JSON pages under %s", path)
        return spark.createDataFrame([], schema or "record string")
    reader = spark.read.option("multiLine", multi_line).option("pathGlobFilter", pattern)
    pages = (reader.schema(schema) if schema else reader).json(path)
    return pages.select("*", F.col("_metadata.file_name").alias("page_file")) if with_file_name else pages
