"""Results as files, and folders of SQL files."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

EXPORT_FORMATS = ("parquet", "csv", "json")


def export(df: DataFrame, name: str, fmt: str, output_dir: str) -> str:
    """Write a result as ``output_dir/name.fmt`` and return the path."""
    if fmt not in EXPORT_FORMATS:
        raise ValueError(f"unknown export format {fmt!r}")
    path = f"{output_dir.rstrip('/')}/{name}.{fmt}"
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(header=True, quote='"', escape='"')
    writer.format(fmt).save(path)
    return path


def run_sql_folder(spark: SparkSession, folder: str, fmt: str, output_dir: str) -> dict[str, DataFrame]:
    """Run the ``.sql`` files of a folder in name order (blank ones skipped), export each result and
    return a frame reading each export."""
    source = Path(folder)
    if not source.is_dir():
        raise FileNotFoundError(f"not a directory: {folder}")
    results = {}
    for file in sorted(source.glob("*.sql")):
        text = file.read_text(encoding="utf-8").strip()
        if text:
            frame = spark.sql(text)
            path = export(frame, file.stem, fmt, output_dir)
            reader = spark.read.schema(frame.schema)
            results[file.stem] = (reader.options(header=True, quote='"', escape='"') if fmt == "csv"
                                  else reader).format(fmt).load(path)
    return results
