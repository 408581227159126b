"""Files by name: temporary views, saved tables and the dependencies of a query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from civiclake.sources.storage import log, matches
from civiclake.sources.tables import read_table

FORMATS = ("parquet", "csv", "json")


def read_file(spark: SparkSession, path: str, fmt: str, *, schema=None) -> DataFrame:
    """Scan of one fetched file or folder by format; CSV skips rows that are not well formed."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}")
    reader = spark.read.schema(schema) if schema else spark.read
    if fmt == "csv":
        # Types are inferred only when no schema is declared; column pruning stays off in the parser
        # so that a row is judged the same whichever columns a query uses.
        reader = reader.options(header=True, inferSchema=schema is None, multiLine=True, quote='"', escape='"',
                                mode="DROPMALFORMED", columnPruning=False)
    return reader.format(fmt).load(path)


def _format_of(path: str) -> str:
    return path.rstrip("/").rsplit(".", 1)[-1].lower()


def _named(paths: list[str], names: list[str]):
    if len(paths) != len(names):
        raise ValueError("paths and names must have the same length")
    return zip(paths, names)


def register_views(spark: SparkSession, paths: list[str], names: list[str], *,
                   schemas: dict[str, T.StructType | str] | None = None) -> list[str]:
    """Temporary view per path (``.parquet``, ``.csv``, ``.json``); paths naming nothing are skipped. A name with a
    declared schema needs no pass over its file to infer one."""
    done = []
    for path, name in _named(paths, names):
        if not matches(spark, path):
            log.warning("skipping %s: nothing at %s", name, path)
            continue
        read_file(spark, path, _format_of(path), schema=(schemas or {}).get(name)).createOrReplaceTempView(name)
        done.append(name)
    return done


def register_tables(spark: SparkSession, paths: list[str], names: list[str], *, location: str | None = None,
                    schemas: dict[str, T.StructType | str] | None = None) -> list[str]:
    """As :func:`register_views`, stored as tables: in the warehouse, or below ``location``."""
    done = []
    for path, name in _named(paths, names):
        if not matches(spark, path):
            log.warning("skipping %s: nothing at %s", name, path)
            continue
        writer = read_file(spark, path, _format_of(path), schema=(schemas or {}).get(name)).write.mode("overwrite")
        (writer.option("path", f"{location.rstrip('/')}/{name}") if location else writer).saveAsTable(name)
        done.append(name)
    return done


def register_partitioned_view(spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None) -> bool:
    """View over a hive-partitioned table, of a declared schema or of its files' merged one; False when it has no
    files."""
    try:
        read_table(spark, root, schema=schema).createOrReplaceTempView(name)
    except FileNotFoundError:
        log.warning("skipping %s: no Parquet files under %s", name, root)
        return False
    return True


def bulk_register(spark: SparkSession, base: str, names: list[str],
                  schemas: dict[str, T.StructType | str] | None = None) -> list[str]:
    """Views over ``base/name`` for every name, flat or partitioned."""
    return [n for n in names if register_partitioned_view(spark, f"{base.rstrip('/')}/{n}", n, (schemas or {}).get(n))]


def empty_view(spark: SparkSession, name: str, schema: T.StructType | str | None = None) -> None:
    """Empty stand-in for a missing table, with its contract's columns when known."""
    spark.createDataFrame([], schema or "placeholder string").createOrReplaceTempView(name)


def mount_dependencies(spark: SparkSession, deps: list[str], roots: list[str],
                       schemas: dict[str, T.StructType | str] | None = None) -> dict[str, str | None]:
    """View per dependency from the first root that has it; an empty one when none has. A declared schema
    serves both, so that no footers are read to find it. Returns the root used for each."""
    used: dict[str, str | None] = {}
    for dep in deps:
        declared = (schemas or {}).get(dep)
        used[dep] = next((r for r in roots if matches(spark, f"{r.rstrip('/')}/{dep}")
                          and register_partitioned_view(spark, f"{r.rstrip('/')}/{dep}", dep, declared)), None)
        if used[dep] is None:
            log.warning("no data for dependency %s", dep)
            empty_view(spark, dep, (schemas or {}).get(dep))
    return used


class Catalogue:
    """Registered frames by name, with ad-hoc SQL over them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.names: set[str] = set()

    def register(self, name: str, df: DataFrame) -> None:
        df.createOrReplaceTempView(name)
        self.names.add(name)

    def table(self, name: str) -> DataFrame:
        if name not in self.names:
            raise KeyError(f"no table registered as {name!r}")
        return self.spark.table(name)

    def sql(self, text: str, args: dict | None = None) -> DataFrame:
        """Lazy result; parameters are bound as ``:name``, never spliced in."""
        return self.spark.sql(text, args=args)
