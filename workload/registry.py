"""Query names, their Spark side and their DuckDB side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from civiclake.session import configure, shared_dir
from workload.shapes import SHAPES, TABLES, expand

SPARK: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_SCHEMAS: dict[str, StructType] = {}


class Source:
    """Test tables and the shapes derived from them, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self._read(f"{self.sf_dir}/{name}.parquet")
        if name in SHAPES:
            sql, inputs = SHAPES[name]
            return self.spark.sql(sql, **{i: getattr(self, i) for i in inputs})
        raise AttributeError(name)

    def _read(self, path: str) -> DataFrame:
        """A table; its schema is inferred from the footers once per process."""
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def sql(self, text: str, *names: str, **args) -> DataFrame:
        """Spark SQL over named inputs, written ``{name}``; ``args`` are bound parameters."""
        return self.spark.sql(text, args=args or None, **{n: getattr(self, n) for n in names})

    def dir(self, name: str) -> str:
        return shared_dir(self.spark, name)


def query(name: str, sql: str | None = None):
    """Register a function of a :class:`Source`. ``sql`` is DuckDB SQL over tables and shapes, the
    shapes written ``{name}``."""

    def register(fn):
        if name in SPARK:
            raise ValueError(f"query {name} is registered twice")
        SPARK[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = expand(sql)
        return fn

    return register
