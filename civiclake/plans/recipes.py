"""SQL recipes: a header and a query, run over named tables, whole or one partition at a time."""

from __future__ import annotations

import re
import textwrap
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime
from pathlib import Path
from zoneinfo import ZoneInfo

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from civiclake.functions.temporal import NEW_YORK, partition_windows
from civiclake.operators.quality import stored_nonempty_check
from civiclake.sources.storage import log, partition_path, partition_values, write_by_columns
from civiclake.sources.tables import write_table
from civiclake.sources.views import mount_dependencies

try:
    import yaml
except ImportError:  # recipes with a header are then skipped, those without still run
    yaml = None

RECIPES = Path(__file__).with_name("sql")

_HEADER = re.compile(r"\s*/\*---(?P<header>.*?)---\*/", re.DOTALL)
_TOKEN = re.compile(r"\{\{\s*(partition_(?:start_ts|end_ts|start|end|key))\s*\}\}")
_SAFE_KEY = re.compile(r"[A-Za-z0-9_\-:. ]+")


class RecipeError(ValueError):
    pass


@dataclass(frozen=True)
class Recipe:
    name: str
    sql: str
    deps: Sequence[str] = ()
    group: str | None = None
    tags: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping | None = None
    description: str = ""


@dataclass(frozen=True)
class Partition:
    """One partition of a recipe's output: its key and, for time partitions, ``[start, end)``."""

    key: str
    start: datetime | None = None
    end: datetime | None = None


def split_header(text: str) -> tuple[dict, str]:
    """YAML header (empty when there is none) and the query below it."""
    found = _HEADER.match(text)
    if not found:
        return {}, text.lstrip()
    if yaml is None:
        raise RecipeError("a YAML reader is needed for recipe headers")
    try:
        header = yaml.safe_load(textwrap.dedent(found["header"])) or {}
    except yaml.YAMLError as problem:
        raise RecipeError(f"malformed header: {problem}") from problem
    return header, text[found.end():].lstrip()


def read_recipe(path: Path, extra_deps: Mapping[str, Sequence[str]] | None = None) -> Recipe:
    header, sql = split_header(path.read_text(encoding="utf-8"))
    name = header.get("name", path.stem)
    extra = (extra_deps or {}).get(path.stem) or (extra_deps or {}).get(name) or []
    return Recipe(
        name=name, sql=sql, deps=list(dict.fromkeys([*(header.get("deps") or []), *extra])), group=header.get("group"),
        tags={str(k): str(v) for k, v in (header.get("tags") or {}).items()},
        partitions=header.get("partitions"), description=header.get("description", ""))


def discover_recipes(root: str | Path, extra_deps: Mapping[str, Sequence[str]] | None = None) -> list[Recipe]:
    """All recipes below a folder; files that cannot be read or understood are skipped with a warning."""
    recipes = []
    for path in sorted(Path(root).rglob("*.sql")):
        try:
            recipes.append(read_recipe(path, extra_deps))
        except (OSError, UnicodeDecodeError, RecipeError) as problem:
            log.warning("skipping %s: %s", path, problem)
    return recipes


def bind_partition(sql: str, partition: Partition | None = None) -> tuple[str, dict]:
    """Turn ``{{partition_...}}`` tokens into bound parameters. A token the partition cannot fill is
    an error, as is a key with characters outside letters, digits, ``_ - : .`` and blank."""
    args: dict[str, object] = {}

    def bind(match: re.Match) -> str:
        token = match[1]
        args[token] = _token_value(token, partition)
        return f":{token}"

    return _TOKEN.sub(bind, sql), args


def _token_value(token: str, partition: Partition | None) -> str | date | datetime:
    if token == "partition_key":
        if partition is None:
            raise RecipeError("the query uses {{partition_key}} but there is no partition")
        if not _SAFE_KEY.fullmatch(partition.key):
            raise RecipeError(f"partition key {partition.key!r} has characters that are not allowed")
        return partition.key
    moment = partition and (partition.start if "start" in token else partition.end)
    if moment is None:
        raise RecipeError(f"the query uses {{{{{token}}}}} but there is no time partition")
    # Day boundaries are those of the partition's own zone; instants keep theirs.
    return moment if token.endswith("_ts") else moment.date()


def query(spark: SparkSession, recipe: Recipe, partition: Partition | None = None) -> DataFrame:
    """The recipe's result over the views already registered."""
    text, args = bind_partition(recipe.sql, partition)
    return spark.sql(text, args=args or None)


def run_recipe(spark: SparkSession, recipe: Recipe, roots: Sequence[str], target: str,
               partition: Partition | None = None) -> DataFrame:
    """Mount the dependencies from the first root that has them, run, write ``target/name`` (or one
    partition of it) and return the non-empty check."""
    mount_dependencies(spark, list(recipe.deps), list(roots))
    root = f"{target.rstrip('/')}/{recipe.name}"
    write_table(query(spark, recipe, partition), root, partition.key if partition else None)
    return stored_nonempty_check(spark, root)


def recipe_partitions(spark: SparkSession, recipe: Recipe, until: date) -> list[Partition]:
    """Time partitions declared in the header, up to those complete at ``until``."""
    spec = recipe.partitions
    if not spec:
        return []
    start = spec.get("start_date") or spec.get("start")
    if start is None:
        raise RecipeError("time partitions need a start")
    tz = spec.get("tz", NEW_YORK)
    windows = partition_windows(
        spark.range(1), spec.get("type"), F.lit(_first_day(str(start))), F.lit(str(spec.get("end") or until)), tz=tz,
        end_offset=int(spec.get("end_offset") or 0))
    zone = ZoneInfo(tz)
    # Bounded by the number of years or months declared.
    rows = windows.select("partition_key", F.unix_timestamp("window_start"), F.unix_timestamp("window_end")) \
        .orderBy("partition_key").collect()
    return [Partition(key, datetime.fromtimestamp(a, zone), datetime.fromtimestamp(b, zone)) for key, a, b in rows]


def _first_day(start: str) -> str:
    return f"{start}-01-01" if len(start) == 4 else start


#: Alias of the partition table inside a recipe that runs for all of its partitions at once.
_WINDOW = "__window"
_WINDOW_COLUMNS = {"partition_key": "string", "partition_start": "date", "partition_end": "date",
                   "partition_start_ts": "timestamp", "partition_end_ts": "timestamp"}


def query_partitions(spark: SparkSession, recipe: Recipe, partitions: Sequence[Partition]) -> DataFrame:
    """The recipe's results for several partitions as one frame, each row beside its ``partition_key``.

    The partitions are a small table (a row per year or month) and the query a lateral subquery of it, with
    every token bound to a column: Spark turns it into one range join of the data with the partitions, under the
    recipe's own aggregates. A global aggregate has its row for a partition without data too."""
    used, args, rows = set(_TOKEN.findall(recipe.sql)), {}, []
    for i, partition in enumerate(partitions):
        values = {c: _token_value(c, partition) if c in used else partition.key if c == "partition_key" else None for c in _WINDOW_COLUMNS}
        bound = {f"{c}_{i}": v for c, v in values.items() if v is not None}
        args |= bound
        rows.append("(%s)" % ", ".join(f"CAST({f':{c}_{i}' if f'{c}_{i}' in bound else 'NULL'} AS {t})" for c, t in _WINDOW_COLUMNS.items()))
    view = f"partitions_{uuid.uuid4().hex}"
    # An inline table has a known, small size: Spark broadcasts it and never the data beside it.
    spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS windows({', '.join(_WINDOW_COLUMNS)})", args=args).createOrReplaceTempView(view)
    body = _TOKEN.sub(lambda m: f"{_WINDOW}.{m[1]}", recipe.sql).rstrip().rstrip(";")
    try:
        return spark.sql(f"SELECT {_WINDOW}.partition_key, result.* FROM {view} AS {_WINDOW}, LATERAL (\n{body}\n) AS result")
    finally:
        spark.catalog.dropTempView(view)


def _write_partitions(spark: SparkSession, recipe: Recipe, root: str, partitions: Sequence[Partition]) -> bool:
    """All partitions by one job. False, with nothing written, where the query cannot be bound to a table of
    partitions or their folders are not hive folders of their own."""
    hive = {p.key: partition_values(p.key) for p in partitions}
    shapes = {tuple(v) for v in hive.values()}
    if len(partitions) < 2 or len(shapes) != 1 or shapes == {()} or len({partition_path("", k) for k in hive}) < len(partitions):
        return False
    columns, written = list(shapes.pop()), Observation()
    try:
        made = query_partitions(spark, recipe, partitions)
        made = made.drop(*[c for c in columns if c != "partition_key"])
        # A set of keys stays the same when a task is repeated.
        seen = made.observe(written, F.collect_set("partition_key").alias("keys"))
        parts = F.split("partition_key", "-")
        frame = seen.withColumns({c: F.get(parts, F.lit(i)) for i, c in enumerate(columns)}).drop("partition_key")
        if "CollectMetrics" not in frame._jdf.queryExecution().executedPlan().toString():
            return False
    except PySparkException as problem:
        log.warning("recipe %s runs once per partition: %s", recipe.name, str(problem).splitlines()[0])
        return False
    write_by_columns(frame, root, "parquet", columns)
    keys = set(written.get["keys"])
    # A partition that has no rows now must not keep those of an earlier run.
    for partition in partitions:
        if partition.key not in keys:
            write_table(frame.drop(*columns).limit(0), root, partition.key)
    return True


def backfill(spark: SparkSession, recipe: Recipe, roots: Sequence[str], target: str, partitions: Sequence[Partition]) -> DataFrame:
    """Run the recipe for the given partitions, several by one job that reads the dependencies once. Only the
    folders of these partitions are replaced, so a backfill can be resumed or repeated for some keys; the result
    is the check of the whole table. A single partition, keys without hive folders and queries that Spark cannot
    correlate with a table of partitions run one after another."""
    mount_dependencies(spark, list(recipe.deps), list(roots))
    root = f"{target.rstrip('/')}/{recipe.name}"
    if not _write_partitions(spark, recipe, root, partitions):
        for partition in partitions:
            write_table(query(spark, recipe, partition), root, partition.key)
    return stored_nonempty_check(spark, root)
