"""Row accounting from landing files to the clean table, and what follows from it.

Counts come from one scan per layer, grouped by partition; verdicts are plain columns. Nothing but
folder names is looked at on the driver.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from civiclake.contracts import apply_schema_contract
from civiclake.functions.classify import assemble_annotations
from civiclake.operators.layout import with_row_index
from civiclake.operators.unions import YearSource, active_source
from civiclake.session import materialize
from civiclake.sources.landing import CORRUPT, landing_files, scan_landing_records
from civiclake.sources.storage import child_names, matches, partition_path
from civiclake.sources.tables import read_table

MONTHS = tuple(f"{m:02d}" for m in range(1, 13))
GRAINS = ("unpartitioned", "same_grain", "monthly_to_yearly")
COUNTS = ("landing_rows", "parsed_rows", "clean_rows")


# -- counts ---------------------------------------------------------------------------------------

def _file_key(path: Column) -> Column:
    """One spelling for ``file:/x`` and ``file:///x``."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def landing_file_counts(spark: SparkSession, root: str, key: str | None = None) -> DataFrame:
    """Records and well-formed records of every landing file; a header-only file has none. Quoted
    line breaks do not count as records."""
    schema = "file_name string, landing_rows bigint, parsed_rows bigint"
    records = scan_landing_records(spark, root, [key] if key else None)
    if records is None:
        return spark.createDataFrame([], schema)
    per_file = records.groupBy(_file_key(F.col("file_path")).alias("file")).agg(
        F.count("*").alias("landing_rows"), F.count_if("parsed").alias("parsed_rows"))
    files = landing_files(spark, partition_path(root, key)).select(_file_key(F.col("path")).alias("file"))
    return files.join(per_file, "file", "left").select(
        F.substring_index("file", "/", -1).alias("file_name"),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("landing_rows", "parsed_rows")])


def landing_counts(spark: SparkSession, root: str, by: list[str], keys: list[str] | None = None) -> DataFrame:
    """Landing and parsed rows per hive column value, from one scan."""
    records = scan_landing_records(spark, root, keys)
    if records is None:
        shape = ", ".join([f"{c} string" for c in by] + ["landing_rows bigint", "parsed_rows bigint"])
        return spark.createDataFrame([], shape)
    grouped = records.groupBy(*[F.col(c).cast("string").alias(c) for c in by])
    return grouped.agg(F.count("*").alias("landing_rows"), F.count_if("parsed").alias("parsed_rows"))


class LandingTally:
    """Landing and parsed rows counted while the clean rows are written, so that the shards are parsed once.

    With ``months`` (year, month) the counts are kept per month, at most twelve a year. A count is right when
    every task of the scan adds to it once: an exchange above the scan may repeat tasks after a lost executor
    or for the samples of a sort, and a limit ends them early. :meth:`holds` tells whether a frame is free of
    these; otherwise the records are to be counted by :func:`landing_counts`."""

    def __init__(self, months: list[tuple[str, str]] | None = None):
        self._months = months
        self._seen = Observation()

    def watch(self, records: DataFrame) -> DataFrame:
        """Well-formed records of a marked scan, all of them counted on the way."""
        parsed = F.col(CORRUPT).isNull()
        groups = [F.lit(True)] if self._months is None else [(F.col("year") == y) & (F.col("month") == m) for y, m in self._months]
        counts = [F.count_if(g & p).alias(f"{name}{i}") for i, g in enumerate(groups)
                  for name, p in (("landing", F.lit(True)), ("parsed", parsed))]
        return records.observe(self._seen, *counts).where(parsed).drop(CORRUPT)

    @staticmethod
    def holds(df: DataFrame) -> bool:
        plan = df._jdf.queryExecution().executedPlan().toString()
        return plan.count("CollectMetrics") >= 1 and not re.search(r"\bExchange\b|Limit\b|TakeOrdered|InMemoryTableScan", plan)

    def counts(self, spark: SparkSession) -> DataFrame:
        """The counts after the write, shaped as those of :func:`landing_counts`."""
        seen = self._seen.get
        shape = "landing_rows bigint, parsed_rows bigint"
        if self._months is None:
            return spark.createDataFrame([(seen["landing0"], seen["parsed0"])], shape)
        rows = [(y, m, seen[f"landing{i}"], seen[f"parsed{i}"]) for i, (y, m) in enumerate(self._months)]
        return spark.createDataFrame([r for r in rows if r[2]], f"year string, month string, {shape}")


def clean_counts(spark: SparkSession, root: str, by: list[str] = (), keys: list[str] | None = None) -> DataFrame:
    """Rows of a clean table per hive column value; an absent table has none. Parquet footers hold
    the counts, so no column is read and schemas need not be merged."""
    try:
        table = read_table(spark, root, keys, merge_schema=False)
    except FileNotFoundError:
        if by:
            return spark.createDataFrame([], ", ".join([f"{c} string" for c in by] + ["clean_rows bigint"]))
        return spark.createDataFrame([(0,)], "clean_rows bigint")
    if not by:
        return table.agg(F.count("*").alias("clean_rows"))
    return table.groupBy(*[F.col(c).cast("string").alias(c) for c in by]).agg(F.count("*").alias("clean_rows"))


def _combine(frames: list[DataFrame], by: list[str]) -> DataFrame:
    """Counts of several layers side by side; a layer without a group counts zero there."""
    aligned = [df.select(*by, *[(F.col(c) if c in df.columns else F.lit(0)).cast("long").alias(c) for c in COUNTS])
               for df in frames]
    stacked = aligned[0]
    for df in aligned[1:]:
        stacked = stacked.unionByName(df)
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in COUNTS]
    return stacked.groupBy(*by).agg(*totals) if by else stacked.agg(*totals)


def with_gaps(df: DataFrame) -> DataFrame:
    return df.withColumns({"parse_gap": F.col("landing_rows") - F.col("parsed_rows"),
                           "transform_gap": F.col("parsed_rows") - F.col("clean_rows")})


# -- verdicts -------------------------------------------------------------------------------------

def with_verdict(df: DataFrame, *, allow_row_drop: bool = False, empty_months: bool = False) -> DataFrame:
    """Add passed, severity and reason. The first rule that applies decides: all landed months empty
    (only with ``empty_months``), unreadable records, more rows out than in, nothing out, rows
    removed. Rows removed are a warning where that is expected."""
    landed, parsed, clean = (F.col(c) for c in COUNTS)
    gap = F.col("transform_gap")
    rules: list[tuple[Column, bool, str, str]] = []
    if empty_months:
        rules.append(((F.col("months_materialized") > 0) & (F.col("months_with_data") == 0), True, "warn", "no_data_yet"))
    rules += [
        (F.col("parse_gap") > 0, False, "error", "rows_lost_in_parsing"),
        ((clean > parsed) & (parsed > 0), False, "error", "row_expansion"),
        ((clean == 0) & (landed > 0), False, "error", "clean_is_empty"),
        (gap > 0, allow_row_drop, "warn" if allow_row_drop else "error",
         "rows_filtered" if allow_row_drop else "rows_lost_in_transform"),
    ]

    def first(values, otherwise):
        return F.coalesce(*[F.when(r[0], F.lit(v)) for r, v in zip(rules, values)], F.lit(otherwise))

    return df.withColumns({
        "passed": first([r[1] for r in rules], True),
        "severity": first([r[2] for r in rules], "ok"),
        "reason": first([r[3] for r in rules], "balanced"),
    })


# -- accounting of one partition ------------------------------------------------------------------

def flat_accounting(spark: SparkSession, landing_root: str, clean_root: str, key: str | None = None, *,
                    allow_row_drop: bool = False, landed: DataFrame | None = None) -> DataFrame:
    """One row: landing, parsed and clean rows, their gaps and the verdict. ``landed`` are landing counts
    already at hand; the shards are parsed for them otherwise."""
    keys = [key] if key else None
    if landed is None:
        landed = landing_counts(spark, landing_root, [], keys)
    layers = [landed, clean_counts(spark, clean_root, [], keys)]
    return with_verdict(with_gaps(_combine(layers, [])), allow_row_drop=allow_row_drop)


def landed_months(spark: SparkSession, root: str, years: list[str]) -> list[tuple[str, str]]:
    """(year, month) of the month folders that exist."""
    return [(year, name.removeprefix("month=")) for year in years
            for name in child_names(spark, partition_path(root, year)) if name.startswith("month=")]


def monthly_landing(spark: SparkSession, root: str, years: list[str], counts: DataFrame | None = None) -> DataFrame:
    """Twelve rows per year: status, files, landing and parsed rows, also for months not landed. ``counts``
    per month already at hand save parsing the shards."""
    landed = set(landed_months(spark, root, years))
    spine = spark.createDataFrame(
        [(y, m, (y, m) in landed) for y in years for m in MONTHS], "year string, month string, landed boolean")
    keys = [f"{y}-{m}" for y, m in sorted(landed)]
    if counts is None and keys:
        counts = landing_counts(spark, root, ["year", "month"], keys)
    months = spine if counts is None else spine.join(counts, ["year", "month"], "left")
    rows = {c: (F.coalesce(F.col(c), F.lit(0)) if counts is not None else F.lit(0)).cast("long")
            for c in ("landing_rows", "parsed_rows")}
    return months.select(
        "year", F.concat_ws("-", "year", "month").alias("month_key"), "landed",
        *[c.alias(n) for n, c in rows.items()],
    ).withColumn("status", F.when(~F.col("landed"), "not materialized")
                 .when(F.col("landing_rows") > 0, "materialized").otherwise("empty"))


def coverage(months: DataFrame) -> DataFrame:
    """Per year: months landed, with data, empty and missing, and the row totals."""
    landed, filled = F.count_if("landed"), F.count_if(F.col("landing_rows") > 0)
    return months.groupBy("year").agg(
        landed.alias("months_materialized"), filled.alias("months_with_data"),
        (landed - filled).alias("months_empty"), (F.lit(len(MONTHS)) - landed).alias("months_missing"),
        F.sum("landing_rows").alias("landing_rows"), F.sum("parsed_rows").alias("parsed_rows"))


def monthly_accounting(spark: SparkSession, landing_root: str, clean_root: str, years: list[str], *,
                       allow_row_drop: bool = False, landed: DataFrame | None = None) -> DataFrame:
    """One row per year for monthly landing and yearly clean partitions, with coverage and verdict;
    ``landed`` as in :func:`monthly_landing`."""
    clean = clean_counts(spark, clean_root, ["year"], years)
    joined = coverage(monthly_landing(spark, landing_root, years, landed)).join(clean, "year", "left")
    filled = joined.withColumn("clean_rows", F.coalesce("clean_rows", F.lit(0)))
    return with_verdict(with_gaps(filled), allow_row_drop=allow_row_drop, empty_months=True)


# -- all partitions -------------------------------------------------------------------------------

def discover_years(spark: SparkSession, root: str) -> list[str]:
    """Years with a ``year=`` folder."""
    years = [n.removeprefix("year=") for n in child_names(spark, root) if n.startswith("year=")]
    return [y for y in years if len(y) == 4 and y.isdigit()]


def _with_issues(df: DataFrame) -> DataFrame:
    gaps = with_gaps(df)
    return gaps.withColumn("issues", assemble_annotations([
        (F.col("parse_gap") > 0, "parse errors"),
        (F.col("transform_gap") > 0, "transform gap"),
        ((F.col("landing_rows") > 0) & (F.col("clean_rows") == 0), "landing has data but clean is empty"),
    ]))


def cross_partition_summary(spark: SparkSession, landing_root: str, clean_root: str,
                            grain: str = "monthly_to_yearly") -> DataFrame:
    """Counts, gaps and issues of every year with a clean partition."""
    years = discover_years(spark, clean_root)
    clean = clean_counts(spark, clean_root, ["year"], years or None)
    if grain == "monthly_to_yearly":
        landing = coverage(monthly_landing(spark, landing_root, years))
    else:
        landing = landing_counts(spark, landing_root, ["year"], years).withColumns({
            "months_materialized": F.lit(1), "months_with_data": (F.col("landing_rows") > 0).cast("int")})
    filled = clean.join(landing, "year", "left").select("year", *[
        F.coalesce(c, F.lit(0)).cast("long").alias(c)
        for c in ("months_with_data", "months_materialized", *COUNTS)])
    return _with_issues(filled)


def summary_totals(summary: DataFrame) -> DataFrame:
    """One row over all partitions. Issues warn, they never block."""
    return summary.agg(
        F.count("*").alias("total_partitions"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in ("landing_rows", "clean_rows", "parse_gap", "transform_gap")],
        F.count("issues").alias("partitions_with_issues"),
    ).withColumns({"passed": F.lit(True),
                   "severity": F.when(F.col("partitions_with_issues") > 0, "warn").otherwise("ok")})


# -- several sources ------------------------------------------------------------------------------

def _source_counts(spark: SparkSession, source: YearSource, root: str, years: list[str]) -> DataFrame:
    """Landing and parsed rows of the years a source serves; a clean source loses none in parsing."""
    if source.layer == "clean":
        counted = clean_counts(spark, root, ["year"], years)
        counts = counted.select("year", F.col("clean_rows").alias("landing_rows"), F.col("clean_rows").alias("parsed_rows"))
        return counts.withColumns({"months_materialized": F.lit(None).cast("long"), "months_with_data": F.lit(None).cast("long")})
    if source.grain == "monthly_to_yearly":
        return coverage(monthly_landing(spark, root, years)).select(
            "year", "landing_rows", "parsed_rows", "months_materialized", "months_with_data")
    return landing_counts(spark, root, ["year"], years).withColumns(
        {"months_materialized": F.lit(None).cast("long"), "months_with_data": F.lit(None).cast("long")})


def dual_source_accounting(spark: SparkSession, sources: list[YearSource], roots: dict[str, str], clean_root: str,
                           years: list[str], *, allow_row_drop: bool = False) -> DataFrame:
    """Accounting per year, each against the one source serving it; a year without a source warns."""
    routed: dict[str, list[str]] = {}
    for year in years:
        source = active_source(sources, int(year))
        if source is not None:
            routed.setdefault(source.name, []).append(year)
    by_name = {s.name: s for s in sources}
    rows = [(y, name) for name, ys in routed.items() for y in ys]
    rows += [(y, None) for y in years if y not in {r[0] for r in rows}]
    counted = None
    for name, ys in routed.items():
        part = _source_counts(spark, by_name[name], roots[name], ys)
        counted = part if counted is None else counted.unionByName(part)
    spine = spark.createDataFrame(rows, "year string, active_source string")
    clean = clean_counts(spark, clean_root, ["year"], years)
    joined = spine.join(clean, "year", "left")
    if counted is None:
        joined = joined.withColumns({c: F.lit(None).cast("long") for c in
                                     ("landing_rows", "parsed_rows", "months_materialized", "months_with_data")})
    else:
        joined = joined.join(counted, "year", "left")
    judged = with_verdict(with_gaps(joined.fillna(0, list(COUNTS))), allow_row_drop=allow_row_drop, empty_months=True)
    unrouted = F.col("active_source").isNull()
    return judged.withColumns({
        "passed": unrouted | F.col("passed"),
        "severity": F.when(unrouted, "warn").otherwise(F.col("severity")),
        "reason": F.when(unrouted, "no_source").otherwise(F.col("reason")),
    })


def dual_source_summary(spark: SparkSession, sources: list[YearSource], roots: dict[str, str],
                        clean_root: str) -> DataFrame:
    """All clean years against their sources; a year without one has the gap ``-clean_rows``."""
    years = discover_years(spark, clean_root)
    accounted = dual_source_accounting(spark, sources, roots, clean_root, years)
    return _with_issues(accounted.select("year", "active_source", *COUNTS))


# -- results, transforms, dropped rows ------------------------------------------------------------

def nonempty_check(df: DataFrame) -> DataFrame:
    """Row count of a result; none fails."""
    return df.agg(F.count("*").alias("row_count")).select("row_count", (F.col("row_count") > 0).alias("passed"))


def stored_nonempty_check(spark: SparkSession, root: str) -> DataFrame:
    """As :func:`nonempty_check` for a written table; a table never written fails too."""
    return clean_counts(spark, root).select(F.col("clean_rows").alias("row_count"), (F.col("clean_rows") > 0).alias("passed"))


class TransformCounts:
    """Rows before and after a transform, counted while the result is written: no extra pass."""

    def __init__(self):
        self._before, self._after = Observation(), Observation()

    def watch(self, df: DataFrame, transform) -> DataFrame:
        return transform(df.observe(self._before, F.count(F.lit(1)).alias("n"))).observe(
            self._after, F.count(F.lit(1)).alias("n"))

    def result(self, spark: SparkSession) -> DataFrame:
        before, after = self._before.get["n"], self._after.get["n"]
        return spark.createDataFrame([(before, after, before - after)],
                                     "pre_transform_rows bigint, post_transform_rows bigint, transform_row_delta bigint")


@dataclass(frozen=True)
class Diagnostics:
    """Optional, dearer diagnostics of a clean step."""

    row_counts: bool = False
    dropped_rows: str = "off"  # off | sample | full
    sample_size: int = 20

    def __post_init__(self):
        if self.dropped_rows not in ("off", "sample", "full"):
            raise ValueError(f"dropped_rows must be off, sample or full, got {self.dropped_rows!r}")


ROW_ID = "__row_id"
#: Rows that one step of writing out repeated rows makes at once.
_COPIES = 10_000


def dropped_rows(raw: DataFrame, contract: dict, transform, *, timezone: str = "America/New_York") -> DataFrame | None:
    """Contract-shaped rows that do not survive ``transform``; None when the transform loses the row id.

    A row's id is the digest of its values, so both sides may be worked out anew and agree; nothing is written in
    between. Equal rows share it, and as many of them are reported as are missing behind the transform."""
    shaped = apply_schema_contract(raw, contract, timezone=timezone, drop_unknown=False)
    values = F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in shaped.columns]))
    named = shaped.withColumn(ROW_ID, F.sha2(values, 256))
    kept = transform(named)
    if ROW_ID not in kept.columns:
        return None
    before = named.groupBy(ROW_ID).agg(F.count("*").alias("__n"), F.first(F.struct(*shaped.columns)).alias("__row"))
    after = kept.groupBy(ROW_ID).agg(F.count("*").alias("__kept"))
    missing = before.join(after, ROW_ID, "left").withColumn("__missing", F.col("__n") - F.coalesce("__kept", F.lit(0))).where("__missing > 0")
    runs = missing.withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__missing") - 1, F.lit(_COPIES).cast("long"))))
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.col("__missing") - F.col("__from"), F.lit(_COPIES).cast("long"))))
    return runs.select("__row", copies.alias("__copy")).select("__row.*")


def report_dropped(dropped: DataFrame | None, diagnostics: Diagnostics, csv_path: str) -> dict:
    """Number and sample of the dropped rows; all of them as CSV in full mode. The rows are worked out once."""
    if diagnostics.dropped_rows == "off" or dropped is None:
        return {}
    dropped = materialize(dropped)
    count = dropped.count()
    if count == 0:
        return {}
    report = {"count": count, "sample": [r.asDict() for r in dropped.limit(diagnostics.sample_size).collect()]}
    if diagnostics.dropped_rows == "full":
        dropped.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(csv_path)
        report["csv"] = csv_path
    return report


# -- grains ---------------------------------------------------------------------------------------

def infer_grain(landing: str | None, clean: str | None) -> str:
    """Relation of landing and clean partitions (``monthly``, ``yearly``, ``static`` or None)."""
    if landing is None:
        return "unpartitioned"
    return "monthly_to_yearly" if (landing, clean) == ("monthly", "yearly") else "same_grain"


def landing_keys(spark: SparkSession, root: str, key: str | None, grain: str) -> list[str] | None:
    """Landing partitions feeding a clean partition; None means the whole table."""
    if grain == "unpartitioned" or key is None:
        return None
    if grain == "monthly_to_yearly":
        return [k for k in (f"{key}-{m}" for m in MONTHS) if matches(spark, partition_path(root, k))]
    return [key]
