"""Landing to clean in one Spark plan: scan, contract, enrichments, own transform, write, check."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from civiclake.contracts import apply_schema_contract, build_table_schema, normalize_contract, with_comments
from civiclake.functions.coerce import NEW_YORK
from civiclake.operators import quality
from civiclake.operators.enrichments import StandardEnrichments
from civiclake.operators.quality import Diagnostics
from civiclake.session import shared_dir
from civiclake.sources.landing import scan_landing, scan_landing_marked
from civiclake.sources.tables import read_table, write_table

Transform = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class PipelineRun:
    """Where the partition was written, its row accounting and the diagnostics asked for."""

    path: str
    accounting: DataFrame
    counts: DataFrame | None = None
    dropped: dict = field(default_factory=dict)


@dataclass(frozen=True)
class LandingToClean:
    """A clean table fed by landing shards."""

    name: str
    contract: dict
    enrichments: StandardEnrichments | None = None
    post_transform: Transform | None = None
    landing_partitions: str | None = None  # None, "yearly", "monthly" or "static"
    clean_partitions: str | None = None
    expect_filtered_rows: bool = False
    diagnostics: Diagnostics = Diagnostics()
    timezone: str = NEW_YORK

    @property
    def grain(self) -> str:
        return quality.infer_grain(self.landing_partitions, self.clean_partitions or self.landing_partitions)

    def schema(self) -> T.StructType:
        """Columns of the clean table with their comments."""
        derived = self.enrichments.build_derived_columns() if self.enrichments else []
        return build_table_schema(self.contract, derived)

    def enrich(self, df: DataFrame) -> DataFrame:
        """Everything after the contract."""
        if self.enrichments:
            df = df.transform(self.enrichments.build_transform_fn())
        return df.transform(self.post_transform) if self.post_transform else df

    def transform(self, landing: DataFrame) -> DataFrame:
        """Contract, enrichments, own transform: one lazy plan, no shuffle of its own."""
        contract, _ = normalize_contract(self.contract)
        shaped = apply_schema_contract(landing, contract, timezone=self.timezone)
        return with_comments(self.enrich(shaped), self.schema())

    def scan(self, spark: SparkSession, landing_root: str, key: str | None) -> DataFrame:
        keys = quality.landing_keys(spark, landing_root, key, self.grain)
        if keys == []:
            # No month has landed: an empty frame of the contract's sources.
            return scan_landing(spark, landing_root, [key], contract=self.contract).limit(0)
        return scan_landing(spark, landing_root, keys, contract=self.contract)

    def run(self, spark: SparkSession, landing_root: str, clean_root: str, key: str | None = None) -> PipelineRun:
        """Build and write one clean partition (or the whole table) and account for its rows. The shards are
        parsed once: the job that writes the clean rows counts the records."""
        landing = self.scan(spark, landing_root, key)
        watched = quality.TransformCounts() if self.diagnostics.row_counts else None
        transform = (lambda df: watched.watch(df, self.transform)) if watched else self.transform
        tally, clean = self._tallied(spark, landing_root, key, transform)
        if tally is None:
            clean = transform(landing)
        path = write_table(clean, clean_root, key)
        landed = tally.counts(spark) if tally else None
        counts = watched.result(spark) if watched else None
        dropped = {}
        if self.diagnostics.dropped_rows != "off":
            contract, _ = normalize_contract(self.contract)
            missing = quality.dropped_rows(landing, contract, self.enrich, timezone=self.timezone)
            dropped = quality.report_dropped(missing, self.diagnostics, shared_dir(spark, f"{self.name}-dropped"))
        return PipelineRun(path, self.check(spark, landing_root, clean_root, key, landed), counts, dropped)

    def _tallied(self, spark: SparkSession, landing_root: str, key: str | None, transform: Transform):
        """The clean rows over a scan that counts its records, and the tally; (None, None) where nothing has
        landed or the transform would spoil the count."""
        monthly = self.grain == "monthly_to_yearly" and key
        keys = quality.landing_keys(spark, landing_root, key, self.grain)
        records = scan_landing_marked(spark, landing_root, keys) if keys != [] else None
        if records is None:
            return None, None
        tally = quality.LandingTally(quality.landed_months(spark, landing_root, [key]) if monthly else None)
        clean = transform(tally.watch(records))
        return (tally, clean) if tally.holds(clean) else (None, None)

    def check(self, spark: SparkSession, landing_root: str, clean_root: str, key: str | None = None,
              landed: DataFrame | None = None) -> DataFrame:
        """Accounting of what is stored; ``landed`` are the counts of a run, without them the shards are parsed."""
        if self.grain == "monthly_to_yearly" and key:
            return quality.monthly_accounting(spark, landing_root, clean_root, [key],
                                              allow_row_drop=self.expect_filtered_rows, landed=landed)
        return quality.flat_accounting(spark, landing_root, clean_root, key, allow_row_drop=self.expect_filtered_rows,
                                       landed=landed)

    def summary(self, spark: SparkSession, landing_root: str, clean_root: str) -> DataFrame:
        return quality.cross_partition_summary(spark, landing_root, clean_root, self.grain)

    def read(self, spark: SparkSession, clean_root: str, keys: list[str] | None = None) -> DataFrame:
        """The clean table with hive columns as numbers; filters on them still prune folders."""
        table = read_table(spark, clean_root, keys)
        hive = [c for c in ("year", "month") if c in table.columns and isinstance(table.schema[c].dataType, T.StringType)]
        return table.withColumns({c: F.col(c).cast("int") for c in hive}) if hive else table
