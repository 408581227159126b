from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from civiclake.operators.enrichments import BoroughConfig, StandardEnrichments, TemporalConfig, TimestampConfig
from civiclake.operators import quality
from civiclake.operators.quality import Diagnostics
from civiclake.plans import analytics, flood
from civiclake.plans.pipeline import LandingToClean
from civiclake.sources import tables
from civiclake.streaming.arrivals import clean_arrivals
from tests.test_sources import shard
from workload.registry import Source

CONTRACT = {"unique_key": ("unique_key", "string", "Id"), "created_date": ("created_date", "timestamp", "Filed"), "borough": ("borough", "string", "Where")}
ENRICH = StandardEnrichments(borough=BoroughConfig("borough"), timestamp=TimestampConfig("created_date"), temporal=TemporalConfig())


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "landing"
    shard(root / "year=2024" / "month=01", "a.csv.gz", "unique_key,created_date,borough,other\na,2024-01-05T10:00:00,BRONX,1\nb,2024-01-06T10:00:00,,2\n")
    shard(root / "year=2024" / "month=03", "a.csv.gz", "unique_key,created_date,borough,other\nc,2024-03-10T02:30:00,K,3\n")
    return str(root)


def test_monthly_landing_to_yearly_clean(spark, landed, tmp_path):
    pipeline = LandingToClean("p", CONTRACT, ENRICH, landing_partitions="monthly", clean_partitions="yearly", diagnostics=Diagnostics(row_counts=True))
    assert pipeline.grain == "monthly_to_yearly"
    clean = str(tmp_path / "clean")
    run = pipeline.run(spark, landed, clean, "2024")
    assert run.path.endswith("year=2024")
    account = run.accounting.first()
    assert (account.landing_rows, account.clean_rows, account.months_missing, account.passed, account.reason) == (3, 3, 10, True, "balanced")
    assert tuple(run.counts.first()) == (3, 3, 0)
    rows = {r.unique_key: r for r in pipeline.read(spark, clean).collect()}
    assert (rows["a"].borough_key, rows["a"].year, rows["a"].month, rows["a"].quarter) == ("bronx", 2024, 1, 1)
    assert rows["c"].created_date is None and rows["c"].month is None and rows["c"].year == 2024
    assert set(rows["a"].asDict()) == set(pipeline.schema().names)
    plan = pipeline.read(spark, clean).where("year = 2024")._jdf.queryExecution().executedPlan().toString()
    assert "year" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_filtering_pipeline_reports_what_it_drops(spark, landed, tmp_path):
    def run(expect):
        pipeline = LandingToClean("p", CONTRACT, ENRICH, lambda df: df.where("borough IS NOT NULL"), "monthly", "yearly", expect,
                                  Diagnostics(dropped_rows="full"))
        return pipeline.run(spark, landed, str(tmp_path / f"clean-{expect}"), "2024")

    strict, easy = run(False), run(True)
    assert (strict.accounting.first().passed, strict.accounting.first().reason) == (False, "rows_lost_in_transform")
    assert (easy.accounting.first().passed, easy.accounting.first().severity) == (True, "warn")
    assert easy.dropped["count"] == 1 and easy.dropped["sample"][0]["unique_key"] == "b" and "csv" in easy.dropped


def test_shards_are_parsed_once(spark, tmp_path, monkeypatch):
    root = tmp_path / "landing"
    shard(root / "year=2024" / "month=01", "a.csv.gz", "unique_key,created_date,borough,other\na,2024-01-05T10:00:00,BRONX,1\nbroken\n")
    shard(root / "year=2024" / "month=02", "a.csv.gz", "unique_key,created_date,borough,other\n")
    shard(root / "year=2024" / "month=03", "a.csv.gz", "unique_key,created_date,borough,other\nc,2024-03-10,K,\"x\ny\"\nd,2024-03-11,,4\n")
    steps = {"plain": None, "filtered": lambda df: df.where("borough IS NOT NULL"), "sorted": lambda df: df.orderBy("unique_key"),
             "limited": lambda df: df.limit(1), "emptied": lambda df: df.where("false")}
    calls = []
    counted = quality.landing_counts
    monkeypatch.setattr(quality, "landing_counts", lambda *a: calls.append(a) or counted(*a))
    for grain, key in (("monthly", "2024"), (None, None)):
        for name, step in steps.items():
            pipeline = LandingToClean("p", CONTRACT, ENRICH, step, grain, grain and "yearly", True)
            calls.clear()
            clean = str(tmp_path / f"{name}-{grain}")
            run = pipeline.run(spark, str(root), clean, key)
            assert bool(calls) == (name in ("sorted", "limited", "emptied")), name
            assert run.accounting.collect() == pipeline.check(spark, str(root), clean, key).collect()
            if name == "filtered":
                row = run.accounting.first()
                assert (row.landing_rows, row.parsed_rows, row.clean_rows, row.reason) == (4, 3, 2, "rows_lost_in_parsing")
                assert grain is None or (row.months_materialized, row.months_with_data, row.months_empty) == (3, 2, 1)


def test_year_without_landing(spark, landed, tmp_path):
    pipeline = LandingToClean("p", CONTRACT, ENRICH, landing_partitions="monthly", clean_partitions="yearly")
    run = pipeline.run(spark, landed, str(tmp_path / "clean"), "2030")
    assert (run.accounting.first().clean_rows, run.accounting.first().months_missing) == (0, 12)


def test_unpartitioned_pipeline(spark, tmp_path):
    shard(tmp_path / "l", "a.csv.gz", "unique_key,created_date,borough\na,01/05/2024,Q\n")
    pipeline = LandingToClean("p", CONTRACT)
    run = pipeline.run(spark, str(tmp_path / "l"), str(tmp_path / "c"))
    assert pipeline.grain == "unpartitioned" and run.accounting.first().reason == "balanced"
    assert tables.read_table(spark, str(tmp_path / "c")).selectExpr("CAST(created_date AS timestamp_ntz)").first()[0] == datetime(2024, 1, 5, 5)


def test_stream_equals_batch_and_restarts(spark, landed, tmp_path):
    pipeline = LandingToClean("p", CONTRACT, ENRICH)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("unique_key", "created_date", "borough", "other")])
    clean, checkpoint = str(tmp_path / "stream"), str(tmp_path / "checkpoint")
    run = lambda: clean_arrivals(spark, pipeline, landed, clean, checkpoint, schema).awaitTermination(120)
    run()
    assert sorted(r.unique_key for r in spark.read.parquet(clean).collect()) == ["a", "b", "c"]
    shard(tmp_path / "landing" / "year=2024" / "month=04", "a.csv.gz", "unique_key,created_date,borough,other\nd,2024-04-01T00:00:00,SI,4\n")
    run()
    stored = spark.read.parquet(clean)
    assert sorted(r.unique_key for r in stored.collect()) == ["a", "b", "c", "d"]
    assert stored.where("unique_key = 'd'").first().borough_key == "staten_island"


# -- the enriched join ----------------------------------------------------------------------------

def test_enriched_events(spark, frame):
    at = datetime(2024, 7, 1, 3, 30)
    events = frame(
        "sensor_name string, sensor_id string, flood_start_time timestamp_ntz, flood_end_time timestamp_ntz, max_depth_inches double, onset_time_mins double, "
        "drain_time_mins double, duration_mins double, flood_profile_depth_inches string, flood_profile_time_secs string",
        ("n", "s1", None, at, 13.0, 10.0, 20.0, 30.0, "[0, 13, 0]", "[0, 600, 1800]"), ("n", "s9", at, None, None, 0.0, None, 15.0, "broken", "[0]"))
    columns = ", ".join(f"{c} {t}" for c, (_, t, _) in flood.FLOOD_SENSORS.items())
    sensor = {c: None for c in flood.FLOOD_SENSORS} | {"sensor_id": "s1", "borough": "Queens", "tidally_influenced": "Yes", "date_installed": date(2024, 1, 1), "latitude": 40.7, "longitude": -74.0}
    sensors = frame(columns, tuple(sensor.values()))
    first, second = flood.enrich_events(events, sensors).orderBy("sensor_id").collect()
    assert first.flood_start_time == datetime(2024, 7, 1, 3) and first.has_imputed_timestamp and first.flood_severity == "major"
    assert (first.rise_rate_in_per_min, first.drain_rate_in_per_min, first.drain_efficiency_ratio, first.time_to_peak_pct) == (1.3, 0.65, 2.0, 0.3333)
    assert (first.flood_volume_index, first.profile_sample_count, first.flood_season, first.flood_is_overnight, first.has_location) == (195.0, 3, "summer", True, True)
    assert second.flood_end_time == datetime(2024, 7, 1, 3, 45) and second.flood_severity == "severe" and second.rise_rate_in_per_min is None
    assert (second.borough, second.is_tidally_influenced, second.has_location, second.profile_sample_count) == (None, None, False, None)
    assert flood.duplicate_sensors(sensors.union(sensors)).first().copies == 2


# -- plans ----------------------------------------------------------------------------------------

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    s = Source(spark, SF_DIR)
    from civiclake.operators.filters import time_window

    kept = s.orders.where(time_window("o_orderdate", F.lit("1997-01-01").cast("timestamp_ntz"), F.lit("1998-01-01").cast("timestamp_ntz"))).select("o_orderkey")
    plan = plan_of(kept)
    assert "GreaterThanOrEqual(o_orderdate" in plan and "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


@pytest.mark.parametrize("name", ["R01_collisions_annual", "R03_contributing_factors", "R04_tonnage_annual", "R10_top_heat_properties", "R12_transit_vs_air",
                                  "R16_enriched_join", "R19_06_flood_days_and_next_day", "E01_enrichment_bundle", "C01_multi_parse_date"])
def test_no_python_and_no_cross_join(spark, name):
    from workload import load

    plan = plan_of(load()[0][name](spark, SF_DIR))
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_aggregates_combine_before_the_shuffle(spark):
    plan = plan_of(analytics.ridership_by_mode(Source(spark, SF_DIR).ridership))
    assert "partial_sum" in plan


def test_organics_rollout_reads_months_with_leading_blanks_signs_and_zeros(spark):
    months = ["2014 / 05", " 2014 / 06", "  2014 / 07", "+2014 / 08", "02014 / 09", "2012 / 05", " 2012 / 06", "unknown", None]
    tons = ["refuse_tons_collected", "paper_tons_collected", "mgp_tons_collected", "res_organics_tons", "school_organic_tons", "leaves_organic_tons",
            "xmas_tree_tons", "other_organics_tons"]
    df = spark.createDataFrame([(m, "Bronx", str(k), *[1.0] * len(tons)) for k, m in enumerate(months)],
                               "month string, borough string, community_district string, " + ", ".join(f"{t} double" for t in tons))
    years = {r.year: r["count"] for r in df.groupBy(analytics.month_part("month", 1).alias("year")).count().collect()}
    made = {r.year: r.total_districts for r in analytics.organics_rollout(df).collect()}
    assert made == {y: n for y, n in years.items() if y is not None and y >= 2013} and made[2014] >= 3


def test_unpivot_replaces_five_scans(spark):
    plan = plan_of(analytics.contributing_factors(Source(spark, SF_DIR).collisions))
    assert "Expand" in plan and plan.count("Scan parquet") == 1


def test_flood_sort_does_not_carry_derived_columns(spark):
    s = Source(spark, SF_DIR)
    plan = plan_of(flood.enrich_events(s.flood_events, s.sensors, sort=True))
    above, below = plan.split("Exchange rangepartitioning")[:2]
    assert "flood_severity" in above and "from_json" in above and "flood_severity" not in below and "from_json" not in below
