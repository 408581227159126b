import gzip

import pytest
from pyspark.sql import functions as F

from civiclake.operators import quality
from civiclake.operators.unions import YearSource
from civiclake.sources import tables
from tests.test_sources import shard


@pytest.mark.parametrize("landing, parsed, clean, allowed, verdict", [
    (10, 9, 9, False, (False, "error", "rows_lost_in_parsing")), (10, 9, 20, True, (False, "error", "rows_lost_in_parsing")),
    (10, 10, 11, True, (False, "error", "row_expansion")), (10, 10, 0, True, (False, "error", "clean_is_empty")),
    (10, 10, 8, True, (True, "warn", "rows_filtered")), (10, 10, 8, False, (False, "error", "rows_lost_in_transform")),
    (10, 10, 10, False, (True, "ok", "balanced")), (0, 0, 0, False, (True, "ok", "balanced")), (0, 0, 5, False, (True, "ok", "balanced"))])
def test_verdicts_in_order(frame, landing, parsed, clean, allowed, verdict):
    df = frame("landing_rows bigint, parsed_rows bigint, clean_rows bigint", (landing, parsed, clean))
    row = quality.with_verdict(quality.with_gaps(df), allow_row_drop=allowed).first()
    assert (row.passed, row.severity, row.reason) == verdict


@pytest.fixture
def layers(spark, frame, tmp_path):
    """Landing 2023: January good, February with a ragged row, March header only. 2024: May. 2025: none."""
    root = tmp_path / "landing"
    shard(root / "year=2023" / "month=01", "a.csv.gz", 'id,note\n1,"x\ny"\n2,b\n')
    shard(root / "year=2023" / "month=02", "a.csv.gz", "id,note\n3,c\n4\n")
    shard(root / "year=2023" / "month=03", "a.csv.gz", "id,note\n")
    shard(root / "year=2024" / "month=05", "a.csv.gz", "id,note\n5,d\n6,e\n")
    clean = str(tmp_path / "clean")
    for year, ids in (("2023", (1, 2, 3)), ("2024", (5,)), ("2025", (7, 8))):
        tables.write_table(frame("id int", *ids), clean, year)
    return str(root), clean


def test_file_counts(spark, layers):
    counts = quality.landing_file_counts(spark, layers[0], "2023")
    assert sorted((r.landing_rows, r.parsed_rows) for r in counts.collect()) == [(0, 0), (2, 1), (2, 2)]
    assert quality.landing_file_counts(spark, layers[0] + "-none").count() == 0


def test_clean_counts(spark, layers, tmp_path):
    assert quality.clean_counts(spark, layers[1]).first()[0] == 6
    assert quality.clean_counts(spark, str(tmp_path / "none")).first()[0] == 0
    assert {tuple(r) for r in quality.clean_counts(spark, layers[1], ["year"]).collect()} == {("2023", 3), ("2024", 1), ("2025", 2)}


def test_monthly_landing(spark, layers):
    rows = {r.month_key: r for r in quality.monthly_landing(spark, layers[0], ["2023"]).collect()}
    assert len(rows) == 12
    assert (rows["2023-02"].landing_rows, rows["2023-02"].parsed_rows, rows["2023-02"].status) == (2, 1, "materialized")
    assert (rows["2023-03"].status, rows["2023-04"].status) == ("empty", "not materialized")


def test_monthly_accounting(spark, layers):
    rows = {r.year: r for r in quality.monthly_accounting(spark, *layers, ["2023", "2024", "2025"]).collect()}
    assert (rows["2023"].months_materialized, rows["2023"].months_with_data, rows["2023"].months_empty, rows["2023"].months_missing) == (3, 2, 1, 9)
    assert [rows[y].reason for y in ("2023", "2024", "2025")] == ["rows_lost_in_parsing", "rows_lost_in_transform", "balanced"]


def test_flat_accounting(spark, frame, tmp_path):
    shard(tmp_path / "l", "a.csv.gz", "id\n1\n2\n")
    tables.write_table(frame("id int", 1, 2), str(tmp_path / "c"))
    row = quality.flat_accounting(spark, str(tmp_path / "l"), str(tmp_path / "c")).first()
    assert (row.landing_rows, row.parsed_rows, row.clean_rows, row.passed) == (2, 2, 2, True)
    nothing = quality.flat_accounting(spark, str(tmp_path / "x"), str(tmp_path / "y")).first()
    assert (nothing.landing_rows, nothing.clean_rows, nothing.passed) == (0, 0, True)


def test_summary(spark, layers):
    summary = quality.cross_partition_summary(spark, *layers)
    rows = {r.year: r for r in summary.collect()}
    assert rows["2023"].issues == "parse errors" and rows["2024"].issues == "transform gap" and rows["2025"].issues is None
    total = quality.summary_totals(summary).first()
    assert (total.total_partitions, total.total_clean_rows, total.partitions_with_issues, total.passed, total.severity) == (3, 6, 2, True, "warn")


def test_discovery(spark, layers, tmp_path):
    (tmp_path / "clean" / "year=20x4").mkdir()
    (tmp_path / "clean" / "other").mkdir()
    assert quality.discover_years(spark, layers[1]) == ["2023", "2024", "2025"]
    assert quality.discover_years(spark, str(tmp_path / "none")) == []


def test_dual_sources(spark, layers):
    sources = [YearSource("old", 2000, 2023), YearSource("kept", 2024, 2024, layer="clean", grain="same_grain")]
    roots = {"old": layers[0], "kept": layers[1]}
    rows = {r.year: r for r in quality.dual_source_accounting(spark, sources, roots, layers[1], ["2023", "2024", "2025"]).collect()}
    assert (rows["2023"].active_source, rows["2023"].reason) == ("old", "rows_lost_in_parsing")
    assert (rows["2024"].parse_gap, rows["2024"].reason) == (0, "balanced")
    assert (rows["2025"].active_source, rows["2025"].passed, rows["2025"].severity, rows["2025"].reason) == (None, True, "warn", "no_source")
    summary = {r.year: r for r in quality.dual_source_summary(spark, sources, roots, layers[1]).collect()}
    assert summary["2025"].transform_gap == -2 and summary["2025"].issues is None


def test_result_checks(spark, frame, tmp_path):
    assert tuple(quality.nonempty_check(frame("a int", 1)).first()) == (1, True)
    assert tuple(quality.nonempty_check(frame("a int", 1).where("a > 1")).first()) == (0, False)
    assert tuple(quality.stored_nonempty_check(spark, str(tmp_path / "none")).first()) == (0, False)


@pytest.mark.parametrize("mode, rows, has_csv", [("sample", 5, False), ("sample", 30, False), ("full", 5, True)])
def test_dropped_rows(spark, tmp_path, mode, rows, has_csv):
    raw = spark.range(100).selectExpr("CAST(id AS STRING) AS id", "CAST(id % 7 AS STRING) AS extra")
    gone = quality.dropped_rows(raw, {"id": ("id", "bigint")}, lambda df: df.where(F.col("id") >= rows))
    assert sorted(r.id for r in gone.collect()) == list(range(rows)) and gone.columns == ["id", "extra"]
    report = quality.report_dropped(gone, quality.Diagnostics(dropped_rows=mode), str(tmp_path / "csv"))
    assert report["count"] == rows and len(report["sample"]) == min(rows, 20) and ("csv" in report) is has_csv


def test_dropped_rows_without_an_answer(spark):
    raw = spark.range(5).selectExpr("CAST(id AS STRING) AS id")
    assert quality.dropped_rows(raw, {"id": ("id", "bigint")}, lambda df: df.select("id")) is None
    assert quality.report_dropped(None, quality.Diagnostics(dropped_rows="full"), "x") == {}
    none = quality.dropped_rows(raw, {"id": ("id", "bigint")}, lambda df: df)
    assert quality.report_dropped(none, quality.Diagnostics(dropped_rows="full"), "x") == {}


def test_diagnostics_are_checked():
    with pytest.raises(ValueError):
        quality.Diagnostics(dropped_rows="some")


@pytest.mark.parametrize("landing, clean, grain", [
    (None, None, "unpartitioned"), ("monthly", "yearly", "monthly_to_yearly"), ("monthly", "monthly", "same_grain"), ("yearly", "yearly", "same_grain"),
    ("static", "static", "same_grain"), ("yearly", None, "same_grain")])
def test_grains(landing, clean, grain):
    assert quality.infer_grain(landing, clean) == grain


def test_landing_keys(spark, layers):
    assert quality.landing_keys(spark, layers[0], "2023", "monthly_to_yearly") == ["2023-01", "2023-02", "2023-03"]
    assert quality.landing_keys(spark, layers[0], "2023-01", "same_grain") == ["2023-01"]
    assert quality.landing_keys(spark, layers[0], None, "unpartitioned") is None


def test_transform_counts(spark, tmp_path):
    counts = quality.TransformCounts()
    tables.write_table(counts.watch(spark.range(10).toDF("a"), lambda df: df.where("a < 3")), str(tmp_path / "t"))
    assert tuple(counts.result(spark).first()) == (10, 3, 7)
