from datetime import date, datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from civiclake.functions import classify, flags, geo, ids, numeric, profiles, temporal, text
from civiclake.operators.dedup import add_duplicate_markers
from civiclake.operators.layout import reorder_columns


# -- time -----------------------------------------------------------------------------------------

def test_parse_string_date(frame, values):
    parsed = temporal.parse_string_date("m", "%Y-%m-%d", pre_replace={" / ": "-"}, suffix="-01")
    assert values(frame("m string", "2026 / 02", "bad", None).select(parsed)) == [date(2026, 2, 1), None, None]


def test_record_timestamp_kinds(frame):
    df = frame("d date, y int, t timestamp_ntz", (date(2024, 6, 15), 2023, datetime(2024, 3, 10, 2, 30)))
    def stamp(source, precision):
        made = temporal.add_record_timestamp(df, source, precision)
        return made.select(F.col("record_timestamp").cast("timestamp_ntz"), "record_date_precision").first()
    assert tuple(stamp("d", "day")) == (datetime(2024, 6, 15, 4), "day")
    assert tuple(stamp("y", "year")) == (datetime(2023, 1, 1, 5), "year")
    assert tuple(stamp("t", "datetime")) == (None, "datetime")
    with pytest.raises(ValueError):
        stamp("d", "century")


@pytest.mark.parametrize("day, expected", [
    (date(2024, 6, 15), (2024, 6, 2, 2024, "summer", "Saturday", "2024-06")), (date(2024, 7, 1), (2024, 7, 3, 2025, "summer", "Monday", "2024-07")),
    (date(2024, 6, 30), (2024, 6, 2, 2024, "summer", "Sunday", "2024-06")), (date(2024, 1, 31), (2024, 1, 1, 2024, "winter", "Wednesday", "2024-01")),
    (date(2024, 4, 1), (2024, 4, 2, 2024, "spring", "Monday", "2024-04")), (date(2024, 10, 1), (2024, 10, 4, 2025, "fall", "Tuesday", "2024-10")),
    (date(2024, 12, 31), (2024, 12, 4, 2025, "winter", "Tuesday", "2024-12")), (None, (None, None, None, None, "unknown", "Unknown", None))])
def test_calendar_parts(frame, day, expected):
    made = temporal.add_temporal_columns(frame("d date", (day,)), "d", fiscal_year=True, season=True, day_of_week=True, year_month_key=True)
    assert tuple(made.select("year", "month", "quarter", "fiscal_year", "season", "day_of_week", "year_month").first()) == expected


def test_temporal_prefix_and_nothing(frame):
    df = frame("d date", date(2024, 1, 1))
    assert temporal.add_temporal_columns(df, "d", month=False, quarter=False, prefix="flood_").columns == ["d", "flood_year"]
    assert temporal.add_temporal_columns(df, "d", year=False, month=False, quarter=False).columns == ["d"]


@pytest.mark.parametrize("hour, night", [(21, False), (22, True), (0, True), (5, True), (6, False)])
def test_overnight(frame, values, hour, night):
    df = frame("t timestamp_ntz", datetime(2024, 1, 1, hour, 59))
    assert values(temporal.add_temporal_columns(df, "t", is_overnight=True).select("is_overnight")) == [night]


@pytest.mark.parametrize("end, unit, expected, wrong", [
    (datetime(2024, 1, 1, 12), "hours", 2.0, False), (datetime(2024, 1, 1, 8), "hours", -2.0, True), (datetime(2024, 1, 1, 10, 30), "minutes", 30.0, False),
    (datetime(2024, 1, 1, 8, 30), "hours", -1.0, True), (None, "hours", None, False)])
def test_durations(frame, end, unit, expected, wrong):
    df = frame("a timestamp_ntz, b timestamp_ntz", (datetime(2024, 1, 1, 10), end))
    made = df.select(*temporal.duration_columns("a", "b", unit=unit, flag_negative=True))
    assert made.columns == [f"a_to_b_{unit}", "is_temporal_error"]
    assert tuple(made.first()) == (expected, wrong)


def test_duration_unit():
    with pytest.raises(ValueError):
        temporal.compute_duration("a", "b", unit="weeks")


def test_enforce_timezone(frame):
    df = frame("wall timestamp_ntz, words string, at timestamp", (datetime(2024, 1, 15, 12), "2024-01-15 12:00:00", datetime(2024, 1, 15, 12, tzinfo=timezone.utc)))
    made = temporal.enforce_timezone(df, ["wall", "words", "at", "absent"])
    assert [tuple(r) for r in made.select(*[F.col(c).cast("timestamp_ntz") for c in made.columns]).collect()] == [
        (datetime(2024, 1, 15, 17), datetime(2024, 1, 15, 17), datetime(2024, 1, 15, 12))]
    other = temporal.enforce_timezone(df, ["wall"], target_tz="Asia/Tokyo")
    assert other.select(F.col("wall").cast("timestamp_ntz")).first()[0] == datetime(2024, 1, 15, 3)


def test_partition_windows(spark, frame):
    bounds = frame("a string, b string", ("2020-01-01", "2022-05-01"))
    years = temporal.partition_windows(bounds, "yearly", "a", "b", end_offset=1).orderBy("partition_key")
    assert [r[0] for r in years.collect()] == ["2020", "2021", "2022"]
    months = temporal.partition_windows(frame("a string, b string", ("2024-02-01", "2024-05-10")), "monthly", "a", "b")
    rows = months.orderBy("partition_key").select("partition_key", *[F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")]).collect()
    assert [tuple(r) for r in rows][1] == ("2024-03", datetime(2024, 3, 1, 5), datetime(2024, 4, 1, 4))
    assert len(rows) == 3
    with pytest.raises(ValueError):
        temporal.partition_windows(bounds, "weekly", "a", "b")


def test_timestamp_literal():
    assert temporal.timestamp_literal(datetime(2024, 1, 1, tzinfo=ZoneInfo("America/New_York"))) == "2024-01-01 00:00:00-05:00"
    assert temporal.timestamp_literal(datetime(2024, 1, 1, 2, 3, 4)) == "2024-01-01 02:03:04"


def test_impute(frame):
    t = datetime(2024, 1, 1, 10)
    df = frame("a timestamp_ntz, b timestamp_ntz, m double", (None, t, 30.0), (t, None, 90.5), (None, None, 5.0), (t, t, 1.0))
    made = temporal.impute_interval(df, "a", "b", "m").collect()
    assert made[0].a == datetime(2024, 1, 1, 9, 30) and made[1].b == datetime(2024, 1, 1, 11, 30, 30)
    assert made[2].a is None and [r.has_imputed_timestamp for r in made] == [True, True, True, False]


# -- places ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("spelling, key, code, name", [
    ("MANHATTAN", "manhattan", 1, "Manhattan"), ("manhattan", "manhattan", 1, "Manhattan"), ("M", "manhattan", 1, "Manhattan"), ("MN", "manhattan", 1, "Manhattan"),
    ("New York", "manhattan", 1, "Manhattan"), ("B", "bronx", 2, "Bronx"), ("X", "bronx", 2, "Bronx"), ("bx", "bronx", 2, "Bronx"), ("K", "brooklyn", 3, "Brooklyn"),
    ("KINGS", "brooklyn", 3, "Brooklyn"), ("3", "brooklyn", 3, "Brooklyn"), ("Q", "queens", 4, "Queens"), ("QN", "queens", 4, "Queens"), ("R", "staten_island", 5, "Staten Island"),
    ("Staten Island", "staten_island", 5, "Staten Island"), ("RICHMOND / STATEN ISLAND", "staten_island", 5, "Staten Island"), ("\t si \n", "staten_island", 5, "Staten Island"),
    ("Narnia", None, None, None), ("", None, None, None), (None, None, None, None)])
def test_boroughs(frame, spelling, key, code, name):
    made = geo.add_borough_key(frame("borough string", (spelling,)), code=True, canonical_name=True)
    assert tuple(made.select("borough_key", "borough_code", "borough_name").first()) == (key, code, name)


def test_borough_columns_are_optional(frame):
    df = frame("b string", "Bronx")
    assert geo.add_borough_key(df, "b", key=False).columns == ["b"]
    assert geo.add_borough_key(df, "b").columns == ["b", "borough_key"]


@pytest.mark.parametrize("lat, lon, bounded, free", [
    (40.7128, -74.006, True, True), (None, -74.0, False, False), (35.0, -120.0, False, True), (40.4, -74.3, True, True), (40.95, -73.65, True, True)])
def test_location(frame, lat, lon, bounded, free):
    df = frame("latitude double, longitude double", (lat, lon))
    assert geo.add_location_flag(df).first().has_location is bounded
    assert geo.add_location_flag(df, validate_nyc_bounds=False).first().has_location is free


def test_location_from_text(frame, values):
    assert values(frame("a string, b string", ("40.7", "-74.0"), ("x", "-74.0")).select(geo.has_valid_location("a", "b"))) == [True, False]


@pytest.mark.parametrize("boro, block, lot, expected", [
    (1, 12345, 67, "1123450067"), (2, 1, 1, "2000010001"), (3, 500, 12, "3005000012"), (4, 123456, 7, "41234560007"), (1, None, 5, None)])
def test_parcels(frame, boro, block, lot, expected):
    assert geo.add_nyc_bbl(frame("boro int, block int, lot int", (boro, block, lot))).first().bbl == expected


def test_districts(frame, values):
    df = frame("d string, b string", ("01", "MANHATTAN"), ("12", "3"), (" 7 ", "bx"), ("5", "Nowhere"))
    assert values(df.select(geo.community_district_key("d", "b"))) == ["101", "312", "207", None]
    assert values(frame("d string", "501", "7", None).select(geo.community_district_key("d"))) == ["501", "007", None]


def test_boards(frame):
    rows = frame("n int", 101, 312, 595, 600, None).select(geo.board_borough("n"), geo.board_number("n")).collect()
    assert [tuple(r) for r in rows] == [("MANHATTAN", 1), ("BROOKLYN", 12), ("STATEN ISLAND", 95), (None, 0), (None, None)]


# -- text, numbers --------------------------------------------------------------------------------

def test_clean_text(frame, values):
    df = frame("x string", "  a \t b\n c ", "straße", "a  b", "", None)
    assert values(df.select(text.clean_text("x"))) == ["A B C", "STRASSE", "A B", "", None]
    assert values(df.select(text.clean_text("x", uppercase=False)))[0] == "a b c"


def test_replacements(frame, values):
    df = frame("x string", "A.A", None)
    assert values(df.select(text.apply_literal_replacements("x", {"A": "B", "B": "C", ".": "-"}))) == ["C-C", None]
    assert values(df.select(text.apply_literal_replacements("x", {"A": "B"}, replace_all=False))) == ["B.A", None]


def test_split(frame, values):
    df = frame("x string", "a,, b ,c", "", None)
    assert values(df.select(text.split_and_clean_list("x"))) == [["a", "b", "c"], [], None]
    assert values(frame("x string", "a|b| |c").select(text.split_and_clean_list("x", delimiter="|"))) == [["a", "b", "c"]]


def test_sums_and_rates(frame, values):
    df = frame("a double, b double", (10.0, 100.0), (10.0, 0.0), (None, 4.0), (0.0, 0.0), (-1.0, 0.0))
    assert values(df.select(numeric.sum_components(["a", "b"]))) == [110.0, 10.0, 4.0, 0.0, -1.0]
    assert values(df.select(numeric.compute_rate("a", "b"))) == [0.1, None, None, None, None]
    assert values(df.select(numeric.compute_rate("a", "b", scale=1 / 60, round_digits=6)))[0] == 0.001667
    loose = values(df.select(numeric.compute_rate("a", "b", null_on_zero=False, round_digits=None)))
    assert loose[:3] == [0.1, float("inf"), None] and loose[3] != loose[3] and loose[4] == float("-inf")


# -- labels, flags, ids ---------------------------------------------------------------------------

def test_mapping(frame, values):
    df = frame("x string", "a", "z", None)
    assert values(df.select(classify.map_with_default("x", {"a": "A"}, default="?"))) == ["A", "?", "?"]
    assert values(df.select(classify.map_with_default("x", {}, default="?"))) == ["?"] * 3


def test_rules(frame, values):
    df = frame("x string", "Water leak", "gas leak", "noise", None)
    rules = [("water", "(?i)WATER"), ("leak", "leak")]
    assert values(df.select(classify.ordered_regex_classification("x", rules, default="other"))) == ["water", "leak", "other", "other"]
    assert values(df.select(classify.ordered_regex_classification("x", [], default="other"))) == ["other"] * 4
    assert values(df.select(classify.collect_matching_labels("x", rules))) == ["water; leak", "leak", None, None]
    assert values(df.select(classify.collect_matching_labels("x", []))) == [None] * 4


def test_annotations(frame, values):
    df = frame("n int", 1, 5, 50, None)
    conditions = [(F.col("n") > 3, "big"), (F.col("n") > 10, "huge")]
    assert values(df.select(classify.assemble_annotations(conditions, separator=" | "))) == [None, "big", "big | huge", None]


def test_severity(frame, values):
    df = frame("d double", 3.9, 4.0, 12.0, 24.0, None)
    assert values(df.select(classify.depth_severity("d"))) == ["minor", "moderate", "major", "severe", "severe"]
    assert values(df.select(classify.depth_severity("d", null_is_severe=False)))[-1] is None
    assert values(frame("s string", "major", "x", None).select(classify.label_rank("s", classify.SEVERITIES))) == [3, None, None]


def test_flags(frame):
    df = frame("d date, lat double, lon double, bbl string, bin string", (date(2024, 1, 1), 1.0, None, None, "7"), (None, 1.0, 2.0, None, None))
    made = flags.add_completeness_flags(df, date_col="d", lat_col="lat", lon_col="lon", geo_id_cols=["bbl", "bin"], custom_flags={"ok": ["d", "bin"]})
    assert [tuple(r) for r in made.select("has_date", "has_location", "has_geo_ids", "ok").collect()] == [(True, False, True, True), (False, True, False, False)]
    assert flags.add_completeness_flags(df) is df


def test_hashes(frame, values):
    df = frame("a string, b string", ("x", None), ("x", ""), ("x", "y"), ("y", "x"))
    for method in ("md5", "xxhash64"):
        first = values(df.select(ids.stable_string_hash(["a", "b"], method=method)))
        assert first == values(df.select(ids.stable_string_hash(["a", F.col("b")], method=method)))
        assert first[0] == first[1] and len(set(first)) == 3 and isinstance(first[0], str)
    with pytest.raises(ValueError):
        ids.stable_string_hash(["a"], method="crc")


def test_profiles(frame):
    rows = [("[0, 2, 0]", "[0, 60, 120]", 2.0, 3), ("[0, 2", "[0, 60]", None, None), ("[1]", "[0]", None, 1), ("[1, 2]", "[0]", None, 2),
            (None, "[0, 1]", None, None), ("[]", "[]", None, 0), ("[1.5, 2.5, 4]", "[0, 30, 90]", 4.25, 3), ("oops", "[0]", None, None)]
    df = frame("d string, t string, area double, n int", *rows)
    made = df.select(profiles.profile_area("d", "t").alias("area"), profiles.profile_sample_count("d").alias("n"))
    assert [tuple(r) for r in made.collect()] == [(a, n) for *_, a, n in rows]


def test_layout_and_dedup(frame):
    df = frame("id string, val int, note string", ("A", 20, "x"), ("A", 10, "y"), ("B", 30, "z"), ("B", None, "w"))
    assert reorder_columns(df, ["note", "absent", "val"]).columns == ["note", "val", "id"]
    made = add_duplicate_markers(df, key_cols=["id"], rank_col="val", tiebreak=[]).orderBy("id", "val")
    assert [(r.id, r.val, r._dedup_count, r._dedup_rank) for r in made.collect()] == [("A", 10, 2, 2), ("A", 20, 2, 1), ("B", None, 2, None), ("B", 30, 2, 1)]
    assert dict(made.dtypes)["_dedup_rank"] == "int"
