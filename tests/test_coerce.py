from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from civiclake.contracts import coerce_column
from civiclake.functions import coerce


@pytest.mark.parametrize("words, expected", [
    (["1", "t", "true", "y", "yes", "TRUE", "Yes"], True), (["0", "f", "false", "n", "no", "FALSE", "No"], False),
    ([None, "maybe", ""], None), ([" yes "], True)])
def test_bool_words(frame, values, words, expected):
    assert values(frame("w string", *words).select(coerce.safe_bool("w"))) == [expected] * len(words)


def test_bool_from_integers(frame, values):
    assert values(frame("w int", 1, 0, 100, -5).select(coerce.safe_bool("w"))) == [True, False, None, None]


def test_float_texts(frame, values):
    texts = ["123.45", "-42", "$1,234.56", "-$999.99", " 42 ", "1 000", "abc", "1d", "5f", "1e3", ".5", "", None, "1 000"]
    assert values(frame("x string", *texts).select(coerce.safe_float("x"))) == [
        123.45, -42.0, 1234.56, -999.99, 42.0, 1000.0, None, None, None, 1000.0, 0.5, None, None, 1000.0]


def test_float_from_integers(frame, values):
    assert values(frame("x int", 7).select(coerce.safe_float("x"))) == [7.0]


def test_integer_texts(frame, values):
    texts = ["1,234", "12.0", " 5 ", "-7", "+8", "99999999999999999999", "9223372036854775807", "9223372036854775808", "0007", "x", None]
    assert values(frame("x string", *texts).select(coerce.safe_int("x"))) == [
        1234, None, None, -7, 8, None, 9223372036854775807, None, 7, None, None]


@pytest.mark.parametrize("kind, texts, expected", [
    ("tinyint", ["127", "128", "-128", "-129"], [127, None, -128, None]),
    ("smallint", ["32767", "32768"], [32767, None]),
    ("int", ["2147483647", "2147483648"], [2147483647, None]),
    ("uint8", ["255", "256", "-1"], [255, None, None]),
    ("uint16", ["65535", "65536"], [65535, None]),
    ("uint32", ["4294967295", "4294967296"], [4294967295, None]),
    ("uint64", ["18446744073709551615", "18446744073709551616"], [18446744073709551615, None])])
def test_integer_ranges(frame, values, kind, texts, expected):
    assert [None if v is None else int(v) for v in values(frame("x string", *texts).select(coerce_column("x", kind)))] == expected


@pytest.mark.parametrize("text, utc", [
    ("2024-01-15", datetime(2024, 1, 15, 5)), ("2024-06-15T10:30:00", datetime(2024, 6, 15, 14, 30)),
    ("2024-06-15T10:30:00Z", datetime(2024, 6, 15, 10, 30)), ("2024-06-15T10:30:00.250Z", datetime(2024, 6, 15, 10, 30, 0, 250000)),
    ("01/15/2024", datetime(2024, 1, 15, 5)), ("20240115", datetime(2024, 1, 15, 5)), ("2024-06-15 10:30:00.5", datetime(2024, 6, 15, 14, 30, 0, 500000)),
    ("2024-02-30", None), ("soon", None), ("", None), (None, None),
    ("2024-03-10T02:30:00", None),                               # skipped hour
    ("2024-03-10T03:30:00", datetime(2024, 3, 10, 7, 30)),
    ("2024-11-03 01:30:00", datetime(2024, 11, 3, 6, 30)),       # doubled hour: the later instant
    ("2024-11-03 00:30:00", datetime(2024, 11, 3, 4, 30)),
    ("2024-11-03 02:30:00", datetime(2024, 11, 3, 7, 30))])
def test_multi_parse_date(frame, values, text, utc):
    instant = coerce.multi_parse_date("x").cast("timestamp_ntz")
    assert values(frame("x string", text).select(instant)) == [utc]


def test_parse_with_offset_and_other_zone(frame, values):
    df = frame("x string", "2024-01-05T03:04:05+0530", "2024-07-05")
    instant = coerce.multi_parse_date("x", ("%Y-%m-%dT%H:%M:%S%z", "%Y-%m-%d"), "Europe/Paris").cast("timestamp_ntz")
    assert values(df.select(instant)) == [datetime(2024, 1, 4, 21, 34, 5), datetime(2024, 7, 4, 22)]


def test_local_date_of_an_instant(frame, values):
    # 03:00 UTC is still the day before in New York.
    assert values(frame("x string", "2024-01-15T03:00:00Z", "2014-01-21T00:00:00.000").select(coerce.parse_local_date("x"))) == [
        date(2024, 1, 14), date(2014, 1, 21)]


def test_unknown_layout_token():
    with pytest.raises(ValueError, match="%Q"):
        coerce.spark_layout("%Y-%Q")


def test_no_python_in_the_plan(frame):
    plan = frame("x string", "1").select(coerce.multi_parse_date("x"), coerce.safe_float("x"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def test_generic_cast_is_lenient(frame, values):
    assert values(frame("x string", "1.5", "no").select(coerce_column("x", "decimal(5,2)").cast("string"))) == ["1.50", None]
