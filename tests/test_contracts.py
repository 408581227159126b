from datetime import date

import pytest
from pyspark.sql import types as T

from civiclake import contracts
from civiclake.operators import enrichments as e


def test_strict_and_resilient(frame):
    df = frame("src string, amount string, z string, a string", ("1,234", "$3,000", "zz", "aa"))
    contract = {"src": ("id", "bigint"), "amount": ("amount", "double"), "gone": ("gone", "date")}
    strict = contracts.apply_schema_contract(df, contract)
    assert strict.dtypes == [("id", "bigint"), ("amount", "double"), ("gone", "date")]
    assert tuple(strict.first()) == (1234, 3000.0, None)
    loose = contracts.apply_schema_contract(df, contract, drop_unknown=False)
    assert loose.columns == ["id", "amount", "gone", "a", "z"]


def test_types_of_a_contract(frame):
    df = frame("x string", "1")
    kinds = ["string", "tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "uint8", "uint16", "uint32", "uint64"]
    made = contracts.apply_schema_contract(df.select(*[df.x.alias(k) for k in kinds]), {k: (k, k) for k in kinds})
    assert [t for _, t in made.dtypes] == kinds[:10] + ["smallint", "int", "bigint", "decimal(20,0)"]


def test_zone_of_a_contract(frame):
    df = frame("d string", "2024-01-15T03:00:00Z")
    assert contracts.apply_schema_contract(df, {"d": ("d", "date")}).first().d == date(2024, 1, 14)
    assert contracts.apply_schema_contract(df, {"d": ("d", "date")}, timezone="UTC").first().d == date(2024, 1, 15)


def test_odd_column_names(frame):
    df = frame("`a.b` string, `c``d` string", ("1", "2"))
    assert tuple(contracts.apply_schema_contract(df, {"a.b": ("x", "int")}, drop_unknown=False).first()) == (1, "2")


def test_normalizing():
    assert contracts.normalize_contract({"a": ("b", "int", "text")}) == ({"a": ("b", "int")}, True)
    assert contracts.normalize_contract({"a": ("b", "int")}) == ({"a": ("b", "int")}, False)
    with pytest.raises(ValueError):
        contracts.normalize_contract({"a": ("b", "int"), "c": ("d", "int", "text")})


def test_dictionary():
    contract = {"a": ("x", "string", "An a"), "b": ("y", "double", "A b"), "c": ("z", "timestamp", "A c"), "d": ("w", "boolean", ""), "e": ("v", "uint8", ""), "f": ("u", "int", "")}
    rows = contracts.column_dictionary(contract, [{"name": "last"}], {"x": [{"name": "next"}]})
    assert [r["name"] for r in rows] == ["x", "next", "y", "z", "w", "v", "u", "last"]
    assert [r["type"] for r in rows if "type" in r] == ["string", "number", "date", "boolean", "unknown", "number"]
    assert rows[0] == {"name": "x", "type": "string", "api_name": "a", "description": "An a"}


def test_table_schema_and_comments(frame):
    contract = {"a": ("x", "string", "An a"), "b": ("y", "int")}
    schema = contracts.build_table_schema(contract, [e.derived("year", T.IntegerType(), "year")], {"x": [e.derived("x2", T.StringType(), "more")]})
    assert schema.names == ["x", "x2", "y", "year"] and schema["x"].metadata == {"comment": "An a"} and schema["y"].metadata == {}
    made = contracts.with_comments(contracts.apply_schema_contract(frame("a string", "q"), contract), schema)
    assert made.schema["x"].metadata["comment"] == "An a"


def test_declarative_clean(frame):
    df = frame("A string, d string, f string, b string", ("7", "01/02/2024", "$1.5", "no"))
    made = contracts.clean_columns(df, rename_map={"A": "a"}, int_cols=["a"], date_cols=["d"], float_cols=["f"], bool_cols=["b"])
    assert tuple(made.first()) == (7, date(2024, 1, 2), 1.5, False)
    assert contracts.clean_columns(df).columns == df.columns


# -- enrichment bundle ----------------------------------------------------------------------------

def test_bundle_columns_match_what_it_makes(frame):
    df = frame("boro string, latitude double, longitude double, seen date, bbl string", ("K", 40.7, -74.0, date(2024, 7, 1), None))
    bundle = e.StandardEnrichments(
        borough=e.BoroughConfig("boro", code=True, canonical_name=True), location=e.LocationConfig(), timestamp=e.TimestampConfig("seen"),
        temporal=e.TemporalConfig(day_of_week=True, fiscal_year=True, season=True, year_month_key=True, hour=True, is_overnight=True),
        completeness=e.CompletenessConfig("seen", ["bbl"], {"full": ["seen", "bbl"]}))
    described = bundle.build_derived_columns()
    made = df.transform(bundle.build_transform_fn())
    assert [c.name for c in described] == made.columns[len(df.columns):]
    assert [c.dataType for c in described] == [made.schema[c.name].dataType for c in described]
    row = made.first()
    assert (row.borough_code, row.has_location, row.year, row.fiscal_year, row.has_geo_ids, row.full) == (3, True, 2024, 2025, False, False)
    assert all(c.metadata["comment"].startswith("[Derived]") for c in described)


def test_bundle_parts_are_optional(frame):
    df = frame("a int", 1)
    assert e.StandardEnrichments().build_derived_columns() == []
    assert df.transform(e.StandardEnrichments().build_transform_fn()).columns == ["a"]


def test_bundle_refuses_repeated_names():
    bundle = e.StandardEnrichments(location=e.LocationConfig(), completeness=e.CompletenessConfig(custom_flags={"has_location": ["latitude"]}))
    with pytest.raises(ValueError, match="has_location"):
        bundle.build_derived_columns()


def test_bundle_zone(frame):
    from datetime import datetime

    df = frame("t timestamp_ntz", datetime(2024, 1, 1, 0, 30))
    made = df.transform(e.StandardEnrichments(timestamp=e.TimestampConfig("t", "datetime"), temporal=e.TemporalConfig(), timezone_columns=["t"], tz="Asia/Tokyo").build_transform_fn())
    assert (made.first().year, made.selectExpr("CAST(record_timestamp AS timestamp_ntz)").first()[0]) == (2024, datetime(2023, 12, 31, 15, 30))


def test_dictionaries_of_single_enrichments():
    assert [c.name for c in e.temporal_columns(prefix="p_", season=True)] == ["p_year", "p_month", "p_quarter", "p_season"]
    assert [c.name for c in e.completeness_columns(lat_col="a", lon_col="b")] == ["has_location"]
    assert [c.name for c in e.duplicate_columns() + e.parcel_columns() + e.district_columns()] == ["_dedup_count", "_dedup_rank", "bbl", "community_district_key"]
