"""Every query with a DuckDB counterpart gives the same rows."""

import pytest

from workload import load
from workload.check import compare, connect

SF_DIR, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
SPARK, ORACLE = load()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_matches_duckdb(spark, duck, name):
    problem = compare(SPARK[name](spark, SF_DIR), duck, ORACLE[name])
    if problem == "EMPTY":  # a filter may leave nothing of so little; then the next scale must give rows
        problem = compare(SPARK[name](spark, LARGER), connect(LARGER), ORACLE[name])
    assert problem is None, problem


def test_every_survey_row_has_a_query():
    wanted = [f"{letter}{i:02d}" for letter, count in (
        ("S", 26), ("P", 18), ("C", 9), ("T", 19), ("G", 8), ("X", 4), ("N", 5), ("M", 6), ("F", 4), ("I", 1), ("J", 2), ("E", 1),
        ("D", 4), ("A", 14), ("W", 5), ("O", 6), ("U", 5), ("Q", 15), ("R", 22), ("K", 7)) for i in range(1, count + 1)]
    wanted += [f"J{i}" for i in range(11, 20)]
    missing = [w for w in wanted if not any(n.split("_")[0] == w for n in SPARK)]
    assert missing == []


def test_driver_contract(spark):
    import __spark_entry__ as contract

    assert contract.FLAGSHIP in contract.queries()
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert not contract.entry(spark).isEmpty()
