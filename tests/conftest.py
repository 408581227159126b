import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from civiclake.session import get_session

    session = get_session("tests", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.driver.memory": "6g",
        "spark.sql.debug.maxToStringFields": "500"})
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def frame(spark):
    """One-column-per-keyword frame builder: ``frame("a string, b int", (1, 2), ...)``."""
    return lambda schema, *rows: spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)


@pytest.fixture
def values():
    """Values of the first column, in row order."""
    return lambda df: [r[0] for r in df.collect()]
