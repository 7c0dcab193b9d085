import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from lakeloom.session import build_session

    session = build_session("tests", "8", 4)
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """``make("a int, b string", (1, "x"), ...)`` -> DataFrame"""
    return lambda schema, *rows: spark.createDataFrame(list(rows), schema)
