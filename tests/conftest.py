import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    from millstream.session import local_session

    session = local_session("tests", "*", 8)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def at():
    """Minute offsets as naive times."""

    def time(minutes: float) -> dt.datetime:
        return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)

    return time


def series(spark, rows, schema):
    return spark.createDataFrame(rows, schema)
