import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from checks.compare import local_session  # noqa: E402
from tickloom.session import prepare  # noqa: E402

SMALL = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_ticks(spark):
    """Ticks from (seconds, benchmark, price, volume) rows, in arrival order."""

    def make(rows):
        data = [
            (i, START + timedelta(seconds=row[0]), row[1], "X", float(row[2]), float(row[3]) if len(row) > 3 else 1.0)
            for i, row in enumerate(rows)
        ]
        columns = "event_id long, time timestamp_ntz, benchmark string, exchange string, price double, volume double"
        return spark.createDataFrame(data, columns)

    return make
