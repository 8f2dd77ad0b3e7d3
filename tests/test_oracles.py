"""Every registered query against its reference SQL on the smallest tables."""

import pytest

from checks.compare import differences, duck
from checks.oracles import ORACLES
from checks.queries import QUERIES
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_reference_sql(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name in ORACLES:
        found = differences(df, con, ORACLES[name])
        assert found.startswith("= "), found
    else:
        assert df.count() > 0


def test_every_oracle_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)
