"""Every query of the engine against its SQL on the smallest tables."""

import pytest

from tests.parity import connect, same
from tidewright.queries import ORACLES, QUERIES

WHERE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(WHERE)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, con, name):
    same(QUERIES[name](spark, WHERE), con, ORACLES[name])


def test_every_query_has_sql_or_a_stated_reason():
    assert set(QUERIES) - set(ORACLES) == {"pagerank_converged", "seeded_sample"}


def test_seeded_sample_repeats(spark):
    a, b = (sorted(map(tuple, QUERIES["seeded_sample"](spark, WHERE).collect())) for _ in range(2))
    assert a == b and len(a) == 20
