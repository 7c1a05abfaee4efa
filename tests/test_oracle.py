"""Every query against its SQL in another engine, at the smallest scale."""

import pytest

from checks.compare import difference, oracle
from checks.oracles import ORACLES
from checks.queries import QUERIES
from support import SF


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    found = QUERIES[name](spark, SF).toPandas()
    assert len(found)
    assert difference(found, db.execute(ORACLES[name]).df()) is None


def test_entry(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).count() > 0
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_results_do_not_depend_on_the_session_zone(spark, db, with_conf):
    with_conf(spark__sql__session__timeZone="America/New_York")
    for name in ("silver_expense", "parse_lenient", "timestamp_zone", "fact_keys"):
        found = QUERIES[name](spark, SF).toPandas()
        assert difference(found, db.execute(ORACLES[name]).df()) is None, name
