import pytest

from checks.compare import difference, duck
from checks.queries import ORACLE, QUERIES
from tests.conftest import SF


@pytest.fixture(scope="module")
def connection():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, connection, name):
    assert difference(QUERIES[name](spark, SF).toPandas(), connection.execute(ORACLE[name]).df()) is None


@pytest.mark.parametrize("name", ["eda_report_lines", "run_report_lines"])
def test_reports_have_lines(spark, name):
    assert QUERIES[name](spark, SF).count() > 50


def test_entry_contract():
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert callable(contract.entry)
