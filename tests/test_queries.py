"""Every registered query with SQL against DuckDB on the smallest tables."""

import oracle
import pytest

SF = "/root/testdata/sf0.001"


def names():
    from socigrain.plans import catalog

    return sorted(catalog.SQL)


@pytest.fixture(scope="module")
def duck():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", names())
def test_query_equals_sql(spark, duck, name):
    from socigrain.plans import catalog

    message = oracle.compare(catalog.QUERIES[name](spark, SF), duck, catalog.SQL[name])
    assert message in ("", "EMPTY")


def test_entry_points():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
