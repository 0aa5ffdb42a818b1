import pytest
from compare import compare

from quillspan.plans.oracle import ORACLES
from quillspan.plans.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    compare(spark, QUERIES[name], ORACLES[name], SMALL)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_without_sql_run(spark):
    assert {r.invalid for r in QUERIES["heading_paths"](spark, SMALL).collect()} == {True, False}
    assert QUERIES["worldview_json"](spark, SMALL).filter("worldview is null").count() == 0
