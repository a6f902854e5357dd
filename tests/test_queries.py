"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import difference

FOLDER = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, FOLDER)
    if name in ORACLES:
        assert difference(df, FOLDER, ORACLES[name]) is None
    else:
        assert df.count() >= 0
    spark.catalog.clearCache()


def test_entry(spark):
    rows = {r.stage: r for r in entry.entry(spark).collect()}
    assert set(rows) == {"stage0", "stage1", "transformed"}
    assert rows["transformed"].hits > 0
