"""Every registered query equals its DuckDB oracle on the sf0.001 tables
(row count, column names, order-insensitive values)."""

import pytest

from tools.compare_oracle import digest, duck
from __spark_entry__ import entry
from tillroll.plans.oracle import ORACLE_SQL as PLAIN_SQL
from tillroll.plans.registry import QUERIES as PLAIN
from tillroll.plans.state_queries import STATE_ORACLE, STATE_QUERIES

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE_SQL = PLAIN | STATE_QUERIES, PLAIN_SQL | STATE_ORACLE


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLE_SQL[name])
    ocols = [c[0] for c in cur.description]
    orows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert digest(sdf.columns, srows)[0] == digest(ocols, orows)[0]


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, con, name):
    sdt = dict(QUERIES[name](spark, SF).dtypes)
    rel = con.sql(ORACLE_SQL[name])
    odt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in sdt.items()} == odt


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert df.columns[0] == "customer_id"
