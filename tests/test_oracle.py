"""Every query with an oracle, Spark vs DuckDB, on the smallest test data;
the driver contract (entry / queries / oracle_sql)."""

import pytest

import __spark_entry__ as E
from harness import SF_SMALL
from harness import compare, duck

ORACLE = E.oracle_sql()
QUERIES = E.queries()


def test_contract_keys(spark):
    assert set(ORACLE) <= set(QUERIES)
    df = E.entry(spark)
    assert df.count() > 0 and "customer_id" in df.columns


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


# Spark simple type -> DuckDB type name
TYPE_MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    duck_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    for f in df.schema.fields:
        t = f.dataType.simpleString()
        assert TYPE_MAP.get(t, t) == duck_types.get(f.name), (f.name, t, duck_types.get(f.name))
    ok, msg = compare(df.toPandas(), rel.df())
    assert ok, msg
