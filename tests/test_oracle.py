"""Every registered query against its DuckDB oracle on the driver's small tables."""

import pytest

import __spark_entry__ as E
from newsarc.plans.queries import QUERIES as OWN
from newsarc.plans.compare import compare, duck

from conftest import SF_SMALL

QUERIES = {name: fn for name, fn in E.queries().items() if name in OWN}
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(OWN) and set(OWN) <= set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_SMALL), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["website_hash", "url", "origin", "rank"]
    assert df.count() > 0


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def test_column_types_match_oracle(spark, con):
    bad = {}
    for name, fn in QUERIES.items():
        spark_types = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
                       for f in fn(spark, SF_SMALL).schema.fields}
        rel = con.sql(ORACLE[name])
        duck_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        if spark_types != duck_types:
            bad[name] = (spark_types, duck_types)
    assert not bad, bad
