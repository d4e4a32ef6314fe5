"""Every query that SQL can express against its SQL, on the same parquet tables."""

import os
from pathlib import Path

import duckdb
import pytest
from fairlead.llm.oracles import ORACLES
from fairlead.llm.queries import QUERIES
from tests.test_queries import canonical


@pytest.fixture(scope="module")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "labels", "conversations"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf_dir) / name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(llm_spark, db, sf_dir, name):
    frame = QUERIES[name](llm_spark, sf_dir)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    relation = db.sql(ORACLES[name])
    want = canonical(relation.columns, relation.fetchall())
    assert got[0] == want[0] and len(got[1]) == len(want[1])
    assert got[1] == want[1] and got[1]


def test_oracles_are_of_queries():
    assert set(ORACLES) <= set(QUERIES)
