"""Every query against its SQL on the same parquet tables."""

import math
import os
from datetime import datetime
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from fairlead.plans.queries import QUERIES


@pytest.fixture(scope="module")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    connection.sql(f"CREATE VIEW events AS SELECT * FROM '{Path(sf_dir) / 'events.parquet'}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = []
    for row in rows:
        values = []
        for i in order:
            value = row[i]
            if isinstance(value, float):
                value = "nan" if math.isnan(value) else repr(value)
            elif isinstance(value, datetime):
                value = value.isoformat()
            values.append(value)
        out.append(tuple(values))
    return [columns[i] for i in order], sorted(out, key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, db, sf_dir, name):
    frame = entry_points.queries()[name](spark, sf_dir)
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    relation = db.sql(entry_points.oracle_sql()[name])
    want = canonical(relation.columns, relation.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "a query without rows proves nothing"


def test_entry(spark):
    assert entry_points.entry(spark).count() == 569
