"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry
from compare import canonical, oracle_rows
from roadpulse.plans.catalog import QUERIES
from roadpulse.plans.oracle import ORACLE

# Spark type names and the DuckDB types they must meet.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, small, name):
    frame = QUERIES[name](spark, small)
    names, rows, kinds = oracle_rows(small, ORACLE[name])
    assert {c: TYPES[t] for c, t in frame.dtypes} == dict(zip(names, kinds))
    got = canonical(frame.columns, frame.collect())
    want = canonical(names, rows)
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1], "an empty result checks nothing"


def test_entry(spark):
    assert entry(spark).count() > 0
