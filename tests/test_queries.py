"""Every registered query against its SQL, and the shape of its plan."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from __spark_entry__ import entry  # noqa: E402
from rosterflow.registry import CHECKS, QUERIES  # noqa: E402
from tools.check_queries import TABLES, canonical  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = df.toPandas()
    want = duck.sql(CHECKS[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert canonical(got) == canonical(want)
    plan = df._jdf.queryExecution().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas"):
        assert unwanted not in plan


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    assert entry(spark).count() > 0
