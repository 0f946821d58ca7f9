"""Stored reports: a refresh of changed parts gives what a full refresh gives, and leaves other parts alone."""

import random
import uuid

import pytest

from rosterflow.plans.incremental import KEY, PART, changed_parts, refresh_stored, store_report, stored_report, with_stored_notes
from rosterflow.plans.refresh import refresh_report


@pytest.fixture(scope="module")
def schema(spark):
    name = f"stored_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


def files(spark, table):
    rows = spark.table(table).selectExpr(PART, "_metadata.file_path AS f").distinct().collect()
    found = {}
    for part, file in rows:
        found.setdefault(part, set()).add(file)
    return found


COLUMNS = "id string, name string, note string, more string"


def report(spark, r, n=120):
    rows = [(r.choice([str(i), str(i), "", "Not Assigned Yet"]) if i % 5 == 0 else str(i), f"n{i}", r.choice(["", "a", "b"]), r.choice(["", "x"])) for i in range(n)]
    return spark.createDataFrame(rows + [("7", "n7", "other", ""), ("7", "twice", "", "")], COLUMNS)


@pytest.mark.parametrize("seed", range(2))
def test_same_as_a_full_refresh(spark, rows, schema, seed):
    r = random.Random(seed)
    table = f"{schema}.r{seed}"
    store_report(report(spark, r), table, "id", 2, parts=8)
    assert rows(stored_report(spark, table)) == rows(report(spark, random.Random(seed)).fillna(""))
    for step in range(3):
        query = [(str(i) if i % 11 else r.choice(["", "Not Assigned Yet"]), f"n{i}" + ("!" if r.random() < 0.02 else "")) for i in range(130) if r.random() > 0.05]
        query = spark.createDataFrame(query + query[:3], "id string, name string")
        want = rows(refresh_report(query, spark.createDataFrame(stored_report(spark, table).collect(), COLUMNS), "id", query_columns=2))
        refresh_stored(query, table)
        assert rows(stored_report(spark, table)) == want
        assert refresh_stored(query, table) == []


def test_only_changed_parts_are_written(spark, rows, schema):
    table = f"{schema}.parts"
    base = spark.createDataFrame([(str(i), f"n{i}", f"note {i}", "") for i in range(200)], COLUMNS)
    store_report(base, table, "id", 2, parts=8)
    before = files(spark, table)
    query = spark.createDataFrame([(str(i), "changed" if i == 3 else f"n{i}") for i in range(200)], "id string, name string")
    changed = refresh_stored(query, table)
    after = files(spark, table)
    assert len(changed) == 1 and {p for p in before if before[p] != after[p]} == set(changed)
    assert rows(stored_report(spark, table).filter("id = '3'")) == [("3", "changed", "note 3", "")]
    # A note that someone edited stays, without a write.
    spark.sql(f"INSERT INTO {table} SELECT 'x', 'y', 'z', '', '{chr(0)}1', 1L, 2L, 0")
    assert refresh_stored(query, table) == [0]
    with pytest.raises(ValueError, match="was stored for the columns"):
        refresh_stored(query.select("name", "id"), table)
    with pytest.raises(ValueError, match="exists"):
        store_report(base, table, "id", 2)


def test_a_part_whose_rows_left_is_emptied(spark, rows, schema):
    table = f"{schema}.gone"
    store_report(spark.createDataFrame([(str(i), "n", "", "") for i in range(40)], COLUMNS), table, "id", 2, parts=8)
    refresh_stored(spark.createDataFrame([("1", "n")], "id string, name string"), table)
    assert rows(stored_report(spark, table)) == [("1", "n", "", "")]
    refresh_stored(spark.createDataFrame([], "id string, name string"), table)
    assert stored_report(spark, table).count() == 0
    refresh_stored(spark.createDataFrame([("1", "n")], "id string, name string"), table)
    assert rows(stored_report(spark, table)) == [("1", "n", "", "")]


def test_stored_rows_are_not_dealt_out_again(spark, schema):
    table = f"{schema}.plan"
    store_report(spark.createDataFrame([(str(i), "n", "", "") for i in range(40)], COLUMNS), table, "id", 2, parts=4)
    stored = spark.table(table)
    fresh = stored.drop("note", "more").repartition(3)
    plan = with_stored_notes(fresh, stored, ["note", "more"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert changed_parts(fresh, stored, ["note", "more"]) == [] and KEY in stored.columns
