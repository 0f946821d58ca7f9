"""Schemas found in JSON, sessions, and stored sketches."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from rosterflow.operators.temporal import with_sessions
from rosterflow.plans.sketches import current_sketches, distinct_estimates, store_sketches
from rosterflow.sources.json_columns import discover_schema, json_columns
from rosterflow.sources.paged_json import read_paged_json

START = dt.datetime(2024, 1, 1)


def frame(spark, *texts):
    return spark.createDataFrame([(i, t, "own") for i, t in enumerate(texts)], "id int, props string, a string")


def test_schema_merged_over_rows(spark):
    texts = ['{"a": 1, "B b": "x"}', '{"a": 2.5, "c": {"d": [1, 2]}}', '{"e": null, "f": 1}', '{"f": "text"}', None, '{"a`b": true, "OBJECT<": 1}']
    found = discover_schema(frame(spark, *texts), "props")
    kinds = {f.name: f.dataType.simpleString() for f in found.fields}
    assert kinds["B b"] == "string" and kinds["c"] == "struct<d:array<bigint>>" and kinds["f"] == "variant" and kinds["e"] == "string"
    assert kinds["a`b"] == "boolean" and kinds["OBJECT<"] == "bigint" and kinds["a"].startswith("decimal")
    typed = json_columns(frame(spark, *texts), "props")
    assert typed.columns[:2] == ["id", "a"] and "a_1" in typed.columns and "b_b" in typed.columns
    rows = {r["id"]: r for r in typed.withColumn("f", F.to_json(F.struct("f"))).collect()}
    assert [float(rows[i]["a_1"]) if rows[i]["a_1"] is not None else None for i in range(5)] == [1.0, 2.5, None, None, None]
    assert rows[1]["c"]["d"] == [1, 2] and json.loads(rows[3]["f"]) == {"f": "text"} and json.loads(rows[2]["f"]) == {"f": 1}


def test_malformed_texts(spark):
    docs = frame(spark, '{"a": 1}', '{"a": ', "[1]", "", None)
    kept = {r["id"]: (r["a_1"], r["bad"]) for r in json_columns(docs, "props", discover_schema(docs.filter("id = 0"), "props"), malformed="bad").collect()}
    assert kept[0] == (1, None) and kept[4] == (None, None) and kept[1][1] == '{"a": ' and kept[3][1] == ""
    with pytest.raises(Exception, match="holds no JSON object"):
        json_columns(docs, "props", discover_schema(docs.filter("id = 0"), "props")).collect()
    with pytest.raises(ValueError, match="holds no JSON objects"):
        json_columns(docs.filter("id > 5"), "props")


def test_pages_without_a_schema(spark, folder):
    for i, page in enumerate(['[{"id": 1, "n": "a"}, {"id": 2}]', "[]", '[{"id": 3, "tags": ["x"]}]'], start=1):
        spark.createDataFrame([(page,)], "value string").coalesce(1).write.mode("append").text(f"{folder}/pages/{i}")
    found = read_paged_json(spark, f"{folder}/pages/*", one_page_per_line=True)
    assert sorted((r["id"], r["n"], r["tags"]) for r in found.collect()) == [(1, "a", None), (2, None, None), (3, None, ["x"])]


@pytest.mark.parametrize("slice_seconds", [30, 100, 100_000])
def test_sessions_against_plain_python(spark, slice_seconds):
    r = random.Random(slice_seconds)
    rows = [(i, r.choice(["a", "hot", "hot", None]), r.choice([None] + [START + dt.timedelta(seconds=r.randrange(4000))] * 9)) for i in range(300)]
    found = with_sessions(spark.createDataFrame(rows, "id int, `k k` string, at timestamp_ntz"), ["k k"], "at", 20, "began", slice_seconds)
    want, seen = {i: None for i, *_ in rows}, {}
    for i, k, at in sorted((x for x in rows if x[1] and x[2]), key=lambda x: x[2]):
        last, began = seen.get(k, (None, None))
        began = began if last is not None and (at - last).total_seconds() <= 20 else at
        seen[k] = (at, began)
        want[i] = began
    assert found.columns == ["id", "k k", "at", "began"]
    assert {r["id"]: r["began"] for r in found.collect()} == want


def test_sketches_by_load(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS sketched")
    spark.sql("DROP TABLE IF EXISTS sketched.t")
    rows = spark.range(6000).select((F.col("id") % 2500).alias("v"), (F.col("id") % 3).alias("g"), F.expr("date '2024-01-01' + int(id % 5)").alias("day"))
    store_sketches(rows, "sketched.t", 1, "day", ["g"], "v")
    store_sketches(rows, "sketched.t", 1, "day", ["g"], "v")
    store_sketches(rows.filter("day = '2024-01-02'").limit(0), "sketched.t", 2, "day", ["g"], "v")
    assert current_sketches(spark.table("sketched.t")).count() == 15
    total = distinct_estimates(spark.table("sketched.t"), []).first()
    assert total["n_rows"] == 6000 and abs(total["estimate"] - 2500) <= 125
    store_sketches(rows.filter("day = '2024-01-02' AND v < 100"), "sketched.t", 3, "day", ["g"], "v")
    first = {r["load_day"].day: r for r in distinct_estimates(spark.table("sketched.t"), ["load_day"]).collect()}
    assert first[2]["n_rows"] == rows.filter("day = '2024-01-02' AND v < 100").count() and first[1]["n_rows"] == 1200
    with pytest.raises(Exception, match="has nulls"):
        store_sketches(rows.withColumn("day", F.lit(None).cast("date")), "sketched.t", 4, "day", ["g"], "v")
