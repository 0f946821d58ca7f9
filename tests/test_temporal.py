"""Joins over time against plain Python, and the streams."""

import datetime as dt
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import temporal
from rosterflow.operators.temporal import as_of_join, overlap_join
from rosterflow.plans.load import append_frame, reconcile_load
from rosterflow.streaming.newest import NewestRows
from rosterflow.streaming.windows import WindowedStream

START = dt.datetime(2024, 1, 1)


def moment(r, span):
    return START + dt.timedelta(seconds=r.randrange(span))


@pytest.mark.parametrize("other_than", [None, "kind"])
@pytest.mark.parametrize("slice_seconds", [50, 10_000])
def test_as_of_against_plain_python(spark, other_than, slice_seconds):
    r = random.Random(slice_seconds)

    def made(n):
        return [(i, r.choice(["a", "b", "hot", "hot", "hot", None]), r.choice([None, *[moment(r, 1000)] * 9]), r.choice(["x", "x", "x", "x", "y", None])) for i in range(n)]

    left, right = made(250), made(250)
    schema = "id long, `by key` string, at timestamp_ntz, kind string"
    found = as_of_join(
        spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["by key"], "at", "id", other_than, "p_", slice_seconds
    )
    want = []
    for row in left:
        partners = [
            p for p in right
            if row[1] is not None and row[2] is not None and p[1] == row[1] and p[2] is not None and p[2] < row[2] and (not other_than or p[3] != row[3])
        ]
        best = max(partners, key=lambda p: (p[2], p[0]), default=(None,) * 4)
        want.append((*row, best[0], best[2], best[3]))
    assert found.columns == ["id", "by key", "at", "kind", "p_id", "p_at", "p_kind"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


def test_as_of_pairs_nothing(spark):
    frame = spark.createDataFrame([(1, "a", START)], "id long, k string, at timestamp_ntz")
    plan = as_of_join(frame, frame, ["k"], "at", "id")._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert as_of_join(frame.limit(0), frame, ["k"], "at", "id").count() == 0
    assert tuple(as_of_join(frame, frame.limit(0), ["k"], "at", "id").first()) == (1, "a", START, None, None)


@pytest.mark.parametrize("bin_seconds", [7, 100, 100_000])
@pytest.mark.parametrize("by", [[], ["k"]])
def test_overlap_against_plain_python(spark, bin_seconds, by):
    r = random.Random(bin_seconds)

    def made(n, mark):
        rows = []
        for i in range(n):
            start = moment(r, 3000)
            length = r.choice([0, 0, 5, 40, 900, 3000, -5])
            rows.append((f"{mark}{i}", r.choice(["a", "b"]), r.choice([start] * 9 + [None]), start + dt.timedelta(seconds=length)))
        return rows

    left, right = made(90, "l"), made(90, "r")
    a = spark.createDataFrame(left, f"a string, {'k' if by else 'ka'} string, a_from timestamp_ntz, a_to timestamp_ntz")
    b = spark.createDataFrame(right, f"b string, {'k' if by else 'kb'} string, b_from timestamp_ntz, b_to timestamp_ntz")
    found = overlap_join(a, b, ("a_from", "a_to"), ("b_from", "b_to"), by, bin_seconds)
    want = [
        (x[0], y[0]) for x in left for y in right
        if x[2] and y[2] and x[2] <= x[3] and y[2] <= y[3] and x[2] <= y[3] and y[2] <= x[3] and (not by or x[1] == y[1])
    ]
    assert sorted(map(tuple, found.select("a", "b").collect())) == sorted(want)
    plan = found._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError, match="both sides have"):
        overlap_join(a, a, ("a_from", "a_to"), ("a_from", "a_to"))


def test_late_rows_are_kept_apart(spark, folder):
    def drop(*hours):
        rows = [(i, START + dt.timedelta(hours=h), "x") for i, h in enumerate(hours)]
        spark.createDataFrame(rows, "id long, at timestamp_ntz, k string").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    stream = WindowedStream(spark, f"{folder}/in", "id long, at timestamp_ntz, k string", folder, "at", ["k"], {"n": F.count(F.lit(1))}, "1 hour", "2 hours")
    drop(0.1, 0.2, 5.5)
    stream.run()
    assert stream.late_rows().count() == 0
    # The newest moment is 5:30, so windows that ended by 3:30 are closed: 0 and 1 o'clock are late, 3 o'clock is not.
    drop(0.3, 1.9, 3.1, 5.6)
    stream.run()
    stream.run()
    assert sorted(r["at"].hour for r in stream.late_rows().collect()) == [0, 1]
    got = {r["window_start"].hour: r["n"] for r in stream.windows().collect()}
    assert got == {0: 2, 3: 1, 5: 2}
    # A batch that is split again writes the same.
    batch = spark.read.parquet(f"{folder}/on_time/batch-1").unionByName(spark.read.parquet(f"{folder}/late/batch-1"))
    stream.split(spark.createDataFrame(batch.collect(), batch.schema), 1)
    assert stream.late_rows().count() == 2


def test_repeated_batches_change_nothing(spark, folder, rows):
    def batch(*found):
        return spark.createDataFrame([(k, START + dt.timedelta(hours=h), i) for k, h, i in found], "k string, at timestamp_ntz, id long")

    newest = NewestRows(spark, folder, ["k"], "at", "id")
    with pytest.raises(ValueError, match="no batch"):
        newest.rows()
    newest.upsert(batch(("a", 1, 1), ("a", 2, 2), ("b", 1, 3)), 0)
    newest.upsert(batch(("a", 1, 9), ("c", 1, 4), ("b", 1, 5)), 1)
    want = [("a", 2), ("b", 5), ("c", 4)]
    assert rows(newest.rows(), "k", "id") == want
    newest.upsert(batch(("a", 9, 99)), 1)
    newest.upsert(batch(("a", 9, 99)), 0)
    assert rows(newest.rows(), "k", "id") == want and newest.state() == (-1, [0, 1])
    newest.compact()
    newest.compact()
    assert rows(newest.rows(), "k", "id") == want and newest.state() == (1, [])
    newest.upsert(batch(("a", 9, 99)), 1)
    newest.upsert(batch(("a", 3, 6)), 2)
    assert rows(newest.rows(), "k", "id") == [("a", 6), ("b", 5), ("c", 4)] and newest.state() == (1, [2])


def test_load_counts_as_it_writes(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS counted")
    spark.sql("DROP TABLE IF EXISTS counted.t")
    frame = spark.range(1000).select("id", (F.col("id") % 7).alias("My Code"))
    seen = append_frame(frame, "counted.t", figures={"zero": F.count_if(F.col("my_code") == 0), "last": F.max("id")})
    assert seen == {"rows": 1000, "zero": 143, "last": 999}
    assert append_frame(frame.limit(0), "counted.t") == {"rows": 0}
    status = {r["figure"]: r["status"] for r in reconcile_load(spark, "counted.t", {"rows": 1000, "zero": 142, "none": 0}, {**seen, "none": 0}).collect()}
    assert status == {"rows": "ok", "zero": "mismatch", "none": "empty", "last": "mismatch"}


def test_overlapping_spans_meet_once(spark):
    """Long spans that begin together: pairs that the join tries are hardly more than those it finds, however many cells a span has."""
    r = random.Random(5)

    def made(mark):
        rows = [(i, START + dt.timedelta(days=r.randrange(400)), START + dt.timedelta(days=2000 + r.randrange(400))) for i in range(200)]
        return spark.createDataFrame(rows, f"{mark} long, {mark}_from timestamp_ntz, {mark}_to timestamp_ntz")

    found = overlap_join(made("a"), made("b"), ("a_from", "a_to"), ("b_from", "b_to"), bin_seconds=30 * 86_400)
    pairs = found.count()
    assert pairs == found.distinct().count() == 200 * 200
    plan = found._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Join Inner") == 1

    def joins(node):
        children = [node.children().apply(i) for i in range(node.children().size())]
        return [node] * (node.nodeName() == "Join") + [j for c in children for j in joins(c)]

    sides = [joins(plan)[0].left(), joins(plan)[0].right()]
    Dataset = spark._jvm.org.apache.spark.sql.classic.Dataset
    left, right = (type(found)(Dataset.ofRows(spark._jsparkSession, side), spark) for side in sides)
    keys = [c for c in ("_cell", "_part", "_level", "_bin") if c in left.columns]
    tried = left.groupBy(*keys).count().join(right.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys).agg(F.sum(F.col("count") * F.col("n"))).first()[0]
    assert tried < 1.5 * pairs


def test_full_cells_are_dealt(spark, folder):
    """However many rows a cell has, few right rows meet under one key, and written pairs take a fraction of a byte."""

    def made(mark, n):
        r = random.Random(n)
        rows = [(i * 7919 % 100_003, START + dt.timedelta(days=r.randrange(20)), START + dt.timedelta(days=2000 + r.randrange(300))) for i in range(n)]
        return spark.createDataFrame(rows, f"{mark} long, {mark}_from timestamp_ntz, {mark}_to timestamp_ntz")

    found = overlap_join(made("a", 500), made("b", 6000), ("a_from", "a_to"), ("b_from", "b_to"), bin_seconds=30 * 86_400).select("a", "b")
    found.write.parquet(f"{folder}/pairs")
    written = spark.read.parquet(f"{folder}/pairs")
    assert written.count() == written.distinct().count() == 500 * 6000
    assert sum(p.stat().st_size for p in Path(folder, "pairs").glob("*.parquet")) < 500 * 6000 * 0.5

    def join(node):
        return node if node.nodeName() == "Join" else join(node.children().apply(0))

    plan = join(found._jdf.queryExecution().optimizedPlan())
    assert plan.joinType().toString() == "Inner"
    right = type(found)(spark._jvm.org.apache.spark.sql.classic.Dataset.ofRows(spark._jsparkSession, plan.right()), spark)
    keys = [c for c in right.columns if c.startswith(("_cell", "_part"))]
    assert right.groupBy(*keys).count().agg(F.max("count")).first()[0] < 400


@pytest.mark.parametrize("blocks", [(5, 3), (1000, 3), (5, 1000), (1000, 1000)])
@pytest.mark.parametrize("most", [0, 100_000])
def test_dealt_cells_lose_and_repeat_nothing(spark, monkeypatch, blocks, most):
    monkeypatch.setattr(temporal, "BLOCKS", blocks)
    monkeypatch.setattr(temporal, "MOST_COUNTS", most)
    r = random.Random(blocks[0] + most)

    def made(mark):
        rows = [(i // 2, r.choice(["a", "a", "a", "b", None]), moment(r, 3000), r.choice([0, 40, 900, 3000, -5])) for i in range(120)]
        rows = [(i, k, r.choice([at] * 9 + [None]), at + dt.timedelta(seconds=s)) for i, k, at, s in rows]
        return rows, spark.createDataFrame(rows + rows[:9], f"{mark} long, `by key` string, {mark}_from timestamp_ntz, {mark}_to timestamp_ntz")

    (x, left), (y, right) = made("a"), made("b")
    found = overlap_join(left, right, ("a_from", "a_to"), ("b_from", "b_to"), ["by key"], 50)
    want = [
        (a[0], a[1], b[0]) for a in x + x[:9] for b in y + y[:9]
        if a[1] and a[1] == b[1] and a[2] and b[2] and a[2] <= a[3] and b[2] <= b[3] and a[2] <= b[3] and b[2] <= a[3]
    ]
    assert sorted(map(tuple, found.select("a", "by key", "b").collect())) == sorted(want)


def test_keys_of_two_types_meet(spark, monkeypatch):
    monkeypatch.setattr(temporal, "BLOCKS", (2, 2))
    a, b = (
        spark.range(20).select(
            F.col("id").alias(mark), (F.col("id") % 2).cast(kind).alias("k"), F.lit(START).alias(f"{mark}_from"), F.lit(START + dt.timedelta(9)).alias(f"{mark}_to")
        )
        for mark, kind in (("a", "int"), ("b", "bigint"))
    )
    assert overlap_join(a, b, ("a_from", "a_to"), ("b_from", "b_to"), ["k"]).count() == 200
