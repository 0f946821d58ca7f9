import datetime
import random

import pytest
from pyspark.sql import functions as F

from rosterflow.operators import ordering
from rosterflow.operators.aggregates import (
    count_findings,
    last_value,
    max_per_group,
    reconcile,
    require_reconciled,
    require_rows,
    row_count,
)
from rosterflow.operators.columns import (
    all_strings,
    clean_columns,
    create_table_sql,
    drop_column,
    first_columns,
    guess_types,
    keep_right_of,
    rename_present,
    spark_type,
    type_text_columns,
)
from rosterflow.operators.latest import latest_record, latest_rows
from rosterflow.operators.matching import fallback_match, is_newly_listed, split_matches, with_match_flag
from rosterflow.operators.ordering import distinct_rows, row_range, sort_rows, union_by_name
from rosterflow.operators.rules import add_formulas, count_violations, prefix_labels, rule_violations


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Matching


def test_match_flag_fans_out_and_keeps_left_values(spark, rows):
    left = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    right = spark.createDataFrame([("a", 9, "x"), ("a", 9, "y"), (None, 9, "z")], "k string, v int, w string")
    assert rows(with_match_flag(left, right, "k")) == sorted(
        [("a", 1, "x", True), ("a", 1, "y", True), ("b", 2, None, False), (None, 3, None, False)], key=repr
    )
    assert (None, 3, "z", True) in rows(with_match_flag(left, right, ["k"], "hit", null_keys_match=True))
    pairs = spark.createDataFrame([("a", 1, "p"), (None, 3, "q"), ("b", None, "r")], "k string, v long, w string")
    assert rows(with_match_flag(left, pairs, ["k", "v"]), "k", "v", "w", "matched") == sorted(
        [("a", 1, "p", True), ("b", 2, None, False), (None, 3, None, False)], key=repr
    )
    assert (None, 3, "q", True) in rows(with_match_flag(left, pairs, ["k", "v"], null_keys_match=True))


def test_match_flag_with_odd_names(spark, rows):
    left = spark.createDataFrame([("a", 1)], ["Student No.", "x`y"])
    right = spark.createDataFrame([("a", "n")], ["Student No.", "My Note."])
    assert rows(with_match_flag(left, right, "Student No.")) == [("a", 1, "n", True)]


def test_split_matches(spark, rows):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([(1, "x"), (1, "y"), (None, "z")], "k int, w string")
    matched, unmatched = split_matches(left, right, "k")
    assert rows(matched) == [(1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (1, "b", "y")]
    assert rows(unmatched) == sorted([(2, "c"), (None, "d")], key=repr)


def test_fallback_match_holds_no_side_whole(spark, folder):
    """The files of the right side are smaller than the size below which Spark broadcasts; its keys are not held by every task all the same."""
    spark.range(200_000).selectExpr("id AS k", "id + 7 AS j", "'same' AS w").write.parquet(folder + "/right")
    left = spark.range(300_000).selectExpr("CASE WHEN id % 3 > 0 THEN id END AS k", "id AS j", "id AS v")
    found = fallback_match(left, spark.read.parquet(folder + "/right"), ["k", "j"], "on")
    assert "Broadcast" not in plan_of(found)
    got = found.groupBy("on").agg(F.count(F.lit(1)).alias("n")).collect()
    by_key = sum(1 for i in range(200_000) if i % 3)
    by_next = sum(1 for i in range(7, 200_007) if not (i % 3 and i < 200_000))
    assert {r["on"]: r["n"] for r in got} == {"k": by_key, "j": by_next, None: 300_000 - by_key - by_next}


@pytest.mark.parametrize("broadcast", [True, False])
def test_fallback_match_against_brute_force(spark, rows, broadcast):
    pick = random.Random(3)
    value = lambda: pick.choice([None, None, "hot", "hot", "hot", "a", "b", "c", "d"])
    left = [(i, value(), value()) for i in range(80)]
    right = [(value(), value(), i) for i in range(25)]
    wanted = []
    for i, first, second in left:
        hits = [(w, "first") for a, _, w in right if a is not None and a == first]
        hits = hits or [(w, "second") for _, b, w in right if b is not None and b == second]
        wanted += [(i, first, second, w, on) for w, on in hits or [(None, None)]]
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    try:
        got = fallback_match(
            spark.createDataFrame(left, "i int, first string, second string"),
            spark.createDataFrame(right, "first string, second string, w int"),
            ["first", "second"],
            "on",
        )
        assert rows(got) == sorted(wanted, key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_newly_listed(spark):
    df = spark.createDataFrame([("1", "N/A"), ("x", "N/A"), ("1", "5"), (None, "N/A")], "p string, s string")
    got = [tuple(r) for r in df.select(is_newly_listed(F.col("p"), F.col("s")), is_newly_listed(F.col("p"))).collect()]
    assert got == [(True, True), (False, False), (False, True), (False, False)]


# Columns


def test_clean_columns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["Name", "name!", "2nd", ""])
    assert clean_columns(df).columns == ["name", "name_", "_2nd", "no_col_name_or_merged_column_header"]
    same = spark.createDataFrame([(1, 2, 3)], ["A B", "a-b", "a_b_1"])
    assert clean_columns(same).columns == ["a_b", "a_b_1", "a_b_1_1"]


def test_guess_types_and_ddl(spark):
    df = spark.sql(
        "SELECT 1 AS i, 1L AS l, 1.5D AS d, 'x' AS s, true AS b, DATE'2024-01-01' AS day, TIMESTAMP_NTZ'2024-01-01' AS t, "
        "CAST(1 AS DECIMAL(7,2)) AS n, array('a') AS r, parse_json('1') AS v, 'x' AS As_Of"
    )
    assert guess_types(df) == {
        "i": "INTEGER", "l": "INTEGER", "d": "FLOAT", "s": "VARCHAR", "b": "BOOLEAN", "day": "DATE",
        "t": "TIMESTAMP WITHOUT TIME ZONE", "n": "NUMERIC(7,2)", "r": "ARRAY", "v": "VARIANT", "as_of": "DATE",
    }
    with pytest.raises(TypeError, match="no declared type"):
        guess_types(spark.sql("SELECT map('a', 1) AS m"))
    assert [spark_type(t) for t in ("INTEGER", "varchar", "NUMERIC(7,2)", "ARRAY<INT>", "FLOAT", "VARCHAR(5)")] == [
        "BIGINT", "STRING", "DECIMAL(7,2)", "ARRAY<INT>", "DOUBLE", "VARCHAR(5)",
    ]


def test_create_table(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS ddl")
    data = spark.createDataFrame([(1, "x", "2024")], "`Student No.` int, `a``b` string, as_of string")
    spark.sql(create_table_sql("made", "ddl", "it's a \"table\" \\ of things", data=data))
    assert spark.table("ddl.made").dtypes == [("student_no_", "bigint"), ("a_b", "string"), ("as_of", "date")]
    comment = [r.data_type for r in spark.sql("DESCRIBE TABLE EXTENDED ddl.made").collect() if r.col_name == "Comment"]
    assert comment == ["it's a \"table\" \\ of things"]
    spark.sql(create_table_sql("texts", "ddl", data=data, force_string=True))
    assert {t for n, t in spark.table("ddl.texts").dtypes if n != "as_of"} == {"string"}
    spark.sql(create_table_sql("given", "ddl", columns={"A b": "NUMERIC(9,3)", "v": "VARIANT"}))
    assert spark.table("ddl.given").dtypes == [("A b", "decimal(9,3)"), ("v", "variant")]
    with pytest.raises(ValueError):
        create_table_sql("nothing", "ddl")


def test_column_selection(spark, rows):
    df = spark.createDataFrame([(1, 2, 3, 4)], ["id", "b", "c.d", "e"])
    assert keep_right_of(df, ["id"], 2).columns == ["id", "c.d", "e"]
    assert first_columns(df, 2).columns == ["id", "b"]
    assert rename_present(df, {"b": "bb", "zz": "y"}).columns == ["id", "bb", "c.d", "e"]
    assert drop_column(df, "e").columns == ["id", "b", "c.d"]
    with pytest.raises(ValueError):
        drop_column(df, "zz")
    assert rows(all_strings(spark.createDataFrame([(1, None)], "a int, b int"))) == [("1", None)]


def test_type_text_columns(spark):
    df = spark.createDataFrame(
        [("1", "1.5", "x", "", "9" * 25, "007", 1), ("-2", " 3 ", "1", None, "1", "8", 2)],
        "i string, d string, s string, e string, big string, z string, n int",
    )
    typed = type_text_columns(df)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "string", "string", "string", "bigint", "int"]
    assert [tuple(r)[:2] for r in typed.collect()] == [(1, 1.5), (-2, 3.0)]


# Order


def test_sort_rows(spark):
    df = spark.createDataFrame([(1, "b"), (None, "a"), (2, "a"), (2, "b")], "x int, y string")
    up = [tuple(r) for r in sort_rows(df, ["x", "y"], [False, True]).collect()]
    assert up == [(2, "a"), (2, "b"), (1, "b"), (None, "a")]
    assert [r.x for r in sort_rows(df, ["x"]).collect()] == [1, 2, 2, None]
    with pytest.raises(ValueError):
        sort_rows(df, ["x", "y"], [True])


def test_sort_splits_a_frequent_value(spark):
    df = spark.range(0, 200_000, 1, 8).select(F.lit("same").alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sort_rows(df, ["k"]).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 4 and max(r["count"] for r in sizes) < 100_000


@pytest.mark.parametrize("small", [10, 1_000_000])
@pytest.mark.parametrize("kind", ["bigint", "string", "timestamp_ntz", "timestamp"])
def test_row_range(spark, monkeypatch, small, kind):
    monkeypatch.setattr(ordering, "SMALL_RANGE", small)
    monkeypatch.setattr(ordering, "CUTS", 8)
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    key = {
        "bigint": "id * 37 % 1009",
        "string": "lpad(cast(id * 37 % 1009 as string), 5, '0')",
        "timestamp_ntz": "timestamp_ntz '2024-11-03' + make_dt_interval(0, 0, id * 37 % 1009)",
        "timestamp": "timestamp '2024-11-03' + make_dt_interval(0, 0, id * 37 % 1009)",
    }[kind]
    df = spark.range(1009).selectExpr(f"{key} AS k", "id * 37 % 1009 AS place")
    try:
        for start, end in ((0, None), (0, 10), (100, 300), (999, 1009), (1008, 2000), (5, 5), (1009, None)):
            got = sorted(r.place for r in row_range(df, "k", start, end).collect())
            assert got == list(range(1009))[start:end], (start, end)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_row_range_checks_its_key(spark, monkeypatch):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k int")
    with pytest.raises(ValueError, match="not unique"):
        row_range(df, "k", 2)
    with pytest.raises(ValueError, match="not unique"):
        row_range(df, "k", 1)
    with pytest.raises(ValueError, match="nulls"):
        row_range(spark.createDataFrame([(1,), (None,)], "k int"), "k", 1)
    with pytest.raises(ValueError):
        row_range(df, "k", 3, 2)
    monkeypatch.setattr(ordering, "SMALL_RANGE", 10)
    hot = spark.range(100).selectExpr("if(id < 60, 7, id) AS k")
    with pytest.raises(ValueError, match="not unique"):
        row_range(hot, "k", 30)


@pytest.mark.parametrize("most", [2_000_000, 3])
def test_row_range_by_a_sketch(spark, monkeypatch, most):
    monkeypatch.setattr(ordering, "STEPS", 64)
    monkeypatch.setattr(ordering, "MOST_KEYS", most)
    df = spark.range(5000).selectExpr("id * 3 + 9007199254740993 AS k", "cast(id as double) / 7 AS d", "date '2000-01-01' + int(id) AS day", "cast(id as decimal(20,2)) AS m")
    for key in df.columns:
        ordered = [r[0] for r in df.select(key).orderBy(key).collect()]
        for start, end in ((10, 4321), (0, 2500), (2500, 2501), (4999, 9000), (6000, 7000)):
            assert sorted(r[0] for r in row_range(df, key, start, end).select(key).collect()) == ordered[start:end], (key, start, end)


def test_row_range_takes_two_scans(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id AS k")
    jobs, real = [], type(df).first
    monkeypatch.setattr(type(df), "first", lambda self: (jobs.append(1), real(self))[1])
    monkeypatch.setattr(ordering, "_key_at", lambda *_: pytest.fail("another scan"))
    assert ordering._keys_at(df, "k", [100, 2000]) == [100, 2000] and len(jobs) == 2


def test_row_range_filter_reaches_the_scan(spark, folder):
    spark.range(100).write.parquet(folder + "/t")
    plan = plan_of(row_range(spark.read.parquet(folder + "/t"), "id", 10, 20))
    assert "GreaterThanOrEqual(id,10)" in plan and "LessThan(id,20)" in plan and "Exchange" not in plan


def test_union_and_distinct(spark, rows):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(union_by_name(a, b)) == sorted([(1, "x", None), (None, "y", 2.0)], key=repr)
    assert rows(distinct_rows(union_by_name(a, a))) == [(1, "x")]


# Newest rows and figures


def test_latest_rows_keep_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 2023, "x"), ("a", 1, 2024, "y"), ("a", 1, 2024, "z"), ("a", 2, 2020, "w"), ("b", 1, None, "n"), (None, 1, 5, "k")],
        "e string, t int, y int, v string",
    )
    assert rows(latest_rows(df, ["e", "t"], "y"), "v") == [("k",), ("w",), ("y",), ("z",)]
    plan = plan_of(latest_rows(df, ["e", "t"], "y"))
    assert "Window" not in plan and "NestedLoop" not in plan


def test_latest_record_limits_before_the_shuffle(spark, rows):
    day = datetime.datetime
    df = spark.createDataFrame(
        [("a", day(2024, 1, 1), 1), ("a", day(2024, 1, 2), 2), ("a", day(2024, 1, 2), 3), ("b", None, 4)],
        "k string, at timestamp, id int",
    )
    assert rows(latest_record(df, ["k"], "at", "id"), "k", "id") == [("a", 3), ("b", 4)]
    plan = plan_of(latest_record(df, ["k"], "at", "id"))
    assert "Partial" in plan[plan.index("Exchange") :] and "WindowGroupLimit" in plan[plan.index("Exchange") :]


def test_figures(spark, rows):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 20), ("b", 2, None)], "k string, seq int, v int")
    assert rows(max_per_group(df, ["k"], "seq", "last")) == [("a", 3), ("b", 2)]
    assert rows(last_value(df, "v", "seq")) == [(20,)]
    assert rows(last_value(df, "v", "seq", ["k"])) == sorted([("a", 20), ("b", None)], key=repr)
    assert rows(row_count(df)) == [(3,)]
    with pytest.raises(Exception, match="upload: no row where at least one is needed"):
        row_count(df.filter("seq > 9"), "upload").collect()
    assert require_rows(df) is df
    with pytest.raises(ValueError, match="no row where at least one is needed"):
        require_rows(df.filter("seq > 9"))


def test_reconcile(spark, rows):
    frames = {n: spark.range(n) for n in (0, 3, 1500)}
    table = reconcile(
        {"good": frames[1500], "bad": frames[3], "none": frames[0], "lost": frames[3]},
        {"good": frames[1500], "bad": frames[0], "none": frames[0]},
    )
    assert rows(table) == [
        ("bad", 3, 0, "mismatch", "Imported: 0"),
        ("good", 1500, 1500, "ok", "Imported: 1,500"),
        ("lost", 3, 0, "mismatch", "Imported: 0"),
        ("none", 0, 0, "empty", "Imported: 0"),
    ]
    with pytest.raises(ValueError, match="expected"):
        require_reconciled(table)
    fine = reconcile({"good": frames[3]}, {"good": frames[3]})
    assert require_reconciled(fine) is fine


def test_findings(spark, rows):
    a = spark.createDataFrame([("E1", "View"), ("E2", "View")], "code string, record string")
    b = spark.createDataFrame([("E1", 5)], "code string, n int")
    assert rows(count_findings([a, b], "code", ["record"])) == [("E1", 2), ("E2", 1)]


# Rules


def test_rules(spark, rows):
    df = spark.createDataFrame([(1, "True", 5), (2, "maybe", 7), (3, "", 5), (4, None, None)], "id int, a string, b int")
    rules = [("a", ["nothing"]), ("b", [5]), ("a", ["True", "False"])]
    assert rows(rule_violations(df, rules, ["id"])) == [(2, "a", "maybe"), (2, "b", "7")]
    assert rows(count_violations(df, rules)) == [("a", "maybe", 1), ("b", "7", 1)]


def test_prefix_labels_first_rule_wins(spark, rows):
    df = spark.createDataFrame([("Done", "Do", "x"), ("x", None, "Done")], "a string, b string, c string")
    labels = {"green": [("Done", "a", "b")], "red": [("Do", "a", "b"), ("x", "a", "a")]}
    got = prefix_labels(df, labels)
    assert got.columns == ["a", "b", "c", "a_label", "b_label"]
    assert rows(got, "a_label", "b_label") == sorted([("green", "red"), ("red", None)], key=repr)


def test_formulas_chain(spark, rows):
    got = add_formulas(spark.createDataFrame([(1, 2)], "a int, b int"), {"c": "a + b", "a": "c * 10"})
    assert rows(got) == [(30, 2, 3)]


# Skew


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


@pytest.fixture
def shuffled_joins(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_a_hot_key_is_split(spark, shuffled_joins):
    left = spark.range(200_000).selectExpr("if(id % 3 = 0, -1L, id) AS k", "sha2(cast(id AS string), 256) AS v")
    right = spark.range(-2, 1000).selectExpr("id AS k", "id * 2 AS w")
    matched, unmatched = split_matches(left, right, "k")
    assert "skew=true" in final_plan(matched)
    assert "skew=true" in final_plan(unmatched.select("k", F.length("v")))
    looked_up = final_plan(fallback_match(left, right, ["k"]).select("k", "w", F.length("v")))
    assert looked_up.count("skew=true") == 2
    assert final_plan(with_match_flag(left, right, "k").select("k", "w", F.length("v"))).count("skew=true") == 2
    turned = with_match_flag(right, left, "k").select("k", "w", F.length("v"))
    assert "skew=true" in final_plan(turned)


def test_rows_without_a_key_are_spread(spark, shuffled_joins):
    left = spark.range(100_000).selectExpr("if(id % 3 = 0, NULL, id) AS k", "id AS v")
    got = fallback_match(left, spark.range(5).selectExpr("id AS k", "id AS w"), ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 100_000 and max(sizes) < 20_000
