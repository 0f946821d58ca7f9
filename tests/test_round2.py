"""Loads into declared types, silent losses, repeated refreshes, null groups and mixed keys."""

import uuid

import pytest

from rosterflow.operators.aggregates import reconcile
from rosterflow.operators.columns import create_table_sql, guess_types, clean_columns, type_text_columns
from rosterflow.operators.matching import with_match_flag
from rosterflow.operators.rules import label_columns, prefix_labels
from rosterflow.plans.load import append_frame, publish_report, report_grid, upload_csv
from rosterflow.plans.refresh import refresh_report
from rosterflow.sources.delimited import read_caret, read_csv, write_import
from rosterflow.sources.folder import latest_drop
from rosterflow.sources.grid import frame_to_grid
from rosterflow.sources.paged_json import explode_pages
from rosterflow.sources.sql import read_sql_file
from rosterflow.streaming.landing import land_new_files


@pytest.fixture
def schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS round2")
    return "round2"


@pytest.fixture
def name():
    return f"t_{uuid.uuid4().hex}"


def write(folder, **files):
    import os

    for file, content in files.items():
        os.makedirs(f"{folder}/in", exist_ok=True)
        with open(f"{folder}/in/{file}.csv", "wb") as out:
            out.write(content if isinstance(content, bytes) else content.encode())
    return f"{folder}/in"


def test_upload_of_the_file_that_declared_the_table(spark, folder, schema, name):
    path = write(folder, a="id,as_of,note\n1,2024-02-01,x\n2,,\n")
    columns = guess_types(clean_columns(read_csv(spark, path)))
    assert columns["as_of"] == "DATE"
    spark.sql(create_table_sql(name, schema, columns={**columns, "left_out": "FLOAT"}))
    upload_csv(spark, path, f"{schema}.{name}")
    rows = sorted(map(tuple, spark.table(f"{schema}.{name}").selectExpr("id", "string(as_of)", "note", "left_out").collect()))
    assert rows == [(1, "2024-02-01", "x", None), (2, None, None, None)]


@pytest.mark.parametrize(
    ("kind", "good", "want", "bad"),
    [
        ("DATE", "2024-02-29", "2024-02-29", "2023-02-29"),
        ("TIMESTAMP WITHOUT TIME ZONE", "2024-01-02 03:04:05", "2024-01-02 03:04:05", "noon"),
        ("BOOLEAN", "true", "true", "maybe"),
        ("NUMERIC(6,2)", " 12.50 ", "12.50", "1234567.00"),
        ("INTEGER", "42", "42", "4.5"),
        ("FLOAT", "1.5", "1.5", "N/A"),
        ("VARIANT", '{"a":[1]}', '{"a":[1]}', "{"),
        ("ARRAY", '["a","b"]', '["a","b"]', "[1"),
    ],
)
def test_text_into_declared_types(spark, schema, name, kind, good, want, bad):
    spark.sql(create_table_sql(name, schema, columns={"v": kind, "k": "INTEGER"}))
    target = f"{schema}.{name}"
    append_frame(spark.createDataFrame([(good,), (None,), (" ",)], "V string"), target)
    shown = "to_json(v)" if kind in ("VARIANT", "ARRAY") else "string(v)"
    assert sorted(r[0] or "" for r in spark.table(target).selectExpr(shown).collect()) == ["", "", want]
    with pytest.raises(Exception, match="cannot hold|MALFORMED"):
        append_frame(spark.createDataFrame([(bad,)], "v string"), target)
    with pytest.raises(ValueError, match="lacks columns: other"):
        append_frame(spark.createDataFrame([("x",)], "other string"), target)


def test_headers_in_another_order(spark, folder, rows):
    path = write(folder, a="first,last\nKim,Bo\n", b="last,first\nBo,Kim\n")
    with pytest.raises(Exception):
        read_csv(spark, path, force_string=True).collect()
    assert rows(read_csv(spark, path, by_name=True), "first", "last") == [("Kim", "Bo")] * 2
    with pytest.raises(Exception):
        land_new_files(spark, path, "first STRING, last STRING", f"{folder}/out", f"{folder}/check")


def test_long_whole_numbers_stay_text(spark):
    ids = ["12345678901234567890123", "12345678901234567890124"]
    typed = type_text_columns(spark.createDataFrame([(i, "9223372036854775807") for i in ids], "a string, b string"))
    assert typed.dtypes == [("a", "string"), ("b", "bigint")]
    assert sorted(r[0] for r in typed.collect()) == ids


def test_characters_that_a_charset_lacks_are_refused(spark, folder):
    write_import(spark.createDataFrame([("é",)], "a string"), f"{folder}/good")
    with pytest.raises(Exception):
        write_import(spark.createDataFrame([("日本",)], "a string"), f"{folder}/bad")


def test_bytes_that_a_charset_lacks_are_refused(spark, folder):
    path = write(folder, a=b"a,b\ncaf\xe9,1\n")
    with pytest.raises(Exception, match="bytes that its charset lacks"):
        read_csv(spark, path, force_string=True).collect()
    assert read_csv(spark, path, force_string=True, keep_bad_bytes=True).count() == 1
    assert read_csv(spark, path, encoding="windows-1252").first()[0] == "café"
    with pytest.raises(Exception, match="bytes that its charset lacks"):
        read_caret(spark, path, ["a"]).collect()


def test_line_break_in_a_file_of_one_column(spark, folder):
    path = write(folder, a='v\n"a\nb"\nc\n')
    assert sorted(r[0] for r in read_csv(spark, path).collect()) == ["a\nb", "c"]


@pytest.mark.parametrize("body", [None, "", "null"])
def test_empty_pages_are_refused(spark, body):
    pages = spark.createDataFrame([(1, "[]"), (2, '[{"id": 1}]')], "`a.b` int, body string")
    assert [tuple(r) for r in explode_pages(pages, "body", "id BIGINT").collect()] == [(2, 1, 1)]
    with pytest.raises(Exception, match="null or empty|MALFORMED"):
        explode_pages(spark.createDataFrame([(3, body)], "`a.b` int, body string"), "body", "id BIGINT").collect()


def test_one_query_file_per_path(spark, folder):
    spark.createDataFrame([("SELECT 1 AS x",), ("SELECT 2 AS x",)], "value string").repartition(2).write.text(f"{folder}/q")
    with pytest.raises(ValueError, match="exactly one"):
        read_sql_file(spark, f"{folder}/q")


def test_latest_drop_below_a_folder_of_the_same_name(spark, folder):
    spark.range(1).write.csv(f"{folder}/in/main/in/p")
    assert latest_drop(spark, f"{folder}/in") == f"{folder}/in/main"


def test_grid_of_odd_column_names(spark):
    grid = frame_to_grid(spark.createDataFrame([(1, "x")], ["row_no", "a`b.c"]), "row_no")
    assert sorted(map(tuple, grid.collect())) == [(1, ["a`b.c"]), (2, ["x"])]


def test_reconcile_null_groups(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",)], "g string")
    found = reconcile({"t": df}, {"t": df}, ["g"])
    assert sorted(map(tuple, found.select("g", "expected_rows", "imported_rows", "status").collect()), key=repr) == [
        ("a", 1, 1, "ok"),
        (None, 2, 2, "ok"),
    ]
    assert "Join" not in found._jdf.queryExecution().toString()


def test_match_of_text_and_number_keys(spark, rows):
    left = spark.createDataFrame([("1",), ("N/A",), (None,)], "k string")
    right = spark.createDataFrame([(1, "x"), (2, "y")], "k bigint, v string")
    assert rows(with_match_flag(left, right, "k")) == sorted([("1", "x", True), ("N/A", None, False), (None, None, False)], key=repr)


def test_labels_replace_older_ones(spark):
    labels = {"red": [("M", "a", "b")]}
    df = prefix_labels(spark.createDataFrame([("Mx", "y")], "a string, b string"), labels)
    again = prefix_labels(df, labels)
    assert again.columns == ["a", "b", "a_label", "b_label"] and tuple(again.first()) == ("Mx", "y", "red", None)
    assert label_columns(["a", "b"], labels) == ["a_label", "b_label"]


def test_refresh_and_publish_every_day(spark, schema, name):
    report = f"{schema}.{name}"
    query = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id string, q string")
    first = spark.createDataFrame([("1", "a", "note 1"), ("2", "b", "")], "id string, q string, note string")
    publish_report(first, report)
    for _ in range(3):
        fresh = refresh_report(query, spark.table(report), "id", query_columns=2, sort_by=["id"], ascending=False, derived=["row_no", "q_label"])
        fresh = prefix_labels(fresh, {"red": [("a", "q", "q")]})
        publish_report(fresh, report, derived=["q_label"], row_no="row_no")
    got = sorted(spark.table(report).collect())
    assert [tuple(r)[1:] for r in got] == [("3", "c", "", None), ("2", "b", "", None), ("1", "a", "note 1", "red")]
    headers = spark.createDataFrame([(1, ["title"]), (2, ["id", "q"])], "row_no bigint, cells array<string>")
    grid = sorted(map(tuple, report_grid(spark.table(report), "row_no", headers).collect()))
    assert grid == [(1, ["title"]), (2, ["id", "q"]), (3, ["3", "c", "", ""]), (4, ["2", "b", "", ""]), (5, ["1", "a", "note 1", "red"])]
    with pytest.raises(ValueError, match="room for 3 columns"):
        publish_report(spark.table(report).selectExpr("*", "1 AS more"), report, derived=["q_label"], row_no="row_no")


def test_published_order_over_many_tasks(spark, schema, name):
    df = spark.range(20_000).selectExpr("id * 7919 % 20011 AS v").repartition(6).orderBy("v")
    report = f"{schema}.{name}"
    publish_report(df, report, row_no="row_no")
    values = [r[0] for r in spark.table(report).orderBy("row_no").select("v").collect()]
    assert values == sorted(values)
    headers = spark.createDataFrame([], "row_no bigint, cells array<string>")
    numbers = [r[0] for r in report_grid(spark.table(report), "row_no", headers).orderBy("row_no").collect()]
    assert numbers == list(range(1, 20_001))
