import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from rosterflow.plans.load import append_frame, upload_csv, upload_grid
from rosterflow.session import scratch_path
from rosterflow.sources import delimited
from rosterflow.sources.folder import latest_drop, list_drops
from rosterflow.sources.grid import frame_to_grid, grid_to_frame
from rosterflow.sources.paged_json import explode_pages, read_paged_json
from rosterflow.sources.sql import SchemaTables, describe, execute, read_sql, read_sql_file, read_sql_files, read_table
from rosterflow.streaming.landing import land_new_files


def written(folder):
    """Contents of the non-empty part files."""
    parts = [Path(folder, f).read_bytes() for f in sorted(os.listdir(folder)) if f.startswith("part-")]
    return [p for p in parts if p]


# SQL


def test_sql_parameters_cannot_change_the_query(spark, rows):
    sql = "SELECT id FROM IDENTIFIER(:t) WHERE cast(id AS string) = :x"
    spark.range(3).createOrReplaceTempView("numbers")
    assert rows(read_sql(spark, sql, {"t": "numbers", "x": "1"})) == [(1,)]
    assert rows(read_sql(spark, sql, {"t": "numbers", "x": "1' OR '1' = '1"})) == []


def test_sql_files(spark, folder, rows):
    Path(folder, "a.sql").write_text("SELECT {n} AS a,\n  '{{x}}' AS b")
    Path(folder, "b.sql").write_text("SELECT '{x}' AS b, CAST(NULL AS INT) AS c")
    assert rows(read_sql_file(spark, f"{folder}/a.sql", {"n": 5})) == [(5, "{x}")]
    both = read_sql_files(
        spark, [{"path": f"{folder}/a.sql", "parameters": {"n": 5}}, {"path": f"{folder}/b.sql", "parameters": {}}]
    )
    assert both.columns == ["a", "b", "c"]
    assert rows(both) == [("", "{x}", ""), ("5", "{x}", "")]


def test_tables(spark, rows):
    execute(spark, "CREATE SCHEMA IF NOT EXISTS shop")
    spark.range(2).write.mode("overwrite").saveAsTable("shop.items")
    execute(spark, "CREATE OR REPLACE VIEW shop.shown AS SELECT id + 1 AS id FROM shop.items")
    shop = SchemaTables(spark, "shop")
    assert {"items", "shown"} <= set(dir(shop))
    assert rows(shop.shown) == [(1,), (2,)]
    assert rows(read_table(spark, "items", "shop")) == rows(read_table(spark, "shop.items", "ignored")) == [(0,), (1,)]
    with pytest.raises(AttributeError):
        _ = shop.nothing
    assert rows(describe(shop.items)) == [(1, "id", "bigint")]
    execute(spark, "DROP TABLE shop.items")
    assert "items" not in dir(shop)


# Delimited files


def test_csv_types(spark, folder):
    Path(folder, "t.csv").write_text('id,score,flag,day,name,blank\n1,1.5,true,2024-01-05,"a ""q"", x",\n2,3,false,2024-01-06, y ,\n')
    typed = delimited.read_csv(spark, folder)
    assert [t for _, t in typed.dtypes] == ["bigint", "double", "boolean", "string", "string", "string"]
    assert [r.name for r in typed.collect()] == ['a "q", x', " y "]
    assert [r.blank for r in typed.collect()] == [None, None]
    assert {t for _, t in delimited.read_csv(spark, folder, force_string=True).dtypes} == {"string"}


def test_csv_ragged_rows_fail_loudly(spark, folder):
    Path(folder, "t.csv").write_text("id,name\n1,a\n2\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        delimited.read_csv(spark, folder, force_string=True).collect()


def test_line_breaks_inside_quotes(spark, folder, rows):
    Path(folder, "t.csv").write_text('id,text\n1,"two\nlines"\n')
    assert rows(delimited.read_csv(spark, folder, multi_line=True)) == [(1, "two\nlines")]


def test_caret_files_in_a_windows_charset(spark, folder, rows):
    Path(folder, "in.txt").write_bytes("1^Zoë^N/A\n2^\x93x\x94^\n".encode("latin-1"))
    df = delimited.read_caret(spark, f"{folder}/in.txt", ["id", "name", "code"], "windows-1252")
    assert rows(df) == sorted([("1", "Zoë", "N/A"), ("2", "“x”", None)], key=repr)


def test_caret_export_bytes(spark, folder):
    df = spark.createDataFrame([("1", None, " é ", "", "a^b")], "a string, b string, c string, d string, e string")
    delimited.write_caret(df.coalesce(1), f"{folder}/out")
    assert written(f"{folder}/out") == ['1^^ é ^^"a^b"\n'.encode()]


def test_swap_in_files(spark, folder):
    Path(folder, "in.txt").write_text("1^A^x\n2^B^\n3^A^A\n")
    delimited.swap_in_files(spark, f"{folder}/in.txt", f"{folder}/out", ["id", "code", "other"], "code", "A", "C")
    assert b"".join(written(f"{folder}/out")) == b"1^C^x\n2^B^\n3^C^A\n"


def test_import_export_bytes(spark, folder, rows):
    Path(folder, "in.csv").write_bytes("student_number,name\n007,Zoë\n8,\n".encode("mac_roman"))
    delimited.convert_to_import(spark, f"{folder}/in.csv", f"{folder}/out")
    assert written(f"{folder}/out") == ["student_number\tname\r007\tZoë\r8\t\r".encode("mac_roman")]
    assert rows(delimited.read_import(spark, f"{folder}/out")) == sorted([("007", "Zoë"), ("8", None)], key=repr)


# Folders


def test_latest_drop(spark, folder):
    for age, name in ((30, "b.csv"), (10, "a.csv"), (20, "c.csv")):
        Path(folder, name).write_text("x")
        os.utime(Path(folder, name), (1_700_000_000 - age,) * 2)
    assert latest_drop(spark, folder) == f"{folder}/a.csv"
    Path(folder, "older").mkdir()
    for age, name in ((40, "part-0"), (5, "part-1")):
        Path(folder, "older", name).write_text("x")
        os.utime(Path(folder, "older", name), (1_700_000_000 - age,) * 2)
    assert latest_drop(spark, f"file:{folder}/") == f"file:{folder}/older"
    assert {r["name"] for r in list_drops(spark, folder).collect()} == {"a.csv", "b.csv", "c.csv", "older"}
    plan = list_drops(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_latest_drop_of_an_empty_folder(spark, folder):
    with pytest.raises(FileNotFoundError):
        latest_drop(spark, folder)


# Grids


def test_grid(spark, rows):
    grid = spark.createDataFrame(
        [(1, ["Title"]), (2, ["id", "Goal %", ""]), (3, ["1", "5", "x"]), (4, ["2"]), (5, ["3", "6", "y", "extra"])],
        "row_no long, cells array<string>",
    )
    df = grid_to_frame(grid, 2)
    assert df.columns == ["id", "Goal %", ""]
    assert rows(df) == [("1", "5", "x"), ("2", "", ""), ("3", "6", "y")]
    assert [t for _, t in grid_to_frame(grid, 2, typed=True).dtypes] == ["bigint", "bigint", "string"]
    with pytest.raises(ValueError):
        grid_to_frame(grid, 9)


def test_grid_round_trip(spark, rows):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 2.5)], "n long, `x.y` string, z double")
    assert rows(grid_to_frame(frame_to_grid(df, "n", 3), 3)) == [("a", ""), ("b", "2.5")]


# Paged JSON


def test_paged_json_keeps_page_order(spark, folder):
    for page, ids in ((1, [5, 4]), (2, []), (10, [3]), (9, [2, 1])):
        body = json.dumps([{"id": i, "name": f"n\n{i}"} for i in ids], indent=1)
        Path(folder, f"users-page-{page}.json").write_text(body)
    items = read_paged_json(spark, folder, "id BIGINT, name STRING")
    got = items.orderBy("page_no", "item_no").collect()
    assert [(r.page_no, r.item_no, r.id) for r in got] == [(1, 1, 5), (1, 2, 4), (9, 1, 2), (9, 2, 1), (10, 1, 3)]
    assert got[0].name == "n\n5"


def test_broken_page_fails_the_query(spark):
    pages = spark.createDataFrame([(1, '[{"id": 1}]'), (2, "oops [")], "page int, body string")
    with pytest.raises(Exception, match="(?i)malformed"):
        explode_pages(pages, "body", "id BIGINT").collect()


def test_nested_item_types(spark, rows):
    pages = spark.createDataFrame([('[{"id": 1, "price": 2.50, "tags": ["a"], "o": {"x": 1, "y": "z"}}]',)], "body string")
    items = explode_pages(pages, "body", "id BIGINT, price DECIMAL(9,2), tags ARRAY<STRING>, o STRUCT<x: INT, y: STRING>")
    row = items.first()
    assert (row.item_no, row.id, str(row.price), row.tags, tuple(row.o)) == (1, 1, "2.50", ["a"], (1, "z"))


# Loading


def test_append_by_name_with_cleaned_columns(spark, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS loading")
    append_frame(spark.createDataFrame([(1, "a")], "`My Id` long, name string"), "loading.t")
    append_frame(spark.createDataFrame([("b", 2)], "NAME string, my_id long"), "loading.t")
    assert rows(spark.table("loading.t"), "my_id", "name") == [(1, "a"), (2, "b")]
    append_frame(spark.range(1), "loading.texts", force_string=True)
    assert spark.table("loading.texts").dtypes == [("id", "string")]


def test_append_row_range(spark, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS loading")
    df = spark.range(10)
    append_frame(df, "loading.steps", 2, 5, key="id")
    append_frame(df, "loading.steps", 7, key="id")
    assert rows(spark.table("loading.steps")) == [(i,) for i in (2, 3, 4, 7, 8, 9)]
    with pytest.raises(ValueError, match="key"):
        append_frame(df, "loading.steps", 1)


def test_uploads(spark, folder, rows):
    spark.sql("CREATE SCHEMA IF NOT EXISTS loading")
    Path(folder, "t.csv").write_text("Id;Last Name\n007;x\n8;y\n")
    upload_csv(spark, f"{folder}/t.csv", "loading.typed", sep=";")
    upload_csv(spark, f"{folder}/t.csv", "loading.text", sep=";", force_string=True, start=1, key="Id")
    assert rows(spark.table("loading.typed")) == [(7, "x"), (8, "y")]
    assert rows(spark.table("loading.text")) == [("8", "y")]
    grid = spark.createDataFrame([(1, ["Id", "Id", ""]), (2, ["1", "2.5", "x"])], "row_no long, cells array<string>")
    upload_grid(grid, "loading.sheet")
    assert spark.table("loading.sheet").dtypes == [
        ("id", "bigint"), ("id_1", "double"), ("no_col_name_or_merged_column_header", "string"),
    ]
    upload_grid(grid, "loading.sheet_text", force_string=True)
    assert rows(spark.table("loading.sheet_text")) == [("1", "2.5", "x")]


# Stream


def test_landing_loads_each_file_once(spark, folder, rows):
    for i in range(3):
        Path(folder, "in").mkdir(exist_ok=True)
        Path(folder, "in", f"f{i}.csv").write_text(f"student_number,Last Name\n{i:03d},n{i}\n")
        landed = land_new_files(
            spark,
            f"{folder}/in",
            "student_number STRING, `Last Name` STRING",
            f"{folder}/out",
            f"{folder}/checkpoint",
            files_per_batch=1,
        )
        assert landed.columns == ["student_number", "last_name"]
        assert rows(landed) == [(f"{j:03d}", f"n{j}") for j in range(i + 1)]
    again = land_new_files(spark, f"{folder}/in", "student_number STRING, `Last Name` STRING", f"{folder}/out", f"{folder}/checkpoint")
    assert again.count() == 3


def test_scratch_path_is_below_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    first, second = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert first != second and (base is None or first.startswith(base))


def test_files_keep_nulls_and_marker_texts_apart(spark, folder, rows):
    Path(folder, "t.csv").write_text("a,b\nN/A,NA\nnull,None\n,x\n")
    assert rows(delimited.read_csv(spark, folder)) == sorted([("N/A", "NA"), ("null", "None"), (None, "x")], key=repr)
    blanks = delimited.read_csv(spark, folder).filter(F.col("a").isNull())
    assert blanks.count() == 1
