import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterflow.functions import dates
from rosterflow.functions.names import NO_NAME, dedup_names, sanitise_name, sanitise_text
from rosterflow.functions.text import (
    blank_nulls,
    blank_sentinel,
    is_numeric_text,
    number_key,
    placeholder,
    swap_value,
    thousands,
    to_number,
)


@pytest.mark.parametrize(
    "name, clean",
    [
        ("", NO_NAME),
        ("2nd Grade", "_2nd_grade"),
        ("Student  No. (#)", "student_no_"),
        ("__x--y__", "_x_y_"),
        ("Prénom / Élève", "prénom_élève"),
        ("²nd", "_²nd"),
        ("½", "½"),
        ("---", "_"),
    ],
)
def test_sanitise_name(name, clean):
    assert sanitise_name(name) == clean


def test_sanitise_text_agrees_with_names(spark):
    names = ["", "2nd Grade", "Prénom / Élève", "²nd", "½ x", "日本 語", "a\nb", "ÀÉ__ç", "١٢ x", "①a", "--", "Straße", "x́y"]
    df = spark.createDataFrame([(n,) for n in names] + [(None,)], "name string")
    got = {r.name: r.clean for r in df.select("name", sanitise_text(F.col("name")).alias("clean")).collect()}
    assert got == {None: None, **{n: sanitise_name(n) for n in names}}


def test_dedup_names():
    assert dedup_names(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    assert dedup_names(["a", "a", "a_1"]) == ["a", "a_1", "a_1_1"]
    assert dedup_names(["a_1", "a", "a"]) == ["a_1", "a", "a_2"]


@given(st.lists(st.sampled_from(["a", "b", "a_1", "a_2", "a_1_1", "b_1"]), max_size=12))
@settings(max_examples=200, deadline=None)
def test_dedup_names_are_unique_and_keep_first_uses(names):
    unique = dedup_names(names)
    assert len(set(unique)) == len(names)
    assert all(u == n or u.startswith(n + "_") for u, n in zip(unique, names, strict=True))


NUMBERS = ["12", " 12 ", "1e3", "5.", ".5", "+7", "-3.25", "inf", "-Infinity", "1E-2", "0012", "\t8"]
OTHERS = ["", " ", "N/A", "NaN", "12d", "12f", "0x10", "0x1p3", "1_000", "1,000", "abc", ".", "e5", "12 3", "True"]


def test_numeric_text(spark):
    df = spark.createDataFrame([(t,) for t in NUMBERS + OTHERS] + [(None,)], "t string")
    got = {r.t: (r.is_number, r.number) for r in df.select("t", is_numeric_text(F.col("t")).alias("is_number"), to_number(F.col("t")).alias("number")).collect()}
    for t in NUMBERS:
        assert got[t] == (True, float(t))
    for t in [*OTHERS, None]:
        assert got[t] == (False, None), t


def test_number_key_is_exact_and_canonical(spark):
    same = ["1000", "+1000", "1e3", "1000.0", " 01000 ", "1000."]
    long = ["12345678901234567", "12345678901234568"]
    df = spark.createDataFrame([(t,) for t in same + long + ["N/A", "", "inf", "1e300"]], "t string")
    got = {r.t: r.k for r in df.select("t", number_key(F.col("t")).alias("k")).collect()}
    assert len({got[t] for t in same}) == 1
    assert got[long[0]] != got[long[1]]
    assert got["N/A"] is None and got[""] is None
    assert got["inf"] is not None and got["1e300"] is not None


def test_rewrites(spark, rows):
    df = spark.createDataFrame([("Not Assigned Yet", 1.5), ("x", None), (None, 2.0)], "a string, b double")
    got = df.select(
        blank_sentinel(F.col("a")).alias("blanked"), swap_value(F.col("a"), "x", "y").alias("swapped")
    )
    assert rows(got) == sorted([("", "Not Assigned Yet"), ("x", "y"), (None, None)], key=repr)
    assert rows(blank_nulls(df)) == sorted([("Not Assigned Yet", "1.5"), ("x", ""), ("", "2.0")], key=repr)


def test_labels(spark):
    row = spark.range(1).select(
        thousands(F.lit(1234567)).alias("n"),
        placeholder(F.lit("tag"), "%").alias("p"),
        dates.academic_year(F.lit(2024)).alias("y"),
    ).first()
    assert tuple(row) == ("1,234,567", "{tag%}", "2023-2024")


def test_dates(spark, rows):
    df = spark.createDataFrame([("1/5/2024 3:04:05 PM",), ("12/31/2023 12:00:00 AM",), (None,)], "t string")
    got = df.select(dates.iso_date(dates.parse_submitted(F.col("t"))).alias("day"))
    assert rows(got) == sorted([("2024-01-05",), ("2023-12-31",), (None,)], key=repr)
    days = spark.createDataFrame([(datetime.date(2024, 6, 1),), (datetime.date(2024, 1, 1),), (None,)], "d date")
    clamped = days.select(dates.clamp_to(F.col("d"), datetime.date(2024, 3, 1)).alias("d"))
    assert rows(clamped) == sorted([(datetime.date(2024, 3, 1),), (datetime.date(2024, 1, 1),), (None,)], key=repr)


def test_keep_from_date_reaches_the_scan(spark, folder, rows, capsys):
    spark.createDataFrame([(1, "20230814"), (2, "20230815"), (3, None)], "id int, d string").write.parquet(folder + "/t")
    kept = dates.keep_from_date(spark.read.parquet(folder + "/t"), "d", "08/15/2023")
    assert rows(kept) == [(2, "20230815")]
    kept.explain()
    assert "GreaterThanOrEqual(d,20230815)" in capsys.readouterr().out


def test_skip_code_until(spark, rows):
    df = spark.createDataFrame([("E131",), ("E001",), (None,)], "code string")
    roll = datetime.date(2024, 6, 30)
    skipped = sorted([("E001",), (None,)], key=repr)
    assert rows(dates.skip_code_until(df, "code", "E131", roll, roll)) == skipped
    assert len(rows(dates.skip_code_until(df, "code", "E131", roll + datetime.timedelta(days=1), roll))) == 3
    assert len(rows(dates.skip_code_until(df, "code", "E131", roll))) == 3
