"""Loads never change a value unless they are asked to."""

import uuid

import pytest
from pyspark.sql import functions as F

from rosterflow.functions.text import number_key
from rosterflow.operators.columns import create_table_sql, type_text_columns
from rosterflow.plans.load import append_frame


@pytest.fixture(scope="module")
def schema(spark):
    name = f"exact_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE SCHEMA {name}")
    yield name
    spark.sql(f"DROP SCHEMA {name} CASCADE")


KEPT = [
    ("INTEGER", "string", ["42", "-7.00", "+3.", "9223372036854775807", "-9223372036854775808", " 5 ", ""]),
    ("INTEGER", "double", [3.0, -1e15, None]),
    ("INTEGER", "boolean", [True, False]),
    ("NUMERIC(12,2)", "string", ["1.5", "1.250000", "-0.10", "1e3", "1.5e-1", "1234567890.12"]),
    ("NUMERIC(12,2)", "double", [1.25, 0.1, -3.0]),
    ("NUMERIC(12,2)", "decimal(20,5)", ["1.25000", "7"]),
    ("FLOAT", "string", ["0.1", "1e300", "0.30000000000000004", "123456789012345", "inf", "1.7976931348623157E308"]),
    ("FLOAT", "long", [2**53, -5]),
    ("DATE", "string", ["2024-05-01", "2024-5-1", "2024-05-01 00:00:00", "2024-05-01T00:00:00.000"]),
    ("DATE", "timestamp_ntz", ["2024-05-01 00:00:00"]),
    ("TIMESTAMP WITHOUT TIME ZONE", "string", ["2024-05-01", "2024-05-01 13:45", "2024-05-01 13:45:00.123456", "2024-05-01T01:02:03.1230000"]),
    ("BOOLEAN", "string", ["true", "F", "yes", "0"]),
    ("BOOLEAN", "int", [0, 1]),
    ("VARCHAR", "double", [1.5]),
]
CHANGED = [
    ("INTEGER", "string", ["1.7", "1.0001", "9223372036854775808", "abc", "1e3x"]),
    ("INTEGER", "double", [1.7, 1e19, float("nan")]),
    ("NUMERIC(12,2)", "string", ["1.239", "1.2345e1", "12345678901.00", "inf"]),
    ("NUMERIC(12,2)", "double", [1.239, 1e11]),
    ("NUMERIC(12,2)", "decimal(20,5)", ["1.23900"]),
    ("FLOAT", "string", ["0.12345678901234567890123", "12345678901234567", "1e999", "1e-999", "0.1000000000000000055"]),
    ("FLOAT", "long", [2**53 + 1]),
    ("DATE", "string", ["2024-05-01 13:45:00", "2024", "2024-05", "2023-02-29", "noon"]),
    ("DATE", "timestamp_ntz", ["2024-05-01 13:45:00"]),
    ("TIMESTAMP WITHOUT TIME ZONE", "string", ["2024-05-01 10:00:00+02:00", "2024-05-01 10:00:00Z", "2024-05-01 10:00:00.1234567", "2024-05"]),
    ("BOOLEAN", "int", [5, -1]),
    ("BOOLEAN", "string", ["5"]),
]


def frame(spark, kind, values):
    return spark.createDataFrame([(v if v is None else str(v) if kind != "boolean" else str(v).lower(),) for v in values], "v string").select(F.col("v").cast(kind))


def table(spark, schema, kind):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.sql(create_table_sql(name, schema, columns={"v": kind}))
    return f"{schema}.{name}"


@pytest.mark.parametrize(("kind", "source", "values"), KEPT)
def test_kept(spark, schema, kind, source, values):
    target = table(spark, schema, kind)
    append_frame(frame(spark, source, values), target)
    assert spark.table(target).count() == len(values)
    assert spark.table(target).filter("v IS NULL").count() == sum(v in (None, "") for v in values)


@pytest.mark.parametrize(("kind", "source", "value"), [(k, s, v) for k, s, values in CHANGED for v in values])
def test_refused(spark, schema, kind, source, value):
    target = table(spark, schema, kind)
    with pytest.raises(Exception, match="cannot hold"):
        append_frame(frame(spark, source, [value]), target)
    assert spark.table(target).count() == 0


def test_rounded_when_asked(spark, schema):
    target = table(spark, schema, "NUMERIC(12,2)")
    append_frame(frame(spark, "string", ["1.239", "2"]), target, lossy=["V"])
    assert sorted(str(r[0]) for r in spark.table(target).collect()) == ["1.24", "2.00"]
    with pytest.raises(Exception, match="cannot hold"):
        append_frame(frame(spark, "string", ["nothing"]), target, lossy=["v"])


def test_guesses_keep_digits(spark):
    rows = [("0.5", "0.12345678901234567890123", "12345678901234567", "9223372036854775807", "-9223372036854775809", "0.1", "+0012"),
            ("1", "1", "0.5", "-9223372036854775808", "1", "inf", "7")]
    typed = type_text_columns(spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string"))
    assert [t for _, t in typed.dtypes] == ["double", "string", "string", "bigint", "string", "double", "bigint"]


def test_keys_that_differ_late_stay_apart(spark):
    texts = ["0.12345678901", "0.12345678902", "1.5", "+01.50", "15e-1", "-0", "0", "0.0", "-0.50", "-5e-1", "1e30", "1e-30", "100", "1e2", ".5", "5e-1",
             "123456789012345678901234567890.5", "123456789012345678901234567890.50", "x"]
    keys = {r.t: r.k for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", number_key(F.col("t")).alias("k")).collect()}
    groups = {}
    for t, k in keys.items():
        groups.setdefault(k, set()).add(t)
    want = [{"0.12345678901"}, {"0.12345678902"}, {"1.5", "+01.50", "15e-1"}, {"-0", "0", "0.0"}, {"-0.50", "-5e-1"}, {"1e30"}, {"1e-30"}, {"100", "1e2"},
            {".5", "5e-1"}, {"123456789012345678901234567890.5", "123456789012345678901234567890.50"}]
    assert groups.pop(None) == {"x"} and sorted(map(sorted, groups.values())) == sorted(map(sorted, want))
