"""Report refresh and the joins it is made of.

The fresh query lists every customer; a fifth of them have no primary identifier yet and those
of some nations have no secondary one. The existing report lists the customers with orders,
under query columns that may be out of date, with notes on the right.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.functions.text import NOT_APPLICABLE, NOT_ASSIGNED, is_numeric_text, to_number
from rosterflow.operators.matching import fallback_match, is_newly_listed, split_matches, with_match_flag
from rosterflow.operators.ordering import sort_rows, union_by_name
from rosterflow.plans.incremental import refresh_stored, store_report, stored_report
from rosterflow.plans.load import publish_report, report_grid
from rosterflow.plans.refresh import ReportSpec, refresh_report, refresh_reports
from rosterflow.registry.base import query, scratch_schema, table, text
from rosterflow.session import scratch_path
from rosterflow.sources.grid import frame_to_grid

QUERY_WIDTH = 5


def fresh_customers(spark: SparkSession, sf: str) -> DataFrame:
    """What the report's query returns now."""
    return table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "BUILDING", NOT_ASSIGNED).otherwise(text("c_custkey")).alias("customer_id"),
        F.when(F.col("c_nationkey") < 8, NOT_APPLICABLE)
        .otherwise(text(F.col("c_custkey") + 1000000))
        .alias("legacy_id"),
        "c_name",
        "c_mktsegment",
        "c_nationkey",
    )


def pending_urgent(spark: SparkSession, sf: str) -> DataFrame:
    """Of each customer with orders the day of the last one that is pending and how many are pending and urgent."""
    pending = F.col("o_orderstatus") == "P"
    urgent = pending & (F.col("o_orderpriority") == "1-URGENT")
    return (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(
            F.coalesce(F.date_format(F.max(F.when(pending, F.col("o_orderdate"))), "yyyy-MM-dd"), F.lit("")).alias("last_pending"),
            text(F.count_if(urgent)).alias("pending_orders"),
        )
    )


def old_report(spark: SparkSession, sf: str, notes: DataFrame, *note_columns: str) -> DataFrame:
    """The report as it was, with the given notes per ``c_custkey``."""
    return (
        table(spark, sf, "customer")
        .join(notes, "c_custkey")
        .select(
            F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") < 3000), NOT_ASSIGNED)
            .otherwise(text("c_custkey"))
            .alias("customer_id"),
            F.when(F.col("c_nationkey") < 8, NOT_APPLICABLE)
            .when(F.col("c_acctbal") < 0, F.concat(text(F.col("c_custkey") + 1000000), F.lit(".0")))
            .otherwise(text(F.col("c_custkey") + 1000000))
            .alias("legacy_id"),
            F.lower("c_name").alias("c_name"),
            "c_mktsegment",
            "c_nationkey",
            *note_columns,
        )
    )


FRESH = """
fresh AS (
  SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'Not Assigned Yet' ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN c_nationkey < 8 THEN 'N/A' ELSE CAST(c_custkey + 1000000 AS VARCHAR) END AS legacy_id,
         c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey
  FROM customer)"""

PENDING = """
pending AS (
  SELECT o_custkey, coalesce(strftime(max(o_orderdate) FILTER (o_orderstatus = 'P'), '%Y-%m-%d'), '') AS last_pending,
         CAST(count(*) FILTER (o_orderstatus = 'P' AND o_orderpriority = '1-URGENT') AS VARCHAR) AS pending_orders
  FROM orders GROUP BY o_custkey)"""

OLD_IDS = """
         CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal < 3000 THEN '' ELSE CAST(c_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN c_nationkey < 8 THEN 'N/A' WHEN c_acctbal < 0 THEN CAST(c_custkey + 1000000 AS VARCHAR) || '.0'
              ELSE CAST(c_custkey + 1000000 AS VARCHAR) END AS legacy_id"""

OLD = f"""
old AS (
  SELECT {OLD_IDS}, last_pending, pending_orders
  FROM customer JOIN pending ON c_custkey = o_custkey)"""

TWO_KEYS_INPUTS = f"""
WITH {FRESH}, {PENDING}, {OLD},
failed AS (SELECT * FROM fresh WHERE customer_id NOT IN (SELECT customer_id FROM old WHERE customer_id <> ''))"""

TWO_KEYS_ROWS = """
SELECT fresh.*, last_pending, pending_orders
FROM fresh JOIN old ON fresh.customer_id = old.customer_id AND old.customer_id <> ''
UNION
SELECT failed.*, coalesce(last_pending, ''), coalesce(pending_orders, '')
FROM failed LEFT JOIN old
  ON old.legacy_id <> 'N/A' AND TRY_CAST(failed.legacy_id AS DOUBLE) = TRY_CAST(old.legacy_id AS DOUBLE)
"""

TWO_KEYS = TWO_KEYS_INPUTS + TWO_KEYS_ROWS

ONE_KEY = f"""
WITH {FRESH}, {PENDING}, {OLD}
SELECT DISTINCT fresh.*, coalesce(last_pending, '') AS last_pending, coalesce(pending_orders, '') AS pending_orders
FROM fresh LEFT JOIN old ON fresh.customer_id = old.customer_id AND old.customer_id <> ''
"""


@query(TWO_KEYS)
def refresh_two_keys(spark: SparkSession, sf: str) -> DataFrame:
    report = old_report(spark, sf, pending_urgent(spark, sf), "last_pending", "pending_orders")
    return refresh_report(fresh_customers(spark, sf), report, "customer_id", "legacy_id", QUERY_WIDTH)


@query(ONE_KEY)
def refresh_one_key(spark: SparkSession, sf: str) -> DataFrame:
    report = old_report(spark, sf, pending_urgent(spark, sf), "last_pending", "pending_orders").drop("legacy_id")
    return refresh_report(
        fresh_customers(spark, sf),
        report,
        "customer_id",
        "legacy_id",
        QUERY_WIDTH,
        report_query_columns=QUERY_WIDTH - 1,
        sort_by=["c_mktsegment", "last_pending"],
        ascending=[True, False],
    )


@query(
    f"""
WITH {FRESH},
old AS (
  SELECT {OLD_IDS}, o_orderpriority AS note, o_orderstatus AS state
  FROM customer JOIN orders ON c_custkey = o_custkey),
failed AS (SELECT * FROM fresh WHERE customer_id NOT IN (SELECT customer_id FROM old WHERE customer_id <> ''))
SELECT fresh.*, note, state
FROM fresh JOIN old ON fresh.customer_id = old.customer_id AND old.customer_id <> ''
UNION
SELECT failed.*, coalesce(note, ''), coalesce(state, '')
FROM failed LEFT JOIN old
  ON old.legacy_id <> 'N/A' AND TRY_CAST(failed.legacy_id AS DOUBLE) = TRY_CAST(old.legacy_id AS DOUBLE)
"""
)
def refresh_duplicate_notes(spark: SparkSession, sf: str) -> DataFrame:
    notes = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("note"), F.col("o_orderstatus").alias("state")
    )
    report = old_report(spark, sf, notes, "note", "state")
    twice = union_by_name(fresh_customers(spark, sf), fresh_customers(spark, sf))
    return refresh_report(twice, report, "customer_id", "legacy_id", QUERY_WIDTH)


@query(
    f"""
{TWO_KEYS_INPUTS}, refreshed AS ({TWO_KEYS_ROWS})
SELECT 'customers' AS report, *, c_name || ' (' || c_mktsegment || ')' AS title,
       CASE WHEN starts_with(c_mktsegment, 'M') OR starts_with(c_mktsegment, 'F') THEN 'red'
            WHEN starts_with(c_mktsegment, 'H') THEN 'green' END AS c_mktsegment_label
FROM refreshed
UNION ALL
SELECT 'rich customers', *, NULL, NULL
FROM refreshed WHERE c_name IN (SELECT c_name FROM customer WHERE c_acctbal >= 5000)
"""
)
def refresh_report_set(spark: SparkSession, sf: str) -> DataFrame:
    """Two reports from query files, each against the old report as a grid."""
    folder = scratch_path(spark, "report-queries")
    fresh_sql = """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN '{sentinel}' ELSE CAST(c_custkey AS STRING) END AS customer_id,
               CASE WHEN c_nationkey < 8 THEN 'N/A' ELSE CAST(c_custkey + 1000000 AS STRING) END AS legacy_id,
               c_name, c_mktsegment, c_nationkey
        FROM parquet.`{folder}/customer.parquet` WHERE c_acctbal >= """
    for name, bound in (("all", "{lowest}"), ("rich", ":bound")):
        spark.createDataFrame([(fresh_sql + bound,)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    notes = pending_urgent(spark, sf).select(
        "c_custkey", "last_pending", F.col("pending_orders").alias("calls"), (F.col("c_custkey") + 1).alias("row_no")
    )
    grid = frame_to_grid(old_report(spark, sf, notes, "last_pending", "calls", "row_no"), "row_no", header_row=3)
    common = {
        "report": grid,
        "query_columns": QUERY_WIDTH,
        "header_rows": 3,
        "renames": {"calls": "pending_orders", "absent": "ignored"},
    }
    specs = {
        "customers": ReportSpec(
            query_path=f"{folder}/all",
            formulas={"title": "c_name || ' (' || c_mktsegment || ')'"},
            labels={
                "red": [("M", "c_mktsegment", "c_mktsegment"), ("F", "c_mktsegment", "c_mktsegment")],
                "green": [("H", "c_mktsegment", "c_mktsegment")],
            },
            **common,
        ),
        "rich customers": ReportSpec(query_path=f"{folder}/rich", named={"bound": 5000}, **common),
    }
    parameters = {"sentinel": NOT_ASSIGNED, "folder": sf.rstrip("/"), "lowest": 0}
    refreshed = refresh_reports(spark, specs, "customer_id", "legacy_id", parameters, {"lowest": -1000000})
    return union_by_name(*[df.withColumn("report", F.lit(name)) for name, df in refreshed.items()])


@query(TWO_KEYS)
def publish_refreshed_report(spark: SparkSession, sf: str) -> DataFrame:
    """Publish the old report, then refresh it and publish the result in its place."""
    report = f"{scratch_schema(spark)}.report_{uuid.uuid4().hex}"
    publish_report(old_report(spark, sf, pending_urgent(spark, sf), "last_pending", "pending_orders"), report)
    publish_report(
        refresh_report(fresh_customers(spark, sf), spark.table(report), "customer_id", "legacy_id", QUERY_WIDTH), report
    )
    return spark.table(report)


@query(
    f"""
WITH {PENDING}
SELECT c_custkey, c_name, last_pending, pending_orders, o_custkey IS NOT NULL AS has_pending
FROM customer LEFT JOIN pending ON c_custkey = o_custkey
"""
)
def match_indicator(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    return with_match_flag(customers, pending_urgent(spark, sf), "c_custkey", "has_pending")


@query(
    """
SELECT o_orderkey, o_custkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, l_quantity,
       l_returnflag, CASE WHEN l_orderkey IS NULL THEN 'no lines' ELSE 'lines' END AS part
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
"""
)
def match_split(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), text("l_linenumber").alias("l_linenumber"), "l_quantity", "l_returnflag"
    )
    matched, unmatched = split_matches(orders, lines, "o_orderkey")
    return union_by_name(matched.withColumn("part", F.lit("lines")), unmatched.withColumn("part", F.lit("no lines")))


@query(
    """
WITH wanted AS (
  SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_key, o_orderdate AS day FROM orders),
offers AS (
  SELECT CASE WHEN c_acctbal >= 5000 THEN c_custkey END AS customer_key, TIMESTAMP '1998-01-01' + to_days(CAST(c_custkey AS INTEGER)) AS day,
         c_name FROM customer),
failed AS (SELECT * FROM wanted WHERE NOT EXISTS (SELECT 1 FROM offers WHERE offers.customer_key = wanted.customer_key))
SELECT wanted.o_orderkey, c_name, 'customer_key' AS matched_on FROM wanted JOIN offers ON wanted.customer_key = offers.customer_key
UNION ALL
SELECT failed.o_orderkey, c_name, CASE WHEN c_name IS NOT NULL THEN 'day' END
FROM failed LEFT JOIN offers ON failed.day = offers.day
"""
)
def match_fallback(spark: SparkSession, sf: str) -> DataFrame:
    wanted = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("customer_key"),
        F.col("o_orderdate").alias("day"),
    )
    offers = table(spark, sf, "customer").select(
        F.when(F.col("c_acctbal") >= 5000, F.col("c_custkey")).alias("customer_key"),
        F.expr("timestamp_ntz '1998-01-01' + make_interval(0, 0, 0, cast(c_custkey as int))").alias("day"),
        "c_name",
    )
    return fallback_match(wanted, offers, ["customer_key", "day"], "matched_on").select("o_orderkey", "c_name", "matched_on")


@query(
    f"""
WITH {FRESH}
SELECT customer_id, legacy_id, c_name, TRY_CAST(customer_id AS DOUBLE) IS NOT NULL AS primary_is_number,
       TRY_CAST(legacy_id AS DOUBLE) AS legacy_number,
       TRY_CAST(customer_id AS DOUBLE) IS NOT NULL AND legacy_id = 'N/A' AS newly_listed
FROM fresh
"""
)
def newly_listed(spark: SparkSession, sf: str) -> DataFrame:
    return fresh_customers(spark, sf).select(
        "customer_id",
        "legacy_id",
        "c_name",
        is_numeric_text(column("customer_id")).alias("primary_is_number"),
        to_number(column("legacy_id")).alias("legacy_number"),
        is_newly_listed(column("customer_id"), column("legacy_id")).alias("newly_listed"),
    )


THREE_TIMES = f"""
{TWO_KEYS_INPUTS}, refreshed AS ({TWO_KEYS_ROWS}),
labelled AS (
  SELECT *, c_name || ' (' || c_mktsegment || ')' AS title,
         CASE WHEN starts_with(c_mktsegment, 'M') THEN 'red' WHEN starts_with(c_mktsegment, 'H') THEN 'green' END AS c_mktsegment_label
  FROM refreshed)"""


def published_three_times(spark: SparkSession, sf: str) -> str:
    """Name of a report that was refreshed and published three times, each from what the last publish left."""
    report = f"{scratch_schema(spark)}.daily_{uuid.uuid4().hex}"
    folder = scratch_path(spark, "daily-query")
    fresh_sql = """
        SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN 'Not Assigned Yet' ELSE CAST(c_custkey AS STRING) END AS customer_id,
               CASE WHEN c_nationkey < 8 THEN 'N/A' ELSE CAST(c_custkey + 1000000 AS STRING) END AS legacy_id,
               c_name, c_mktsegment, c_nationkey
        FROM parquet.`{folder}/customer.parquet`"""
    spark.createDataFrame([(fresh_sql,)], "value string").coalesce(1).write.text(folder)
    notes = pending_urgent(spark, sf).withColumn("row_no", F.col("c_custkey") + 1)
    grid = frame_to_grid(old_report(spark, sf, notes, "last_pending", "pending_orders", "row_no"), "row_no")
    headers = grid.filter("row_no = 1")
    derived = ["title", "c_mktsegment_label"]
    for _ in range(3):
        spec = ReportSpec(
            query_path=folder,
            report=grid,
            query_columns=QUERY_WIDTH,
            formulas={"title": "c_name || ' (' || c_mktsegment || ')'"},
            labels={"red": [("M", "c_mktsegment", "c_mktsegment")], "green": [("H", "c_mktsegment", "c_mktsegment")]},
            sort_by=["c_name", "last_pending", "pending_orders"],
        )
        refreshed = refresh_reports(spark, {"daily": spec}, "customer_id", "legacy_id", {"folder": sf.rstrip("/")})["daily"]
        publish_report(refreshed, report, derived=derived, row_no="row_no")
        published = spark.table(report)
        names = [c for c in published.columns if c != "row_no"]
        headers = spark.createDataFrame([(1, names)], "row_no bigint, cells array<string>")
        grid = report_grid(published, "row_no", headers)
    return report


@query(f"{THREE_TIMES} SELECT * FROM labelled")
def refresh_three_times(spark: SparkSession, sf: str) -> DataFrame:
    """A report with labels, formulas and a sort, refreshed from its own last state three times."""
    return spark.table(published_three_times(spark, sf)).drop("row_no")


@query(
    f"""
{THREE_TIMES}, numbered AS (
  SELECT row_number() OVER (ORDER BY c_name, last_pending, pending_orders) + 1 AS row_no, * FROM labelled)
SELECT row_no, customer_id, legacy_id, c_name, c_mktsegment, c_nationkey, last_pending, pending_orders, title, coalesce(c_mktsegment_label, '') AS c_mktsegment_label
FROM numbered
UNION ALL SELECT 1, 'customer_id', 'legacy_id', 'c_name', 'c_mktsegment', 'c_nationkey', 'last_pending', 'pending_orders', 'title', 'c_mktsegment_label'
"""
)
def refreshed_grid(spark: SparkSession, sf: str) -> DataFrame:
    """The same report as a grid below its header row, in the order of its sort."""
    published = spark.table(published_three_times(spark, sf))
    names = [c for c in published.columns if c != "row_no"]
    headers = spark.createDataFrame([(1, names)], "row_no bigint, cells array<string>")
    grid = report_grid(published, "row_no", headers)
    return grid.select("row_no", *[F.get("cells", F.lit(i)).alias(c) for i, c in enumerate(names)])


@query(
    """
SELECT c_custkey, c_name, CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderkey IS NOT NULL AS has_order
FROM (SELECT *, CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE CAST(c_custkey AS VARCHAR) END AS customer FROM customer)
LEFT JOIN orders ON customer = CAST(o_custkey AS VARCHAR)
"""
)
def match_mixed_key_types(spark: SparkSession, sf: str) -> DataFrame:
    """Text keys, some of them N/A, against number keys."""
    customers = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") < 0, "N/A").otherwise(text("c_custkey")).alias("customer")
    )
    orders = table(spark, sf, "orders").select(F.col("o_custkey").alias("customer"), text("o_orderkey").alias("o_orderkey"))
    return with_match_flag(customers, orders, "customer", "has_order").drop("customer")


@query(
    f"""
WITH {FRESH}, {PENDING}, {OLD},
later AS (
  SELECT customer_id, legacy_id, CASE WHEN customer_id IN ('1', '2', '3') THEN c_name || ' (new)' ELSE c_name END AS c_name, c_mktsegment, c_nationkey
  FROM fresh WHERE c_name NOT IN (SELECT c_name FROM customer WHERE c_custkey = 4))
SELECT DISTINCT later.*, coalesce(last_pending, '') AS last_pending, coalesce(pending_orders, '') AS pending_orders
FROM later LEFT JOIN old ON later.customer_id = old.customer_id AND old.customer_id <> ''
"""
)
def refresh_changed_only(spark: SparkSession, sf: str) -> DataFrame:
    """A stored report, refreshed when a few customers have changed; only their parts are written again."""
    report = f"{scratch_schema(spark)}.stored_{uuid.uuid4().hex}"
    fresh = fresh_customers(spark, sf)
    old = old_report(spark, sf, pending_urgent(spark, sf), "last_pending", "pending_orders").drop("legacy_id")
    first = refresh_report(fresh, old, "customer_id", query_columns=QUERY_WIDTH, report_query_columns=QUERY_WIDTH - 1)
    store_report(first, report, "customer_id", QUERY_WIDTH)
    gone = table(spark, sf, "customer").filter("c_custkey = 4").select("c_name")
    renamed = F.when(F.col("customer_id").isin("1", "2", "3"), F.concat("c_name", F.lit(" (new)"))).otherwise(F.col("c_name"))
    refresh_stored(fresh.join(gone, "c_name", "left_anti").withColumn("c_name", renamed).select(fresh.columns), report)
    return stored_report(spark, report)
