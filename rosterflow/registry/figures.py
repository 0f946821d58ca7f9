"""Grouped figures, newest rows, result checks and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.dates import parse_submitted
from rosterflow.operators.aggregates import count_findings, last_value, max_per_group, reconcile, require_rows, row_count
from rosterflow.operators.latest import latest_record, latest_rows
from rosterflow.operators.rules import add_formulas, count_violations, prefix_labels, rule_violations
from rosterflow.registry.base import query, table


@query("SELECT o_custkey, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders GROUP BY o_custkey")
def max_year_per_customer(spark: SparkSession, sf: str) -> DataFrame:
    dated = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("year"))
    return max_per_group(dated, ["o_custkey"], "year", "last_year")


@query(
    """
SELECT o_orderkey, o_custkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM orders
QUALIFY rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY year(o_orderdate) DESC) = 1
"""
)
def latest_rows_per_tag(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", F.year("o_orderdate").alias("order_year")
    )
    return latest_rows(orders, ["o_custkey", "o_orderpriority"], "order_year")


@query(
    """
SELECT user_id, event_type, event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS submitted_at FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY date_trunc('second', ts) DESC, event_id DESC) = 1
"""
)
def latest_submission(spark: SparkSession, sf: str) -> DataFrame:
    """Newest submission per user and type, from submission times as they are displayed."""
    submissions = table(spark, sf, "events").select(
        "user_id", "event_type", "event_id", F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("submitted")
    )
    timed = submissions.withColumn("moment", parse_submitted(F.col("submitted")))
    return latest_record(timed, ["user_id", "event_type"], "moment", "event_id").select(
        "user_id", "event_type", "event_id", F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("submitted_at")
    )


@query("SELECT event_type, arg_max(user_id, event_id) AS user_id FROM events GROUP BY event_type")
def last_value_by_seq(spark: SparkSession, sf: str) -> DataFrame:
    return last_value(table(spark, sf, "events"), "user_id", "event_id", ["event_type"])


@query("SELECT arg_max(strftime(l_shipdate, '%Y-%m-%d'), l_orderkey * 10 + l_linenumber) AS shipped FROM lineitem")
def last_row_of_file(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"),
    )
    return last_value(lines, "shipped", "seq")


@query(
    """
SELECT event_type, count(*) AS finding_count FROM events GROUP BY event_type
"""
)
def findings_per_code(spark: SparkSession, sf: str) -> DataFrame:
    """Two result pages with different columns, one of them for display only."""
    events = table(spark, sf, "events")
    low = events.filter("value < 10").select("event_type", "user_id", F.lit("View").alias("error_record"))
    high = events.filter("value >= 10 OR value IS NULL").select("event_type", "value")
    return count_findings([low, high], "event_type", ["error_record"])


@query(
    """
WITH wanted AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1),
imported AS (SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders
             WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) GROUP BY 1)
SELECT 'orders' AS table_name, month, w.n AS expected_rows, coalesce(i.n, 0) AS imported_rows,
       CASE WHEN w.n = coalesce(i.n, 0) THEN 'ok' ELSE 'mismatch' END AS status,
       'Imported: ' || format('{:,}', coalesce(i.n, 0)) AS message
FROM wanted w LEFT JOIN imported i USING (month)
"""
)
def load_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per month against those that arrived with lines."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    arrived = orders.join(lines, "o_orderkey", "left_semi")
    return reconcile({"orders": require_rows(orders)}, {"orders": arrived}, ["month"])


@query(
    """
WITH wanted AS (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS state, o_orderkey FROM orders),
arrived AS (SELECT * FROM wanted WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem) OR state IS NULL),
both_sides AS (SELECT state, count(*) AS e, 0 AS i FROM wanted GROUP BY 1 UNION ALL SELECT state, 0, count(*) FROM arrived GROUP BY 1)
SELECT 'orders' AS table_name, state, CAST(sum(e) AS BIGINT) AS expected_rows, CAST(sum(i) AS BIGINT) AS imported_rows,
       CASE WHEN sum(e) = sum(i) THEN 'ok' ELSE 'mismatch' END AS status, 'Imported: ' || format('{:,}', CAST(sum(i) AS BIGINT)) AS message
FROM both_sides GROUP BY state
"""
)
def load_reconcile_null_group(spark: SparkSession, sf: str) -> DataFrame:
    """Orders per state, pending ones under null, against those that arrived with lines or are pending."""
    state = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("state")
    orders = table(spark, sf, "orders").select("o_orderkey", state)
    lines = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    arrived = orders.filter("state IS NOT NULL").join(lines, "o_orderkey", "left_semi")
    return reconcile({"orders": orders}, {"orders": arrived.union(orders.filter("state IS NULL"))}, ["state"])


@query("SELECT count(*) AS row_count FROM lineitem")
def rows_in_file(spark: SparkSession, sf: str) -> DataFrame:
    return row_count(table(spark, sf, "lineitem"), "lineitem")


@query(
    """
SELECT l_orderkey, l_linenumber, 'l_returnflag' AS column_name, l_returnflag AS value FROM lineitem
WHERE l_returnflag NOT IN ('A', 'N')
UNION ALL
SELECT l_orderkey, l_linenumber, 'l_linestatus', l_linestatus FROM lineitem WHERE l_linestatus NOT IN ('O')
"""
)
def values_not_allowed(spark: SparkSession, sf: str) -> DataFrame:
    rules = [("l_returnflag", ["R"]), ("l_linestatus", ["O"]), ("l_returnflag", ["A", "N"])]
    return rule_violations(table(spark, sf, "lineitem"), rules, ["l_orderkey", "l_linenumber"])


@query(
    """
SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS row_count FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 2
UNION ALL
SELECT 'o_orderstatus', o_orderstatus, count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F') GROUP BY 2
"""
)
def allowed_values(spark: SparkSession, sf: str) -> DataFrame:
    rules = [("o_orderpriority", ["1-URGENT", "2-HIGH"]), ("o_orderstatus", ["O", "F"])]
    return count_violations(table(spark, sf, "orders"), rules)


@query(
    """
SELECT p_partkey, CASE WHEN starts_with(p_brand, 'Brand#1') THEN 'red' WHEN starts_with(p_brand, 'Brand#2') THEN 'green' END AS p_brand_label,
       CASE WHEN starts_with(p_type, 'S') THEN 'red' WHEN starts_with(p_type, 'PRO') THEN 'green' WHEN starts_with(p_type, 'P') THEN 'blue' END AS p_type_label
FROM part
"""
)
def prefix_label_columns(spark: SparkSession, sf: str) -> DataFrame:
    labels = {
        "red": [("Brand#1", "p_brand", "p_brand"), ("S", "p_type", "p_type")],
        "green": [("Brand#2", "p_brand", "p_type"), ("PRO", "p_type", "p_type")],
        "blue": [("P", "p_type", "p_type")],
    }
    return prefix_labels(table(spark, sf, "part"), labels).select("p_partkey", "p_brand_label", "p_type_label")


@query(
    """
WITH priced AS (
  SELECT *, CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS DOUBLE) AS net FROM lineitem)
SELECT l_orderkey, l_linenumber, l_suppkey, net, CASE WHEN net >= 50000 THEN 'large' ELSE 'small' END AS size FROM priced
"""
)
def formula_columns(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    net = "CAST(CAST(l_extendedprice AS DECIMAL(12, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2))) AS DOUBLE)"
    return add_formulas(lines, {"net": net, "size": "if(net >= 50000, 'large', 'small')"}).select("l_orderkey", "l_linenumber", "l_suppkey", "net", "size")
