"""Joins over time, sessions and their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators.temporal import as_of_join, overlap_join, with_sessions
from rosterflow.registry.base import query, table, text


@query(
    """
SELECT event_id, user_id, event_type, ts, value, props,
       CAST(p.e.event_id AS VARCHAR) AS earlier_event_id, p.e.event_type AS earlier_event_type, p.e.ts AS earlier_ts, p.e.value AS earlier_value
FROM (
  SELECT *, (SELECT max_by(o, struct_pack(ts := o.ts, id := o.event_id)) FROM events o
             WHERE o.user_id = e.user_id AND o.ts < e.ts AND o.event_type <> e.event_type) AS e
  FROM events e) p
"""
)
def event_before(spark: SparkSession, sf: str) -> DataFrame:
    """Each event with the user's newest earlier event of another type."""
    events = table(spark, sf, "events")
    found = as_of_join(events, events.drop("props"), ["user_id"], "ts", "event_id", other_than="event_type", slice_seconds=7 * 86_400)
    return found.withColumn("earlier_event_id", text("earlier_event_id"))


@query(
    """
WITH periods AS (
  SELECT o_orderpriority, date_trunc('month', o_orderdate) AS month, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_shipdate, l_quantity, o_orderpriority, first_day, last_day
FROM lineitem JOIN periods ON l_shipdate BETWEEN first_day AND last_day
"""
)
def lines_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with the periods of orders that hold their ship date, one period per priority and month with orders."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_quantity")
    periods = order_periods(spark, sf)
    return overlap_join(lines, periods, ("l_shipdate", "l_shipdate"), ("first_day", "last_day"), bin_seconds=7 * 86_400)


def order_periods(spark: SparkSession, sf: str) -> DataFrame:
    """First and last day of each month's orders, by priority."""
    grouped = table(spark, sf, "orders").groupBy("o_orderpriority", F.date_trunc("month", "o_orderdate").alias("month"))
    return grouped.agg(F.min("o_orderdate").alias("first_day"), F.max("o_orderdate").alias("last_day")).drop("month")


@query(
    """
WITH spans AS (SELECT o_custkey, min(o_orderdate) AS first_day, max(o_orderdate) AS last_day FROM orders GROUP BY o_custkey),
near AS (SELECT c_nationkey, s.* FROM spans s JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING'),
other AS (SELECT c_nationkey, s.* FROM spans s JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY')
SELECT near.c_nationkey, near.o_custkey AS builder, other.o_custkey AS maker
FROM near JOIN other ON near.c_nationkey = other.c_nationkey AND near.first_day <= other.last_day AND other.first_day <= near.last_day
"""
)
def overlapping_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of two segments in one nation whose spans of orders overlap; spans are of any length."""
    spans = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    known = table(spark, sf, "customer").join(spans, "c_custkey")

    def of(segment: str, name: str) -> DataFrame:
        rows = known.filter(F.col("c_mktsegment") == segment)
        return rows.select("c_nationkey", F.col("c_custkey").alias(name), F.col("first").alias(f"{name}_first"), F.col("last").alias(f"{name}_last"))

    pairs = overlap_join(
        of("BUILDING", "builder"), of("MACHINERY", "maker"), ("builder_first", "builder_last"), ("maker_first", "maker_last"), by=["c_nationkey"], bin_seconds=30 * 86_400
    )
    return pairs.select("c_nationkey", "builder", "maker")


@query(
    """
WITH marked AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS starts FROM events),
numbered AS (SELECT *, sum(starts) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM marked)
SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS n_events, round(sum(value), 2) AS total FROM numbered GROUP BY user_id, session
"""
)
def event_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of users, which end after thirty minutes without an event."""
    rows = with_sessions(table(spark, sf, "events"), ["user_id"], "ts", 30 * 60)
    return rows.groupBy("user_id", "session_start").agg(
        F.max("ts").alias("session_end"), F.count(F.lit(1)).alias("n_events"), F.round(F.sum("value"), 2).alias("total")
    )
