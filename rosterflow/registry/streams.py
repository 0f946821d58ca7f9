"""Streams over event files that arrive in drops. Whatever is written goes to a new shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.operators.ordering import union_by_name
from rosterflow.registry.base import query, table
from rosterflow.session import scratch_path
from rosterflow.streaming.newest import NewestRows
from rosterflow.streaming.windows import WindowedStream

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_drops(spark: SparkSession, sf: str) -> list[DataFrame]:
    """All events in three drops by their day of the month; one event in ten comes a drop or two after its time."""
    events = table(spark, sf, "events")
    day = F.dayofmonth("ts")
    arrival = F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2) + F.when(F.col("event_id") % 10 == 0, 1 + F.floor(F.col("event_id") % 20 / 10)).otherwise(0)
    return [events.filter(F.least(arrival, F.lit(2)) == i) for i in range(3)]


@query(
    """
SELECT date_trunc('hour', ts) AS window_start, event_type, CAST(count(*) AS BIGINT) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL
"""
)
def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Events in three drops, out of order, counted per hour and type: windows of the stream and its late rows together."""
    folder = scratch_path(spark, "windows")
    figures = {"n": F.count(F.lit(1)), "total": F.sum("value")}
    stream = WindowedStream(spark, f"{folder}/in", EVENTS, folder, "ts", ["event_type"], figures, "1 hour", "6 hours")
    for drop in event_drops(spark, sf):
        drop.write.mode("append").parquet(f"{folder}/in")
        stream.run()
    late = stream.late_rows().groupBy(F.window(F.col("ts").cast("timestamp"), "1 hour")["start"].alias("window_start"), "event_type")
    both = union_by_name(stream.windows().drop("window_end"), late.agg(*[f.alias(n) for n, f in figures.items()]))
    summed = both.groupBy("window_start", "event_type").agg(F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"))
    return summed.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def stream_newest(spark: SparkSession, sf: str) -> DataFrame:
    """The newest event per user after three drops; the second comes twice, once under its own number and once under a new one."""
    folder = scratch_path(spark, "newest")
    newest = NewestRows(spark, folder, ["user_id"], "ts", "event_id")
    drops = event_drops(spark, sf)
    for i, drop in enumerate(drops):
        drop.write.mode("append").parquet(f"{folder}/in")
        newest.follow(f"{folder}/in", EVENTS)
        if i == 1:
            newest.upsert(drops[1], 1)
            newest.compact()
    newest.upsert(drops[1], 1)
    newest.upsert(drops[1], 3)
    return newest.rows()
