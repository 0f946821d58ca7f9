"""Refresh a stored report by rewriting only the parts of it whose rows changed.

A stored report is a table of text, dealt into parts by a hash of its identifier and, within parts, into buckets by
the identifier. Each row has a digest of its query columns. A refresh compares digests part by part, joins the parts that
differ with the new query rows bucket by bucket, so that stored rows never move, and writes those parts alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.functions.text import NOT_ASSIGNED, blank_nulls
from rosterflow.operators.ordering import distinct_rows

KEY, ROW_1, ROW_2, PART = "_key", "_row_1", "_row_2", "_part"

# Parts of a stored report; digests are compared and files replaced part by part.
PARTS = 16

# Starts the key of a row without an identifier, which matches nothing.
NO_KEY = "\u0000"


def store_report(report: DataFrame, table: str, primary: str, query_columns: int, parts: int = PARTS, buckets: int | None = None) -> None:
    """Write a report as a new stored one: its first ``query_columns`` columns came from the query, the others are notes.

    ``buckets`` is by default the session's number of shuffle partitions, which keeps a refresh from dealing stored rows
    out again.
    """
    spark = report.sparkSession
    if spark.catalog.tableExists(table):
        raise ValueError(f"{table} exists")
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = _keyed(blank_nulls(report), primary, report.columns[:query_columns], parts)
    # Dealt by key, so that a part is one file per bucket. Writes to the table replace only the parts they have rows for.
    dealt = rows.repartition(number, KEY)
    dealt.write.partitionBy(PART).bucketBy(number, KEY).sortBy(KEY).option("partitionOverwriteMode", "dynamic").saveAsTable(table)
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('report.primary' = '{_quoted(primary)}', 'report.parts' = '{parts}', 'report.query_columns' = '{query_columns}')")


def stored_report(spark: SparkSession, table: str) -> DataFrame:
    """The rows of a stored report, without what the store adds."""
    return spark.table(table).drop(KEY, ROW_1, ROW_2, PART)


def refresh_stored(query: DataFrame, table: str) -> list[int]:
    """Bring a stored report up to date with new query rows, and return the parts that were rewritten.

    The result is that of ``refresh_report`` with the primary identifier alone, on the same rows: every query row stays, with the notes
    of its identifier, once per different note; rows that left the query go with their notes, and so do notes on
    rows without an identifier. A part is left alone if its query rows are the stored ones, each identifier's rows already have all of
    its notes, and no row without an identifier has one; notes edited in the table count.

    What reaches the driver is one line per part. A run that fails half-way is repaired by running it again: parts that
    were written already come out the same.
    """
    spark = query.sparkSession
    stored, properties = spark.table(table), _properties(spark, table)
    primary, parts, width = properties["report.primary"], int(properties["report.parts"]), int(properties["report.query_columns"])
    own = [c for c in stored.columns if c not in (KEY, ROW_1, ROW_2, PART)]
    names, notes = own[:width], own[width:]
    if query.columns != names:
        raise ValueError(f"{table} was stored for the columns {', '.join(names)}, got {', '.join(query.columns)}")
    fresh = _keyed(distinct_rows(blank_nulls(query)), primary, names, parts)
    changed = changed_parts(fresh, stored, notes)
    if not changed:
        return []
    asked, kept = fresh.filter(F.col(PART).isin(changed)), stored.filter(F.col(PART).isin(changed))
    joined = with_stored_notes(asked, kept, notes)
    # A part whose rows all left the query is emptied by itself; a write replaces only parts that it has rows for.
    filled = {r[0] for r in asked.select(PART).distinct().collect()}
    joined = joined.select(*[column(c) for c in [*own, KEY, ROW_1, ROW_2]], PART)
    joined.select(spark.table(table).columns).write.mode("overwrite").insertInto(table)
    for part in changed:
        if part not in filled:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({PART} = {part})")
    return changed


def changed_parts(fresh: DataFrame, stored: DataFrame, notes: Sequence[str]) -> list[int]:
    """Parts whose query rows differ from the stored ones, or whose notes a refresh would spread or drop."""
    note = F.xxhash64(*[column(c) for c in notes]) if notes else F.lit(0).cast("long")
    noted = F.concat(*[column(c) for c in notes]) != "" if notes else F.lit(False)
    # Stored rows are grouped by their key where they lie.
    rows = stored.groupBy(PART, KEY, ROW_1, ROW_2).agg(F.count(F.lit(1)).alias("n"), F.bool_or(noted).alias("noted"))
    pairs = stored.select(PART, KEY, note.alias("note")).distinct().groupBy(PART, KEY).agg(F.count(F.lit(1)).alias("notes"))
    of_key = rows.groupBy(PART, KEY).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows"), F.bool_or("noted").alias("noted"))
    open_keys = of_key.join(pairs, [PART, KEY]).filter(
        (F.col("n") != F.col("rows") * F.col("notes")) | (F.col("noted") & F.col(KEY).startswith(NO_KEY))
    )
    digest = [F.count(F.lit(1)).alias("n"), F.bit_xor(ROW_1).alias("x"), F.bit_xor(ROW_2).alias("y")]
    now = fresh.groupBy(PART).agg(*digest).withColumn("side", F.lit(1))
    then = rows.groupBy(PART).agg(*digest).withColumn("side", F.lit(0))
    sides = now.unionByName(then).groupBy(PART).agg(F.count(F.lit(1)).alias("sides"), F.count_distinct("n", "x", "y").alias("kinds"))
    differ = sides.filter("sides = 1 OR kinds > 1").select(PART).union(open_keys.select(PART)).distinct()
    return sorted(r[0] for r in differ.collect())


def with_stored_notes(fresh: DataFrame, stored: DataFrame, notes: Sequence[str]) -> DataFrame:
    """Query rows with the different notes stored under their key, blank where there are none; stored rows stay where they are."""
    offers = stored.filter(~F.col(KEY).startswith(NO_KEY)).select(KEY, *[column(c) for c in notes]).distinct()
    offers = offers.withColumnsRenamed({c: f"_note_{i}" for i, c in enumerate(notes)})
    blank = [F.coalesce(F.col(f"_note_{i}"), F.lit("")).alias(c) for i, c in enumerate(notes)]
    return fresh.join(offers.hint("merge"), KEY, "left").select(*[column(c) for c in fresh.columns], *blank)


def _keyed(rows: DataFrame, primary: str, query_columns: Sequence[str], parts: int) -> DataFrame:
    """Rows with their key, the digest of their query columns and their part. Rows without an identifier have a key of their own."""
    own = [column(c) for c in query_columns]
    usable = (column(primary) != NOT_ASSIGNED) & (column(primary) != "")
    key: Column = F.when(usable, column(primary)).otherwise(F.concat(F.lit(NO_KEY), F.xxhash64(*own).cast("string")))
    rows = rows.withColumns({KEY: key, ROW_1: F.xxhash64(*own), ROW_2: F.xxhash64(F.lit("second"), *own)})
    return rows.withColumn(PART, F.pmod(F.xxhash64(KEY), F.lit(parts)).cast("int"))


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
