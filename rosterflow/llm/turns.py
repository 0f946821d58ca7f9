"""Places of turns in their conversations, and lookups whose hot keys are few, for conversations of any length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import saved

# Keys that hold more than this share of all rows are looked up by a broadcast, so those are at most as many.
HOT_KEYS = 50_000

# Keys with fewer rows than this are never hot.
COLD_ROWS = 10_000


def turn_digest(role: Column, text: Column) -> Column:
    """SHA-256 of a role and a text, neither of which may be null."""
    return F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)


def n_words(text: Column) -> Column:
    """Words of a text, cut at white space."""
    return F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def placed(turns: DataFrame, *then: str, by: tuple[str, ...] = ("conv_id",)) -> DataFrame:
    """``turns`` with ``place``, from 1, in the order of ``turn`` (nulls first) and then of other columns.

    ``by`` tells conversations apart and has no nulls; ``turns`` should be narrow. Rows are dealt by ranges of the order and
    numbered where they lie; what went before in other parts is added from one count per part and
    conversation, so no conversation has to fit into one task. The numbered rows are saved once,
    which keeps the numbers when a task is run again.
    """
    order = [*[F.col(c).asc() for c in by], F.col("turn").asc_nulls_first(), *[F.col(c).asc() for c in then]]
    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = saved(dealt.withColumn("_seq", F.monotonically_increasing_id()))
    part = F.shiftright("_seq", 33).alias("_part")
    spans = dealt.groupBy(*by, part).agg(F.min("_seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = spans.select(*by, "_part", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return (
        dealt.withColumn("_part", part)
        .join(before, [*by, "_part"])
        .withColumn("place", F.col("_seq") + F.col("_shift"))
        .drop("_seq", "_part", "_shift")
    )


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has each of its keys once and how many rows have it in ``weight``.

    Keys with more than their share of ``total`` are broadcast: they are at most ``HOT_KEYS``,
    whatever the size. The others are shuffled, and rows that are done or have no key are spread over tasks by
    a hash of themselves. The weight is not passed on.
    """
    most = max(COLD_ROWS, total // HOT_KEYS)
    added = [c for c in table.columns if c not in (*keys, weight)]
    one = F.struct(*added).alias("_found")
    hot = table.filter(F.col(weight) > most).select(*keys, one).withColumnRenamed("_found", "_hot")
    cold = table.filter(F.col(weight) <= most).select(*[F.col(k).alias(f"_on_{k}") for k in keys], F.lit(0).alias("_idle"), one)
    first = rows.join(F.broadcast(hot), keys, "left")
    idle = F.col("_hot").isNotNull() | F.col(keys[0]).isNull()
    spread = F.xxhash64(*rows.columns)
    on = [F.when(idle, spread).otherwise(F.col(k)).alias(f"_on_{k}") for k in keys]
    met = first.select(*rows.columns, "_hot", *on, F.when(idle, 1).otherwise(0).alias("_idle")).join(cold, [*[f"_on_{k}" for k in keys], "_idle"], "left")
    best = F.coalesce("_hot", "_found")
    return met.select(*rows.columns, *[best.getField(c).alias(c) for c in added])
