"""Joins that say what matched."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.functions.text import NOT_APPLICABLE, is_numeric_text
from rosterflow.operators.ordering import union_by_name


def with_match_flag(
    left: DataFrame, right: DataFrame, on: str | list[str], flag: str = "matched", null_keys_match: bool = False
) -> DataFrame:
    """Left equi-join that adds whether each row found a partner.

    Keys whose types differ are compared as text on both sides, so ``N/A`` against numbers just finds nothing.
    Columns both sides have keep the left value. Matched and unmatched rows come from an inner
    and an anti join (see ``split_matches``), because a left join cannot split a hot key of its
    right side.
    """
    keys = [on] if isinstance(on, str) else list(on)
    differ = {k for k in keys if left.schema[k].dataType != right.schema[k].dataType}
    parts = [column(k).cast("string") if k in differ else column(k) for k in keys]
    several = null_keys_match or len(keys) > 1
    key = F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)]) if several else parts[0]
    if not null_keys_match:
        key = F.when(reduce(Column.__and__, [column(k).isNotNull() for k in keys]), key)
    extra = [c for c in right.columns if c not in left.columns]
    offers = right.select(key.alias("_pair"), *[column(c) for c in extra])
    matched, unmatched = split_matches(left.withColumn("_pair", key), offers, "_pair")
    flagged = union_by_name(matched.withColumn(flag, F.lit(True)), unmatched.withColumn(flag, F.lit(False)))
    return flagged.select(*[column(c) for c in [*left.columns, *extra, flag]])


def distinct_keys(df: DataFrame, *keys: str) -> DataFrame:
    """The distinct keys, not yet partitioned by key.

    They are made distinct together with a hash of themselves, so a join on the keys has to
    shuffle them. Keys are narrow, so that is cheap, and it pays: adaptive execution splits a
    hot key of the other join side only where both sides come straight out of a shuffle.
    """
    columns = [column(k) for k in keys]
    return df.select(*columns, F.xxhash64(*columns).alias("_mix")).distinct().drop("_mix")


def split_matches(left: DataFrame, right: DataFrame, on: str) -> tuple[DataFrame, DataFrame]:
    """Left rows with their partners' columns, and the left rows without a partner.

    The inner and the anti join read one shuffle of the left side, which Spark reuses, and both
    let adaptive execution split a hot key. Null keys match nothing: they skip the joins and
    their shuffle, so a large share of rows without an identifier cannot pile up in one task.
    """
    extra = [c for c in right.columns if c not in left.columns]
    keyed = left.filter(column(on).isNotNull())
    partners = right.filter(column(on).isNotNull())
    matched = keyed.join(partners.select(column(on), *[column(c) for c in extra]), on, "inner")
    unmatched = keyed.join(distinct_keys(partners, on), on, "left_anti")
    order = [column(c) for c in left.columns]
    return (
        matched.select(*order, *[column(c) for c in extra]),
        unmatched.select(*order).union(left.filter(column(on).isNull())),
    )


def is_newly_listed(primary: Column, secondary: Column | None = None) -> Column:
    """A row that found no partner but has a real primary identifier and, if asked for, no secondary one."""
    numeric = is_numeric_text(primary)
    return numeric if secondary is None else numeric & (secondary == NOT_APPLICABLE)


# Parts over which rows without a partner are spread in a join.
SPREAD = 16_384


def fallback_match(
    left: DataFrame, right: DataFrame, keys: Sequence[str], matched_on: str | None = None, distinct: bool = False
) -> DataFrame:
    """Match on the first key; rows that fail try the next key, and so on. All left rows stay.

    Both sides have the key columns; ``right`` adds its other columns, and where both sides have
    a column the left value stays. Keys are compared as text; null keys match nothing.
    ``matched_on`` names a column for the key that matched, null if none did. With ``distinct``
    equal offers under a key count once.

    First each row learns which of its keys exists, from the distinct keys of the right side.
    Then one inner join fetches the partners under that key, with blank partners for the rows
    that have none. So the left side is never branched and read again, rows without a key or
    partner are spread evenly, and a hot key can be split on either side of the join. The joins
    are merged (a hint): Spark takes the size of the keys from that of the right side's files, which may be
    a small part of it, and would hold all of them in the memory of every task, once per key.
    """
    extra = [c for c in right.columns if c not in left.columns]
    slots = range(len(keys))
    candidates = F.array(
        *[F.struct(F.lit(i).alias("slot"), column(k).cast("string").alias("key")) for i, k in enumerate(keys)]
    )
    offers = (
        right.select(F.explode(candidates).alias("_offer"), *[column(c) for c in extra])
        .filter("_offer.key IS NOT NULL")
        .select(F.col("_offer.slot").alias("_slot"), F.col("_offer.key").alias("_key"), *[column(c) for c in extra])
    )
    if distinct:
        offers = offers.distinct()
    known = distinct_keys(offers, "_slot", "_key")

    spread = F.pmod(F.xxhash64(*[column(c) for c in left.columns]), F.lit(SPREAD)).cast("string")
    seen = left.withColumn("_spread", spread)
    for i, k in enumerate(keys):
        key = column(k).cast("string")
        seen = (
            seen.withColumn("_try_slot", F.when(key.isNull(), -1).otherwise(i))
            .withColumn("_try_key", F.coalesce(key, F.col("_spread")))
            .join(
                known.select(
                    F.col("_slot").alias("_try_slot"), F.col("_key").alias("_try_key"), F.lit(True).alias(f"_hit_{i}")
                ).hint("merge"),
                ["_try_slot", "_try_key"],
                "left",
            )
            .drop("_try_slot", "_try_key")
        )
    slot = F.coalesce(*[F.when(F.col(f"_hit_{i}"), F.lit(i)) for i in slots], F.lit(-1))
    key = F.coalesce(
        *[F.when(F.col(f"_hit_{i}"), column(k).cast("string")) for i, k in enumerate(keys)], F.col("_spread")
    )
    blanks = left.sparkSession.range(SPREAD).select(
        F.lit(-1).alias("_slot"), F.col("id").cast("string").alias("_key")
    )
    partners = offers.unionByName(blanks, allowMissingColumns=True)
    names = F.array(*[F.lit(k) for k in keys])
    label = [] if matched_on is None else [F.when(F.col("_slot") >= 0, F.get(names, F.col("_slot"))).alias(matched_on)]
    return (
        seen.withColumn("_slot", slot)
        .withColumn("_key", key)
        .join(partners.hint("merge"), ["_slot", "_key"])
        .select(*[column(c) for c in [*left.columns, *extra]], *label)
    )
