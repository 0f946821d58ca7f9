"""Sorting, row ranges, unions and whole-row distinct."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.names import column

# Steps of the grid that a sketch of keys gives, and its accuracy: ranks are off by a row in so many at most.
STEPS = 4096
ACCURACY = 1_000_000

# Keys around row positions that the driver may hold.
MOST_KEYS = 2_000_000

# Rows that one sort may hold when a row position is narrowed down by counting.
SMALL_RANGE = 1_000_000

# Parts into which each pass cuts the key range.
CUTS = 64


def sort_rows(df: DataFrame, by: Sequence[str], ascending: Sequence[bool] | bool = True) -> DataFrame:
    """Sort with a direction per column, nulls last either way.

    A hash of the other columns breaks ties. Rows are spread over tasks by sort range, so
    without it all rows of one frequent value would be sorted by a single task.
    """
    directions = [ascending] * len(by) if isinstance(ascending, bool) else list(ascending)
    if len(directions) != len(by):
        raise ValueError("give one direction per sort column")
    order = [
        column(c).asc_nulls_last() if up else column(c).desc_nulls_last()
        for c, up in zip(by, directions, strict=True)
    ]
    rest = [column(c) for c in df.columns if c not in by]
    return df.orderBy(*order, *([F.xxhash64(*rest)] if rest else []))


def row_range(df: DataFrame, key: str, start: int = 0, end: int | None = None) -> DataFrame:
    """Rows ``[start, end)`` in order of a unique key without nulls.

    Only the keys at both ends are looked up, both at once, by a sketch of the key column and one exact count; the rows
    then come from a filter on the key that reaches the scan. Nothing is sorted or numbered as
    a whole, and no more than ``MOST_KEYS`` keys pass through the driver. Keys that have no sketch, such as text, are found
    by counting passes.
    """
    if start < 0 or (end is not None and end < start):
        raise ValueError("need 0 <= start <= end")
    kind = df.select(column(key)).schema[0].dataType
    if end == start:
        return df.filter(F.lit(False))
    # From the first row on nothing has to be found.
    wanted = [p for p in (start, end) if p]
    found = dict(zip(wanted, _keys_at(df, key, wanted), strict=True))
    if start and found[start] is None:
        return df.filter(F.lit(False))
    rows = df.filter(column(key) >= _bound(found[start], kind)) if start else df
    stop = found[end] if end else None
    return rows if stop is None else rows.filter(column(key) < _bound(stop, kind))


def _bound(value, kind: T.DataType) -> Column:
    """A found key as a literal of the key's type. Timestamps travel as microseconds, clear of time zones."""
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(F.lit(value))
    if isinstance(kind, T.TimestampNTZType):
        return F.lit(value.isoformat(sep=" ")).cast(kind)
    return F.lit(value)


def _keys_at(df: DataFrame, key: str, positions: Sequence[int]) -> list:
    """The keys at positions of the ascending order, null past the end.

    One scan makes a quantile sketch of the keys, which is merged from all tasks' ones; keys of it on both sides of a
    position are its bracket. A second scan counts what is below each bracket and brings the brackets' keys, a few ten-thousandths of
    all, to the driver. Where those would be too many, the sketch is made again of the brackets alone.
    """
    kind = df.select(column(key)).schema[0].dataType
    if not positions or not isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return [_key_at(df, key, p) for p in positions]
    if isinstance(kind, T.TimestampType):
        keys, kind = df.select(F.unix_micros(column(key)).alias("k")), T.LongType()
    else:
        keys = df.select(column(key).alias("k"))
    rows, total, grid = keys.agg(F.count(F.lit(1)), F.count("k"), _grid()).first()
    if rows > total:
        raise ValueError(f"key {key} has nulls")
    inside = [p for p in positions if p < total]
    brackets = [_bracket(grid, p / total) for p in inside]
    if any(b is None for b in brackets):
        return [_key_at(df, key, p) for p in positions]
    parts = [_within(b, kind) for b in brackets]
    while brackets and total > MOST_KEYS * STEPS / 8:
        # A bracket holds a few steps of the grid; of so many rows that is too much for the driver, so each is cut up in turn.
        brackets = [_narrowed(keys, part, _below(keys, bracket, kind), p) for part, bracket, p in zip(parts, brackets, inside, strict=True)]
        parts = [_within(b, kind) for b in brackets]
        total //= STEPS // 4
    if not inside:
        return [None] * len(positions)
    below = [F.count_if(F.lit(False) if low is None else F.col("k") < _bound(low, kind)).alias(f"below_{i}") for i, (low, _) in enumerate(brackets)]
    # A bounded list: the keys of the brackets.
    seen = keys.agg(F.collect_list(F.when(reduce(Column.__or__, parts), F.col("k"))).alias("near"), *below).first()
    near = sorted(seen["near"])
    found = []
    for i, (p, (low, high)) in enumerate(zip(inside, brackets, strict=True)):
        own = [k for k in near if (low is None or k >= low) and (high is None or k < high)]
        at = p - seen[f"below_{i}"]
        if not 0 <= at < len(own):
            # Keys that doubles cannot tell apart may put a bracket beside its position.
            found.append(_key_at(df, key, p))
            continue
        if own.count(own[at]) > 1:
            raise ValueError(f"key {key} is not unique")
        found.append(own[at])
    return [*found, *[None] * (len(positions) - len(inside))]


def _grid() -> Column:
    shares = ", ".join(f"{i / STEPS!r}D" for i in range(STEPS + 1))
    return F.expr(f"percentile_approx(k, array({shares}), {ACCURACY})")


def _bracket(grid: list | None, share: float) -> tuple | None:
    """Keys of the grid around a share of the rows, a step further on either side; none is unbounded."""
    if not grid:
        return None
    low, high = int(share * STEPS) - 1, int(share * STEPS) + 3
    return (grid[low] if low >= 0 else None, grid[high] if high <= STEPS else None)


def _within(bracket: tuple, kind: T.DataType) -> Column:
    low, high = bracket
    inside = F.lit(True) if low is None else F.col("k") >= _bound(low, kind)
    return inside if high is None else inside & (F.col("k") < _bound(high, kind))


def _below(keys: DataFrame, bracket: tuple, kind: T.DataType) -> int:
    return 0 if bracket[0] is None else keys.filter(F.col("k") < _bound(bracket[0], kind)).count()


def _narrowed(keys: DataFrame, part: Column, below: int, position: int) -> tuple:
    """A bracket within a bracket."""
    n, grid = keys.filter(part).agg(F.count("k"), _grid()).first()
    return _bracket(grid, (position - below) / n)


def _key_at(df: DataFrame, key: str, position: int):
    """The key at a position of the ascending order, null past the end.

    Each pass counts the keys below a few dozen sampled cut points in one aggregate without a
    sort and goes on between the two cut points around the position.
    """
    kind = df.select(column(key)).schema[0].dataType
    if isinstance(kind, T.TimestampType):
        keys, kind = df.select(F.unix_micros(column(key)).alias("k")), T.LongType()
    else:
        keys = df.select(column(key).alias("k"))
    rows, total = keys.agg(F.count(F.lit(1)), F.count("k")).first()
    if rows > total:
        raise ValueError(f"key {key} has nulls")
    if position >= total:
        return None
    skip = position
    while total > SMALL_RANGE:
        # One uniformly drawn key per hash class, whatever the type of the key.
        drawn = keys.groupBy(F.pmod(F.xxhash64("k"), F.lit(CUTS))).agg(F.min_by("k", F.xxhash64("k", F.lit(total))))
        cuts = sorted({row[1] for row in drawn.collect()})
        below = keys.agg(*[F.count_if(F.col("k") < _bound(c, kind)).alias(f"c{i}") for i, c in enumerate(cuts)]).first()
        low = max((i for i, n in enumerate(below) if n <= skip), default=None)
        high = min((i for i, n in enumerate(below) if n > skip), default=None)
        narrowed = keys
        if low is not None:
            narrowed = narrowed.filter(F.col("k") >= _bound(cuts[low], kind))
        if high is not None:
            narrowed = narrowed.filter(F.col("k") < _bound(cuts[high], kind))
        dropped = 0 if low is None else below[low]
        remaining = (total if high is None else below[high]) - dropped
        if remaining == total:
            raise ValueError(f"key {key} is not unique")
        keys, skip, total = narrowed, skip - dropped, remaining
    found = [row[0] for row in keys.orderBy("k").offset(max(skip - 1, 0)).limit(3).collect()]
    at = min(skip, 1)
    if found.count(found[at]) > 1:
        raise ValueError(f"key {key} is not unique")
    return found[at]


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column that a frame lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole rows once. Copies collapse before the shuffle, so a frequent row costs one row per task."""
    return df.distinct()
