"""Joins over time: the newest earlier row, and spans that overlap."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.functions.names import column

# A level's cells are as many times wider than those of the level below; a power of two, so that numbers divide exactly.
FANOUT = 8
# Left and right rows of a cell that are paired at a time, where both sides are spans; a cell with more is dealt into parts.
BLOCKS = (65_536, 256)
# Counts of cells with more rows than that are broadcast up to so many cells.
MOST_COUNTS = 100_000


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    moment: str,
    tie_break: str,
    other_than: str | None = None,
    prefix: str = "earlier_",
    slice_seconds: int = 86_400,
) -> DataFrame:
    """Each left row with the newest right row of its key at an earlier moment; all left rows stay.

    Both sides have the columns ``by`` and ``moment``; of right rows at one moment the largest ``tie_break`` counts. Right columns
    but the keys come with ``prefix``, null where there is no such row. With ``other_than`` only right rows with another value in that
    column, which both sides have, are partners; null is a value. A null key or moment finds nothing.

    Both sides are stacked in the order of time and the last partner is carried over, so nothing is paired. A key is cut
    into slices of ``slice_seconds``, which makes a hot key many windows over a slice each. What a slice
    inherits comes from one row per slice. Two rows are carried: the newest, and the newest with another value than that; one of
    them is the answer whatever the left row's value is.
    """
    given = [c for c in right.columns if c not in by]
    own = [f"_by_{i}" for i in range(len(by))]
    place = [*own, "_slice"]

    def side(df: DataFrame, number: int, name: str, columns: Sequence[str]) -> DataFrame:
        seconds = F.unix_seconds(column(moment).cast("timestamp"))
        kind = column(other_than).cast("string") if other_than else F.lit(None).cast("string")
        tie = column(tie_break) if number else F.lit(None).cast(right.schema[tie_break].dataType)
        return df.filter(_known(by, moment)).select(
            *[column(c).alias(k) for c, k in zip(by, own, strict=True)], column(moment).alias("_at"), F.floor(seconds / slice_seconds).alias("_slice"),
            kind.alias("_kind"), F.lit(number).alias("_side"), tie.alias("_tie"), F.struct(*[column(c) for c in columns]).alias(name),
        )

    stacked = side(left, 0, "_left", left.columns).unionByName(side(right, 1, "_right", given), allowMissingColumns=True)
    # Partners at the same moment come after left rows, so they are not earlier ones.
    order = Window.partitionBy(*place).orderBy("_at", "_side", "_tie")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offer = F.when(F.col("_side") == 1, F.struct(F.col("_kind").alias("kind"), F.col("_right").alias("row")))
    rows = stacked.withColumn("_offer", offer).withColumn("_before", F.last("_offer", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    turned = F.when((F.col("_side") == 1) & F.col("_before").isNotNull() & ~_same(F.col("_before"), F.col("_kind")), F.col("_before"))
    rows = rows.withColumn("_turn", turned).withColumn("_other", F.last("_turn", ignorenulls=True).over(so_far))

    # One row per slice: its last partner, and the last one before the partners that are like it.
    late = F.struct("_at", "_tie")
    slices = rows.groupBy(*place).agg(
        F.max_by("_offer", F.when(F.col("_side") == 1, late)).alias("_last"), F.max_by("_turn", F.when(F.col("_turn").isNotNull(), late)).alias("_last_turn")
    )
    earlier = Window.partitionBy(*own).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("_from", F.last("_last", ignorenulls=True).over(earlier))
    across = F.when(F.col("_from").isNotNull() & F.col("_last").isNotNull() & ~_same(F.col("_from"), F.col("_last.kind")), F.col("_from"))
    slices = slices.withColumn("_turn_there", F.coalesce("_last_turn", across))
    slices = slices.select(*place, "_from", F.last("_turn_there", ignorenulls=True).over(earlier).alias("_from_other"))

    found = rows.filter("_side = 0").join(slices, place, "left")
    newest = F.coalesce("_before", "_from")
    # Within the slice all partners so far may be alike; then the other one comes from before it.
    other = F.when(F.col("_before").isNull(), F.col("_from_other")).otherwise(
        F.coalesce("_other", F.when(~_same(F.col("_from"), F.col("_before.kind")), F.col("_from")), F.col("_from_other"))
    )
    picked = F.when(~_same(newest, F.col("_kind")), newest).otherwise(other) if other_than else newest
    found = found.withColumn("_picked", picked)
    matched = found.select("_left.*", *[F.col("_picked.row").getField(c).alias(f"{prefix}{c}") for c in given])
    return matched.unionByName(left.filter(~_known(by, moment)), allowMissingColumns=True)


def _known(by: Sequence[str], moment: str) -> Column:
    return reduce(Column.__and__, [column(c).isNotNull() for c in [*by, moment]])


def _same(offer: Column, kind: Column) -> Column:
    return offer["kind"].eqNullSafe(kind)


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    by: Sequence[str] = (),
    bin_seconds: int = 86_400,
) -> DataFrame:
    """Pairs of rows whose spans share a moment, both ends included; a moment is a span with equal ends.

    ``by`` names columns that must be equal too. Columns of both sides come out, the keys once; the sides share no other names.
    Spans with a null end or that end before they start pair with nothing.

    Rows meet in cells of time, by an equi-join. Of two spans that overlap, the later one starts within the other, so a pair is a
    start that a span holds: right starts in left spans, and left starts, if later, in right spans. A span is put into the
    widest cells that make it up, level by level, a start into its one cell of every level; so a pair meets once, and only
    starts near the ends of a span are tried in vain. Where both sides are spans, a cell may have many rows on either side: they are
    dealt into parts of about ``BLOCKS`` rows, so that a full cell is the work of many tasks, and the sides are merged, as a hash
    table of so many rows per key is slow. Pairs come out as one left row after the other with the same few right rows, which
    columnar files store in a fraction of a byte a pair. ``bin_seconds``, the width of the smallest cells, should be a small part of
    most spans or about the distance of starts.
    """
    shared = sorted((set(left.columns) & set(right.columns)) - set(by))
    if shared:
        raise ValueError(f"both sides have columns: {', '.join(shared)}")
    longest = _longest([(left, left_span), (right, right_span)])
    top = 0
    while bin_seconds * FANOUT**top * (FANOUT - 1) < longest:
        top += 1
    # Which side's spans hold the other one's starts: 0 the left side's, 1 the right side's. A moment holds nothing but its equal.
    holders = [1] if left_span[0] == left_span[1] else [0] if right_span[0] == right_span[1] else [0, 1]

    def placed(df: DataFrame, span: tuple[str, str], side: int) -> DataFrame:
        start, end = (F.unix_micros(column(c).cast("timestamp")) for c in span)
        sound = df.filter(column(span[0]).isNotNull() & column(span[1]).isNotNull() & (start <= end))
        smallest = [F.floor(m / (bin_seconds * 1_000_000)).alias(n) for m, n in ((start, "_from"), (end, "_to"))]
        cells = F.concat(*[_cells(h, i, top, held=h != side) for h in holders for i in range(top + 1)])
        found = sound.select("*", start.alias("_start"), end.alias("_end"), *smallest).select("*", F.explode(cells).alias("_cell"))
        # What is held is a moment, and a span of the right side does not hold its own start where left spans do.
        holds = F.pmod("_cell", F.lit(2)) == side
        low = F.col("_start") + F.when(holds, len(holders) - 1).otherwise(0) if side else F.col("_start")
        high = F.when(holds, F.col("_end")).otherwise(F.col("_start"))
        return found.select(*[column(c) for c in df.columns], "_cell", low.alias(f"_low_{side}"), high.alias(f"_high_{side}"))

    rows, partners, meet = placed(left, left_span, 0), placed(right, right_span, 1), [*by, "_cell"]
    if len(holders) > 1:
        # Keys of two types are compared by the join alone.
        if all(left.schema[c].dataType == right.schema[c].dataType for c in by):
            rows, partners, meet = _dealt(rows, partners, meet)
        partners = partners.hint("merge")
    pairs = rows.join(partners, meet)
    taken = (F.col("_low_0") <= F.col("_high_1")) & (F.col("_low_1") <= F.col("_high_0"))
    return pairs.filter(taken).select(*[column(c) for c in left.columns], *[column(c) for c in right.columns if c not in by])


def _cells(holder: int, level: int, top: int, held: bool) -> Column:
    """Numbers of a row's cells on a level: the one of its start if ``held``, else those of its span that no wider cell takes.

    ``_from`` and ``_to`` are the smallest cells of start and end. A number tells cell, level and holder.
    """

    def border(name: str, i: int) -> Column:
        # First whole cell and the one after the last.
        return F.ceil(F.col("_from") / FANOUT**i) if name == "_from" else F.floor((F.col("_to") + 1) / FANOUT**i)

    def between(first: Column, after: Column) -> Column:
        return F.when(first < after, F.sequence(first, after - 1)).otherwise(F.array().cast("array<bigint>"))

    if held:
        found = F.array(F.floor(F.col("_from") / FANOUT**level))
    else:
        first, after = border("_from", level), border("_to", level)
        found = between(first, after)
        if level < top:
            wider = border("_from", level + 1), border("_to", level + 1)
            found = F.when(wider[0] < wider[1], F.concat(between(first, wider[0] * FANOUT), between(wider[1] * FANOUT, after))).otherwise(found)
    return F.transform(found, lambda cell: (cell * (top + 1) + level) * 2 + holder)


def _dealt(left: DataFrame, right: DataFrame, cell: Sequence[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides and the names on which they meet: a row goes into one part of its cell, by a hash, and meets each part of the other side's rows.

    Cells with no more than ``BLOCKS`` rows stay whole. One job counts the others, of which there is one for every 256 rows at most.
    """
    keys = [column(c) for c in cell]
    sides = [df.select(*keys, *[F.lit(int(i == side)).alias(f"_rows_{i}") for i in (0, 1)]) for side, df in enumerate((left, right))]
    parts = [F.ceil(F.sum(f"_rows_{i}") / most).cast("int").alias(f"_parts_{i}") for i, most in enumerate(BLOCKS)]
    full = sides[0].unionAll(sides[1]).groupBy(*keys).agg(*parts).filter("_parts_0 > 1 OR _parts_1 > 1")
    found = full.count()
    if not found:
        return left, right, [*cell]
    if found <= MOST_COUNTS:
        full = F.broadcast(full)

    def dealt(df: DataFrame, side: int) -> DataFrame:
        n = [F.greatest(F.lit(1), f"_parts_{i}") for i in (0, 1)]
        own = F.pmod(F.xxhash64(*[column(c) for c in df.columns]), n[side]).cast("int").alias(f"_part_{side}")
        others = F.explode(F.sequence(F.lit(0), n[1 - side] - 1)).alias(f"_part_{1 - side}")
        return df.join(full, [*cell], "left").select(*[column(c) for c in df.columns], own, others)

    return dealt(left, 0), dealt(right, 1), [*cell, "_part_0", "_part_1"]


def _longest(spans: Sequence[tuple[DataFrame, tuple[str, str]]]) -> int:
    """Seconds of the longest span, by one job; one number."""
    lengths = [
        df.select((F.unix_micros(column(span[1]).cast("timestamp")) - F.unix_micros(column(span[0]).cast("timestamp"))).alias("micros"))
        for df, span in spans
        if span[0] != span[1]
    ]
    micros = reduce(DataFrame.unionAll, lengths).agg(F.max("micros")).first()[0] if lengths else None
    return int((micros or 0) / 1_000_000 + 1)


def with_sessions(df: DataFrame, by: Sequence[str], moment: str, gap_seconds: int, name: str = "session_start", slice_seconds: int = 86_400) -> DataFrame:
    """``df`` with the moment at which each row's session started: a session of a key ends where more than ``gap_seconds`` pass without a row.

    A key is cut into slices of time, each a window of its own; a slice learns from one row per slice when the key was last
    seen and when the session that it may continue began. So a hot key is many small windows, and sessions go on over
    the borders of slices. Rows with a null key or moment are in no session.
    """
    own = [f"_by_{i}" for i in range(len(by))]
    place = [*own, "_slice"]
    seconds = F.unix_micros(column(moment).cast("timestamp"))
    rows = df.filter(_known(by, moment)).select(
        F.struct(*[column(c) for c in df.columns]).alias("_row"), *[column(c).alias(k) for c, k in zip(by, own, strict=True)], column(moment).alias("_at"),
        seconds.alias("_micros"), F.floor(seconds / 1_000_000 / slice_seconds).alias("_slice"),
    )
    order = Window.partitionBy(*place).orderBy("_micros")
    of_key = Window.partitionBy(*own).orderBy("_slice")
    rows = rows.withColumn("_before", F.lag("_micros").over(order))
    seen = rows.groupBy(*place).agg(F.max("_micros").alias("_last"))
    rows = rows.join(seen.select(*place, F.lag("_last").over(of_key).alias("_seen")), place)
    before = F.coalesce("_before", "_seen")
    fresh = before.isNull() | (F.col("_micros") - before > gap_seconds * 1_000_000)
    rows = rows.withColumn("_start", F.when(fresh, F.struct("_micros", "_at")))
    so_far = order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_own", F.max("_start").over(so_far))
    started = rows.groupBy(*place).agg(F.max("_start").alias("_started"))
    carried = started.select(*place, F.max("_started").over(of_key.rowsBetween(Window.unboundedPreceding, -1)).alias("_carried"))
    found = rows.join(carried, place).select("_row.*", F.coalesce("_own", "_carried")["_at"].alias(name))
    return found.unionByName(df.filter(~_known(by, moment)), allowMissingColumns=True)
