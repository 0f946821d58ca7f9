"""Repair of the turns of conversations by the cheapest edits to an alternating dialogue."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.align import cheapest_edits
from rosterflow.llm.common import saved, ship
from rosterflow.llm.turns import placed, turn_digest

BLANKS = " \t\n\x0b\x0c\r"

# Tells conversations apart: whether there is no id, and the id.
ID = ["no_id", "conv_id"]

# What the letters of a conversation tell, besides its gaps.
FACTS = "blank long, duplicate long, truncated long, illegal long, cost long, audit string"

# One letter per turn: four speakers (another, system, user, assistant) for each of sound, blank, duplicate and truncated.
LETTERS = "abcdefghijklmnop"
SPEAKERS = str.maketrans(LETTERS, "osua" * 4)
CODES = str.maketrans(LETTERS, "osua" + "x" * 8 + "OSUA")

# Conversations of at most this number of turns have their edits remembered.
SHORT = 24

# Codes of a conversation that go into one chunk of text before they are put together.
CHUNK_BITS = 10


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in, by the CRC-32 of ``conv_id:turn`` modulo 20; columns conv_id, turn, role, text and ``copy``.

    0 drops the row, 1 empties its text, 2 takes out its full stops, exclamation and question marks, 3
    repeats it (``copy`` 1), 4 makes it a user's. A null in any column counts as one space, in the checksum too.
    ``tie`` orders rows of one turn, by what they were.
    """
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select(
        "conv_id", "turn", role.alias("role"), text.alias("text"), turn_digest(role, text).alias("tie"), (F.crc32(named.cast("binary")) % 20).alias("fault")
    )
    repeats = F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    return rows.filter("fault <> 0").select("conv_id", "turn", role.alias("role"), text.alias("text"), "tie", F.explode(repeats).alias("copy"))


def repair_conversations(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row per ``conv_id``: its faults, the cheapest edits and the digest of what they leave.

    ``conversations`` has conv_id, turn, role and text, and may have ``tie`` and ``copy``, which order rows of one turn (else the
    SHA-256 of role and text does). Turns are ordered by ``turn``, nulls first. A row is ``blank``, a ``duplicate`` of role and text
    seen earlier, or ``truncated`` (its last character that is no white space is none of ``.!?``), whichever comes first.

    Keep costs 0, rerole to user or assistant 2, delete 3 (blank rows and duplicates must be), insert of an empty turn
    of user or assistant 2, and 1 for a truncated row that stays. What is left has role initials
    ``(s?(ua)+)?``. ``audit`` has the initials of the edits in order, K, R, D, I, the first in ASCII order of
    the cheapest (``cheapest_edits``).

    Rows are placed without bringing a conversation together, and repeated texts are found by their first places. What one task
    sees of a conversation as a whole is one letter per turn, as ``audit`` is itself one value of a letter or more per turn; its texts
    pass through the digest in order, one at a time.

    A null role or text is one space; a null conv_id is a conversation like any other; texts of any length
    and repeated rows are allowed; other columns do not count. A ``conv_id`` of ``ids`` that has no row comes out
    with zeros, an empty audit and the digest of an empty text; without ``ids`` only those with rows come out.
    """
    ship(conversations.sparkSession)
    space = F.lit(" ")
    rows = conversations.withColumns({"role": F.coalesce("role", space), "text": F.coalesce("text", space)})
    if "tie" not in rows.columns:
        rows = rows.withColumns({"tie": turn_digest(F.col("role"), F.col("text")), "copy": F.lit(0)})
    # A conversation without an id is told apart by a flag, so that joins need no null-safe keys.
    rows = _flagged(rows, "turn", "role", "text", "tie", "copy")
    faults = _faults(rows)
    letters = faults.groupBy(*ID, F.shiftright("place", CHUNK_BITS).alias("chunk")).agg(_in_order("place", "letter").alias("letters"))
    letters = letters.groupBy(*ID).agg(_in_order("chunk", "letters").alias("letters"))
    found = letters.mapInArrow(_edited, f"no_id boolean, conv_id long, {FACTS}")
    turns = faults.filter(F.col("turn").isNotNull()).groupBy(*ID, "turn").count()
    gaps = turns.groupBy(*ID).agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    heads = found.join(gaps, ID, "left").withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))
    # The facts of a conversation come first, then its turns; each is read once, in order.
    facts = F.struct("gaps", *[c.split()[0] for c in FACTS.split(", ")])
    heads = heads.select(*ID, F.lit(0).alias("kind"), facts.alias("facts"))
    stream = heads.unionByName(rows.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    order = [*[F.col(c).asc() for c in (*ID, "kind")], F.col("turn").asc_nulls_first(), F.col("tie").asc(), F.col("copy").asc()]
    stream = stream.repartition(*ID).sortWithinPartitions(*order).select(*ID, "facts", "role", "text")
    done = stream.mapInArrow(_digested, f"no_id boolean, conv_id long, gaps long, {FACTS}, repaired_sha256 string")
    if ids is not None:
        done = _flagged(ids).distinct().join(done, ID, "left")
    zeros = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return done.select(
        F.when(~F.col("no_id"), F.col("conv_id")).alias("conv_id"), *zeros,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _flagged(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(F.col("conv_id").isNull().alias("no_id"), F.coalesce("conv_id", F.lit(0)).cast("long").alias("conv_id"), *columns)


def _in_order(place: str, text: str) -> Column:
    """The texts of a group, in the order of their places, as one."""
    return F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(place, text))), lambda e: e[text]), "")


def _faults(rows: DataFrame) -> DataFrame:
    """Each turn's place and the letter that stands for its speaker and its first fault."""
    last = F.substring(F.rtrim("text", F.lit(BLANKS)), -1, 1)
    narrow = rows.select(
        *ID, "turn", "tie", "copy",
        turn_digest(F.col("role"), F.col("text")).alias("said"),
        F.when(F.col("role") == "", 0).otherwise(F.instr(F.lit("sua"), F.substring("role", 1, 1))).alias("speaker"),
        F.when(last == "", 1).when(~last.isin(".", "!", "?"), 3).otherwise(0).alias("fault"),
    )
    by_place = saved(placed(narrow, "tie", "copy", by=tuple(ID)).drop("tie", "copy"))
    first = by_place.groupBy(*ID, "said").agg(F.min("place").alias("place")).select(*ID, "place", F.lit(True).alias("is_first"))
    marked = by_place.join(first, [*ID, "place"], "left")
    fault = F.when((F.col("fault") != 1) & F.col("is_first").isNull(), 2).otherwise(F.col("fault"))
    return marked.select(*ID, "turn", "place", F.substring(F.lit(LETTERS), fault * 4 + F.col("speaker") + 1, F.lit(1)).alias("letter"))


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of faults and the cheapest edits, from the letters of each conversation."""
    for batch in batches:
        found = [_facts(letters) if len(letters) <= SHORT else _facts.__wrapped__(letters) for letters in batch.column(2).to_pylist()]
        columns = list(zip(*found, strict=True)) if found else [()] * 6
        arrays = [pa.array(c, pa.string() if i == 5 else pa.int64()) for i, c in enumerate(columns)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *arrays], ["no_id", "conv_id", *[c.split()[0] for c in FACTS.split(", ")]])


@lru_cache(maxsize=50_000)
def _facts(letters: str) -> tuple[int, int, int, int, int, str]:
    speakers = letters.translate(SPEAKERS)
    illegal = sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(speakers, speakers[1:], strict=False)))
    counts = [sum(letters.count(letter) for letter in LETTERS[4 * f : 4 * f + 4]) for f in (1, 2, 3)]
    return (*counts, illegal, *cheapest_edits(letters.translate(CODES)))


def repaired_lines(audit: str, turns: Iterator[tuple[str, str]]) -> Iterator[str]:
    """The lines ``role:text`` that the edits leave of turns, which are taken from the iterator one at a time."""
    place, with_system = 0, False
    for edit in audit:
        if edit == "I":
            role, text = None, ""
        else:
            role, text = next(turns)
            if edit == "D":
                continue
            with_system = with_system or (place == 0 and edit == "K" and role[:1] == "s")
        if edit != "K":
            role = "assistant" if (place - with_system) % 2 else "user"
        place += 1
        yield f"{role}:{text}"


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The facts of each conversation with the digest of its repaired lines; rows come by conversation, facts first."""
    heads: list[tuple] = []

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*[column.to_pylist() if i < 3 else column for i, column in enumerate(batch.columns)], strict=True)

    def record() -> pa.RecordBatch:
        names = ["no_id", "conv_id", "gaps", *[c.split()[0] for c in FACTS.split(", ")], "repaired_sha256"]
        kinds = [pa.bool_(), *[pa.int64()] * 7, pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([h[i] for h in heads], k) for i, k in enumerate(kinds)], names)

    source = rows()
    for no_id, conv_id, facts, _, _ in source:
        digest, between = hashlib.sha256(), b""
        # The audit has one letter for every turn that follows, and more for those put in.
        turns = ((role.as_py(), text.as_py()) for _, _, _, role, text in source)
        for line in repaired_lines(facts["audit"], turns):
            digest.update(between)
            digest.update(line.encode())
            between = b"\n"
        heads.append((no_id, conv_id, *facts.values(), digest.hexdigest()))
        if len(heads) >= 1_000:
            yield record()
            heads.clear()
    yield record()
