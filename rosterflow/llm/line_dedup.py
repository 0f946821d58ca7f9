"""Lines that many documents share, found through sharded minimal perfect hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, free_name, parts_of, replace_columns, saved, ship, slices, texts_of
from rosterflow.llm.perfect_hash import PerfectHash

SPACES = " \t\n\x0b\x0c\r"


def line_key(line: str, least_chars: int) -> tuple[int, int] | None:
    """A 128-bit hash of the key of a line, as two signed longs; none for keys that are too short."""
    stripped = line.strip(SPACES)
    if len(stripped) < least_chars:
        return None
    digest = xxhash.xxh3_128_digest(stripped.encode("utf-8", "surrogatepass").lower())
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def line_keys(docs: DataFrame, id_column: str, text_column: str, least_chars: int) -> DataFrame:
    """A row (doc, hi, lo) for each distinct key of each document."""
    schema = pa.schema([("doc", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                found = {line_key(line, least_chars) for line in text.split("\n")} - {None}
                rows += [(doc, *k) for k in found]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], schema=schema)

    ship(docs.sparkSession)
    picked = docs.select(col(id_column).cast("long").alias("doc"), col(text_column).cast("string").alias("text"))
    return picked.mapInArrow(keys, "doc long, hi long, lo long")


def line_index(counted: DataFrame, shards: int) -> DataFrame:
    """One row per shard of distinct line hashes (hi, lo, n_docs, last_doc): the shard's perfect hash
    over ``lo`` and, at each key's number, its fingerprint ``hi``, its count and its largest document."""
    schema = pa.schema(
        [("shard", pa.int64()), ("hash", pa.binary()), ("prints", pa.binary()), ("counts", pa.binary())]
        + [("lasts", pa.binary()), ("nulls", pa.binary())]
    )

    def build(group: pa.Table) -> pa.Table:
        lo, hi = group["lo"].to_numpy(), group["hi"].to_numpy()
        # Two lines whose lo agree are told apart by nothing else here; the chance is 2**-64 per pair.
        _, first = np.unique(lo, return_index=True)
        group = group.take(pa.array(first))
        lo, hi = lo[first], hi[first]
        hashed = PerfectHash.build(lo.view(np.uint64))
        at = hashed.find(lo.view(np.uint64))
        last = group["last_doc"].combine_chunks()
        arrays = (hi, group["n_docs"].to_numpy().astype(np.int64), last.fill_null(0).to_numpy(), last.is_null().to_numpy(zero_copy_only=False))
        packed = []
        for values in arrays:
            placed = np.empty_like(values)
            placed[at] = values
            packed.append(placed.tobytes())
        shard = group["shard"][0].as_py()
        return pa.Table.from_pylist(
            [dict(zip(schema.names, [shard, hashed.to_bytes(), *packed]))], schema=schema
        )

    sharded = counted.withColumn("shard", F.pmod("hi", F.lit(shards)))
    return sharded.groupBy("shard").applyInArrow(
        build, "shard long, hash binary, prints binary, counts binary, lasts binary, nulls binary"
    )


def dropped_keys(keys: DataFrame, index: DataFrame, shards: int, least_docs: int, most_probes: int) -> DataFrame:
    """Of each document (``doc``) the fingerprints (``hi``) of keys that it must drop.

    The keys go to their shard's arrays in groups of bounded size: a shard that many probes ask for,
    as one with a very frequent line, is split by a hash of the document, and its arrays are copied.
    """
    schema = pa.schema([("doc", pa.int64()), ("hi", pa.int64())])

    def probe(probes: pa.Table, arrays: pa.Table) -> pa.Table:
        if not arrays.num_rows or not probes.num_rows:
            return schema.empty_table()
        row = {c: arrays[c][0].as_py() for c in ("hash", "prints", "counts", "lasts", "nulls")}
        prints, counts, lasts = (np.frombuffer(row[c], np.int64) for c in ("prints", "counts", "lasts"))
        nulls = np.frombuffer(row["nulls"], bool)
        hi = probes["hi"].to_numpy()
        at = PerfectHash.from_bytes(row["hash"]).find(probes["lo"].to_numpy().view(np.uint64))
        doc = probes["doc"].combine_chunks()
        no_id = doc.is_null().to_numpy(zero_copy_only=False)
        last = (nulls[at] & no_id) | (~nulls[at] & ~no_id & (lasts[at] == doc.fill_null(0).to_numpy()))
        drop = (at >= 0) & (prints[at] == hi) & (counts[at] >= least_docs) & ~last
        return pa.table([doc.filter(pa.array(drop)), pa.array(hi[drop])], schema=schema)

    sharded = keys.withColumn("shard", F.pmod("hi", F.lit(shards)))
    # As many rows as there are shards.
    asked = saved(sharded.groupBy("shard").agg(F.count("*").alias("n")))
    mean = asked.agg(F.avg("n")).first()[0] or 0
    unit = int(min(max(mean, 1024), most_probes))
    parts = asked.select("shard", F.ceil(F.col("n") / unit).alias("parts"))
    part_of = F.pmod(F.xxhash64("doc", F.lit(1)), F.col("parts")).alias("part")
    # Eight thousand shards make 128 KB; with more of them the sizes are joined by a shuffle.
    small = F.broadcast(parts) if shards <= 8192 else parts
    probes = sharded.join(small, "shard").select("shard", part_of, "doc", "hi", "lo")
    copies = index.join(parts, "shard").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return (
        probes.groupBy("shard", "part")
        .cogroup(copies.drop("parts").groupBy("shard", "part"))
        .applyInArrow(probe, "doc long, hi long")
    )


def drop_shared_lines(
    docs: DataFrame,
    least_docs: int = 3,
    least_chars: int = 20,
    shard_keys: int = 50_000,
    most_probes: int = 200_000,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with shared lines gone from the text, and the numbers of lines before and dropped.

    A text is split at line breaks. A line's key is the line without white space at its ends and with
    A-Z in lower case. A key of at least ``least_chars`` code points that at least ``least_docs``
    documents hold loses all its lines but those of the largest id that holds it. The other lines stay,
    with a line break between them. ``n_lines`` and ``n_dropped`` are new; columns named so are replaced.

    All distinct keys are indexed by minimal perfect hashes, about ``shard_keys`` a shard, with their counts; the
    arrays alone decide which keys are shared. Documents send 128-bit hashes of their keys, never lines, to the
    arrays of a shard, ``most_probes`` at a time. A very long text is cut by itself, in a part of its own; a
    document has one row per distinct key, spread over the shards, until the list of those it drops.

    A null text is one empty line, as an empty one, and comes out empty. Each row counts as a document; rows that share
    an id keep or drop a key together. A null id is smaller than any other. An empty table stays
    empty.
    """
    keys = saved(line_keys(docs, id_column, text_column, least_chars))
    counted = keys.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))
    # An estimate will do: it sets the size of shards only.
    distinct = keys.agg(F.approx_count_distinct("hi")).first()[0] or 0
    shards = max(256, -(-distinct // shard_keys))
    gone = dropped_keys(keys, line_index(counted, shards), shards, least_docs, most_probes)
    per_doc = gone.groupBy("doc").agg(F.collect_list("hi").alias("gone"))

    key, dropped = free_name(docs.columns, "dropped_for"), free_name(docs.columns, "dropped_keys")
    per_doc = per_doc.select(F.col("doc").alias(key), F.col("gone").alias(dropped))
    joined = docs.join(per_doc, col(id_column).cast("long").eqNullSafe(F.col(key)), "left")

    @F.arrow_udf("struct<text:string,lines:long,gone:long>")
    def cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, lists in batches:
            for start, length in parts_of(texts, 500, 4 << 20):
                yield cut_part(texts.slice(start, length), lists.slice(start, length))

    def cut_part(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out, before, lost = [], [], []
        for text, drop in zip(texts_of(texts), lists.to_pylist()):
            lines = text.split("\n")
            before.append(len(lines))
            if drop:
                drop = set(drop)
                kept = [x for x in lines if (k := line_key(x, least_chars)) is None or k[0] not in drop]
                lost.append(len(lines) - len(kept))
                text = "\n".join(kept)
            else:
                lost.append(0)
            out.append(text)
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(before, pa.int64()), pa.array(lost, pa.int64())], ["text", "lines", "gone"])

    found = cut(col(text_column).cast("string"), F.col(dropped))
    order = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    result = replace_columns(joined.drop(key), {"n_lines": found["lines"], "n_dropped": found["gone"], text_column: found["text"]})
    return result.select(*[col(c) for c in order], "n_lines", "n_dropped")
