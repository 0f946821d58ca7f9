"""Near-duplicate documents by b-bit minwise hashing, confirmed on full sets of word shingles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, free_name, saved, ship, slices, texts_of
from rosterflow.llm.components import connected_components

BANDS, ROWS, LOW_BITS = 32, 5, 2
SIZE = BANDS * ROWS
ODD = np.uint64(0xD6E8FEB86659FD93)
# Members of a bucket or of a group of candidates are compared in blocks of two parts of about so many each.
PART = 256


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    x = (x ^ (x >> np.uint64(32))) * ODD
    return x ^ (x >> np.uint64(32))


def permutations() -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20)
    draw = lambda: random.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return draw(), draw()


FACTORS, SHIFTS = permutations()


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), dtype=np.uint64, count=len(found))
    size = min(words, len(found))
    rolled = np.full(len(found) - size + 1, size, dtype=np.uint64)
    for i in range(size):
        rolled = mix(rolled * ODD + hashes[i : len(found) - size + 1 + i])
    return np.unique(rolled)


def minima(hashed: np.ndarray) -> np.ndarray:
    """The least value of the set under each permutation."""
    out = np.full(SIZE, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashed), 512):
        part = hashed[start : start + 512]
        np.minimum(out, (FACTORS[:, None] * part + SHIFTS[:, None]).min(axis=1), out=out)
    return out


def packed_bits(values: np.ndarray) -> bytes:
    """The low bits of the minima, mixed first, packed."""
    low = (mix(values) >> np.uint64(64 - LOW_BITS)).astype(np.uint8)
    bits = (low[:, None] >> np.arange(LOW_BITS, dtype=np.uint8)) & 1
    return np.packbits(bits.T).tobytes()


def band_keys(values: np.ndarray) -> np.ndarray:
    """A 64-bit key per band, of the full minima of its rows and its number."""
    rows = values.reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mix(key * ODD + rows[:, i])
    return key


def estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Similarities of packed signatures (64-bit words in the last axis), corrected for chance agreement of low bits."""
    words = left.shape[-1] // LOW_BITS
    equal = SIZE - words * 64  # what is padded always agrees
    for w in range(words):
        differ = np.uint64(0)
        for place in range(w, left.shape[-1], words):
            differ = differ | (left[..., place] ^ right[..., place])
        equal = equal + (64 - np.bitwise_count(differ).astype(np.int64))
    chance = 2.0**-LOW_BITS
    return (equal / SIZE - chance) / (1 - chance)


def signature_words(signatures: list[bytes]) -> np.ndarray:
    """Packed signatures as rows of 64-bit words: first all words of the lowest bit, then those of the next."""
    each = SIZE // 8
    flat = np.frombuffer(b"".join(signatures), np.uint8).reshape(len(signatures), LOW_BITS, each)
    words = -(-each // 8)
    padded = np.zeros((len(signatures), LOW_BITS, words * 8), dtype=np.uint8)
    padded[:, :, :each] = flat
    return padded.view(np.uint64).reshape(len(signatures), LOW_BITS * words)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sets' intersection is at least ``percent`` hundredths of their union."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def signed_documents(docs: DataFrame, words: int) -> DataFrame:
    """(doc, n, hi, lo, low_bits, keys) of rows (doc, text): set size, a 128-bit digest of the set and, of sets
    that are not empty, the packed signature and the keys of the bands."""
    schema = pa.schema(
        [("doc", pa.int64()), ("n", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64())]
        + [("low_bits", pa.binary()), ("keys", pa.list_(pa.int64()))]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                hashed = shingles(text, words)
                digest = xxhash.xxh3_128_digest(hashed.tobytes())
                hi, lo = (int.from_bytes(digest[i : i + 8], "little", signed=True) for i in (0, 8))
                low, keys = None, None
                if len(hashed):
                    least = minima(hashed)
                    low, keys = packed_bits(least), band_keys(least).view(np.int64)
                rows.append((doc, len(hashed), hi, lo, low, keys))
            if rows:
                columns = [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    ship(docs.sparkSession)
    return docs.mapInArrow(sign, "doc long, n long, hi long, lo long, low_bits binary, keys array<long>")


def component_of(link: np.ndarray) -> np.ndarray:
    """Of each row of a symmetric matrix of links the smallest row that links reach."""
    label = np.full(len(link), -1, dtype=np.int64)
    for row in range(len(link)):
        if label[row] >= 0:
            continue
        label[row] = row
        frontier = np.array([row])
        while len(frontier):
            frontier = np.flatnonzero(link[frontier].any(axis=0) & (label < 0))
            label[frontier] = row
    return label


def joining_pairs(link: np.ndarray, part: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that join what links join in a block of two parts, as few as there can be.

    What links join inside of one part is left to that part's own block, so that a block of two parts gives a pair only
    for components that meet in it.
    """
    label = component_of(link)
    inside = np.arange(len(link)) if same else component_of(link & (part[:, None] == part))
    row = np.flatnonzero((inside == np.arange(len(link))) & (label != np.arange(len(link))))
    return label[row], row


def linked_sets(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """For all pairs of sets whether their intersection is at least ``percent`` hundredths of their union."""
    if len(sets) == 2:
        return np.array([[False, True], [True, False]]) & linked(*sets, percent)
    n, sizes = len(sets), np.array([len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    # Only what two sets share at least can meet; those columns are counted in slices of bounded size.
    shared = np.flatnonzero(count[column] > 1)
    number = np.cumsum(count > 1) - 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    both = np.zeros((n, n))
    width = max(256, 4_000_000 // n)
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, width):
        low, high = np.searchsorted(column, [start, start + width])
        dense = np.zeros((n, width), dtype=np.float32)
        dense[row[low:high], column[low:high] - start] = 1
        both += dense @ dense.T
    # A slice adds whole numbers below 2**24, which single precision holds exactly.
    link = 100 * both >= percent * (sizes[:, None] + sizes - both)
    np.fill_diagonal(link, False)
    return link


def in_blocks(members: DataFrame, group: str, columns: list[str], rows_per_slot: int) -> DataFrame:
    """``members`` (with ``group``, ``node``, the group's size ``n`` and ``columns``) dealt out for comparisons inside of groups.

    A group is cut into parts of about ``PART`` members by a hash, and each member meets each part, its own
    included, in the block (i, j) of both. Blocks go to slots of about ``rows_per_slot`` rows.
    """
    parts = F.ceil(F.col("n") / PART).cast("int")
    placed = members.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    rows = members.agg(F.sum(parts)).first()[0] or 0
    slots = max(1, -(-int(rows) // rows_per_slot))
    blocks = met.select(
        F.col(group).alias("key"), F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "node", *columns
    )
    return blocks.withColumn("slot", F.pmod(F.xxhash64("key", "i", "j"), F.lit(slots)))


def joined_in_blocks(blocks: DataFrame, links) -> DataFrame:
    """Pairs (a, b) that join what links join in each block; ``links`` gives the matrix of links of some rows of Arrow."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("i", "ascending"), ("j", "ascending"), ("node", "ascending")]).combine_chunks()
        block = np.stack([group[c].to_numpy().astype(np.int64) for c in ("key", "i", "j")])
        starts = np.flatnonzero(np.concatenate(([True], (block[:, 1:] != block[:, :-1]).any(axis=0))))
        part, node = group["part"].to_numpy(), group["node"].to_numpy()
        a, b = [], []
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), group.num_rows]):
            if end - start > 1:
                x, y = joining_pairs(links(group.slice(start, end - start)), part[start:end], block[1, start] == block[2, start])
                a.append(node[start:end][x])
                b.append(node[start:end][y])
        empty = np.zeros(0, dtype=np.int64)
        return pa.table([pa.array(np.concatenate([*a, empty])), pa.array(np.concatenate([*b, empty]))], schema=schema)

    return blocks.groupBy("slot").applyInArrow(join, "a long, b long").distinct()


def candidate_links(least: float):
    """Links between signatures whose estimated similarity is ``least`` or more."""

    def links(rows: pa.Table) -> np.ndarray:
        words = signature_words(rows["low_bits"].to_pylist())
        return estimates(words[:, None], words[None, :]) >= least

    return links


def confirmed_links(words: int, percent: int):
    """Links between texts whose full sets are similar enough."""

    def links(rows: pa.Table) -> np.ndarray:
        return linked_sets([shingles(t, words) for t in texts_of(rows["text"])], percent)

    return links


def near_duplicates(
    docs: DataFrame,
    words: int = 5,
    percent: int = 80,
    slack: float = 0.16,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id`` and ``kept``.

    A text, with A-Z in lower case, is cut into words at white space; its set holds the hashes (64 bits)
    of its distinct ``words``-word shingles, or of the whole sequence if it has fewer words. Documents are
    linked if ``100 * intersection >= percent * union``. ``component_id`` is the smallest id that
    links reach, and the document with that id is the one to keep.

    Documents of one set make a class with its smallest id; copies stop there. Classes that agree on all 5
    minima of one of 32 bands are candidates: a pair at 0.8 is missed with a chance of three in a
    million. If their b-bit signatures estimate a similarity of no less than the threshold less ``slack`` (over four
    standard errors), they join a group of candidates, and in each group all pairs are compared by their full
    sets. Both comparisons go block by block; a block gives only the pairs that join components, never
    all links, and a group of any size is spread over tasks.

    Null, empty and blank texts have empty sets: ``n_shingles`` 0, linked with nothing, kept. A null id
    links with nothing, has a null component and is kept. Ids should be unique: each row of a repeated id gets
    the result of its own text, and classes whose smallest id is the same count as one. Other columns are
    not read. An empty table gives none.
    """
    least = percent / 100 - slack
    picked = docs.select(col(id_column).cast("long").alias("doc"), col(text_column).cast("string").alias("text"))
    signed = saved(signed_documents(picked, words))
    classes = (
        signed.filter("n > 0 AND doc IS NOT NULL")
        .groupBy("hi", "lo")
        .agg(F.min("doc").alias("node"), F.first("low_bits").alias("low_bits"), F.first("keys").alias("keys"))
    )
    classes = saved(classes)
    signatures = classes.select("node", "low_bits")
    keyed = classes.select("node", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("node").alias("first"), F.count("*").alias("n")).filter("n > 1")
    members = saved(keyed.join(buckets, "key"))
    blocks = in_blocks(members.join(signatures, "node"), "key", ["low_bits"], 4000)
    groups = connected_components(joined_in_blocks(blocks, candidate_links(least)))
    sizes = groups.groupBy("label").agg(F.count("*").alias("n"))
    grouped = saved(groups.join(sizes, "label").select(F.col("label").alias("group"), "node", "n"))
    blocks = in_blocks(grouped, "group", [], 400)
    texts = picked.select(F.col("doc").alias("node"), "text")
    texts = texts.join(grouped.select("node"), "node", "left_semi")
    labels = connected_components(joined_in_blocks(blocks.join(texts, "node"), confirmed_links(words, percent)))
    of_class = classes.select("hi", "lo", "node").join(labels, "node", "left")
    of_class = of_class.select(F.col("hi"), F.col("lo"), F.coalesce("label", "node").alias("component"))
    joined = signed.select("doc", "n", "hi", "lo").join(of_class, ["hi", "lo"], "left")
    component = F.when(F.col("doc").isNull(), None).otherwise(F.coalesce("component", "doc"))
    return joined.select(
        F.col("doc").alias(id_column),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        (F.col("doc").isNull() | (component == F.col("doc"))).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the documents that ``near_duplicates`` would not keep.

    Rows that share an id are one document here: they stay or go together, and stay if one of them is to be kept.
    """
    found = near_duplicates(docs, words, percent, id_column=id_column, text_column=text_column)
    name = free_name(docs.columns, "lost_id")
    lost = found.groupBy(col(id_column).alias(name)).agg(F.bool_or("kept").alias("any")).filter("NOT any").drop("any")
    return docs.join(lost, col(id_column).cast("long") == F.col(name), "left_anti")
