"""Quality of documents: boosted trees over statistics of the whole text."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.boosting import BoostedTrees, fit_trees
from rosterflow.llm.common import col, learnable, parts_of, replace_columns, ship, texts_of

# Kinds of bytes whose shares are features.
KINDS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789", " \t", "\n", ".", ",", "!", "?", "|", "#$%&*<>", "@/\\_=+~^{}[]", "'\"()-:;")


def byte_kinds() -> np.ndarray:
    """A column per kind, and one for bytes beyond ASCII."""
    table = np.zeros((256, len(KINDS) + 1))
    for kind, letters in enumerate(KINDS):
        table[list(letters.encode()), kind] = 1
    table[128:, -1] = 1
    return table


KIND_OF_BYTE = byte_kinds()
N_STATISTICS = len(KINDS) + 17


def text_statistics(text: str) -> np.ndarray:
    """Statistics of a text; all zero for an empty one."""
    out = np.zeros(N_STATISTICS)
    data = text.encode("utf-8", "replace")
    if not data:
        return out
    n = len(data)
    k = len(KINDS) + 1
    out[:k] = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ KIND_OF_BYTE / n
    words, lines = data.split(), data.split(b"\n")
    total = len(words)
    filled = [line for line in lines if line.strip()]
    out[k] = np.log1p(n)
    out[k + 1] = np.log1p(total)
    out[k + 2] = np.log1p(len(lines))
    out[k + 3] = len(zlib.compress(data, 1)) / n
    if total:
        counts = Counter(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=total)
        out[k + 4] = sizes.mean()
        out[k + 5] = sizes.std()
        out[k + 6] = sizes.max()
        out[k + 7] = len(counts) / total
        out[k + 8] = len(counts) / total**0.5
        out[k + 9] = max(counts.values()) / total
        out[k + 10] = sum(map(eq, words, words[1:])) / total
        out[k + 11] = sum(c for c in counts.values() if c == 1) / total
        out[k + 12] = sum(c for w, c in counts.items() if w.isupper()) / total
        out[k + 13] = sum(c for w, c in counts.items() if w[-1:] in b".,;:!?#$%&*|") / total
        out[k + 14] = total / max(1, len(filled))
        out[k + 15] = 1 - len(set(filled)) / max(1, len(filled))
    return out


def statistics_column(text: Column) -> Column:
    """The statistics of texts as an array of doubles; a null text counts as empty."""

    @F.arrow_udf("array<double>")
    def statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = [text_statistics(t) for t in texts_of(batch)]
            flat = np.concatenate(rows) if rows else np.zeros(0)
            offsets = np.arange(len(rows) + 1, dtype=np.int32) * N_STATISTICS
            yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return statistics(text)


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 12_000,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> BoostedTrees:
    """Trees for the chance that a document has quality 1, from a bounded sample of labelled rows.

    ``most_rows`` bounds the sample: labelled rows that may be learnt from (``learnable``), in the
    order of a hash of their id. Only their statistics reach the driver, some 250 bytes a row.
    Labels other than 0 and 1 and null ids are left out; of several labels of an id the smallest
    counts, and of several rows of an id the one whose statistics sort first.
    """
    ship(docs.sparkSession)
    known = labels.select(col(id_column).alias("id"), col(label_column).cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1) & learnable(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    sample = known.orderBy(F.xxhash64("id"), "id").limit(most_rows)
    texts = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("t"))
    # The sample has a fixed bound, 16 bytes a row.
    rows = (
        texts.join(F.broadcast(sample), "id")
        .select("id", "y", statistics_column(F.col("t")).alias("x"))
        .groupBy("id", "y")
        .agg(F.min("x").alias("x"))
        .orderBy("id")
        .collect()
    )
    x = np.array([r["x"] for r in rows]).reshape(len(rows), N_STATISTICS)
    return fit_trees(x, np.array([r["y"] for r in rows], dtype=float))


def score_quality(
    docs: DataFrame, model: BoostedTrees, threshold: float = 0.7, text_column: str = "text"
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: better) and ``predicted`` (1 from ``threshold`` on, else 0).

    Each row is scored by its whole text alone; null texts count as empty, and empty texts get the
    score of their statistics. Columns named like the new ones are replaced. An empty table
    stays empty.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            parts = (texts_of(batch.slice(*part)) for part in parts_of(batch, 500, 4 << 20))
            rows = [text_statistics(t) for part in parts for t in part]
            yield pa.array(model.probability(np.array(rows).reshape(len(rows), N_STATISTICS)))

    scored = replace_columns(docs, {"score": score(col(text_column).cast("string"))})
    return replace_columns(scored, {"predicted": (F.col("score") >= threshold).cast("int")})
