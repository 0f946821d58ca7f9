"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its exact name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: list[str], wanted: str) -> str:
    """A column name that no column has, in any case of letters."""
    lowered = {c.lower() for c in taken}
    while wanted.lower() in lowered:
        wanted += "_"
    return wanted


def replace_columns(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with new columns at its end; columns of the same name (in any case) give way."""
    gone = {c.lower() for c in columns}
    kept = [col(c) for c in df.columns if c.lower() not in gone]
    return df.select(*kept, *[value.alias(name) for name, value in columns.items()])


def held_out(doc_id: Column) -> Column:
    """True for the documents that no model may learn from: crc32 of the id as text, modulo 4, is 2.

    Without an id it is false; such documents are not learnt from either (see ``learnable``).
    """
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learnable(doc_id: Column) -> Column:
    """True for the documents that a model may learn from."""
    return doc_id.isNotNull() & ~held_out(doc_id)


def parts_of(texts: pa.Array, rows: int, most_bytes: int) -> Iterator[tuple[int, int]]:
    """(start, length) of runs of texts, each of at most ``rows`` rows and ``most_bytes`` or one row."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for at, size in enumerate(sizes):
        if at > start and (at - start >= rows or held + size > most_bytes):
            yield start, at - start
            start, held = at, 0
        held += size
    if len(sizes) > start:
        yield start, len(sizes) - start


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in small pieces by their last column, of texts, so that Python objects exist for few at a time."""
    for batch in batches:
        for start, length in parts_of(batch.column(batch.num_columns - 1), rows, most_bytes):
            yield batch.slice(start, length)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of an Arrow column; null becomes empty."""
    return [t if t is not None else "" for t in column.to_pylist()]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, as ``--py-files`` would."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="rosterflow-")) / "rosterflow_workers.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted((root / "rosterflow").rglob("*.py")):
            out.write(path, path.relative_to(root).as_posix())
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def saved(df: DataFrame) -> DataFrame:
    """The rows of ``df`` in the checkpoint folder that all executors share, with its lineage cut.

    A session that names none in ``spark.checkpoint.dir`` gets a folder of its own, which only
    a local one may do.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
            folder = tempfile.mkdtemp(prefix="rosterflow-checkpoints-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
