"""From raw documents to packed training windows, in five stages.

Each stage takes the session, the documents its predecessor kept and the folder of the tables. All
but the last return the columns of ``documents``, whatever columns those are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.language_id import fit_language, identify_language
from rosterflow.llm.line_dedup import drop_shared_lines
from rosterflow.llm.minhash_dedup import drop_near_duplicates
from rosterflow.llm.packing import pack_documents
from rosterflow.llm.quality_model import fit_quality, score_quality
from rosterflow.llm.queries import table, tokenizer_file
from rosterflow.session import scratch_path


def whole_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """Each row as one struct beside some of its columns, so that new columns clash with none of its own."""
    return docs.select(F.struct("*").alias("row"), *columns)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be of quality 1; it learns from the table of labels.

    A null text counts as empty. Where labels tell no two kinds of these documents apart there is nothing to judge by, and
    all stay.
    """
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    if not len(model.feature):
        return docs
    scored = score_quality(whole_rows(docs, "text"), model)
    return scored.filter(F.col("predicted") == 1).select("row.*")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model can tell; it learns from their own ``lang``.

    A text that is null or without a letter has no language and goes. Where no document says its language, all stay.
    """
    model = fit_language(docs)
    if not model.languages:
        return docs
    found = identify_language(whole_rows(docs, "text"), model)
    return found.filter(~F.col("rejected")).select("row.*")


def own_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines they share with two or more others but in the last; ``n_chars`` follows.

    A null text becomes an empty one; documents stay even where no line is left.
    """
    kept = drop_shared_lines(whole_rows(docs, "doc_id", "text"))
    new = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return kept.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8 or more.

    Documents without words, with a null text for one, and those without an id are in no group and stay.
    """
    return drop_near_duplicates(docs, words=5, percent=80)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens, with their ids; a null text counts as empty."""
    pieces = pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))
    columns = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(*columns)


STAGES = [
    ("quality_classifier", good_quality),
    ("language_id", known_language),
    ("line_dedup", own_lines),
    ("minhash_near_dedup", without_near_duplicates),
    ("packing", packed),
]

# The first two stages are trained models, which SQL cannot express; tests hold all five against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of ``documents`` after all stages; what a stage keeps is written for the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
