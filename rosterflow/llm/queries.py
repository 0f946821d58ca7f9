"""The registered queries of this subpackage, with the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.llm.common import held_out
from rosterflow.llm.embedding_dedup import near_duplicate_vectors
from rosterflow.llm.html_extract import extract_main_text
from rosterflow.llm.language_id import fit_language, identify_language
from rosterflow.llm.line_dedup import drop_shared_lines
from rosterflow.llm.license_scan import scan_licenses
from rosterflow.llm.line_rules import fit_lines, judge_lines
from rosterflow.llm.minhash_dedup import near_duplicates
from rosterflow.llm.packing import pack_documents
from rosterflow.llm.prefix_trie import prefix_trie
from rosterflow.llm.quality_model import fit_quality, score_quality
from rosterflow.llm.sentencepiece_io import decode_pieces, encode_pieces
from rosterflow.llm.turn_repair import damaged, repair_conversations
from rosterflow.llm.url_rules import judge_urls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with its check."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if check is not None:
            CHECKS[build.__name__] = check
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary file is."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 1024 tokens, with a digest of their ids."""
    pieces = pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = score_quality(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query()
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs.select("doc_id", "text"), fit_language(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query(
    """
WITH lines AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
    FROM documents
), keyed AS (
    SELECT doc_id, line, place,
           translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.last_doc AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
)
def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that others share, as a digest of what is left."""
    kept = drop_shared_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text"), 256).alias("kept_sha256"))


@query()
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents, by sets of two-word shingles."""
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


@query()
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline, from raw documents to packed windows."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


@query()
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices of every document."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query()
def op4_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts over words and lines of every document, and whether rules and lines let it stay."""
    docs = table(spark, sf_dir, "documents")
    model = fit_lines(docs, table(spark, sf_dir, "labels"))
    judged = judge_lines(docs.select("doc_id", "text"), model)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"
    )


@query()
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document in a SentencePiece vocabulary, checked against its library and decoded again."""
    model = tokenizer_file("piece_bpe_32k.model")
    encoded = encode_pieces(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    decoded = decode_pieces(encoded, model)
    return decoded.select(
        "doc_id", "n_ids", F.crc32("ids").alias("ids_crc32"), "parity", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip")
    )


@query()
def op2_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = extract_main_text(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", "n_chars")


@query()
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors of equal labels."""
    found = near_duplicate_vectors(table(spark, sf_dir, "embeddings"), least=0.98)
    return found.select("vec_id", "n_links", "component_id", "kept")


# The rules that the query applies.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    """
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), rest AS (
    SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
           row_number() OVER () AS place
    FROM rest
), best AS (
    SELECT place, arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) AS rule,
           arg_max(rule_verdict, length(rule_host) + length(rule_path)) AS verdict
    FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY place
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN best USING (place)
"""
)
def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    judged = judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query()
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"))


@query()
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every conversation after damage, and the cheapest edits that repair it."""
    conversations = table(spark, sf_dir, "conversations")
    return repair_conversations(damaged(conversations), ids=conversations)
