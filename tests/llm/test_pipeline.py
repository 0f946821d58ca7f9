"""The registered queries of the subpackage, and the pipeline against its operators."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rosterflow.llm.queries import CHECKS, QUERIES
from tools.check_queries import TABLES, canonical

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_packing": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
    "op2_html_extract": ["page_id", "url", "text", "n_chars"],
    "op3_license_scan": ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"],
    "op4_line_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op5_sentencepiece": ["doc_id", "n_ids", "ids_crc32", "parity", "round_trip"],
    "op6_quality": ["doc_id", "held_out", "score", "predicted"],
    "op7_embedding_dedup": ["vec_id", "n_links", "component_id", "kept"],
    "op8_line_dedup": ["doc_id", "n_lines", "n_dropped", "kept_sha256"],
    "op9_minhash_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op10_language": ["doc_id", "held_out", "lang_pred", "score"],
    "op11_url_rules": ["page_id", "host", "path", "rule", "verdict"],
    "op12_prefix_trie": ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
    "op13_turn_repair": ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"],
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_query_has_the_columns_and_all_rows(spark, name):
    df = QUERIES[name](spark, SF)
    assert df.columns[: len(COLUMNS[name])] == COLUMNS[name]
    source = {"op2": "pages", "op7": "embeddings", "op11": "pages", "op12": "conversations", "op13": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF}/{source}.parquet")
    ids = rows.select(rows.columns[0]).distinct()
    if name == "op12_prefix_trie":
        # The root has all conversations as members.
        assert df.filter("depth = 0").select("n_convs").first()[0] == ids.count()
        return
    assert df.select(df.columns[0]).distinct().count() == ids.count()
    if name == "op5_sentencepiece":
        assert df.filter("NOT parity OR NOT round_trip").count() == 0


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_as_in_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert canonical(QUERIES[name](spark, SF).toPandas()) == canonical(con.sql(CHECKS[name]).df())


def test_all_queries_are_registered():
    assert set(QUERIES) == {*COLUMNS, "pipeline"}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "language_id", "line_dedup", "minhash_near_dedup", "packing"]


def test_stages_keep_columns_and_decide(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", F.lit("own")).withColumn("kept", F.lit(1))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    before, stages = docs, dict(corpus_pipeline.STAGES)
    for name in ("quality_classifier", "language_id", "line_dedup", "minhash_near_dedup"):
        stages[name](spark, before, SF).write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        assert after.filter("score <> 'own' OR kept <> 1").count() == 0
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids <= {r[0] for r in before.select("doc_id").collect()}
        if name == "quality_classifier":
            bad = {r[0] for r in labels.filter("quality = 0").select("doc_id").collect()}
            good = {r[0] for r in labels.filter("quality = 1").select("doc_id").collect()}
            assert len(ids & bad) <= 0.2 * len(bad) and len(ids & good) >= 0.95 * len(good)
        if name == "line_dedup":
            assert after.count() == before.count() and after.filter("n_chars <> char_length(text)").count() == 0
        before = after
    pieces = stages["packing"](spark, before, SF)
    assert {r[0] for r in pieces.select("doc_id").distinct().collect()} == {r[0] for r in before.select("doc_id").collect()}


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def made_docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "src", 0) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.mark.parametrize("name", ["quality_classifier", "language_id"])
def test_filters_that_learnt_nothing_keep_all(spark, name, tmp_path):
    docs = made_docs(spark, [(i, f"some plain text number {i} about nothing", None) for i in range(60)])
    spark.read.parquet(f"{SF}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    kept = dict(corpus_pipeline.STAGES)[name](spark, docs, str(tmp_path))
    assert kept.count() == 60 and kept.columns == docs.columns


def test_stages_take_odd_rows(spark):
    long = "word " * 300_000 + "\n" * 200_000 + " " * 150_000
    odd = [(None, "no id here at all", "en"), (-1, None, None), (-2, "", "en"), (-3, " \n\t ", "en"), (-4, long, "en"), (-5, "twice", "en"), (-5, "twice", "en")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(made_docs(spark, odd))
    stages = dict(corpus_pipeline.STAGES)
    for name in ("quality_classifier", "language_id", "line_dedup", "minhash_near_dedup"):
        kept = stages[name](spark, docs, SF)
        assert kept.columns == docs.columns
        n = kept.filter("text IS NULL OR text IS NOT NULL").count()
        assert 0 < n <= docs.count() and (name != "line_dedup" or n == docs.count())
    pieces = stages["packing"](spark, docs, SF)
    assert pieces.filter("doc_id = -4").agg(F.sum("length")).first()[0] == pieces.filter("doc_id = -4").first()["doc_tokens"]
