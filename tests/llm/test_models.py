"""Quality classifier, language ID and line rules: held-out accuracy, brute force and odd input."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rosterflow.llm.boosting import fit_trees
from rosterflow.llm.common import held_out
from rosterflow.llm.language_id import fit_language, identify_language, subwords
from rosterflow.llm.line_rules import LineModel, N_FEATURES, base_counts, fit_lines, judge_lines, train
from rosterflow.llm.quality_model import fit_quality, score_quality, text_statistics

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_trees_traverse_as_one_by_one():
    random = np.random.default_rng(1)
    x = random.normal(size=(600, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    model = fit_trees(x, y, trees=40, depth=3)
    assert ((model.probability(x) > 0.5) == y).mean() > 0.95
    for row in x[:50]:
        margin = model.base
        for feature, threshold, leaf in zip(model.feature, model.threshold, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            margin += leaf[node - len(feature)]
        assert model.margin(row[None])[0] == pytest.approx(margin)


def test_trees_without_rows_or_with_one_class():
    assert fit_trees(np.zeros((0, 3)), np.zeros(0)).probability(np.zeros((2, 3))) == pytest.approx([0.5, 0.5])
    assert (fit_trees(np.ones((9, 3)), np.ones(9)).probability(np.ones((2, 3))) > 0.8).all()


def test_quality_on_held_out_documents(docs, labels):
    model = fit_quality(docs, labels)
    rows = (
        score_quality(docs.join(labels, "doc_id"), model)
        .filter(held_out(F.col("doc_id")) & F.col("quality").isNotNull())
        .select("quality", "predicted", "score")
        .collect()
    )
    assert len(rows) > 60
    assert np.mean([r["quality"] == r["predicted"] for r in rows]) > 0.95


def test_quality_of_odd_documents(odd_docs, no_docs, docs, labels):
    model = fit_quality(docs, labels)
    out = score_quality(odd_docs, model)
    assert out.columns == ["doc_id", "text", "lang", "Kept", "n_words", "ids", "a.b `c`", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == 12 and all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert score_quality(no_docs, model).count() == 0
    assert not text_statistics("").any()
    empty = fit_quality(docs.limit(0), labels.limit(0))
    assert score_quality(odd_docs, empty).count() == 12


def test_language_on_held_out_documents(docs):
    model = fit_language(docs)
    rows = identify_language(docs, model).filter(held_out(F.col("doc_id"))).select("lang", "lang_pred", "score", "rejected").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert np.mean([r["rejected"] for r in rows]) < 0.03


def test_rare_languages_are_learnt(spark, prose):
    rows = [(i, prose(i, 40), "common") for i in range(600)] + [(1000 + i, "one and the same text", "copies") for i in range(600)]
    rows += [(2000 + i, f"zuxq vyxzu quzvyx{i} xuzyq vuzqy", "rare") for i in range(8)]
    model = fit_language(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_rows=60)
    assert model.languages == ["common", "copies", "rare"]


def test_language_of_odd_documents(odd_docs, no_docs, docs):
    model = fit_language(docs)
    rows = identify_language(odd_docs, model).collect()
    assert len(rows) == 12
    for r in rows:
        letters = any(map(str.isalpha, r["text"] or ""))
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score"] <= 1 and (letters or (r["score"] == 0 and r["rejected"]))
    assert identify_language(no_docs, model).count() == 0
    unknown = fit_language(odd_docs)  # no row has a language
    assert {r["lang_pred"] for r in identify_language(odd_docs, unknown).collect()} == {"und"}


def test_subwords_as_by_slices():
    words = ["ab", "c", "wörld", "éé"]
    bucket, of = subwords(words, 1 << 16)
    for i, word in enumerate(words):
        marked = f" {word} "
        grams = [marked[a : a + n] for n in (2, 3, 4) for a in range(len(marked) - n + 1)] + list(word)
        assert (of == i).sum() == len(grams)
    again, _ = subwords(["wörld"], 1 << 16)
    assert sorted(bucket[of == 2]) == sorted(again)


def slow_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_base_counts_as_by_search(spark, docs, prose):
    texts = [r["text"] for r in docs.select("text").collect()]
    texts += ["", " ", "a b c d e f g h a b c d e f g h", "x\n\nx\n x\nx", "é é |#|", "a " * 30, prose(1, 50) + "\n" + prose(1, 50)]
    for text in texts:
        assert base_counts(text) == slow_counts(text)


def test_viterbi_as_over_all_paths():
    from itertools import product

    random = np.random.default_rng(3)
    model = LineModel(random.normal(size=N_FEATURES), random.normal(size=(2, 2)))
    for n in (0, 1, 2, 5, 7):
        x = random.normal(size=(n, N_FEATURES))
        gain = x @ model.weight

        def value(path):
            return sum(gain[i] for i, s in enumerate(path) if s) + sum(model.move[a, b] for a, b in zip(path, path[1:]))

        best = max(product((0, 1), repeat=n), key=value)
        assert model.decode(x) == [bool(s) for s in best]


def test_field_learns_runs():
    random = np.random.default_rng(4)
    sequences = []
    for _ in range(60):
        y = np.repeat(random.integers(0, 2, 4), random.integers(1, 6, 4))
        x = random.normal(size=(len(y), N_FEATURES)) * 0.5
        x[:, 3] += 2 * y - 1
        sequences.append((x, y))
    model = train(sequences[:40])
    right = [np.mean(np.array(model.decode(x)) == y) for x, y in sequences[40:]]
    assert np.mean(right) > 0.95
    assert model.move[0, 0] + model.move[1, 1] > model.move[0, 1] + model.move[1, 0]


def test_line_rules_keep_good_and_reject_bad(docs, labels):
    model = fit_lines(docs, labels)
    rows = judge_lines(docs, model).join(labels, "doc_id").select("quality", "base_failed", "kept", "n_words", "n_repeat_words").collect()
    assert all(r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"]) for r in rows)
    passed = [r for r in rows if not r["base_failed"]]
    assert np.mean([r["kept"] for r in passed if r["quality"] == 1]) > 0.97
    assert np.mean([r["kept"] for r in passed if r["quality"] == 0]) < 0.1


def test_line_rules_of_odd_documents(odd_docs, no_docs, docs, labels):
    model = fit_lines(docs, labels)
    out = judge_lines(odd_docs, model)
    rows = out.collect()
    assert len(rows) == 12 and [c.lower() for c in out.columns].count("kept") == 1
    for r in rows:
        n = len((r["text"] or "").encode().split())
        assert r["n_words"] == n and r["base_failed"] >= (n < 20)
        assert n or not r["kept"] and r["content_share"] == 0
    assert judge_lines(no_docs, model).count() == 0
    assert judge_lines(odd_docs, fit_lines(docs.limit(0), labels.limit(0))).count() == 12
