"""Licence scan, HTML extraction and SentencePiece."""

import html
import random
import re
import struct
import time

import numpy as np
import pytest

from rosterflow.llm.html_extract import N_FEATURES, TreeModel, default_model, extract_main_text, features, node_labels
from rosterflow.llm.html_tree import parse_page
from rosterflow.llm.labelled_pages import labelled_pages
from rosterflow.llm.license_scan import PHRASES, TEMPLATES, LicenseScanner, license_words, scan_licenses
from rosterflow.llm.sentencepiece_io import PieceCodec, SentencePieceModel, decode_pieces, encode_pieces
from rosterflow.llm.suffix_automaton import SuffixAutomaton

SF = "/root/testdata/sf0.01"


def test_matching_statistics_as_by_search():
    r = random.Random(5)
    for _ in range(40):
        sequences = [[r.randrange(3) for _ in range(r.randrange(1, 14))] for _ in range(3)]
        automaton = SuffixAutomaton(sequences)
        text = [r.randrange(4) for _ in range(40)]
        runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        for end, (length, state) in enumerate(automaton.stream(text), 1):
            want = max((n for n in range(1, end + 1) if tuple(text[end - n : end]) in runs), default=0)
            assert length == want
            if length:
                run = text[end - length : end]
                ends = {k: next((e for e in range(length, len(s) + 1) if s[e - length : e] == run), None) for k, s in enumerate(sequences)}
                assert automaton.ends[state] == {k: e for k, e in ends.items() if e is not None}


def slow_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    places = [(i, label) for phrase, label in PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def test_license_base_as_by_search(spark):
    scanner = LicenseScanner()
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    texts += ["CC-BY cc by. General_Public License, general public license", "ALL rights É reserved all RIGHTS reserved", ""]
    for text in texts:
        got = scanner.scan(text)
        assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == slow_base(text)


def test_licenses_are_found_in_other_text(prose):
    scanner = LicenseScanner()
    for label, template in TEMPLATES:
        got = scanner.scan(f"{prose(1, 80)}\n{template.upper()}\n{prose(2, 300)}")
        assert label in got["labels"].split(",") and got["score"] > 0.9
        span = next(s for s in got["spans"] if s["label"] == label and s["share"] > 0.9)
        assert span["first"] <= 80 and span["end"] >= 80 + 0.9 * len(license_words(template))
    words = TEMPLATES[0][1].split()
    words[20:24] = ["something", "else"]  # a changed passage is bridged
    assert "mit" in scanner.scan(" ".join(words))["labels"]
    assert scanner.scan(prose(3, 3000))["score"] == 0


def test_license_scan_of_odd_documents(odd_docs, no_docs):
    rows = scan_licenses(odd_docs).collect()
    assert len(rows) == 12
    for r in rows:
        if not r["text"]:
            assert (r["n_words"], r["n_base"], r["first_word"], r["labels"], r["score"]) == (0, 0, None, "", 0)
    assert sum(r["base_labels"] == "reserved" for r in rows) == 4
    assert scan_licenses(no_docs).count() == 0


def test_sum_product_as_over_all_labelings():
    from itertools import product

    tree = parse_page("<body><div class=ad><p>one<p>two</div><main>three <ul><li>x</ul></main></body>")
    x = features(tree)
    r = np.random.default_rng(2)
    model = TreeModel(r.normal(size=N_FEATURES), r.normal(size=(2, 2, 2)))
    content, edges = model.messages(tree, x)
    n, total, one = len(tree.tag), 0.0, np.zeros(len(tree.tag))
    pair = np.zeros((n, 4))
    gain = x @ model.weight
    for labels in product((0, 1), repeat=n):
        score = sum(g for g, s in zip(gain, labels) if s)
        score += sum(model.pair[int(tree.tag[i] == "#text"), labels[tree.parent[i]], labels[i]] for i in range(1, n))
        weight = np.exp(score)
        total += weight
        one += weight * np.array(labels)
        for i in range(1, n):
            pair[i, 2 * labels[tree.parent[i]] + labels[i]] += weight
    assert np.allclose(content, one / total)
    for i, _, *both in edges:
        assert np.allclose(both, pair[i] / total)


def test_extraction_learns_its_pages():
    wrong = total = 0
    for page in labelled_pages():
        tree = parse_page(page)
        content, _ = default_model().messages(tree, features(tree))
        texts = [i for i, t in enumerate(tree.tag) if t == "#text"]
        wrong += sum((content[i] >= 0.5) != node_labels(tree)[i] for i in texts)
        total += len(texts)
    assert wrong <= 0.01 * total


def test_extraction_of_all_pages(spark):
    """The pages' articles, cut out by their tags."""
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    for r in extract_main_text(pages).collect():
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S)[1]
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        want = "\n".join(b for b in blocks if b)
        assert r["text"] == want and r["n_chars"] == len(want)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><h1>T &amp; U</h1><p>a\n b<br>c <b>d</b>e</p><div class='user-comments'><p>I like it.</p></div></article>", "T & U\na b c de"),
        ("<div class='cookie-consent'>We use cookies.</div><main><h1>A</h1><p>B &lt;x&gt; &#233;.</p><ul><li>one</li></ul></main>", "A\nB <x> é.\none"),
        ("<body><p>Hello there.<p>World.</body>", "Hello there.\nWorld."),
        ("<article><p>x y z.<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> --></article>", "x y z."),
    ],
)
def test_extraction_of_hand_made_pages(page, text):
    assert default_model().main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<head><title>x</title><p>Article", ["Article"]),
        ("<html><head><meta charset=u><title>x</title>Plain <b>text</b>.", ["Plain text."]),
        ("<head><noscript><link></head><body><p>One<noscript>no</noscript></p>", ["One"]),
        ("<head><title>x</title></head><body><p>One<button>no<b>no</b></p><p>Two</p></body>", ["One", "Two"]),
        ("<body><select><option>no<p>One<p>Two", ["One", "Two"]),
        ("<body><div><object><p>One</p></div><p>Two</p><object><p>no</p></object>", ["One", "Two"]),
        ("<ul><li>One<button>no<li>Two</ul><p>Three</p>", ["One", "Two", "Three"]),
        ("<p>One</p><template><ul><li>no</li></ul><svg>no</svg></template><canvas><p>no</canvas><p>Two", ["One", "Two"]),
    ],
)
def test_open_heads_and_skipped_elements_lose_no_text(page, text):
    tree = parse_page(page)
    assert [t for t, tag in zip(tree.text, tree.tag) if tag == "#text"] == text


def test_extraction_of_odd_pages(spark):
    odd = [None, "", "<", "<p", "</div></p>", "<a href='x", "<![CDATA[ x ]]>", "<script>", "<p>" * 3000, "<div>" * 500 + "x", "plain text", "&#0;&bogus;&#x110000;"]
    pages = spark.createDataFrame([(i, None, p, "t", 1) for i, p in enumerate(odd)], "page_id long, url string, html string, TEXT string, n_chars int")
    rows = {r["page_id"]: r for r in extract_main_text(pages).collect()}
    assert len(rows) == len(odd) and all(r["n_chars"] == len(r["text"]) for r in rows.values())
    assert rows[0]["text"] == rows[1]["text"] == "" and rows[10]["text"] == "plain text"
    assert extract_main_text(pages.limit(0)).count() == 0


def piece(text, score, kind):
    body = b"\x0a" + bytes([len(text.encode())]) + text.encode() + b"\x15" + struct.pack("<f", score) + b"\x18" + bytes([kind])
    return b"\x0a" + bytes([len(body)]) + body


def unigram_model():
    """A small unigram model with byte fallback, written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    words = ("▁", "a", "b", "ab", "▁a", "▁ab", "abb", "c", "bc", "▁the", "he", "t", "h", "e", "er")
    pieces += [(w, -1.0 - 0.37 * i, 1) for i, w in enumerate(words)]
    trainer = b"\x18\x01" + b"\x98\x02\x01"  # unigram; byte fallback
    normaliser = b"\x0a\x08identity" + b"\x18\x01\x20\x00\x28\x01"
    return b"".join(piece(*p) for p in pieces) + b"\x12" + bytes([len(trainer)]) + trainer + b"\x1a" + bytes([len(normaliser)]) + normaliser


@pytest.mark.parametrize("kind", ["bpe", "unigram"])
def test_pieces_have_parity_and_round_trip(kind, vocabulary, tmp_path):
    path = vocabulary("piece_bpe_32k.model")
    if kind == "unigram":
        path = str(tmp_path / "unigram.model")
        (tmp_path / "unigram.model").write_bytes(unigram_model())
    codec = PieceCodec(path)
    texts = ["", "a", "abab bc the", " ab", "ab  c ", "\n\tx", "é 😀 日本語", "<s> <unk> <0x0A>", "the her cabb"]
    texts += [" " * k + "ab" + " " * (70 - k) for k in range(0, 70, 3)]
    packed = codec.encode(texts)
    assert all(codec.same_as_library(texts, packed))
    assert codec.decode(packed) == texts


def test_pieces_of_odd_documents(odd_docs, no_docs, vocabulary):
    path = vocabulary("piece_bpe_32k.model")
    rows = decode_pieces(encode_pieces(odd_docs, path), path).collect()
    assert len(rows) == 12
    for r in rows:
        assert r["decoded"] == r["text"] and r["parity"] is (None if r["text"] is None else True)
        assert r["n_ids"] == (None if r["text"] is None else len(r["ids"]) // 4)
    assert encode_pieces(no_docs, path).count() == 0


def test_bad_model_files_are_refused():
    with pytest.raises(ValueError, match="supported"):
        SentencePieceModel.parse(piece("x", 0.0, 4))


@pytest.mark.parametrize("first", ["<p data-x=don't>", '<p class=a">', '<p title="a > b">', "<p a='x>y' b>", '<p a = "x">', '<p ">', '<p "a=b>'])
def test_stray_quotes_cost_no_text(first):
    paragraphs = [f"Paragraph {i} of the article tells a long story, with commas, and ends here." for i in range(3)]
    last = '<p>It\'s <b>super<wbr>cali</b> fo<img src=x>ur, <math><mi>x</mi></math> is one of them, it "works".</p>'
    page = "<html><body><article>" + first + "</p><p>".join(paragraphs) + "</p>" + last + "</article></body></html>"
    assert default_model().main_text(page).split("\n") == [*paragraphs, 'It\'s supercali four, x is one of them, it "works".']


def test_deep_pages_take_time_in_proportion():
    begun = time.process_time()
    for page in ("<div>" * 30_000 + "<p>x" * 30_000, "<div></section>" * 30_000, '<p a="x ' * 30_000, "<ul><li>" * 30_000 + "<li>" * 30_000):
        parse_page(page)
    assert time.process_time() - begun < 30


def test_words_of_pieces_that_are_encoded_together(vocabulary):
    codec = PieceCodec(vocabulary("piece_bpe_32k.model"))
    texts = ["a b a", "<s> x </s> \u2581", "x" * 5000 + " y", "\u00e9 \u65e5\u672c\u8a9e \U0001f600", "tab\tline\nend", "\x00 \ud7ff", " ".join(f"w{i}" for i in range(3000))]
    packed, same = codec.encode_and_verify(texts)
    assert all(same) and packed == [np.array(codec.library.encode(t), dtype="<u4").tobytes() for t in texts]
    assert codec.decode(packed)[:1] + codec.decode(packed)[2:] == texts[:1] + texts[2:]
    assert codec.decode([]) == [] and codec.decode([b""]) == [""]
