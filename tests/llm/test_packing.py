import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rosterflow.llm.packing import best_fit_decreasing, cut_to_powers, pack_documents, power_parts
from rosterflow.llm.tokens import encoder


def slow_best_fit(lengths, window):
    left, rooms = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [r for r in range(len(rooms)) if rooms[r] >= lengths[i]]
        if fits:
            r = min(fits, key=lambda r: rooms[r])
        else:
            r = len(rooms)
            rooms.append(window)
            left.append([])
        rooms[r] -= lengths[i]
        left[r].append(i)
    return sorted(rooms)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 37), max_size=60), st.integers(37, 64))
def test_best_fit_decreasing_as_by_search(lengths, window):
    windows = best_fit_decreasing(lengths, window)
    assert sorted(i for w in windows for i in w) == list(range(len(lengths)))
    assert sorted(window - sum(lengths[i] for i in w) for w in windows) == slow_best_fit(lengths, window)


@given(st.integers(0, 5000))
def test_power_parts(total):
    parts = power_parts(total)
    assert sum(parts) == total and all(p & (p - 1) == 0 for p in parts)


def test_cut_to_powers_keeps_every_token():
    windows = cut_to_powers([(0, 0, 300), (1, 0, 401)])
    sizes = [sum(p[2] for p in w) for w in windows]
    assert sizes == [512, 128, 32, 16, 8, 4, 1]
    taken = {0: [], 1: []}
    for w in windows:
        for item, start, length in w:
            taken[item] += range(start, start + length)
    assert taken == {0: list(range(300)), 1: list(range(401))}


def check_pieces(rows, documents, window):
    """Every id lies in exactly one piece, and sequences have no gap."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for i, ids in documents.items():
        pieces = sorted(by_doc.pop(i), key=lambda r: r["start"])
        joined = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in pieces]).tolist()
        assert joined == ids
        assert [r["start"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
        assert all(r["doc_tokens"] == len(ids) and r["length"] == len(r["ids"]) // 4 > 0 for r in pieces)
    assert not by_doc
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in pieces] == np.cumsum([0, *(r["length"] for r in pieces)])[:-1].tolist()
        assert sum(r["length"] for r in pieces) <= window
    return by_sequence


def test_pack_documents(spark, vocabulary, prose):
    path = vocabulary("byte_bpe_50k.json")
    texts = {i: prose(i, 1 + i * i % 900) for i in range(120)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    tokenizer = Tokenizer.from_file(path)
    want = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    for block in (7, 8192):
        rows = pack_documents(docs, path, window=256, block_docs=block).collect()
        sequences = check_pieces(rows, want, 256)
        sizes = [sum(r["length"] for r in s) for s in sequences.values()]
        padding = sum(256 - s for s in sizes if s & (s - 1))
        assert padding < 0.03 * sum(sizes)


def test_pack_odd_documents(odd_docs, no_docs, vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    rows = pack_documents(odd_docs, path).collect()
    single = {r["doc_id"]: r for r in rows if r["doc_tokens"] == 1}
    assert set(single) == {1, 2} and all(r["ids"] == b"\0\0\0\0" for r in single.values())
    assert sum(r["doc_id"] is None and r["start"] == 0 for r in rows) == 2
    assert sum(r["doc_id"] == 5 and r["start"] == 0 for r in rows) == 2
    assert sum(r["length"] for r in rows if r["doc_id"] == 4) == next(r["doc_tokens"] for r in rows if r["doc_id"] == 4)
    assert pack_documents(no_docs, path).count() == 0


def test_encoder_gives_the_ids_of_the_library(vocabulary):
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        path = vocabulary(name)
        tokenizer = Tokenizer.from_file(path)
        for text in ("", " a  b ", "<|endoftext|> x", "it's\t\tI'll \n\n z", "日本語 é 😀", "a\xa0b   c", "x" * 3000, "12²½ ٣"):
            want = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(encoder(path).encode(text), "<u4").tolist() == want


@pytest.mark.parametrize("text", [" " * 2_000_000, "a" + "\n" * 2_000_000 + "b", "word " * 400_000, "x" * 1_000_000])
def test_very_long_texts_encode_as_in_tokenizers(vocabulary, text):
    own = encoder(vocabulary("byte_bpe_50k.json"))
    assert own.encode(text) == np.array(own.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
