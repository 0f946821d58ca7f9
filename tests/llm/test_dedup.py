"""Line dedup, MinHash near-dedup, embedding near-dedup and components."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rosterflow.llm.components import connected_components
from rosterflow.llm.embedding_dedup import near_duplicate_vectors
from rosterflow.llm.flat_graph import build_graph, medoid, range_search
from rosterflow.llm.line_dedup import drop_shared_lines, line_index, line_key, line_keys
from rosterflow.llm.minhash_dedup import (
    drop_near_duplicates,
    estimates,
    linked,
    linked_sets,
    minima,
    near_duplicates,
    packed_bits,
    shingles,
    signature_words,
)
from rosterflow.llm.perfect_hash import PerfectHash


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_paths_stars_and_rings(spark):
    r = random.Random(1)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 700)] + [(900 + i, 900 + (i + 1) % 9) for i in range(9)]
    links += [(r.randrange(2000, 2100), r.randrange(2000, 2100)) for _ in range(60)] + [(7, 7)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = {x["node"]: x["label"] for x in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == components(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=300))
def test_perfect_hash_is_minimal_and_perfect(keys):
    keys = np.array(sorted(keys), dtype=np.uint64)
    hashed = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
    assert sorted(hashed.find(keys).tolist()) == list(range(len(keys)))
    assert (hashed.find(np.arange(1000, dtype=np.uint64)) < len(keys)).all()


def test_perfect_hash_refuses_repeated_keys():
    with pytest.raises(ValueError, match="distinct"):
        PerfectHash.build(np.array([5, 5], dtype=np.uint64))


def test_the_line_index_holds_every_distinct_key_with_its_count(spark):
    texts = {i: "\n".join(f"line number {j} of many" for j in range(i, i + 7)) for i in range(40)}
    held = defaultdict(set)
    for doc, text in texts.items():
        for line in text.split("\n"):
            held[line_key(line, 20)].add(doc)
    keys = line_keys(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "doc_id", "text", 20)
    counted = keys.groupBy("hi", "lo").agg(F.count("*").alias("n_docs"), F.max("doc").alias("last_doc"))
    shards = {x["shard"]: x for x in line_index(counted, 5).collect()}
    sizes = {s: len(np.frombuffer(x["prints"], np.int64)) for s, x in shards.items()}
    assert sum(sizes.values()) == len(held) and any(len(d) == 1 for d in held.values())
    for (hi, lo), docs in held.items():
        x = shards[hi % 5]
        at = PerfectHash.from_bytes(x["hash"]).find(np.array([lo], np.int64).view(np.uint64))[0]
        values = [int(np.frombuffer(x[c], np.int64)[at]) for c in ("prints", "counts", "lasts")]
        assert values == [hi, len(docs), max(docs)]


SPACES = " \t\n\x0b\x0c\r"


def slow_lines(rows):
    """(n_lines, n_dropped, sha256) per row of (doc, text)."""
    holders = defaultdict(list)

    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACES))

    for doc, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            holders[k].append(doc)
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for x in lines:
            k = key(x)
            known = [d for d in holders[k] if d is not None]
            last = max(known) if known else None
            if not (len(k) >= 20 and len(holders[k]) >= 3 and doc != last):
                kept.append(x)
        text = "\n".join(kept)
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def lines_of(df):
    rows = drop_shared_lines(df).select("doc_id", "n_lines", "n_dropped", "text").collect()
    return sorted(((r[0], r[1], r[2], hashlib.sha256(r[3].encode()).hexdigest()) for r in rows), key=repr)


def test_shared_lines_as_by_search(spark, odd_docs):
    r = random.Random(2)
    lines = [f"a line number {i} that is long enough" for i in range(12)] + ["short", "", "  A LINE number 3 that is long enough\t", "É line of twenty ünits"]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randrange(8)))) for i in range(90)]
    # One line that every second document holds twice, and the exact lengths around the least one.
    rows += [(200 + i, ("x" * 20 + "\n") * 2 + "y" * 19) for i in range(60)]
    assert lines_of(spark.createDataFrame(rows, "doc_id long, text string")) == slow_lines(rows)
    odd = [(x["doc_id"], x["text"]) for x in odd_docs.select("doc_id", "text").collect()]
    assert lines_of(odd_docs) == slow_lines(odd)


def test_shared_lines_keep_columns(odd_docs, no_docs):
    out = drop_shared_lines(odd_docs)
    assert out.columns == [*odd_docs.columns, "n_lines", "n_dropped"]
    assert drop_shared_lines(no_docs).count() == 0


def word_set(text, words):
    found = (text or "").encode().lower().split()
    n = min(words, len(found))
    return {tuple(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set()


def slow_near(rows, words, percent):
    sets = {d: word_set(t, words) for d, t in rows}
    ids = [d for d in sets if sets[d]]
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[:i]
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return {d: (len(sets[d]), c) for d, c in components(sets, links).items()}


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_as_by_search(spark, prose, words):
    r = random.Random(words)
    rows = []
    for base in range(12):
        text = prose(base, 60 + 30 * base).split()
        for _ in range(1 + base * 2):
            copy = list(text)
            for _ in range(r.randrange(len(copy) // 12)):
                copy[r.randrange(len(copy))] = f"new{r.randrange(999)}"
            rows.append((r.randrange(10**9), " ".join(copy)))
    # A large family whose members differ from the first one too much to be linked with it, but not from each other.
    text = prose(99, 200).split()
    for i in range(300):
        rows.append((10**9 + i, " ".join(text[i // 10 : i // 10 + 150]) + f" end{i}"))
    rows += [(5 * 10**9 + i, "one and the same text") for i in range(40)] + [(6 * 10**9, "Word"), (6 * 10**9 + 1, "word"), (7 * 10**9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_duplicates(df, words).collect()}
    assert got == slow_near(rows, words, 80)


def test_near_duplicates_of_odd_documents(odd_docs, no_docs):
    rows = near_duplicates(odd_docs, 2).collect()
    assert len(rows) == 12
    by_id = defaultdict(list)
    for x in rows:
        by_id[x["doc_id"]].append((x["n_shingles"], x["component_id"], x["kept"]))
    assert by_id[1] == by_id[2] == [(0, by_id[1][0][1], True)] or by_id[1] == [(0, 1, True)] and by_id[2] == [(0, 2, True)]
    assert len(by_id[5]) == 2 and {c for _, c, _ in by_id[5]} == {5} and by_id[6][0][1:] == (5, False)
    assert all(c is None and k for _, c, k in by_id[None])
    kept = drop_near_duplicates(odd_docs, 2)
    assert kept.columns == odd_docs.columns and kept.count() == 11
    assert near_duplicates(no_docs).count() == 0


def test_other_text_of_a_repeated_id_is_not_lost(spark):
    rows = [(3, "one two three four"), (5, "one two three four"), (5, "something else entirely here"), (6, "one two three four")]
    kept = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2)
    assert sorted(map(tuple, kept.collect())) == rows[:3]


def test_sets_and_estimates(prose):
    texts = [prose(1, 400), prose(1, 400) + " more words here", prose(2, 400), "one two three four five six seven", "a b"]
    sets = [shingles(t, 2) for t in texts]
    pairs = linked_sets(sets, 80)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert pairs[i, j] == (i != j and linked(a, b, 80))
    words = signature_words([packed_bits(minima(s)) for s in sets])
    found = estimates(words[:, None], words[None, :])
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert abs(found[i, j] - both / (len(a) + len(b) - both)) < 0.2


def test_range_search_recall():
    random_state = np.random.default_rng(8)
    centre = random_state.normal(size=(40, 24))
    v = np.concatenate([c + 0.05 * random_state.normal(size=(30, 24)) for c in centre])
    v /= np.sqrt((v**2).sum(axis=1, keepdims=True))
    graph, start = build_graph(v), None
    start = medoid(v)
    found = want = 0
    for q in v[::7]:
        exact = set(np.flatnonzero(v @ q >= 0.98).tolist())
        got = set(range_search(v, graph, start, q, 0.98).tolist())
        assert got <= exact
        found, want = found + len(got), want + len(exact)
    assert found >= 0.9 * want


def slow_vectors(rows):
    """(n_links, component) by id, for distinct ids."""
    good = {}
    for i, v, label in rows:
        if v is None or label is None or None in v:
            continue
        v = np.array(v, dtype=float)
        if len(v) and np.isfinite(v).all() and v.any():
            v = v / np.abs(v).max()
            good[i] = (label, v / np.sqrt(v @ v))
    ids = list(good)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if good[a][0] == good[b][0] and len(good[a][1]) == len(good[b][1]) and good[a][1] @ good[b][1] >= 0.98]
    count = {i: 0 for i, _, _ in rows}
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {i: (count[i], c) for i, c in components([i for i, _, _ in rows], links).items()}


def test_vectors_as_by_search(spark):
    r = np.random.default_rng(6)
    rows, number = [], iter(range(1, 10**6))
    for group in range(60):
        centre = r.normal(size=16)
        for k in range(1 + group % 9):
            rows.append((next(number) * 7919 % 100_003, (centre + 0.02 * group / 10 * r.normal(size=16)).tolist(), group % 3))
    chain = [np.array([np.cos(0.15 * k), np.sin(0.15 * k)] + [0.0] * 14) for k in range(20)]  # linked only with their neighbours
    rows += [(200_000 - k, v.tolist(), 1) for k, v in enumerate(chain)]
    hot = r.normal(size=16)
    rows += [(300_000 + k, (hot + 0.001 * r.normal(size=16)).tolist(), 2) for k in range(150)] + [(310_000 + k, hot.tolist(), 2) for k in range(50)]
    nan, inf = float("nan"), float("inf")
    odd = [None, [], [0.0] * 16, [nan] + [1.0] * 15, [inf] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e300] * 16, [1e-300] * 16]
    rows += [(400_000 + k, v, 1) for k, v in enumerate(odd)] + [(500_000, hot.tolist(), None), (500_001, hot.tolist(), 7)]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], "vec_id long, embedding array<double>, label int, kept string, id int")
    want = slow_vectors(rows)
    for shard_rows in (1000, 20):
        found = near_duplicate_vectors(df, shard_rows=shard_rows).collect()
        assert {x["vec_id"]: (x["n_links"], x["component_id"]) for x in found} == want
        assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in found)


def arcs():
    """Rows of vectors along circles in 32 planes, each linked only with the ones before and after it, under shuffled ids."""
    r = np.random.default_rng(12)
    rows, ids = [], iter(r.permutation(10**4).tolist())
    for plane in range(32):
        start = r.uniform(0, 6)
        for k in range(20):
            v = np.zeros(64)
            v[2 * plane], v[2 * plane + 1] = np.cos(start + 0.19 * k), np.sin(start + 0.19 * k)
            rows.append((next(ids), v.tolist(), 1))
    return rows


def test_groups_across_borders_have_all_links(spark):
    rows = arcs()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = near_duplicate_vectors(df, shard_rows=10).collect()
    assert {x["vec_id"]: x["n_links"] for x in found} == {i: n for i, (n, _) in slow_vectors(rows).items()}


def test_links_found_from_one_side_join_components(spark):
    rows = arcs()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = near_duplicate_vectors(df, shard_rows=10).collect()
    assert {x["vec_id"]: x["component_id"] for x in found} == {i: c for i, (_, c) in slow_vectors(rows).items()}


def test_vectors_without_id_repeated_or_none(spark):
    schema = "vec_id long, embedding array<double>, label int"
    rows = [(None, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.01], 1)]
    found = sorted(map(tuple, near_duplicate_vectors(spark.createDataFrame(rows, schema)).select("vec_id", "n_links", "component_id", "kept").collect()), key=repr)
    assert found == [(3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (None, 0, None, True)]
    assert near_duplicate_vectors(spark.createDataFrame([], schema)).count() == 0
