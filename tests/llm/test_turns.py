import random

import pytest
from plain_turns import cheapest_by_states, plain_repair, plain_trie  # noqa: F401
from pyspark.sql import types as T

from rosterflow.llm import turns as turns_module
from rosterflow.llm.align import cheapest_edits
from rosterflow.llm.prefix_trie import prefix_trie
from rosterflow.llm.turn_repair import damaged, repair_conversations

SCHEMA = T.StructType(
    [
        T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()), T.StructField("depth", T.StringType()), T.StructField("Audit", T.StringType()),
    ]
)


def rows_of(seed, convs=90, no_id=True):
    """Conversations with shared beginnings, copies, ties, nulls, odd roles and one that is long."""
    r = random.Random(seed)
    texts = ["a b.", "a b.", "What?", "no end", "", " \t", None, "é 日本 😀!", "x " * 3000 + "."]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "User", "sage"]
    made = []
    for c in range(convs):
        for t in range(r.choice([0, 1, 2, 3, 5, 8]) if c != 40 else 700):
            role = ["user", "assistant"][t % 2] if r.random() < 0.8 else r.choice(roles)
            made.append((c if c % 9 else -c, t if r.random() < 0.9 else r.choice([None, 0, 3]), role, r.choice(texts), "d", "a"))
    made += [(7, 1, "user", "copy.", "d", "a")] * 3
    if no_id:
        made += [(None, 1, "user", "who?", "d", "a"), (None, None, None, None, "d", "a")]
    return made


@pytest.mark.parametrize("piece", [8192, 5])
def test_trie_against_plain_python(spark, piece, monkeypatch):
    monkeypatch.setattr(turns_module, "COLD_ROWS", 10)
    rows = rows_of(1)
    got = [tuple(r) for r in prefix_trie(spark.createDataFrame(rows, SCHEMA), piece).collect()]
    assert sorted(got, key=repr) == sorted(plain_trie([r[:4] for r in rows]), key=repr)


def test_trie_of_a_deep_and_a_wide_tree(spark, monkeypatch):
    monkeypatch.setattr(turns_module, "COLD_ROWS", 10)
    deep = [(c, t, "user", f"t{t}", "", "") for c in (20, 40) for t in range(90 if c == 20 else 60)]
    wide = [(60 + 20 * c, t, "user", "t0" if t == 0 else f"w{c}", "", "") for c in range(80) for t in range(2)]
    rows = deep + wide
    got = [tuple(r) for r in prefix_trie(spark.createDataFrame(rows, SCHEMA), 7).collect()]
    assert sorted(got, key=repr) == sorted(plain_trie([r[:4] for r in rows]), key=repr)


def test_trie_of_nothing(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("block", [256, 3, 1])
def test_edits_against_states(block):
    r = random.Random(block)
    for _ in range(2000):
        codes = "".join(r.choice("suaoSUAOxuaua") for _ in range(r.randrange(13)))
        assert cheapest_edits(codes, block) == cheapest_by_states(codes), codes
    long = "".join(r.choice("uuUxs") if r.random() < 0.2 else "ua"[i % 2] for i in range(900))
    assert cheapest_edits(long, max(block, 16)) == cheapest_by_states(long)


def test_repair_against_plain_python(spark):
    rows = rows_of(2) + [(1000 + c, 0, "user", "gone.", "d", "a") for c in range(60)]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = [tuple(r) for r in repair_conversations(damaged(frame), ids=frame).collect()]
    assert sorted(got, key=repr) == sorted(plain_repair([r[:4] for r in rows]), key=repr)
    assert any(g[7] == "" for g in got) and max(len(g[7]) for g in got) > 600


def test_repair_of_sound_and_of_no_rows(spark):
    sound = [(1, 0, "system", "Be brief.", "", ""), (1, 1, "user", "Why?", "", ""), (1, 2, "assistant", "So.", "", "")]
    found = repair_conversations(spark.createDataFrame(sound, SCHEMA)).first()
    assert tuple(found)[:8] == (1, 0, 0, 0, 0, 0, 0, "KKK")
    assert repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
