"""Language of documents: averaged embeddings of hashed subwords under a linear softmax."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.common import col, learnable, parts_of, replace_columns, saved, ship, texts_of

UNKNOWN = "und"
LONGEST = 4
# Sizes, in words, of the pieces of a text that are learnt from, in turn.
PIECE_WORDS = (24, 12, 6, 3)
MIX = np.uint64(0x9E3779B97F4A7C15)


def split_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-case words of all texts, and for each word met its code and its text."""
    array = pa.array(texts, pa.large_string())
    spaced = pc.utf8_trim(pc.replace_substring_regex(pc.utf8_lower(array), r"[^\pL]+", " "), " ")
    words = pc.split_pattern(spaced, " ")
    counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    codes, owner = coded.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(texts)), counts)
    distinct = coded.dictionary.to_pylist()
    if "" in distinct:  # of texts without a letter
        met = codes != distinct.index("")
        codes, owner = codes[met], owner[met]
    return distinct, codes, owner


def subwords(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the subwords of 1 to 4 characters of each word, with its ends marked, and the word of each."""
    points = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    space = points == 32
    word = np.cumsum(space) - 1
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    found, owners = [], []
    rolled = np.zeros(len(points), dtype=np.uint64)
    for n in range(1, LONGEST + 1):
        size = len(points) - n + 1
        if size <= 0:
            break
        rolled = (rolled[:size] * np.uint64(1_000_003)) ^ points[n - 1 :]
        if n == 1:
            good, at = ~space, word
        elif n == 2:
            good = ~(space[:-1] & space[1:])
            at = np.where(space[:-1], word[1:], word[:-1])
        else:
            good = np.ones(size, dtype=bool)
            for inner in range(1, n - 1):
                good &= ~space[inner : inner + size]
            at = word[1 : 1 + size]
        mixed = (rolled[good] + np.uint64(n)) * MIX
        mixed ^= mixed >> np.uint64(29)
        found.append(((mixed * MIX) >> shift).astype(np.int64))
        owners.append(at[:size][good])
    return np.concatenate(found), np.concatenate(owners)


@dataclass
class LanguageModel:
    """``table`` is the product of embeddings and softmax weights, one row per bucket."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Logits of each text, and whether it has a letter."""
        n, k = len(texts), len(self.languages)
        words, codes, owner = split_words(texts)
        out = np.tile(self.bias, (n, 1)).astype(float)
        if not len(codes):
            return out, np.zeros(n, dtype=bool)
        bucket, of = subwords(words, len(self.table))
        size = np.bincount(of, minlength=len(words))
        total = np.bincount(owner, size[codes], n)
        for i in range(k):
            of_word = np.bincount(of, self.table[bucket, i], len(words))
            out[:, i] += np.bincount(owner, of_word[codes], n) / np.maximum(total, 1)
        return out, total > 0

    def predict(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Index of the likeliest language (-1 without a letter) and its calibrated probability."""
        if not texts or not self.languages:
            return np.full(len(texts), -1), np.zeros(len(texts))
        logits, known = self.logits(texts)
        p = softmax(logits / self.temperature)
        best = p.argmax(1)
        return np.where(known, best, -1), np.where(known, p[np.arange(len(p)), best], 0.0)


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def pieces_of(text: str, most: int) -> list[str]:
    """At most ``most`` short pieces of a text, spread over the whole of it."""
    words = text.split()
    spread = np.linspace(0, max(0, len(words) - PIECE_WORDS[0]), most).astype(int)
    found = [" ".join(words[s : s + PIECE_WORDS[i % len(PIECE_WORDS)]]) for i, s in enumerate(spread)]
    return list(dict.fromkeys(p for p in found if any(map(str.isalpha, p))))


def train(
    texts: list[str],
    y: np.ndarray,
    languages: list[str],
    buckets: int = 1 << 16,
    dim: int = 16,
    epochs: int = 4,
    rate: float = 0.5,
    spread: float = 10.0,
    batch: int = 64,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Embeddings times weights, and bias, by stochastic gradient descent on the mean log loss.

    A subword gets a small share of each gradient, so embeddings move ``spread`` times as fast.
    """
    random = np.random.default_rng(seed)
    embedding = random.uniform(-0.5, 0.5, (buckets, dim)).astype(np.float32) / dim
    weight = np.zeros((dim, len(languages)), dtype=np.float32)
    bias = np.zeros(len(languages), dtype=np.float32)
    words, codes, owner = split_words(texts)
    bucket, of = subwords(words, buckets)
    order = np.argsort(of, kind="stable")
    bucket, starts = bucket[order], np.searchsorted(of[order], np.arange(len(words) + 1))
    begin = np.searchsorted(owner, np.arange(len(texts) + 1))
    steps, step = epochs * -(-len(texts) // batch), 0
    for _ in range(epochs):
        shuffled = random.permutation(len(texts))
        for at in range(0, len(texts), batch):
            rows = shuffled[at : at + batch]
            ids = [np.concatenate([bucket[starts[c] : starts[c + 1]] for c in codes[begin[r] : begin[r + 1]]]) for r in rows]
            sizes = np.array([len(i) for i in ids])
            flat, row = np.concatenate(ids), np.repeat(np.arange(len(rows)), sizes)
            hidden = np.add.reduceat(embedding[flat], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
            error = softmax(hidden @ weight + bias)
            error[np.arange(len(rows)), y[rows]] -= 1
            lr = rate * (1 - step / steps)
            back = error @ weight.T / sizes[:, None]
            weight -= lr / len(rows) * (hidden.T @ error)
            bias -= lr / len(rows) * error.sum(0)
            np.add.at(embedding, flat, (-lr * spread * back[row]).astype(np.float32))
            step += 1
    return embedding @ weight, bias


def fit_language(
    docs: DataFrame,
    most_rows: int = 3_000,
    least_rows: int = 20,
    pieces: int = 8,
    wrong_rejects: float = 0.001,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "lang",
) -> LanguageModel:
    """A model of the languages of a bounded sample of labelled rows.

    Every language of a row that may be learnt from (``learnable``) is known to the model. Of each, equal shares of
    ``most_rows`` texts are taken, but ``least_rows`` if a share is smaller, each text once, in the
    order of a hash of the id, and at most ``pieces`` pieces of 3 to 24 words of each reach the
    driver. A fifth of them sets the temperature of the probabilities and the probability below which
    a prediction is rejected: the largest that rejects at most ``wrong_rejects`` of the right ones.
    Without any such row the model knows no language and predicts none.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("array<string>")
    def cut(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([pieces_of(t, pieces) for t in texts_of(batch)], pa.list_(pa.string()))

    known = docs.select(
        col(id_column).alias("id"), col(text_column).cast("string").alias("t"), col(label_column).cast("string").alias("y")
    ).filter(F.col("t").isNotNull() & F.col("y").isNotNull() & learnable(F.col("id")))
    # Only ids and hashes of texts are sorted; whole texts of the sample alone go to the cutting.
    picked = saved(known.groupBy("y", F.xxhash64("t").alias("h")).agg(F.min("id").alias("id")))
    counts = picked.groupBy("y").agg(F.count(F.lit(1)).alias("n"))
    share = max(least_rows, most_rows // max(1, counts.count()))
    # Only ids whose hash is low enough for their language are put in order: about twice a share of each, however
    # many rows it has. A count per language is broadcast, as the model itself is.
    place = F.xxhash64("id") / F.lit(2.0**64) + 0.5
    low = picked.join(F.broadcast(counts), "y").filter(place <= (2.0 * share + 100) / F.col("n"))
    turn = F.row_number().over(Window.partitionBy("y").orderBy(F.xxhash64("id"), "id", "h"))
    sample = low.withColumn("turn", turn).filter(F.col("turn") <= share).select("y", "h", "id")
    rows = (
        known.withColumn("h", F.xxhash64("t"))
        .join(F.broadcast(sample), ["id", "y", "h"])
        .select("id", "y", "h", cut("t").alias("p"))
        .dropDuplicates(["id", "y", "h"])
        .orderBy(F.xxhash64("id"), "id", "y", "h")
        .collect()
    )
    languages = sorted({r["y"] for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((2, 0)), np.zeros(0), 1.0, 0.0)
    index = {name: i for i, name in enumerate(languages)}
    turns: Counter[str] = Counter()
    parts = []
    for r in rows:
        parts += [(p, index[r["y"]], turns[r["y"]] % 5 == 4) for p in r["p"]]
        turns[r["y"]] += 1
    learn = [p for p in parts if not p[2]] or parts
    check = [p for p in parts if p[2]] or parts
    if not parts:
        return LanguageModel(languages, np.zeros((2, len(languages))), np.zeros(len(languages)), 1.0, 0.0)
    table, bias = train([p[0] for p in learn], np.array([p[1] for p in learn]), languages)
    model = LanguageModel(languages, table, bias, 1.0, 0.0)
    logits, _ = model.logits([p[0] for p in check])
    y = np.array([p[1] for p in check])

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean()

    model.temperature = min((2.0**e for e in np.arange(-4, 4.01, 0.25)), key=loss)
    p = softmax(logits / model.temperature)
    right = np.sort(p.max(1)[p.argmax(1) == y])
    model.reject_below = float(right[int(wrong_rejects * len(right))]) if len(right) else 0.0
    return model


def identify_language(docs: DataFrame, model: LanguageModel, text_column: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (its calibrated probability, 0 to 1) and ``rejected``.

    The whole text counts. A text that is null, empty or without a letter is ``und`` with score 0
    and rejected; of equally likely languages the first by name is predicted. Columns named like
    the new ones are replaced. An empty table stays empty.
    """
    spark = docs.sparkSession
    ship(spark)
    # Buckets times languages: a size set by parameters, not by the data.
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang:string,p:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for batch in batches:
            names, scores = [], []
            for start, length in parts_of(batch, 1000, 3 << 20):
                best, p = model.predict(texts_of(batch.slice(start, length)))
                names += [model.languages[b] if b >= 0 else UNKNOWN for b in best.tolist()]
                scores.append(p)
            p = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(p, pa.float64())], ["lang", "p"])

    found = predict(col(text_column).cast("string"))
    return replace_columns(
        docs,
        {
            "lang_pred": found["lang"],
            "score": found["p"],
            "rejected": (found["lang"] == UNKNOWN) | (found["p"] < model.reject_below),
        },
    )
