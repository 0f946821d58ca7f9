"""Quality rules: counts over words and lines, and a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, learnable, replace_columns, ship, texts_of

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MARKS = bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127))
N_FEATURES = 20


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that are found twice or more, the first time included.

    Windows are compared by a 64-bit hash of their words, which two different windows of a text share
    with a chance of 2**-64.
    """
    if len(words) <= WINDOW:
        return 0
    hashes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
    size = len(words) - WINDOW + 1
    rolled = np.zeros(size, dtype=np.uint64)
    for i in range(WINDOW):
        rolled = (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[i : i + size]
    _, place, counts = np.unique(rolled, return_inverse=True, return_counts=True)
    again = np.flatnonzero(counts[place] > 1)
    if not len(again):
        return 0
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, again, 1)
    np.add.at(change, again + WINDOW, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines with a word that are equal to an earlier one, repeated words."""
    words = text.encode("utf-8", "surrogatepass").split()
    filled = [x for x in text.split("\n") if x.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(filled) - len(set(filled)),
        repeated_words(words),
    )


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line with a word, in order, and the number of its words."""
    rows, sizes = [], []
    seen: set[bytes] = set()
    for line in text.encode("utf-8", "surrogatepass").split(b"\n"):
        words = line.split()
        if not words:
            continue
        n, distinct = len(words), len(set(words))
        stripped = line.strip()
        length = len(stripped)
        upper = sum(map(bytes.isupper, words))
        marked = sum(w[-1] in MARKS and w[-1:] not in b".," for w in words)
        bare = sum(not w.strip(MARKS) for w in words)
        digits = sum(map(bytes.isdigit, words))
        symbols = sum(map(stripped.count, (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")))
        exclaims = stripped.count(b"!")
        mean = (length - n + 1) / n
        rows.append(
            (
                1.0,
                np.log1p(n) / 4,
                n <= 2,
                n <= 5,
                upper / n,
                upper > 0.5 * n and n > 2,
                marked / n,
                marked > 0.3 * n,
                bare / n,
                bare > 0.1 * n,
                digits / n,
                min(1.0, 10 * symbols / length),
                symbols > 0.02 * length,
                exclaims > 0.02 * length,
                distinct / n,
                distinct < 0.5 * n,
                distinct < 0.2 * n,
                stripped[-1:] in b".?",
                stripped in seen,
                min(3.0, mean / 8),
            )
        )
        sizes.append(n)
        seen.add(stripped)
    return np.array(rows, dtype=float).reshape(len(rows), N_FEATURES), np.array(sizes, dtype=np.int64)


@dataclass
class LineModel:
    """Weights of the state "content" against "boilerplate", and of moves between states (boilerplate 0, content 1)."""

    weight: np.ndarray
    move: np.ndarray

    def decode(self, features: np.ndarray) -> list[bool]:
        """Viterbi: of each line whether it is content on the likeliest path; ties go to content."""
        gains = (features @ self.weight).tolist()
        if not gains:
            return []
        (m00, m01), (m10, m11) = self.move.tolist()
        low, high = 0.0, gains[0]
        back = []
        for gain in gains[1:]:
            from_low0, from_high0 = low + m00, high + m10
            from_low1, from_high1 = low + m01, high + m11
            back.append((from_high0 >= from_low0, from_high1 >= from_low1))
            low, high = max(from_low0, from_high0), max(from_low1, from_high1) + gain
        state = high >= low
        path = [state]
        for to_low, to_high in reversed(back):
            state = to_high if state else to_low
            path.append(state)
        return path[::-1]


def log_sum(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(a - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def train(sequences: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, penalty: float = 1e-3, rate: float = 0.1) -> LineModel:
    """Maximum likelihood of the labels of lines (features, labels), by Adam on gradients from forward and backward sums."""
    sequences = [s for s in sequences if len(s[0])]
    weight, move = np.zeros(N_FEATURES), np.zeros((2, 2))
    if not sequences:
        return LineModel(weight, move)
    longest, n = max(len(x) for x, _ in sequences), len(sequences)
    x = np.zeros((n, longest, N_FEATURES))
    y = np.zeros((n, longest), dtype=np.int64)
    real = np.zeros((n, longest), dtype=bool)
    for i, (features, labels) in enumerate(sequences):
        x[i, : len(features)], y[i, : len(features)], real[i, : len(features)] = features, labels, True
    both = real[:, 1:] & real[:, :-1]
    seen_move = np.zeros((2, 2))
    np.add.at(seen_move, (y[:, :-1][both], y[:, 1:][both]), 1)
    seen = x[real & (y == 1)].sum(0)
    total = real.sum()
    theta = np.concatenate([weight, move.ravel()])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        weight, move = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)
        unary = np.stack([np.zeros((n, longest)), x @ weight], axis=-1)
        ahead = np.zeros((n, longest, 2))
        ahead[:, 0] = unary[:, 0]
        for t in range(1, longest):
            ahead[:, t] = log_sum(ahead[:, t - 1, :, None] + move, 1) + unary[:, t]
        behind = np.zeros((n, longest, 2))
        for t in range(longest - 2, -1, -1):
            value = log_sum(move + (unary[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(both[:, t, None], value, 0)
        last = real.sum(1) - 1
        z = log_sum(ahead[np.arange(n), last], 1)
        p = np.exp(ahead[..., 1] + behind[..., 1] - z[:, None]) * real
        expected = (p[..., None] * x).sum((0, 1))
        pair = ahead[:, :-1, :, None] + move + (unary[:, 1:] + behind[:, 1:])[:, :, None, :] - z[:, None, None, None]
        expected_move = np.exp(np.where(both[..., None, None], pair, -np.inf)).sum((0, 1))
        gradient = np.concatenate([seen - expected, (seen_move - expected_move).ravel()]) / total - penalty * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return LineModel(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2))


def fit_lines(
    docs: DataFrame,
    labels: DataFrame,
    most_rows: int = 2_000,
    most_lines: int = 100,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "quality",
) -> LineModel:
    """A field over lines, from a bounded sample of documents labelled by quality.

    Lines of documents of quality 1 are taken for content, those of quality 0 for boilerplate.
    Each sequence learnt from is two documents in a row, so that states also change inside. The
    sample holds at most ``most_rows`` labelled rows that may be learnt from, in the order of a hash
    of their id, and of those the ones with at most ``most_lines`` lines; only features reach the driver.
    """
    ship(docs.sparkSession)
    known = labels.select(col(id_column).alias("id"), col(label_column).cast("int").alias("y"))
    known = known.filter(F.col("y").isin(0, 1) & learnable(F.col("id"))).groupBy("id").agg(F.min("y").alias("y"))
    # Both kinds in equal numbers, as far as there are so many.
    sample = None
    for kind in (0, 1):
        part = known.filter(F.col("y") == kind).orderBy(F.xxhash64("id"), "id").limit(most_rows // 2)
        sample = part if sample is None else sample.union(part)

    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([line_features(t)[0].ravel().tolist() for t in texts_of(batch)], pa.list_(pa.float64()))

    texts = docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("t"))
    # The sample has a fixed bound, 16 bytes a row.
    rows = (
        texts.join(F.broadcast(sample), "id")
        .filter(F.regexp_count("t", F.lit("\n")) < most_lines)
        .select("id", "y", features("t").alias("x"))
        .groupBy("id", "y")
        .agg(F.min("x").alias("x"))
        .orderBy(F.xxhash64("id"), "id")
        .collect()
    )
    parts = [(np.array(r["x"]).reshape(-1, N_FEATURES), r["y"]) for r in rows]
    sequences = []
    for (x1, y1), (x2, y2) in zip(parts[::2], [*parts[1::2], (np.zeros((0, N_FEATURES)), 0)]):
        sequences.append((np.concatenate([x1, x2]), np.array([y1] * len(x1) + [y2] * len(x2))))
    return train(sequences)


def judge_lines(
    docs: DataFrame,
    model: LineModel,
    least_words: int = 20,
    most_repeated: int = 30,
    least_content: float = 0.5,
    text_column: str = "text",
) -> DataFrame:
    """``docs`` with ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed``,
    ``content_share`` and ``kept``; columns named so are replaced.

    Words are what white space (space and U+0009 to U+000D) leaves. The base rules fail a document with
    less than ``least_words`` words or with over ``most_repeated`` hundredths of its words in repeated windows of eight.
    The field labels each line with a word as content or boilerplate; a document is kept if it did not fail
    and at least ``least_content`` of its words are in content lines.

    Null, empty and blank texts have no word, fail, and have a content share of 0. Rows are judged one by
    one, whole. An empty table stays empty.
    """
    ship(docs.sparkSession)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    @F.arrow_udf("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,share:double>")
    def judge(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            counts, shares = [], []
            for text in texts_of(batch):
                counts.append(base_counts(text))
                features, sizes = line_features(text)
                content = np.array(model.decode(features), dtype=bool)
                shares.append(float(sizes[content].sum() / sizes.sum()) if len(sizes) else 0.0)
            columns = [pa.array(c, pa.int64()) for c in zip(*counts)] if counts else [pa.array([], pa.int64())] * 5
            yield pa.StructArray.from_arrays([*columns, pa.array(shares, pa.float64())], [*names, "share"])

    found = judge(col(text_column).cast("string"))
    failed = (found["n_words"] < least_words) | (100 * found["n_repeat_words"] > most_repeated * found["n_words"])
    return replace_columns(
        docs,
        {n: found[n] for n in names}
        | {"base_failed": failed, "content_share": found["share"], "kept": ~failed & (found["share"] >= least_content)},
    )
