"""SentencePiece models on the tokenizers library: the model file is parsed, its parts are rebuilt, parity is checked."""

from __future__ import annotations

import os
import re
import struct
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, parts_of, replace_columns, ship, texts_of

SPACE_MARK = "▁"

# Distinct words that are encoded as one text.
WORDS_AT_ONCE = 64

# Fixed values of the model format: kinds of model and kinds of piece.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of each field of a protobuf message; numbers stay integers, the rest bytes."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        if kind not in (1, 2, 5):
            raise ValueError(f"not a SentencePiece model: wire type {kind}")
        size = {1: 8, 5: 4}.get(kind) or number() if kind != 2 else number()
        yield key >> 3, data[at : at + size]
        at += size


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit numbers."""
    packed = array("I", ids)
    if packed.itemsize != 4 or sys.byteorder != "little":
        return np.array(ids, dtype="<u4").tobytes()
    return packed.tobytes()


@dataclass
class SentencePieceModel:
    """What a model file says; the defaults are those of the format."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown_id: int = 0
    suffix_mark: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    squeeze_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> SentencePieceModel:
        model = cls()
        for number, value in message_fields(data):
            if number == 1:
                parts = dict(message_fields(value))
                score = struct.unpack("<f", parts[2])[0] if 2 in parts else 0.0
                model.pieces.append((parts.get(1, b"").decode("utf-8"), score, parts.get(3, NORMAL)))
            elif number == 2:
                parts = dict(message_fields(value))
                model.kind = parts.get(3, UNIGRAM)
                model.suffix_mark = bool(parts.get(24, 0))
                model.byte_fallback = bool(parts.get(35, 0))
                model.unknown_id = parts.get(40, 0)
            elif number == 3:
                parts = dict(message_fields(value))
                model.charsmap = parts.get(2, b"")
                model.dummy_prefix = bool(parts.get(3, 1))
                model.squeeze_spaces = bool(parts.get(4, 1))
                model.escape_spaces = bool(parts.get(5, 1))
        if model.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if model.suffix_mark or any(kind == USER_DEFINED for _, _, kind in model.pieces):
            raise ValueError("marks at word ends and user-defined pieces are not supported")
        return model

    def merges(self) -> list[tuple[str, str]]:
        """Pairs that BPE joins, the best first.

        The format ranks a pair by the score of the piece it makes and takes the leftmost of equals. Equal scores are
        in use for runs of the space mark alone, which therefore grow from the left: what makes the longest run comes first.
        """
        normal = {p: s for p, s, kind in self.pieces if kind == NORMAL}
        found = []
        for order, (piece, score, kind) in enumerate(self.pieces):
            if kind != NORMAL or len(piece) < 2:
                continue
            pairs = [(piece[:c], piece[c:]) for c in range(1, len(piece)) if piece[:c] in normal and piece[c:] in normal]
            longest = -len(piece) if set(piece) == {SPACE_MARK} else 0
            found += [((-score, longest, order), p) for p in pairs]
        return [p for _, p in sorted(found, key=lambda x: x[0])]

    def tokenizer(self):
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers

        if self.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            unknown = self.pieces[self.unknown_id][0]
            model = models.BPE(vocab=vocab, merges=self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)
        else:
            # The least score of normal pieces sets the cost of unknown characters, so others must not be lower.
            # Texts that spell another piece never get here (see PieceCodec).
            low = min((s for _, s, kind in self.pieces if kind == NORMAL), default=0.0)
            scored = [(p, s if kind == NORMAL else low) for p, s, kind in self.pieces]
            model = models.Unigram(scored, self.unknown_id, self.byte_fallback)
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.squeeze_spaces:
            steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", SPACE_MARK))
        out = Tokenizer(model)
        if steps:
            out.normalizer = normalizers.Sequence(steps)
        back = [decoders.Replace(SPACE_MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            back.append(decoders.Strip(" ", 1, 0))
        out.decoder = decoders.Sequence(back)
        return out


class PieceCodec:
    """Encodes and decodes texts by a model file, in batches on several threads.

    If no piece holds the space mark behind another character and the normaliser only marks spaces, no piece reaches over
    the start of a word; then the distinct words of a batch are encoded once. Other texts are encoded whole.
    """

    def __init__(self, path: str, threads: int = 2):
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        with open(path, "rb") as file:
            self.model = SentencePieceModel.parse(file.read())
        self.path = path
        self.tokenizer = self.model.tokenizer()
        plain = not self.model.charsmap and not self.model.squeeze_spaces
        inner = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p, _, _ in self.model.pieces)
        self.by_word = plain and not inner and self.model.dummy_prefix and self.model.escape_spaces

        spelled = [re.escape(p) for p, _, kind in self.model.pieces if kind != NORMAL]
        self.spelled = re.compile("|".join(spelled)) if spelled and self.model.kind == UNIGRAM else None

    @cached_property
    def library(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=self.path)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as one; a few thousand at a time, since the library's results are large."""
        packed = []
        for start in range(0, len(texts), 4000):
            found = self.tokenizer.encode_batch_fast(texts[start : start + 4000], add_special_tokens=False)
            packed += [pack(e.ids) for e in found]
        if self.spelled:
            for i, text in enumerate(texts):
                if self.spelled.search(text):
                    packed[i] = pack(self.library.encode(text))
        return packed

    def of_words(self, words: list[str], verify: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids of distinct words, one after another, how many each has, and which differ from the library's.

        Words go through both libraries many at a time, with spaces between them, and are told apart in the ids by the
        piece that holds the mark before each. Where that does not give one run of pieces per word, words go one by one.
        """
        ids, lengths, odd = [], [], []
        for start in range(0, len(words), WORDS_AT_ONCE * 64):
            groups = [words[i : i + WORDS_AT_ONCE] for i in range(start, min(start + WORDS_AT_ONCE * 64, len(words)), WORDS_AT_ONCE)]
            joined = [" ".join(g) for g in groups]
            found = self.whole(joined)
            same = self.same_as_library(joined, found) if verify else [True] * len(groups)
            for group, packed, agree in zip(groups, found, same):
                numbers = np.frombuffer(packed, dtype="<u4")
                starts = np.flatnonzero(self.begins_word[numbers])
                if not agree or len(starts) != len(group) or starts[0]:
                    alone = self.whole(group)
                    differ = [not s for s in self.same_as_library(group, alone)] if verify else [False] * len(group)
                    ids.append(np.frombuffer(b"".join(alone), dtype="<u4"))
                    lengths.append(np.array([len(p) // 4 for p in alone], dtype=np.int64))
                    odd.append(np.array(differ))
                    continue
                ids.append(numbers)
                lengths.append(np.diff(starts, append=len(numbers)))
                odd.append(np.zeros(len(group), dtype=bool))
        return np.concatenate(ids), np.concatenate(lengths), np.concatenate(odd)

    @cached_property
    def begins_word(self) -> np.ndarray:
        """For each piece, whether it starts with the space mark."""
        return np.array([p.startswith(SPACE_MARK) for p, _, _ in self.model.pieces])

    def encode(self, texts: list[str], verify: bool = False) -> list[bytes]:
        """Ids of each text, packed little-endian and unsigned with 32 bits; an empty text has none."""
        return self.encode_and_verify(texts, verify)[0]

    def encode_and_verify(self, texts: list[str], verify: bool = True) -> tuple[list[bytes], list[bool]]:
        """Ids of each text, and whether the sentencepiece library gives the same.

        No piece reaches over the start of a word where texts are cut at words, so a text has parity
        if each of its words has; other texts are compared whole.
        """
        cut = [
            self.by_word and t[:1] != " " and t[-1:] != " " and "  " not in t and SPACE_MARK not in t for t in texts
        ]
        others = [t for c, t in zip(cut, texts) if not c and t]
        whole = self.whole(others)
        same = self.same_as_library(others, whole) if verify else [True] * len(others)
        rest = iter(zip(whole, same))
        split = pc.split_pattern(pa.array([t for c, t in zip(cut, texts) if c and t], pa.large_string()), " ")
        parts = iter(())
        if len(split):
            coded = split.flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            pool, lengths, odd = self.of_words(words, verify)
            offsets = np.cumsum(lengths) - lengths
            codes = coded.indices.to_numpy().astype(np.int64)
            n = lengths[codes]
            tops = np.cumsum(n)
            taken = pool[np.repeat(offsets[codes] - (tops - n), n) + np.arange(tops[-1])].tobytes()
            counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(counts)
            bytes_before = (4 * tops[ends - 1]).tolist()
            wrong = np.add.reduceat(odd[codes].astype(np.int64), ends - counts)
            parts = iter([(taken[a:b], not w) for a, b, w in zip([0, *bytes_before[:-1]], bytes_before, wrong.tolist())])
        found = [((next(parts) if c else next(rest)) if t else (b"", True)) for c, t in zip(cut, texts)]
        return [p for p, _ in found], [s for _, s in found]

    @cached_property
    def spellings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What pieces add to a text, in bytes one after another; where each starts, and how many bytes it has."""
        spelled = [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE_MARK, " ").encode() for p, _, kind in self.model.pieces]
        sizes = np.array([len(b) for b in spelled], dtype=np.int64)
        return np.frombuffer(b"".join(spelled), dtype=np.uint8), np.cumsum(sizes) - sizes, sizes

    def decode(self, packed: list[bytes]) -> list[str]:
        """The texts that ids spell; ids whose bytes are no text go through the library, which marks what it can't spell."""
        pool, starts, sizes = self.spellings
        numbers = np.frombuffer(b"".join(packed), dtype="<u4")
        n = sizes[numbers]
        tops = np.cumsum(n)
        spelled = pool[np.repeat(starts[numbers] - (tops - n), n) + np.arange(tops[-1] if len(tops) else 0)].tobytes()
        ends = np.cumsum([len(p) // 4 for p in packed])
        bytes_before = np.concatenate([[0], tops])[ends].tolist() if packed else []
        out = []
        for ids, begin, end in zip(packed, [0, *bytes_before[:-1]], bytes_before):
            try:
                text = spelled[begin:end].decode("utf-8")
            except UnicodeDecodeError:
                text = self.tokenizer.decode(np.frombuffer(ids, "<u4").tolist(), skip_special_tokens=False)
            else:
                text = text[1:] if self.model.dummy_prefix and text[:1] == " " else text
            out.append(text)
        return out

    def same_as_library(self, texts: list[str], packed: list[bytes]) -> list[bool]:
        """Whether the ids of each text are those of the sentencepiece library itself."""
        same = []
        for start in range(0, len(texts), 4000):
            found = self.library.encode(texts[start : start + 4000], num_threads=1)
            same += [pack(ids) == p for ids, p in zip(found, packed[start:])]
        return same


_codecs: dict[tuple[str, int], PieceCodec] = {}


def codec(path: str, threads: int) -> PieceCodec:
    """One codec per file and Python worker."""
    if (path, threads) not in _codecs:
        _codecs[path, threads] = PieceCodec(path, threads)
    return _codecs[path, threads]


def encode_pieces(docs: DataFrame, model_path: str, threads: int = 2, verify: bool = True, text_column: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (packed little-endian unsigned 32-bit), ``n_ids`` and ``parity``.

    ``model_path`` must be readable on each executor, as files shipped with the application are. ``parity`` tells whether the
    sentencepiece library gives the same ids; it is null unless ``verify``. A null text has null ids, a null
    number and null parity; an empty one has none, 0 and true. Rows stand for themselves. Columns named like the new
    ones are replaced. An empty table stays empty.
    """
    ship(docs.sparkSession)

    @F.arrow_udf("struct<ids:binary,n:long,parity:boolean>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model_path, threads)
        for batch in batches:
            # What is given back in small parts need not be held for a whole batch.
            for start, length in parts_of(batch, 1000, 2 << 20):
                part = batch.slice(start, length)
                texts, missing = texts_of(part), part.is_null().to_pylist()
                packed, parity = own.encode_and_verify(texts, verify)
                parity = parity if verify else [None] * len(texts)
                ids = [None if m else p for m, p in zip(missing, packed)]
                same = [None if m else p for m, p in zip(missing, parity)]
                sizes = [None if i is None else len(i) // 4 for i in ids]
                yield pa.StructArray.from_arrays(
                    [pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()), pa.array(same, pa.bool_())], ["ids", "n", "parity"]
                )

    found = encode(col(text_column).cast("string"))
    return replace_columns(docs, {"ids": found["ids"], "n_ids": found["n"], "parity": found["parity"]})


def decode_pieces(encoded: DataFrame, model_path: str, threads: int = 2, ids_column: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the texts that packed ids spell; null ids give a null text."""
    ship(encoded.sparkSession)

    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(model_path, threads)
        for batch in batches:
            for start, length in parts_of(batch, 1000, 2 << 20):
                packed = batch.slice(start, length).to_pylist()
                texts = own.decode([p or b"" for p in packed])
                yield pa.array([None if p is None else t for p, t in zip(packed, texts)], pa.string())

    return replace_columns(encoded, {"decoded": decode(col(ids_column))})
