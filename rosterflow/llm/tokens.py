"""Token ids of a byte-level BPE file of the tokenizers library, by the fastest library that gives them."""

from __future__ import annotations

import json
import re

import numpy as np

# The pattern that byte-level BPE files split texts with before the merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Runs of white space from this length on go through tokenizers: the search for splits in tiktoken gives up on some longer ones.
LONG_RUN = 100_000


def has_long_run(text: str) -> bool:
    """Whether white space runs on for ``LONG_RUN`` characters or more; one pass over the text."""
    return len(text) >= LONG_RUN and any(m.end() - m.start() >= LONG_RUN for m in re.finditer(r"\s{2,}", text))


def byte_of_letter() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable ones for themselves, others from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """Encodes texts as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` does.

    The ids come packed, little-endian and unsigned with 32 bits. If the file is plain byte-level
    BPE whose ids follow the order of its merges, its merges run in tiktoken, which gives the same
    ids several times faster; other files, and texts that hold a special token or a very long run of white space, go
    through tokenizers itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self.ranked(path)

    @staticmethod
    def ranked(path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model, split = content["model"], content.get("pre_tokenizer") or {}
        plain = (
            model.get("type") == "BPE"
            and content.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        )
        if not plain:
            return None
        added = {t["content"] for t in content.get("added_tokens", [])}
        vocab = {t: i for t, i in model["vocab"].items() if t not in added}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        ids = [vocab.get(m, -1) for m in merges]
        if len(vocab) != 256 + len(merges) or ids != sorted(ids) or -1 in ids:
            return None
        letters = byte_of_letter()
        ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items()}
        return tiktoken.Encoding("ranked", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.fast is None or has_long_run(text) or any(s in text for s in self.specials):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), dtype="<u4").tobytes()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per file and Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
