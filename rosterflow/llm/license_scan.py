"""Licence notices in texts, by matching statistics over a suffix automaton of known notices."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col, replace_columns, ship, texts_of
from rosterflow.llm.suffix_automaton import SuffixAutomaton

# Phrases whose every place counts, with their labels.
PHRASES = (
    ("cc by", "cc-by"),
    ("general public license", "gpl"),
    ("all rights reserved", "reserved"),
)

# Public licence notices and the short forms in which documents name a licence.
TEMPLATES = (
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
     associated documentation files (the "Software"), to deal in the Software without restriction, including without
     limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
     Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
     The above copyright notice and this permission notice shall be included in all copies or substantial portions of
     the Software."""),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT License."),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided
     that the following conditions are met: Redistributions of source code must retain the above copyright notice,
     this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above
     copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
     materials provided with the distribution."""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
     hereby granted, provided that the above copyright notice and this permission notice appear in all copies."""),
    ("apache", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
     compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0
     Unless required by applicable law or agreed to in writing, software distributed under the License is distributed
     on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for
     the specific language governing permissions and limitations under the License."""),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("gpl", """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
     General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
     option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
     WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
     General Public License for more details."""),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("lgpl", """This library is free software; you can redistribute it and/or modify it under the terms of the GNU
     Lesser General Public License as published by the Free Software Foundation."""),
    ("mpl", """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL
     was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."""),
    ("unlicense", """This is free and unencumbered software released into the public domain. Anyone is free to copy,
     modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled
     binary, for any purpose, commercial or non-commercial, and by any means."""),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc0", """To the extent possible under law, the author has waived all copyright and related or neighboring rights to
     this work."""),
    ("reserved", "Copyright. All rights reserved."),
)

WORD_BYTES = bytes(range(0x30, 0x3A)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
# Each byte as it stands in a word, A-Z in lower case, and a space for what parts words.
WORD_TABLE = bytes(b if b in WORD_BYTES else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))


def license_words(text: str) -> list[bytes]:
    """Lower-case words of letters, digits and characters beyond ASCII."""
    return text.encode("utf-8", "surrogatepass").translate(WORD_TABLE).split()


class LicenseScanner:
    """Finds phrases and notices; ``templates`` and ``phrases`` are pairs of (label, text) and (text, label)."""

    def __init__(self, templates=TEMPLATES, phrases=PHRASES, least_run: int = 3, most_gap: int = 6, least_share: float = 0.6):
        self.vocabulary: dict[bytes, int] = {}
        code = self.code
        self.labels = [label for label, _ in templates]
        sequences = [[code(w) for w in license_words(text)] for _, text in templates]
        self.sizes = [len(s) for s in sequences]
        self.automaton = SuffixAutomaton(sequences)
        self.phrases = [([code(w) for w in license_words(text)], label) for text, label in phrases]
        self.least_run, self.most_gap, self.least_share = least_run, most_gap, least_share

    def code(self, word: bytes) -> int:
        return self.vocabulary.setdefault(word, len(self.vocabulary) + 1)

    def matches(self, codes: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, state) of the runs of at least ``least_run`` words that no longer match holds.

        Only stretches of known words are streamed; other words bring the automaton back to its root.
        """
        known = np.concatenate(([0], (codes > 0).astype(np.int8), [0]))
        change = np.diff(known)
        found = []
        for start, end in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            if end - start < self.least_run:
                continue
            before = (0, 0)
            place = start
            for length, state in self.automaton.stream(codes[start:end].tolist()):
                if before[0] >= self.least_run and length != before[0] + 1:
                    found.append((place - before[0], place, before[1]))
                before = (length, state)
                place += 1
            if before[0] >= self.least_run:
                found.append((end - before[0], end, before[1]))
        return found

    def spans(self, codes: np.ndarray) -> list[tuple[str, int, int, float]]:
        """(label, first word, end, share) of each chain of matches that covers enough of a template.

        A chain takes matches in the order of the text as well as of the template, with at most
        ``most_gap`` words of the text between them; its share is the part of the template's words that it covers.
        """
        chains: dict[int, list[int]] = {}
        done: list[tuple[str, int, int, float]] = []

        def close(template: int) -> None:
            start, end, _, covered = chains.pop(template)
            share = covered / self.sizes[template]
            if share >= self.least_share:
                done.append((self.labels[template], start, end, share))

        for start, end, state in self.matches(codes):
            for template, there in self.automaton.ends[state].items():
                chain = chains.get(template)
                begins = there - (end - start)
                if chain and (start - chain[1] > self.most_gap or there <= chain[2]):
                    close(template)
                    chain = None
                if chain is None:
                    chains[template] = [start, end, there, end - start]
                else:
                    # Words that the last match has covered already, in the text or in the template, count once.
                    overlap = max(0, chain[1] - start, chain[2] - begins)
                    chain[1], chain[2], chain[3] = end, there, chain[3] + max(0, end - start - overlap)
        for template in list(chains):
            close(template)
        return sorted(done, key=lambda s: (s[1], s[2], s[0]))

    def scan(self, text: str) -> dict:
        words = license_words(text)
        codes = np.fromiter(map(self.vocabulary.get, words, repeat(0)), dtype=np.int64, count=len(words))
        places, labels = [], set()
        for phrase, label in self.phrases:
            size = len(codes) - len(phrase) + 1
            if size <= 0:
                continue
            hit = np.ones(size, dtype=bool)
            for i, code in enumerate(phrase):
                hit &= codes[i : i + size] == code
            at = np.flatnonzero(hit)
            if len(at):
                places.append(at)
                labels.add(label)
        base = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
        spans = self.spans(codes)
        return {
            "n_words": len(words),
            "n_base": len(base),
            "first_word": int(base.min()) if len(base) else None,
            "last_word": int(base.max()) if len(base) else None,
            "base_labels": ",".join(sorted(labels)),
            "labels": ",".join(sorted(labels | {s[0] for s in spans})),
            "score": min(1.0, max((s[3] for s in spans), default=0.0)),
            "spans": [{"label": s[0], "first": s[1], "end": s[2], "share": s[3]} for s in spans],
        }


RESULT = "n_words:long,n_base:long,first_word:long,last_word:long,base_labels:string,labels:string,score:double"
SPANS = "array<struct<label:string,first:long,end:long,share:double>>"
ARROW_RESULT = pa.struct(
    [(n, pa.int64()) for n in ("n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    + [("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("share", pa.float64())])))]
)


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, text_column: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels``, ``score`` and ``spans``.

    Texts are lower-cased (A-Z) and cut into words of digits, letters and characters beyond ASCII. ``n_base`` counts
    the places where a phrase's words stand in a row; ``first_word`` and ``last_word`` are the smallest and the largest
    such start. ``spans`` are stretches of the text that cover enough of a notice, found by chains of long
    matches; ``labels`` joins their labels and those of the phrases, and ``score`` is the largest share
    of a notice that a span covers, 0 without one.

    A null or empty text has no word, empty labels, null places and score 0. Rows are scanned one by one, whole.
    Columns named like the new ones are replaced. An empty table stays empty.
    """
    ship(docs.sparkSession)
    scanner = LicenseScanner(templates, phrases)

    @F.arrow_udf(f"struct<{RESULT},spans:{SPANS}>")
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([scanner.scan(t) for t in texts_of(batch)], type=ARROW_RESULT)

    found = scan(col(text_column).cast("string"))
    return replace_columns(docs, {f.name: found[f.name] for f in ARROW_RESULT})
