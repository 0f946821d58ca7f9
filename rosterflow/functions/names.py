"""Column-name cleaning, for names on the driver and for text columns on executors."""

from __future__ import annotations

import functools
import re
import sys
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the name given to a column that has none.
NO_NAME = "no_col_name_or_merged_column_header"

_NOT_WORD = re.compile(r"[\W_]+")


def column(name: str) -> Column:
    """A column by its exact name, whatever dots, spaces or backticks the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def sanitise_name(name: str) -> str:
    """Lower-case name in which every run of non-word characters is one underscore."""
    if not name:
        return NO_NAME
    prefix = "_" if name[0].isdigit() else ""
    return _NOT_WORD.sub("_", prefix + name.lower())


@functools.cache
def _digit_class() -> str:
    """Regex class of every character that counts as a digit: decimal digits and the likes of superscripts."""
    others = (chr(c) for c in range(sys.maxunicode + 1))
    return r"[\p{Nd}" + "".join(c for c in others if c.isdigit() and not c.isdecimal()) + "]"


def sanitise_text(text: Column) -> Column:
    """``sanitise_name`` over a text column; null stays null.

    A word character is a letter or a number of any script, written as Unicode classes because
    the short class of the JVM knows ASCII only.
    """
    cleaned = F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", "_")
    return (
        F.when(text == "", F.lit(NO_NAME))
        .when(text.rlike("^" + _digit_class()), F.concat(F.lit("_"), cleaned))
        .otherwise(cleaned)
    )


def dedup_names(names: Iterable[str]) -> list[str]:
    """Number repeated names ``x, x_1, x_2`` and go on counting past names that are taken."""
    used: set[str] = set()
    counts: dict[str, int] = {}
    unique = []
    for name in names:
        fresh = name
        while fresh in used:
            counts[name] = counts.get(name, 0) + 1
            fresh = f"{name}_{counts[name]}"
        used.add(fresh)
        unique.append(fresh)
    return unique
