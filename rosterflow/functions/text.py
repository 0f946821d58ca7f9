"""Text predicates and rewrites, all built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column

# The texts that reports use for an identifier that does not exist.
NOT_ASSIGNED = "Not Assigned Yet"
NOT_APPLICABLE = "N/A"

# Text that a number parser accepts: integers, decimals, exponents and infinities,
# with blanks around it. NaN, hexadecimal and typed literals such as 12d are not numbers.
NUMERIC_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf(inity)?))\s*$"

BLANKS = " \t\r\n\f\u000b"


def is_numeric_text(text: Column) -> Column:
    """True where the text is a number; false for null."""
    return F.coalesce(text.rlike(NUMERIC_PATTERN), F.lit(False))


def to_number(text: Column) -> Column:
    """The number as double, null where the text is not one."""
    return F.when(is_numeric_text(text), F.btrim(text, F.lit(BLANKS)).try_cast("double"))


def number_key(text: Column) -> Column:
    """One text per number, so that ``1000``, ``+1000.0`` and ``1e3`` compare equal.

    Digits are trimmed as text, so identifiers of any length and any number of places stay exact. Only numbers with an
    exponent go through a double, and from there through their digits where those say the same. Null where
    not a number.
    """
    bare = F.btrim(text, F.lit(BLANKS))
    number = bare.try_cast("double")
    digits = number.try_cast("decimal(38,18)")
    scaled = F.when(digits.cast("double") == number, _trimmed_digits(digits.cast("string"))).otherwise(number.cast("string"))
    key = F.when(bare.rlike(r"^[+-]?[\d.]+$"), _trimmed_digits(bare)).otherwise(scaled)
    return F.when(is_numeric_text(text), key)


def _trimmed_digits(number: Column) -> Column:
    """A plain number without a plus sign and without zeros that do not count; minus zero is zero."""
    whole = F.regexp_replace(F.regexp_extract(number, r"^[+-]?(\d*)", 1), "^0+", "")
    fraction = F.regexp_replace(F.regexp_extract(number, r"\.(\d*)$", 1), "0+$", "")
    size = F.concat(F.when(whole == "", "0").otherwise(whole), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)))
    return F.when(number.startswith("-") & (size != "0"), F.concat(F.lit("-"), size)).otherwise(size)


def blank_sentinel(text: Column, sentinel: str = NOT_ASSIGNED) -> Column:
    """Empty text in place of the sentinel."""
    return F.when(text == sentinel, F.lit("")).otherwise(text)


def swap_value(text: Column, old: str, new: str) -> Column:
    """``new`` in place of ``old``; everything else, null included, as it is."""
    return F.when(text == old, F.lit(new)).otherwise(text)


def blank_nulls(df: DataFrame) -> DataFrame:
    """Every column as text, null as empty text."""
    return df.select([F.coalesce(column(c).cast("string"), F.lit("")).alias(c) for c in df.columns])


def thousands(number: Column) -> Column:
    """Whole number with a comma between groups of three digits."""
    return F.format_number(number, 0)


def placeholder(tag: Column, suffix: str = "") -> Column:
    """Placeholder text ``{tag}``, with the suffix inside the braces."""
    return F.concat(F.lit("{"), tag, F.lit(suffix + "}"))
