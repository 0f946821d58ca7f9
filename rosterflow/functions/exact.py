"""Conversions that tell whether they kept the value."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

WHOLE = r"^[+-]?\d+(\.0*)?$"
DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
DAY = r"\d{4,}-\d{1,2}-\d{1,2}"

# Texts of numbers up to this length are the same number as a double.
SAFE_DIGITS = 15

_WHOLE_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_NUMBERS = (*_WHOLE_TYPES, T.FloatType, T.DoubleType, T.DecimalType)
_NESTED = (T.ArrayType, T.MapType, T.StructType, T.VariantType)


def significant_digits(text: Column) -> Column:
    """The digits of a number's text that count: no sign, point, exponent, or zeros at either end."""
    mantissa = F.regexp_replace(F.regexp_replace(text, r"[eE].*$", ""), r"[^\d]", "")
    return F.regexp_replace(F.regexp_replace(mantissa, "^0+", ""), "0+$", "")


def is_exact_double(text: Column) -> Column:
    """Whether a number's text is the number that its double is written as, so that reading it loses no digit.

    Only texts longer than ``SAFE_DIGITS`` are looked at closely.
    """
    close = significant_digits(text) == significant_digits(text.try_cast("double").cast("string"))
    return (F.length(text) <= SAFE_DIGITS) & ~text.contains("e") & ~text.contains("E") | F.coalesce(close, F.lit(False))


def fits_bigint(text: Column) -> Column:
    """Whether the text of a whole number is within 64 bits. Digits are compared, since a cast that fails is dear."""
    digits = F.regexp_replace(text, r"^[+-]?0*", "")
    bound = F.when(text.startswith("-"), F.lit(str(2**63))).otherwise(F.lit(str(2**63 - 1)))
    return (F.length(text) <= 18) | (F.length(digits) <= 18) | ((F.length(digits) == 19) & (digits <= bound))


def _exact_decimal(text: Column, kind: T.DecimalType) -> Column:
    """Whether no digit other than zero lies behind the last place of the type."""
    fraction = F.regexp_replace(F.regexp_extract(text, r"\.(\d*)$", 1), "0+$", "")
    plain = ~text.rlike("[eE]") & (F.length(fraction) <= kind.scale)
    # With an exponent the value is held against all the places that the type's whole part leaves.
    wide = T.DecimalType(38, 38 - (kind.precision - kind.scale))
    return plain | text.rlike("[eE]") & (text.try_cast(kind).try_cast(wide) == text.try_cast(wide))


def from_text(text: Column, wanted: T.DataType) -> tuple[Column, Column]:
    """The value that a trimmed text stands for in a type, null where there is none, and whether it is the same value.

    Dates need a full day and no time of day but midnight; times no zone, which the type would drop, and at most
    microseconds.
    """
    converted, same = text.try_cast(wanted), F.lit(True)
    if isinstance(wanted, T.VariantType):
        converted = F.try_parse_json(text)
    elif isinstance(wanted, T.ArrayType):
        converted = F.from_json(text, wanted)
    elif isinstance(wanted, _WHOLE_TYPES):
        # Zeros behind the point are no fraction; without them the cast takes the text.
        same = text.rlike(WHOLE)
        converted = F.coalesce(F.when(same, F.regexp_replace(text, r"\..*$", "").try_cast(wanted)), text.try_cast("decimal(38,18)").try_cast(wanted))
    elif isinstance(wanted, (T.DoubleType, T.FloatType)):
        same = ~text.rlike(DECIMAL) | is_exact_double(text)
    elif isinstance(wanted, T.DecimalType):
        same = text.rlike(DECIMAL) & _exact_decimal(text, wanted)
    elif isinstance(wanted, T.DateType):
        same = text.rlike(rf"^{DAY}([ T]0?0:00(:00(\.0*)?)?)?$")
    elif isinstance(wanted, T.TimestampNTZType):
        same = text.rlike(rf"^{DAY}([ T]\d{{1,2}}:\d{{1,2}}(:\d{{1,2}}(\.\d{{0,6}}0*)?)?)?$")
    elif isinstance(wanted, T.TimestampType):
        same = text.rlike(rf"^{DAY}([ T]\d{{1,2}}:\d{{1,2}}(:\d{{1,2}}(\.\d{{0,6}}0*)?)?\s*(Z|UTC|[+-]\d.*)?)?$")
    return converted, same


def from_value(value: Column, have: T.DataType, wanted: T.DataType) -> tuple[Column, Column]:
    """A value in another type, null where it has none, and whether it comes back the same."""
    converted = value.try_cast(wanted)
    if isinstance(have, _NESTED) or isinstance(wanted, _NESTED):
        return converted, F.lit(True)
    if isinstance(have, T.DecimalType) and isinstance(wanted, (T.FloatType, T.DoubleType)):
        return converted, significant_digits(value.cast("string")) == significant_digits(converted.cast("string"))
    return converted, F.coalesce(converted.try_cast(have) == value, F.lit(False))
