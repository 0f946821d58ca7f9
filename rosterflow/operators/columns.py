"""Schema-level operators: names, types, DDL and column selection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.exact import SAFE_DIGITS, fits_bigint, from_text, from_value, is_exact_double
from rosterflow.functions.names import column, dedup_names, sanitise_name
from rosterflow.functions.text import is_numeric_text, to_number

# The type names a table declaration may use, and the Spark type of each.
DECLARED_TYPES = {
    "BOOLEAN": "BOOLEAN",
    "DATE": "DATE",
    "FLOAT": "DOUBLE",
    "INTEGER": "BIGINT",
    "VARCHAR": "STRING",
    "TIMESTAMP WITHOUT TIME ZONE": "TIMESTAMP_NTZ",
    "VARIANT": "VARIANT",
    "ARRAY": "ARRAY<STRING>",
    "NUMERIC": "DECIMAL",
}

_GUESSES = {
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.ByteType: "INTEGER",
    T.ShortType: "INTEGER",
    T.IntegerType: "INTEGER",
    T.LongType: "INTEGER",
    T.StringType: "VARCHAR",
    T.TimestampType: "TIMESTAMP WITHOUT TIME ZONE",
    T.TimestampNTZType: "TIMESTAMP WITHOUT TIME ZONE",
    T.VariantType: "VARIANT",
    T.ArrayType: "ARRAY",
}


def clean_columns(df: DataFrame) -> DataFrame:
    """Sanitised, unique column names in the same order."""
    return df.toDF(*dedup_names(sanitise_name(c) for c in df.columns))


def guess_types(df: DataFrame) -> dict[str, str]:
    """Declared type per lower-case column name. A column called ``as_of`` is a DATE."""
    guessed = {}
    for field in df.schema.fields:
        if field.name.lower() == "as_of":
            kind = "DATE"
        elif isinstance(field.dataType, T.DecimalType):
            kind = f"NUMERIC({field.dataType.precision},{field.dataType.scale})"
        elif type(field.dataType) in _GUESSES:
            kind = _GUESSES[type(field.dataType)]
        else:
            raise TypeError(f"no declared type for column {field.name}: {field.dataType.simpleString()}")
        guessed[field.name.lower()] = kind
    return guessed


def spark_type(declared: str) -> str:
    """Spark type of a declared one; other texts are taken to be Spark types already."""
    name, bracket, size = declared.strip().partition("(")
    known = DECLARED_TYPES.get(name.strip().upper())
    return f"{known}{bracket}{size}" if known and (bracket == "" or known == "DECIMAL") else declared


def create_table_sql(
    table: str,
    schema: str | None = None,
    comment: str = "",
    columns: Mapping[str, str] | None = None,
    data: DataFrame | None = None,
    force_string: bool = False,
    location: str | None = None,
) -> str:
    """CREATE TABLE text from declared columns as they are, or from cleaned names and guessed types."""
    if columns is None:
        if data is None:
            raise ValueError("give columns or data")
        columns = guess_types(clean_columns(all_strings(data) if force_string else data))

    def quoted(text: str, mark: str) -> str:
        return mark + text.replace("\\", "\\\\").replace(mark, "\\" + mark) + mark

    names = [n for n in (schema, table) if n]
    target = ".".join("`" + n.replace("`", "``") + "`" for n in names)
    fields = ", ".join(f"`{name.replace('`', '``')}` {spark_type(kind)}" for name, kind in columns.items())
    sql = f"CREATE TABLE {target} ({fields}) USING parquet"
    if location:
        sql += f" LOCATION {quoted(location, chr(39))}"
    return sql + (f" COMMENT {quoted(comment, chr(39))}" if comment else "")


def all_strings(df: DataFrame) -> DataFrame:
    """Every column as text; nulls stay null."""
    return df.select([column(c).cast("string").alias(c) for c in df.columns])


def type_text_columns(df: DataFrame) -> DataFrame:
    """Give text columns the type all their values share: whole number, number or text.

    One aggregate over all columns decides. Empty text counts as missing in number columns. A column stays text where a
    number type would lose a digit: with a whole number that does not fit a bigint, or, among fractions, with a number that is not
    what its double is written as.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    # Per value: 0 whole number, 1 other number, 2 text. The largest of a column decides.
    checks = []
    for i in range(len(names)):
        value = F.col(f"value_{i}")
        # Patterns and lengths come first because a cast that fails is far dearer.
        kind = F.when(value == "", None).when(value.rlike(r"^[+-]?\d+$"), F.when(fits_bigint(value), 0).otherwise(2)).when(is_numeric_text(value), 1)
        checks.append(F.max(F.when(value.isNotNull(), kind.otherwise(2))).alias(f"kind_{i}"))
        loses = is_numeric_text(value) & (F.length(value) > SAFE_DIGITS) & ~F.lower(value).contains("inf") & ~is_exact_double(value)
        checks.append(F.bool_or(loses).alias(f"loses_{i}"))
    trimmed = df.select([F.btrim(column(name)).alias(f"value_{i}") for i, name in enumerate(names)])
    seen = trimmed.agg(*checks).first()
    kinds = {}
    for i, name in enumerate(names):
        if seen[f"kind_{i}"] == 0 or (seen[f"kind_{i}"] == 1 and not seen[f"loses_{i}"]):
            kinds[name] = ("bigint", "double")[seen[f"kind_{i}"]]

    def typed(name: str) -> Column:
        kind = kinds.get(name)
        if kind is None:
            return column(name)
        number = to_number(column(name)) if kind == "double" else F.btrim(column(name)).try_cast(kind)
        return number.alias(name)

    return df.select([typed(c) for c in df.columns])


def fit_to_schema(df: DataFrame, schema: T.StructType, lossy: Sequence[str] = ()) -> DataFrame:
    """The columns of ``schema``, by name (in any case), with its types.

    Text is converted: dates, times, numbers and truth values as Spark reads them, VARIANT and ARRAY
    columns from JSON. Blank text is null unless the column is text. A value that does not
    convert fails the query, and so does one that would change: a fraction in a whole-number column, more places than a
    NUMERIC has or digits than a FLOAT holds, a time of day in a DATE, a zone in a time without one, a number other than 0 and 1 in a
    BOOLEAN. Columns named in ``lossy`` are rounded or cut as Spark casts them instead. Columns that
    the frame lacks are null; a column that the schema lacks is an error.
    """
    rounded = {c.lower() for c in lossy}
    given: dict[str, str] = {}
    for name in df.columns:
        if name.lower() in given:
            raise ValueError(f"the frame repeats column {name}")
        given[name.lower()] = name
    unknown = sorted(set(given) - {f.name.lower() for f in schema.fields})
    if unknown:
        raise ValueError(f"the table lacks columns: {', '.join(given[c] for c in unknown)}")

    def fitted(wanted: T.StructField) -> Column:
        name = given.get(wanted.name.lower())
        if name is None:
            return F.lit(None).cast(wanted.dataType).alias(wanted.name)
        have, value = df.schema[name].dataType, column(name)
        if have == wanted.dataType:
            return value.alias(wanted.name)
        if isinstance(have, T.StringType):
            value = F.when(F.btrim(value) != "", F.btrim(value))
            converted, same = from_text(value, wanted.dataType)
        else:
            converted, same = from_value(value, have, wanted.dataType)
        kept = converted.isNotNull() if wanted.name.lower() in rounded else converted.isNotNull() & same
        message = F.concat(F.lit(f"column {wanted.name} cannot hold "), F.coalesce(column(name).cast("string"), F.lit("")))
        failed = F.raise_error(message).cast(wanted.dataType)
        return F.when(value.isNull() | F.coalesce(kept, F.lit(False)), converted).otherwise(failed).alias(wanted.name)

    return df.select([fitted(f) for f in schema.fields])


def rename_present(df: DataFrame, renames: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist and ignore the rest."""
    return df.withColumnsRenamed(dict(renames))


def keep_right_of(df: DataFrame, identifiers: Sequence[str], position: int) -> DataFrame:
    """The identifier columns and every column right of a position."""
    return df.select([column(c) for c in [*identifiers, *df.columns[position:]]])


def first_columns(df: DataFrame, count: int) -> DataFrame:
    """The leftmost columns."""
    return df.select([column(c) for c in df.columns[:count]])


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Without the named column, which must exist unless there are no columns at all."""
    if df.columns and name not in df.columns:
        raise ValueError(f"no column {name}")
    return df.drop(name)
