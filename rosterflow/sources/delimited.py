"""Delimited files: comma-separated, caret-separated and tab-separated with CR line ends."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.text import swap_value
from rosterflow.functions.names import column
from rosterflow.operators.ordering import union_by_name
from rosterflow.session import use_java_charsets

# Columns of the English-language status file, in file order.
LANGUAGE_STATUS_COLUMNS = [
    "Record Type Code",
    "Transaction Type Code",
    "Local Record ID",
    "Reporting LEA",
    "School of Attendance",
    "Academic Year ID",
    "SSID",
    "Student Legal First Name",
    "Student Legal Last Name",
    "Student Birth Date",
    "Student Gender Code",
    "Local Student ID",
    "English Language Acquisition Status Code",
    "English Language Acquisition Status Start Date",
    "Primary Language Code",
    "Correction Reason Code",
]

# Separator of the state files, and separator and line end of the import files.
CARET = "^"
TAB = "\t"
CARRIAGE_RETURN = "\r"
MAC_ROMAN = "x-MacRoman"

# Charsets that Python calls by another name.
PYTHON_CHARSETS = {MAC_ROMAN: "mac_roman"}

# Text is read and written as it stands: quotes double inside quotes, blanks stay, empty is empty.
CSV_AS_IS = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
    "emptyValue": "",
    "nullValue": "",
}


def text_schema(names: Sequence[str]) -> T.StructType:
    """All-text schema with the given names."""
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def read_csv(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    encoding: str = "UTF-8",
    force_string: bool = False,
    schema: T.StructType | None = None,
    line_sep: str | None = None,
    multi_line: bool = False,
    by_name: bool = False,
    keep_bad_bytes: bool = False,
) -> DataFrame:
    """Delimited files with a header row.

    All files must have the same header; one that differs fails the read. With ``by_name`` files may
    have other headers: they are read header by header and put together by column name,
    at the price of a look at each file's first line.

    Types are guessed from all values: whole number, number, truth value or text. Dates stay
    text. With ``force_string`` every column is text, and with a ``schema`` nothing is guessed;
    either saves the guessing pass over the files. Empty fields are null. A row with too few or
    too many fields fails the read. Bytes that the charset does not have fail it too, unless
    ``keep_bad_bytes``. ``multi_line`` allows line breaks inside quotes, at the price of one task per
    file; a file of one column is always read so, since its lines look the same either way.
    """
    use_java_charsets(spark, encoding)
    if by_name:
        groups = files_by_header(spark, path, encoding, line_sep)
        frames = [
            read_csv(spark, files, sep, encoding, force_string, schema, line_sep, multi_line, False, keep_bad_bytes)
            for files in groups
        ]
        if schema is None and len(frames) > 1:
            # Types that differ between headers meet as text.
            kinds = [dict(f.dtypes) for f in frames]
            mixed = {c for k in kinds for c in k if len({o[c] for o in kinds if c in o}) > 1}
            frames = [f.select([column(c).cast("string").alias(c) if c in mixed else column(c) for c in f.columns]) for f in frames]
        return union_by_name(*frames)
    options = dict(sep=sep, encoding=encoding, header=True, enforceSchema=False, mode="FAILFAST", **CSV_AS_IS)
    if line_sep is not None:
        options["lineSep"] = line_sep
    reader = spark.read.options(multiLine=multi_line, **options)
    if schema is None:
        guessed = reader.option("inferSchema", not force_string).csv(path).schema
        schema = T.StructType([T.StructField(f.name, _plain_type(f.dataType)) for f in guessed.fields])
    if len(schema.fields) == 1:
        reader = reader.option("multiLine", True)
    df = reader.schema(schema).csv(path)
    return df if keep_bad_bytes else refuse_bad_bytes(df)


def refuse_bad_bytes(df: DataFrame) -> DataFrame:
    """The frame; a text with U+FFFD, which stands for bytes that the charset does not have, fails the query."""

    def checked(name: str) -> Column:
        message = F.concat(F.lit(f"column {name} has bytes that its charset lacks: "), column(name))
        bad = F.raise_error(message).cast("string")
        return F.when(column(name).contains("\ufffd"), bad).otherwise(column(name)).alias(name)

    return df.select([checked(f.name) if isinstance(f.dataType, T.StringType) else column(f.name) for f in df.schema.fields])


def files_by_header(spark: SparkSession, path: str, encoding: str = "UTF-8", line_sep: str | None = None) -> list[list[str]]:
    """The files of a path in groups of equal first lines, in the order of those; one row per file comes to the driver."""
    reader = spark.read.option("encoding", encoding)
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    lines = reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )
    first = lines.filter("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    groups: dict[str, list[str]] = {}
    for row in first.orderBy("header", "file").collect():
        groups.setdefault(row["header"], []).append(row["file"])
    if not groups:
        raise FileNotFoundError(f"no lines in {path}")
    return list(groups.values())


def _plain_type(guess: T.DataType) -> T.DataType:
    if isinstance(guess, T.IntegralType):
        return T.LongType()
    return guess if isinstance(guess, (T.DoubleType, T.BooleanType)) else T.StringType()


def read_caret(
    spark: SparkSession,
    path: str,
    names: Sequence[str],
    encoding: str = "UTF-8",
    multi_line: bool = False,
    keep_bad_bytes: bool = False,
) -> DataFrame:
    """Caret-separated files without a header, all text, empty fields null.

    Bytes that the charset does not have fail the read, unless ``keep_bad_bytes``.
    """
    use_java_charsets(spark, encoding)
    one_column = len(names) == 1
    df = (
        spark.read.schema(text_schema(names))
        .options(sep=CARET, encoding=encoding, header=False, multiLine=multi_line or one_column, mode="FAILFAST", **CSV_AS_IS)
        .csv(path)
    )
    return df if keep_bad_bytes else refuse_bad_bytes(df)


def write_caret(df: DataFrame, path: str) -> None:
    """Caret-separated UTF-8 files without a header; null is an empty field."""
    df.write.options(sep=CARET, encoding="UTF-8", header=False, **CSV_AS_IS).csv(path)


def write_import(df: DataFrame, path: str, encoding: str = MAC_ROMAN) -> None:
    """Tab-separated files with a header and CR line ends. Each part file is an import file of its own.

    A character that the charset does not have fails the write.
    """
    use_java_charsets(df.sparkSession, encoding)
    # Encoding fails where the writer would put a question mark.
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.select([F.decode(F.encode(column(c), encoding), encoding).alias(c) if c in text else column(c) for c in df.columns])
    for name in df.columns:
        name.encode(PYTHON_CHARSETS.get(encoding, encoding))
    df.write.options(sep=TAB, encoding=encoding, header=True, lineSep=CARRIAGE_RETURN, **CSV_AS_IS).csv(path)


def read_import(spark: SparkSession, path: str, encoding: str = MAC_ROMAN, multi_line: bool = False) -> DataFrame:
    """Files that ``write_import`` wrote, all text."""
    return read_csv(spark, path, TAB, encoding, force_string=True, line_sep=CARRIAGE_RETURN, multi_line=multi_line)


def convert_to_import(
    spark: SparkSession, path: str, target: str, encoding: str = MAC_ROMAN, multi_line: bool = False
) -> None:
    """Comma-separated files to import files in the same charset; ``multi_line`` if fields have line breaks."""
    write_import(read_csv(spark, path, encoding=encoding, force_string=True, multi_line=multi_line), target, encoding)


def swap_in_files(
    spark: SparkSession,
    path: str,
    target: str,
    names: Sequence[str],
    swap_column: str,
    old: str,
    new: str,
    encoding: str = "UTF-8",
) -> None:
    """Rewrite caret files with one value of one column swapped."""
    df = read_caret(spark, path, names, encoding)
    write_caret(df.withColumn(swap_column, swap_value(column(swap_column), old, new)), target)
