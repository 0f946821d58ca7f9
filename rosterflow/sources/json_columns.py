"""JSON texts as typed columns, with the schema found in the data."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.names import column, dedup_names, sanitise_name


def discover_schema(df: DataFrame, text: str) -> T.DataType:
    """The type that all JSON texts of a column share, merged over all rows by one aggregate.

    A field that only some rows have is in it; one with values of different kinds is a VARIANT, whole numbers beside fractions are
    decimals wide enough for both, and one that is null everywhere is text. Texts that are no JSON, and nulls, do not count; without any other the type is VARIANT.
    """
    found = df.agg(F.schema_of_variant_agg(F.try_parse_json(column(text)))).first()[0]
    return spark_type_of(df, found)


def spark_type_of(df: DataFrame, found: str | None) -> T.DataType:
    """The Spark type of a merged variant schema's text."""
    if found is None or found == "VOID":
        return T.VariantType()
    # Names in backticks may hold anything, so only what stands between them is rewritten.
    parts = re.split(r"(`(?:[^`]|``)*`)", found)
    parts[::2] = [re.sub(r"\bVOID\b", "STRING", re.sub(r"\bOBJECT<", "STRUCT<", p)) for p in parts[::2]]
    return df.sparkSession.range(0).select(F.lit(None).cast("".join(parts))).schema[0].dataType


def json_columns(df: DataFrame, text: str, schema: T.DataType | None = None, malformed: str | None = None, prefix: str = "") -> DataFrame:
    """``df`` with the fields of a column of JSON objects as typed columns in its place, in the order of their names.

    Without a ``schema`` one is found in the data (``discover_schema``). Names are cleaned and made unique beside the columns that are there
    already. Objects within objects stay structs. A null text, and an absent field, gives nulls. A text that is no JSON object of the schema
    fails the query, or goes as it is into the column named by ``malformed``.
    """
    kind = schema or discover_schema(df, text)
    if not isinstance(kind, T.StructType):
        raise ValueError(f"column {text} holds no JSON objects: {kind.simpleString()}")
    parsed = F.from_json(column(text), T.StructType([*kind.fields, T.StructField("_corrupt", T.StringType())]), {"columnNameOfCorruptRecord": "_corrupt"})
    bad = column(text).isNotNull() & (F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull())
    kept = [c for c in df.columns if c != text]
    names = dedup_names([*kept, *[sanitise_name(prefix + f.name) for f in kind.fields]])[len(kept) :]
    fields = [F.col("_parsed").getField(f.name).alias(n) for f, n in zip(kind.fields, names, strict=True)]
    rows = df.withColumn("_parsed", parsed)
    if malformed:
        return rows.select(*[column(c) for c in kept], *fields, F.when(bad, column(text)).alias(malformed))
    failed = F.raise_error(F.concat(F.lit(f"column {text} holds no JSON object: "), column(text))).cast("boolean")
    return rows.filter(~bad | failed).select(*[column(c) for c in kept], *fields)
