"""JSON that arrives as pages, each an array of objects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rosterflow.functions.names import column
from rosterflow.sources.json_columns import discover_schema


def parsed_type(item_schema: str) -> T.ArrayType:
    """Type of a page of such items."""
    return T.ArrayType(T.StructType.fromDDL(item_schema))


def explode_pages(pages: DataFrame, body: str, item_schema: str) -> DataFrame:
    """One row per object: the other columns of the page, ``item_no`` from 1, then the object's fields.

    ``item_schema`` is a DDL field list such as ``id BIGINT, name STRING``. A page that is null,
    empty or not an array of JSON fails the query; an empty array has no object.
    """
    parsed = F.from_json(column(body), parsed_type(item_schema), {"mode": "FAILFAST"})
    no_page = F.raise_error(F.lit("a page is null or empty")).cast(parsed_type(item_schema))
    items = F.when(parsed.isNotNull(), parsed).otherwise(no_page)
    rest = [column(c) for c in pages.columns if c != body]
    return pages.select(*rest, F.posexplode(items).alias("_at", "_item")).select(
        *rest, (F.col("_at") + 1).alias("item_no"), "_item.*"
    )


def read_paged_json(
    spark: SparkSession, path: str, item_schema: str | None = None, page_no: Column | None = None, one_page_per_line: bool = False
) -> DataFrame:
    """Objects of all pages; order by ``page_no`` and ``item_no`` for page order.

    Without an ``item_schema`` one is found in all pages first, which reads them twice (see ``discover_schema``).

    A file is a page, or each line is one. ``page_no`` is an expression over the columns
    ``body`` and ``file_name``; by default the last number in the file name.
    """
    raw = spark.read.text(path, wholetext=not one_page_per_line).select(
        F.col("value").alias("body"), F.col("_metadata.file_name").alias("file_name")
    )
    if page_no is None:
        page_no = F.regexp_extract("file_name", r"(\d+)\D*$", 1).try_cast("bigint")
    if item_schema is None:
        found = discover_schema(raw, "body")
        if not isinstance(found, T.ArrayType) or not isinstance(found.elementType, T.StructType):
            raise ValueError(f"{path} holds no pages of JSON objects: {found.simpleString()}")
        item_schema = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in found.elementType.fields)
    return explode_pages(raw.select(page_no.alias("page_no"), "body"), "body", item_schema)
