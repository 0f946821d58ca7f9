"""Files, grids, tables and streams. Whatever is written goes to a new shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions.dates import keep_from_date
from rosterflow.operators.columns import clean_columns, create_table_sql, guess_types, rename_present, type_text_columns
from rosterflow.operators.ordering import union_by_name
from rosterflow.plans.load import append_frame, reconcile_load, upload_csv, upload_grid
from rosterflow.plans.sketches import distinct_estimates, store_sketches
from rosterflow.registry.base import query, scratch_schema, table, text
from rosterflow.session import scratch_path, use_java_charsets
from rosterflow.sources.delimited import (
    CSV_AS_IS,
    LANGUAGE_STATUS_COLUMNS,
    MAC_ROMAN,
    convert_to_import,
    read_caret,
    read_csv,
    read_import,
    swap_in_files,
    write_caret,
)
from rosterflow.sources.folder import latest_drop
from rosterflow.sources.grid import frame_to_grid, grid_to_frame
from rosterflow.sources.json_columns import json_columns
from rosterflow.sources.paged_json import read_paged_json
from rosterflow.sources.sql import execute
from rosterflow.streaming.landing import land_new_files


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
    "printf('%.2f', c_acctbal) AS c_acctbal, c_mktsegment FROM customer"
)
def grid_to_table(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        (F.col("c_custkey") + 1).alias("row_no"), "c_custkey", "c_name", "c_nationkey",
        F.format_string("%.2f", "c_acctbal").alias("c_acctbal"), "c_mktsegment",
    )
    return grid_to_frame(frame_to_grid(customers, "row_no", header_row=2), header_row=2)


@query("SELECT conv_id, turn, role, text FROM conversations")
def paged_json(spark: SparkSession, sf: str) -> DataFrame:
    """Conversations packed into arrays of at most a hundred items, written and read as pages."""
    folder = scratch_path(spark, "pages")
    # Rows are numbered within their file split, so no page depends on how a key is distributed.
    numbered = table(spark, sf, "conversations").select(
        "*", F.spark_partition_id().alias("split"), F.monotonically_increasing_id().alias("row_no")
    )
    pages = numbered.groupBy("split", F.floor(F.col("row_no") / 100).alias("page")).agg(
        F.to_json(F.array_sort(F.collect_list(F.struct("row_no", "conv_id", "turn", "role", "text")))).alias("body")
    )
    pages.select("body").write.text(folder)
    items = read_paged_json(
        spark, folder, "conv_id BIGINT, turn BIGINT, role STRING, text STRING", one_page_per_line=True
    )
    return items.select("conv_id", "turn", "role", "text")


@query(
    """
SELECT CAST(c_custkey AS VARCHAR) AS "Local Student ID", c_name AS "Student Legal First Name",
       CASE WHEN c_mktsegment = 'BUILDING' THEN 'Café' ELSE c_mktsegment END AS "English Language Acquisition Status Code",
       CASE WHEN c_acctbal < 0 THEN '' ELSE CAST(c_nationkey AS VARCHAR) END AS "Primary Language Code",
       strftime(DATE '2023-01-01' + CAST(c_custkey AS INTEGER), '%Y%m%d') AS "English Language Acquisition Status Start Date"
FROM customer WHERE DATE '2023-01-01' + CAST(c_custkey AS INTEGER) >= DATE '2023-08-15'
"""
)
def caret_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Status files in a Windows charset: read, one value swapped, written, read, filtered by date."""
    folder = scratch_path(spark, "caret")
    customers = table(spark, sf, "customer")
    given = {
        "Local Student ID": text("c_custkey"),
        "Student Legal First Name": F.col("c_name"),
        "English Language Acquisition Status Code": F.col("c_mktsegment"),
        "Primary Language Code": F.when(F.col("c_acctbal") >= 0, text("c_nationkey")),
        "English Language Acquisition Status Start Date": F.date_format(
            F.date_add(F.lit("2023-01-01").cast("date"), F.col("c_custkey").cast("int")), "yyyyMMdd"
        ),
    }
    status = customers.select(
        [given.get(c, F.lit(None).cast("string")).alias(c) for c in LANGUAGE_STATUS_COLUMNS]
    )
    write_caret(status, f"{folder}/in")
    swap_in_files(
        spark,
        f"{folder}/in",
        f"{folder}/out",
        LANGUAGE_STATUS_COLUMNS,
        "English Language Acquisition Status Code",
        "BUILDING",
        "Café",
        "windows-1252",
    )
    read = read_caret(spark, f"{folder}/out", LANGUAGE_STATUS_COLUMNS)
    kept = keep_from_date(read, "English Language Acquisition Status Start Date", "08/15/2023")
    return kept.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in given])


@query(
    """
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role AS "Role",
       text AS student_text
FROM conversations
"""
)
def import_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Accented text with line breaks through comma files and tab files with CR line ends, both in the Mac charset."""
    folder = scratch_path(spark, "import")
    flat = table(spark, sf, "conversations").select(
        "conv_id", "turn", F.col("role").alias("Role"), F.col("text").alias("student_text")
    )
    use_java_charsets(spark, MAC_ROMAN)
    flat.write.options(header=True, encoding=MAC_ROMAN, **CSV_AS_IS).csv(f"{folder}/csv")
    convert_to_import(spark, f"{folder}/csv", f"{folder}/tab", MAC_ROMAN, multi_line=True)
    return read_import(spark, f"{folder}/tab", MAC_ROMAN, multi_line=True)


@query(
    """
SELECT s_suppkey AS supplier_no, s_name AS supplier_name, CAST(s_nationkey AS BIGINT) AS nation, s_acctbal AS balance FROM supplier
UNION ALL SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT), s_acctbal FROM supplier
"""
)
def append_load(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows twice into a declared table, with columns in another order the second time."""
    target = f"{scratch_schema(spark)}.supplier_{uuid.uuid4().hex}"
    schema, name = target.split(".")
    suppliers = rename_present(
        table(spark, sf, "supplier"),
        {"s_suppkey": "Supplier No.", "s_name": "Supplier  Name", "s_nationkey": "Nation", "s_acctbal": "Balance"},
    )
    columns = {"supplier_no_": "INTEGER", "supplier_name": "VARCHAR", "nation": "INTEGER", "balance": "FLOAT"}
    execute(spark, create_table_sql(name, schema, "suppliers, loaded twice", columns))
    append_frame(suppliers, target)
    append_frame(suppliers.select([f"`{c}`" for c in reversed(suppliers.columns)]), target)
    return rename_present(spark.table(target), {"supplier_no_": "supplier_no"})


@query("SELECT * FROM orders ORDER BY o_orderkey OFFSET 40")
def append_in_steps(spark: SparkSession, sf: str) -> DataFrame:
    """A load in two steps by row position."""
    target = f"{scratch_schema(spark)}.orders_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    append_frame(orders, target, 40, 7000, key="o_orderkey")
    append_frame(orders, target, 7000, key="o_orderkey")
    return spark.table(target)


@query(
    """
SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS line, l_quantity AS quantity, l_returnflag AS flag,
       strftime(l_shipdate, '%m/%d/%Y') AS shipped, l_linestatus = 'O' AS open, l_partkey AS part, l_suppkey AS supplier,
       l_extendedprice AS price, l_discount AS discount, l_tax AS tax
FROM lineitem
"""
)
def upload_delimited(spark: SparkSession, sf: str) -> DataFrame:
    """Semicolon files with guessed types into a table."""
    folder = scratch_path(spark, "csv")
    target = f"{scratch_schema(spark)}.lines_{uuid.uuid4().hex}"
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("Order No"),
        F.col("l_linenumber").alias("Line"),
        F.col("l_quantity").alias("Quantity"),
        F.col("l_returnflag").alias("Flag"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("Shipped"),
        (F.col("l_linestatus") == "O").alias("Open"),
        F.col("l_partkey").alias("Part"),
        F.col("l_suppkey").alias("Supplier"),
        F.col("l_extendedprice").alias("Price"),
        F.col("l_discount").alias("Discount"),
        F.col("l_tax").alias("Tax"),
    )
    lines.write.options(sep=";", header=True).csv(folder)
    upload_csv(spark, folder, target, sep=";")
    return spark.table(target)


@query(
    "SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DOUBLE) AS o_totalprice, "
    "strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"
)
def upload_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """A grid with guessed types into a table."""
    target = f"{scratch_schema(spark)}.sheet_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select(
        (F.col("o_orderkey") + 1).alias("row_no"), "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderpriority",
    )
    upload_grid(frame_to_grid(orders, "row_no"), target)
    return spark.table(target)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus <> 'P'")
def latest_file(spark: SparkSession, sf: str) -> DataFrame:
    """Two drops of orders; the second, with what has been settled, is read."""
    folder = scratch_path(spark, "drops")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    orders.drop("o_orderstatus").write.csv(f"{folder}/zz-first", header=True)
    orders.filter("o_orderstatus <> 'P'").drop("o_orderstatus").write.csv(f"{folder}/aa-second", header=True)
    return read_csv(spark, latest_drop(spark, folder), force_string=True)


@query(
    """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, user_id, event_type, value, props FROM events
"""
)
def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Event files that arrive in two drops, each landed by a run of the stream."""
    folder = scratch_path(spark, "stream")
    events = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "user_id", F.col("event_type").alias("Event Type"),
        "value", "props",
    )
    schema = "event_id BIGINT, ts STRING, user_id BIGINT, `Event Type` STRING, value DOUBLE, props STRING"
    for drop in ("value < 10", "value >= 10 OR value IS NULL"):
        events.filter(drop).write.mode("append").options(header=True, **CSV_AS_IS).csv(f"{folder}/in")
        landed = land_new_files(spark, f"{folder}/in", schema, f"{folder}/out", f"{folder}/checkpoint")
    return landed


@query(
    """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice, o_orderdate, o_orderpriority,
       strftime(o_orderdate, '%Y-%m-%d') AS as_of, o_orderstatus = 'P' AS pending, '[' || o_orderkey || ',' || o_custkey || ']' AS ids,
       CAST(NULL AS VARCHAR) AS remark
FROM orders
"""
)
def load_declared_types(spark: SparkSession, sf: str) -> DataFrame:
    """Orders through a CSV file into a table whose types are declared; the file lacks one of its columns."""
    folder = scratch_path(spark, "typed")
    schema, name = scratch_schema(spark), f"typed_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", F.format_string("%.2f", "o_totalprice").alias("o_totalprice"),
        "o_orderdate", "o_orderpriority", F.to_date("o_orderdate").alias("As Of"), (F.col("o_orderstatus") == "P").alias("Pending"),
        F.concat(F.lit("["), "o_orderkey", F.lit(","), "o_custkey", F.lit("]")).alias("ids"),
    )
    orders.write.options(header=True, **CSV_AS_IS).csv(folder)
    declared = {
        **guess_types(clean_columns(read_csv(spark, folder, force_string=True))),
        "o_orderkey": "INTEGER",
        "o_custkey": "INTEGER",
        "o_totalprice": "NUMERIC(12,2)",
        "o_orderdate": "TIMESTAMP WITHOUT TIME ZONE",
        "pending": "BOOLEAN",
        "ids": "VARIANT",
        "remark": "VARCHAR",
    }
    execute(spark, create_table_sql(name, schema, columns=declared))
    upload_csv(spark, folder, f"{schema}.{name}")
    loaded = spark.table(f"{schema}.{name}")
    # Shown as text, which both engines spell alike.
    return loaded.withColumns({"ids": F.to_json("ids"), "o_totalprice": text("o_totalprice"), "as_of": text("as_of")})


@query("SELECT c_custkey, c_name, c_mktsegment, CASE WHEN c_acctbal < 0 THEN c_acctbal END AS c_acctbal FROM customer")
def read_mixed_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Files of one folder whose columns stand in another order, or are missing."""
    folder = scratch_path(spark, "headers")
    customers = table(spark, sf, "customer")
    customers.filter("c_acctbal < 0").select("c_mktsegment", "c_acctbal", "c_custkey", "c_name").write.csv(f"{folder}/a", header=True)
    customers.filter("c_acctbal >= 0").select("c_custkey", "c_name", "c_mktsegment").write.csv(f"{folder}/b", header=True)
    return read_csv(spark, f"{folder}/*", by_name=True)


@query("SELECT CAST(l_orderkey AS VARCHAR) || '00000000000000000000' || l_linenumber AS long_id, CAST(l_linenumber AS BIGINT) AS line FROM lineitem")
def long_numbers_stay_exact(spark: SparkSession, sf: str) -> DataFrame:
    """Whole numbers too long for a bigint stay text when types are guessed."""
    lines = table(spark, sf, "lineitem")
    long_id = F.concat("l_orderkey", F.lit("0" * 20), "l_linenumber").alias("long_id")
    return type_text_columns(lines.select(long_id, text("l_linenumber").alias("line")))


@query(
    """
SELECT 'quantity into INTEGER' AS load, count(*) FILTER (l_quantity <> trunc(l_quantity)) > 0 AS refused, count(*) AS held, CAST(sum(l_quantity) AS DOUBLE) AS total FROM lineitem
UNION ALL SELECT 'price text into NUMERIC(12,2)', count(*) FILTER (l_extendedprice <> round(l_extendedprice, 2)) > 0, count(*), round(sum(l_extendedprice), 2) FROM lineitem
UNION ALL SELECT 'price into INTEGER', count(*) FILTER (l_extendedprice <> trunc(l_extendedprice)) > 0, 0, NULL FROM lineitem
UNION ALL SELECT 'price text into NUMERIC(12,1)', count(*) FILTER (l_extendedprice <> round(l_extendedprice, 1)) > 0, 0, NULL FROM lineitem
UNION ALL SELECT 'price text into INTEGER, lossy', false, count(*), CAST(sum(trunc(l_extendedprice)) AS DOUBLE) FROM lineitem
UNION ALL SELECT 'day into DATE', count(*) FILTER (o_orderdate <> date_trunc('day', o_orderdate)) > 0, count(*), CAST(sum(year(o_orderdate)) AS DOUBLE) FROM orders
UNION ALL SELECT 'moment into DATE', count(*) FILTER (ts <> date_trunc('day', ts)) > 0, 0, NULL FROM events
UNION ALL SELECT 'moment text into DATE', count(*) FILTER (ts <> date_trunc('day', ts)) > 0, 0, NULL FROM events
UNION ALL SELECT 'line number into BOOLEAN', count(*) FILTER (l_linenumber NOT IN (0, 1)) > 0, 0, NULL FROM lineitem
"""
)
def load_refuses_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Loads into declared types: which were refused because a value would change, and what the tables hold then."""
    schema = scratch_schema(spark)
    lines, orders, events = (table(spark, sf, n) for n in ("lineitem", "orders", "events"))
    price = F.format_string("%.2f", "l_extendedprice")
    cases = [
        ("quantity into INTEGER", lines.select(F.col("l_quantity").alias("v")), "INTEGER", "v", ()),
        ("price text into NUMERIC(12,2)", lines.select(price.alias("v")), "NUMERIC(12,2)", "v", ()),
        ("price into INTEGER", lines.select(F.col("l_extendedprice").alias("v")), "INTEGER", "v", ()),
        ("price text into NUMERIC(12,1)", lines.select(price.alias("v")), "NUMERIC(12,1)", "v", ()),
        ("price text into INTEGER, lossy", lines.select(price.alias("v")), "INTEGER", "v", ("V",)),
        ("day into DATE", orders.select(F.col("o_orderdate").alias("v")), "DATE", "year(v)", ()),
        ("moment into DATE", events.select(F.col("ts").alias("v")), "DATE", "year(v)", ()),
        ("moment text into DATE", events.select(text("ts").alias("v")), "DATE", "year(v)", ()),
        ("line number into BOOLEAN", lines.select(F.col("l_linenumber").alias("v")), "BOOLEAN", "int(v)", ()),
    ]
    held = []
    for load, df, kind, figure, lossy in cases:
        name = f"exact_{uuid.uuid4().hex}"
        execute(spark, create_table_sql(name, schema, columns={"v": kind}))
        refused = False
        try:
            append_frame(df, f"{schema}.{name}", lossy=lossy)
        except Exception as error:
            if "cannot hold" not in str(error):
                raise
            refused = True
        figures = spark.table(f"{schema}.{name}").agg(F.count(F.lit(1)).alias("held"), F.sum(F.expr(figure)).cast("double").alias("total"))
        held.append(figures.select(F.lit(load).alias("load"), F.lit(refused).alias("refused"), "held", F.round("total", 2).alias("total")))
    return union_by_name(*held)


@query(
    """
WITH figures AS (
  SELECT count(*) AS rows, count(*) FILTER (o_orderstatus = 'F') AS finished, count(*) FILTER (o_orderstatus = 'P') AS pending,
         max(o_orderkey) AS last_key, round(sum(o_totalprice), 2) AS total FROM orders)
SELECT figure, observed, status FROM (
  SELECT 'rows' AS figure, CAST(rows AS VARCHAR) AS observed, CASE WHEN rows = 0 THEN 'empty' ELSE 'ok' END AS status FROM figures
  UNION ALL SELECT 'finished', CAST(finished AS VARCHAR), 'ok' FROM figures
  UNION ALL SELECT 'pending', CAST(pending AS VARCHAR), 'mismatch' FROM figures
  UNION ALL SELECT 'last_key', CAST(last_key AS VARCHAR), 'ok' FROM figures
  UNION ALL SELECT 'stored rows', CAST(rows AS VARCHAR), 'ok' FROM figures)
"""
)
def load_observed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Figures that a load of orders counted as it wrote, held against a manifest that is wrong in one of them."""
    target = f"{scratch_schema(spark)}.counted_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    status = F.col("o_orderstatus")
    figures = {"finished": F.count_if(status == "F"), "pending": F.count_if(status == "P"), "last_key": F.max("o_orderkey")}
    manifest = orders.agg(F.count(F.lit(1)).alias("rows"), *[f.alias(n) for n, f in figures.items()]).first().asDict()
    counted = append_frame(orders, target, figures=figures)
    # What the table holds is counted here only to show that it agrees with the load's own count.
    stored = spark.table(target).count()
    expected = {**manifest, "pending": manifest["pending"] + 1, "stored rows": counted["rows"]}
    return reconcile_load(spark, target, expected, {**counted, "stored rows": stored}).select("figure", "observed", "status")


@query("SELECT event_id, user_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(spark: SparkSession, sf: str) -> DataFrame:
    """The properties of events as typed columns, by a schema found in all of them."""
    return json_columns(table(spark, sf, "events").select("event_id", "user_id", "event_type", "props"), "props")


@query(
    """
SELECT date_trunc('month', o_orderdate) AS month, count(*) AS n_rows, count(DISTINCT o_custkey) AS customers, true AS within_error FROM orders GROUP BY ALL
"""
)
def distinct_customers_by_month(spark: SparkSession, sf: str) -> DataFrame:
    """Customers per month from sketches stored per day, beside exact counts; one month's days are loaded twice."""
    target = f"{scratch_schema(spark)}.sketches_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    store_sketches(orders, target, 1, "o_orderdate", [], "o_custkey")
    store_sketches(orders.filter("o_orderdate >= '1996-02-01' AND o_orderdate < '1996-03-01'"), target, 2, "o_orderdate", [], "o_custkey")
    month = F.date_trunc("month", F.col("load_day").cast("timestamp_ntz")).alias("month")
    estimates = distinct_estimates(spark.table(target), [month])
    exact = orders.groupBy(F.date_trunc("month", "o_orderdate").alias("month")).agg(F.count_distinct("o_custkey").alias("customers"))
    # Five per cent is three standard errors of the sketches.
    close = F.abs(F.col("estimate") - F.col("customers")) <= 0.05 * F.col("customers") + 1
    return exact.join(estimates, "month").select(F.col("month").cast("timestamp_ntz").alias("month"), "n_rows", "customers", close.alias("within_error"))
