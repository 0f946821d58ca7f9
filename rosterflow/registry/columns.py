"""SQL sources, names, types, filters and scalar functions."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.functions import dates
from rosterflow.functions.names import sanitise_text
from rosterflow.functions.text import (
    NOT_ASSIGNED,
    blank_nulls,
    blank_sentinel,
    number_key,
    placeholder,
    swap_value,
    thousands,
)
from rosterflow.operators.columns import (
    all_strings,
    clean_columns,
    create_table_sql,
    drop_column,
    first_columns,
    guess_types,
    keep_right_of,
    rename_present,
    type_text_columns,
)
from rosterflow.operators.ordering import distinct_rows, row_range, sort_rows, union_by_name
from rosterflow.plans.load import publish_report, without_gaps
from rosterflow.registry.base import query, scratch_schema, table, text
from rosterflow.session import scratch_path
from rosterflow.sources.sql import SchemaTables, describe, execute, read_sql, read_sql_file, read_sql_files, read_table

AS_OF = datetime.date(1998, 6, 30)


@query(
    """
SELECT n_name AS nation, o_orderpriority, count(*) AS order_count, max(o_orderkey) AS last_order
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderstatus = 'O' AND c_acctbal >= 1000 GROUP BY ALL
"""
)
def sql_template(spark: SparkSession, sf: str) -> DataFrame:
    """A query file with text fields and with typed parameters."""
    folder = scratch_path(spark, "query")
    sql = """
        SELECT {label} AS nation, o_orderpriority, count(*) AS order_count, max(o_orderkey) AS last_order
        FROM IDENTIFIER('parquet.`' || :folder || '/orders.parquet`')
        JOIN IDENTIFIER('parquet.`' || :folder || '/customer.parquet`') ON o_custkey = c_custkey
        JOIN IDENTIFIER('parquet.`' || :folder || '/nation.parquet`') ON c_nationkey = n_nationkey
        WHERE o_orderstatus = :status AND c_acctbal >= :balance
        GROUP BY ALL"""
    spark.createDataFrame([(sql,)], "value string").coalesce(1).write.text(folder)
    return read_sql_file(
        spark, folder, {"label": "n_name"}, {"folder": sf.rstrip("/"), "status": "O", "balance": 1000}
    )


@query(
    """
SELECT c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, CAST(s_nationkey AS VARCHAR), '' FROM supplier
"""
)
def sql_files_combined(spark: SparkSession, sf: str) -> DataFrame:
    """Two query files stacked by name, blanks for nulls."""
    folder = scratch_path(spark, "queries")
    files = {
        "customers": "SELECT c_name AS name, c_nationkey AS nation, c_mktsegment AS segment FROM parquet.`{folder}/customer.parquet`",
        "suppliers": "SELECT s_nationkey AS nation, s_name AS name FROM parquet.`{folder}/supplier.parquet`",
    }
    for name, sql in files.items():
        spark.createDataFrame([(sql,)], "value string").coalesce(1).write.text(f"{folder}/{name}")
    parameters = {"folder": sf.rstrip("/")}
    return read_sql_files(spark, [{"path": f"{folder}/{name}", "parameters": parameters} for name in files])


@query(
    """
SELECT o_orderpriority, CAST(count(*) AS VARCHAR) AS order_count, strftime(max(o_orderdate), '%Y-%m-%d') AS last_date, '' AS all_orders
FROM orders WHERE o_orderkey >= 100 GROUP BY o_orderpriority
UNION ALL SELECT '', '', '', CAST(count(*) AS VARCHAR) FROM orders
"""
)
def tables_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Create a table, fill it, and reach it by name, by attribute and from SQL."""
    schema, name = scratch_schema(spark), f"orders_{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    execute(spark, create_table_sql(name, schema, "orders that were copied", data=orders))
    read = read_table(spark, name, schema)
    orders.select(*read.columns).write.insertInto(f"{schema}.{name}")
    by_attribute = getattr(SchemaTables(spark, schema), name).agg(F.count(F.lit(1)).alias("all_orders"))
    by_sql = read_sql(
        spark,
        "SELECT o_orderpriority, count(*) AS order_count, date_format(max(o_orderdate), 'yyyy-MM-dd') AS last_date "
        "FROM IDENTIFIER(:orders) WHERE o_orderkey >= :low GROUP BY o_orderpriority",
        {"low": 100, "orders": f"{schema}.{name}"},
    )
    return blank_nulls(union_by_name(by_sql, by_attribute))


LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus l_shipdate"
).split()

# Per column, the widest of whole number, number and text among the texts of all rows.
KIND_OF_COLUMN = """
SELECT {0} AS position, '{1}' AS name, ['bigint', 'double', 'string'][1 + widest] AS type,
       ['INTEGER', 'FLOAT', 'VARCHAR'][1 + widest] AS declared_type
FROM (SELECT max(CASE WHEN regexp_full_match(v, '[+-]?[0-9]+') THEN 0 WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 1 ELSE 2 END) AS widest
      FROM (SELECT CAST({1} AS VARCHAR) AS v FROM lineitem))"""


@query(" UNION ALL ".join(KIND_OF_COLUMN.format(i, name) for i, name in enumerate(LINE_COLUMNS, start=1)))
def describe_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Column types found in the text of every row, and the type a table would declare."""
    typed = type_text_columns(all_strings(table(spark, sf, "lineitem")))
    declared = spark.createDataFrame(list(guess_types(typed).items()), "name string, declared_type string")
    return describe(typed).join(declared, "name").select("position", "name", "type", "declared_type")


SANITISED = r"""regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', '_', 'g')"""
DIGIT_FIRST = "CASE WHEN {0} = '' THEN 'no_col_name_or_merged_column_header' WHEN regexp_matches({0}, '^[0-9]') THEN '_' || " + SANITISED + " ELSE " + SANITISED + " END"


@query(
    f"""
SELECT p_partkey, {SANITISED.format("p_name || ' / ' || p_brand")} AS part_name,
       {DIGIT_FIRST.format("(p_size || '-' || p_type)")} AS size_name,
       {DIGIT_FIRST.format("replace(p_type, 'PROMO', '')")} AS type_name
FROM part
"""
)
def sanitise_part_names(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        "p_partkey",
        sanitise_text(F.concat("p_name", F.lit(" / "), "p_brand")).alias("part_name"),
        sanitise_text(F.concat(text("p_size"), F.lit("-"), "p_type")).alias("size_name"),
        sanitise_text(F.replace("p_type", F.lit("PROMO"), F.lit(""))).alias("type_name"),
    )


@query(f"SELECT conv_id, turn, {DIGIT_FIRST.format('text')} AS name FROM conversations")
def sanitise_accented_text(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", sanitise_text(F.col("text")).alias("name"))


@query(
    """
SELECT a.o_orderkey AS o_orderkey, a.o_custkey AS customer_no, a.o_orderstatus AS state, b.o_custkey AS customer_no_1,
       b.o_totalprice AS _2nd_price, b.o_orderpriority AS state_1
FROM orders a JOIN orders b ON a.o_orderkey = b.o_orderkey
"""
)
def dedup_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Orders beside themselves under clashing names."""
    orders = table(spark, sf, "orders")
    left = orders.select("o_orderkey", F.col("o_custkey").alias("Customer No"), F.col("o_orderstatus").alias("State"))
    right = orders.select(
        "o_orderkey",
        F.col("o_custkey").alias("customer-no"),
        F.col("o_totalprice").alias("2nd Price"),
        F.col("o_orderpriority").alias("state"),
    )
    return clean_columns(left.join(right, "o_orderkey"))


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders
"""
)
def all_text(spark: SparkSession, sf: str) -> DataFrame:
    return all_strings(table(spark, sf, "orders").withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")))


@query("SELECT o_orderkey, o_orderstatus AS state, o_totalprice, o_orderpriority FROM orders")
def keep_notes_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Identifier and everything right of the second column, renamed where present, one column dropped."""
    kept = keep_right_of(table(spark, sf, "orders"), ["o_orderkey"], 2)
    return drop_column(rename_present(kept, {"o_orderstatus": "state", "o_comment": "comment"}), "o_orderdate")


@query("SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY'")
def filter_equal(spark: SparkSession, sf: str) -> DataFrame:
    return first_columns(table(spark, sf, "customer").filter(F.col("c_mktsegment") == "MACHINERY"), 2)


@query(
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS start_date FROM orders
WHERE o_orderstatus <> 'P' AND o_orderdate >= TIMESTAMP '1998-08-14'
"""
)
def filter_from_date(spark: SparkSession, sf: str) -> DataFrame:
    dated = table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.date_format("o_orderdate", "yyyyMMdd")).alias("start_date"),
    )
    return dates.keep_from_date(dated, "start_date", "08/14/1998")


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN '' ELSE o_orderstatus END AS state,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS priority
FROM orders
"""
)
def swap_values(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("state"),
        swap_value(F.col("o_orderpriority"), "4-NOT SPECIFIED", NOT_ASSIGNED).alias("priority"),
    )
    return blank_nulls(
        orders.withColumn("state", swap_value(F.col("state"), "P", "pending")).withColumn(
            "priority", blank_sentinel(F.col("priority"))
        )
    )


@query(
    """
SELECT o_orderkey, o_custkey AS key_number, TRY_CAST(CASE WHEN o_orderstatus = 'F' THEN o_custkey || 'd'
         WHEN o_orderstatus = 'O' THEN ' ' || o_custkey || '.0 ' ELSE CAST(o_custkey AS VARCHAR) END AS DOUBLE) IS NOT NULL AS is_number
FROM orders WHERE o_orderstatus <> 'F'
UNION ALL SELECT o_orderkey, -1, false FROM orders WHERE o_orderstatus = 'F'
"""
)
def number_keys(spark: SparkSession, sf: str) -> DataFrame:
    """One key per number, however it is written; text that is no number has none."""
    written = (
        F.when(F.col("o_orderstatus") == "F", F.concat(text("o_custkey"), F.lit("d")))
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), text("o_custkey"), F.lit(".0 ")))
        .otherwise(text("o_custkey"))
    )
    key = number_key(written)
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.coalesce(key.cast("decimal(38,10)").cast("bigint"), F.lit(-1)).alias("key_number"),
        key.isNotNull().alias("is_number"),
    )


@query(
    """
SELECT 'rollover day' AS day, event_id, user_id, event_type, value FROM events WHERE event_type <> 'error'
UNION ALL SELECT 'day after', event_id, user_id, event_type, value FROM events
"""
)
def skip_code_until(spark: SparkSession, sf: str) -> DataFrame:
    """The code is skipped up to the rollover day and kept from the day after."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    rollover = datetime.date(2024, 1, 15)
    days = {"rollover day": rollover, "day after": rollover + datetime.timedelta(days=1)}
    kept = [
        dates.skip_code_until(events, "event_type", "error", day, rollover).withColumn("day", F.lit(name))
        for name, day in days.items()
    ]
    return union_by_name(*kept)


@query(
    """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS submitted_on,
       strftime(o_orderdate + INTERVAL 13 HOUR + INTERVAL 5 MINUTE, '%Y-%m-%d %H:%M:%S') AS submitted_at,
       strftime(least(o_orderdate, TIMESTAMP '1998-06-30'), '%Y-%m-%d') AS report_date,
       (year(o_orderdate) - 1) || '-' || year(o_orderdate) AS academic_year,
       format('{:,}', o_orderkey * 1000 + o_custkey) AS amount, '{' || o_orderpriority || '_year}' AS token
FROM orders
"""
)
def date_labels(spark: SparkSession, sf: str) -> DataFrame:
    listed = table(spark, sf, "orders").withColumn(
        "submitted", F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" 01:05:00 PM"))
    )
    moment = dates.parse_submitted(F.col("submitted"))
    return listed.select(
        "o_orderkey",
        dates.iso_date(moment).alias("submitted_on"),
        F.date_format(moment, "yyyy-MM-dd HH:mm:ss").alias("submitted_at"),
        dates.iso_date(dates.clamp_to(F.to_date("o_orderdate"), AS_OF)).alias("report_date"),
        dates.academic_year(F.year("o_orderdate")).alias("academic_year"),
        thousands(F.col("o_orderkey") * 1000 + F.col("o_custkey")).alias("amount"),
        placeholder(F.col("o_orderpriority"), "_year").alias("token"),
    )


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 200 OFFSET 100")
def row_range_by_key(spark: SparkSession, sf: str) -> DataFrame:
    return row_range(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_orderkey", 100, 300)


@query("SELECT event_id, event_type FROM events ORDER BY ts OFFSET 5000")
def row_range_to_end(spark: SparkSession, sf: str) -> DataFrame:
    """Everything from a position on, by a timestamp."""
    return row_range(table(spark, sf, "events"), "ts", 5000).select("event_id", "event_type")


@query("SELECT *, row_number() OVER (ORDER BY c_mktsegment NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey) AS position FROM customer")
def sort_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customers in the order of a sort, published with the position it gives each."""
    report = f"{scratch_schema(spark)}.sorted_{uuid.uuid4().hex}"
    publish_report(sort_rows(table(spark, sf, "customer"), ["c_mktsegment", "c_acctbal", "c_custkey"], [True, False, True]), report, row_no="position")
    return without_gaps(spark.table(report), "position")


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 30")
def first_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The thirty largest orders."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(30)


@query(
    """
SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_name, s_nationkey, s_acctbal, NULL FROM supplier
"""
)
def union_missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")
    )
    return union_by_name(customers, suppliers)


@query("SELECT DISTINCT * FROM lineitem")
def distinct_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Whole lines once, with copies put in: all lines twice, and those of one flag a third time."""
    lines = table(spark, sf, "lineitem")
    return distinct_rows(union_by_name(lines, lines, lines.filter("l_returnflag = 'R'")))
