"""Placeholders and filled templates.

Customers are the entities and order priorities their tags. Every nation has a template of its
own, which its customers use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterflow.plans.template import GoalColumns, collect_entries, fill_templates, placeholders, template_slots
from rosterflow.registry.base import query, table, text

NAMES = GoalColumns("o_custkey", "o_orderpriority", "year", "category", "goal", "main", "numerator", "denominator")


def goal_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as goal rows."""
    return table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderpriority",
        F.year("o_orderdate").alias("year"),
        F.when(F.col("o_orderstatus") == "P", "Goal").otherwise("Result").alias("category"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Enrollment").otherwise("Rate").alias("goal"),
        F.col("o_orderkey").alias("main"),
        (F.col("o_orderkey") + F.col("o_custkey")).alias("numerator"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey")).alias("denominator"),
    )


def nation_templates(spark: SparkSession, sf: str) -> DataFrame:
    """One template per nation."""
    body = F.concat(
        F.lit("{school} of "),
        "n_name",
        F.lit(": urgent {1-URGENT} in {1-URGENT_year}; high {2-HIGH%} = {2-HIGH_num}/{2-HIGH_den} in {2-HIGH_year}, "),
        F.lit("goal {2-HIGH}; low {5-LOW%} of {5-LOW_den}; {unknown} and again {1-URGENT}."),
    )
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("template"), body.alias("template_text"))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with the template they use."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("template"), "c_name"
    )


ENTRIES = """
newest AS (
  SELECT o_custkey, o_orderkey AS seq, o_orderpriority AS tag, CAST(year(o_orderdate) AS VARCHAR) AS year, o_orderstatus AS state,
         CAST(o_orderkey AS VARCHAR) AS main, CAST(o_orderkey + o_custkey AS VARCHAR) AS numerator,
         CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS denominator
  FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY year(o_orderdate) DESC) = 1),
entries AS (
  SELECT o_custkey, seq, '{' || tag || '}' AS token, main AS value FROM newest WHERE state = 'P' OR tag = '1-URGENT'
  UNION ALL SELECT o_custkey, seq, '{' || tag || '_year}', year FROM newest WHERE state <> 'P'
  UNION ALL SELECT o_custkey, seq, '{' || tag || '%}', main FROM newest WHERE state <> 'P' AND tag <> '1-URGENT'
  UNION ALL SELECT o_custkey, seq, '{' || tag || '_num}', numerator FROM newest WHERE state <> 'P' AND tag <> '1-URGENT'
  UNION ALL SELECT o_custkey, seq, '{' || tag || '_den}', denominator FROM newest WHERE state <> 'P' AND tag <> '1-URGENT'),
first_entries AS (SELECT o_custkey, token, arg_min(value, seq) AS value, min(seq) AS seq FROM entries GROUP BY ALL)"""

USED = [
    "{1-URGENT}",
    "{1-URGENT_year}",
    "{2-HIGH%}",
    "{2-HIGH_num}",
    "{2-HIGH_den}",
    "{2-HIGH_year}",
    "{2-HIGH}",
    "{5-LOW%}",
    "{5-LOW_den}",
]


@query(f"WITH {ENTRIES} SELECT o_custkey, seq, token, value FROM entries")
def placeholder_rows(spark: SparkSession, sf: str) -> DataFrame:
    return placeholders(goal_rows(spark, sf), "o_orderkey", NAMES)


@query(
    f"""
WITH {ENTRIES}
SELECT o_custkey, string_agg(token || '=' || value, ';' ORDER BY seq, token) AS tags
FROM first_entries WHERE token IN ({', '.join("'" + t + "'" for t in USED)}) GROUP BY o_custkey
"""
)
def tags_per_entity(spark: SparkSession, sf: str) -> DataFrame:
    slots = template_slots(nation_templates(spark, sf), "template", "template_text")
    rows = placeholders(goal_rows(spark, sf), "o_orderkey", NAMES)
    collected = collect_entries(rows, entities(spark, sf), slots, "o_custkey", "template")
    pairs = F.transform(F.map_entries("entries"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return collected.select("o_custkey", F.array_join(pairs, ";").alias("tags"))


def _nested_replace() -> str:
    filled = "replace(template_text, '{school}', c_name)"
    for i, token in enumerate(USED):
        filled = f"replace({filled}, '{token}', coalesce(v{i}, '{token}'))"
    values = ", ".join(f"max(value) FILTER (WHERE token = '{t}') AS v{i}" for i, t in enumerate(USED))
    return f"""
WITH {ENTRIES},
wide AS (SELECT o_custkey, {values} FROM first_entries GROUP BY o_custkey),
templates AS (
  SELECT n_nationkey, '{{school}} of ' || n_name || ': urgent {{1-URGENT}} in {{1-URGENT_year}}; high {{2-HIGH%}} = '
    || '{{2-HIGH_num}}/{{2-HIGH_den}} in {{2-HIGH_year}}, goal {{2-HIGH}}; low {{5-LOW%}} of {{5-LOW_den}}; '
    || '{{unknown}} and again {{1-URGENT}}.' AS template_text FROM nation)
SELECT c_custkey AS o_custkey, c_nationkey AS template, {filled} AS filled_text
FROM customer JOIN templates ON c_nationkey = n_nationkey LEFT JOIN wide ON c_custkey = o_custkey
"""


@query(_nested_replace())
def filled_templates(spark: SparkSession, sf: str) -> DataFrame:
    rows = placeholders(goal_rows(spark, sf), "o_orderkey", NAMES)
    return fill_templates(
        entities(spark, sf), nation_templates(spark, sf), rows, "o_custkey", "template", label="c_name"
    )
