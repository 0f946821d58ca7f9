"""Fill text templates with the newest figures of each entity."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow.functions.names import column
from rosterflow.functions.text import placeholder
from rosterflow.operators.latest import latest_rows

# The category and goal with placeholders of their own, and the entity placeholder.
GOAL_CATEGORY = "Goal"
COUNT_GOAL = "Enrollment"
ENTITY_PLACEHOLDER = "{school}"

PLACEHOLDER_PATTERN = r"\{[^{}]+\}"


@dataclass(frozen=True)
class GoalColumns:
    """Names of the columns of the goal table."""

    entity: str = "School"
    tag: str = "Tag"
    year: str = "Academic Year"
    category: str = "Category"
    goal: str = "Excellence Goal"
    main: str = "Main Data"
    numerator: str = "Numerator"
    denominator: str = "Denominator"


def placeholders(rows: DataFrame, seq: str, names: GoalColumns = GoalColumns()) -> DataFrame:
    """Placeholder and replacement text for each goal row of the newest year of its tag.

    A goal has its figure only; a head count has figure and year; everything else has
    percentage, numerator, denominator and year. Columns: entity, ``seq``, ``token``, ``value``.
    """
    newest = latest_rows(rows, [names.entity, names.tag], names.year)
    tag = column(names.tag)

    def entry(suffix: str, source: str):
        return F.struct(
            placeholder(tag, suffix).alias("token"), F.coalesce(column(source).cast("string"), F.lit("")).alias("value")
        )

    figure = entry("", names.main)
    year = entry("_year", names.year)
    rest = [entry("%", names.main), entry("_num", names.numerator), entry("_den", names.denominator), year]
    entries = (
        F.when(column(names.category) == GOAL_CATEGORY, F.array(figure))
        .when(column(names.goal) == COUNT_GOAL, F.array(figure, year))
        .otherwise(F.array(*rest))
    )
    return newest.select(column(names.entity), column(seq).alias("seq"), F.explode(entries).alias("entry")).select(
        column(names.entity), "seq", "entry.token", "entry.value"
    )


def template_slots(templates: DataFrame, template: str, text: str) -> DataFrame:
    """The distinct placeholders each template contains."""
    found = F.array_distinct(F.regexp_extract_all(column(text), F.lit(PLACEHOLDER_PATTERN), F.lit(0)))
    return templates.select(column(template), F.explode(found).alias("token"))


def collect_entries(
    entries: DataFrame, entities: DataFrame, slots: DataFrame, entity: str, template: str
) -> DataFrame:
    """Per entity, a map from placeholder to text in ``seq`` order.

    Of several rows for a placeholder the first by ``seq`` counts. Only placeholders of the
    entity's template are collected, so a map is never larger than the template's list of
    placeholders, however many rows the entity has.
    """
    listed = slots.groupBy(column(template)).agg(F.collect_set("token").alias("_slots"))
    return _collected(entries, entities.select(column(entity), column(template)).join(listed, template), entity)


def _collected(entries: DataFrame, wanted: DataFrame, entity: str) -> DataFrame:
    """The maps of entities that have entries among their ``_slots``.

    Entries are combined per placeholder before they move; the join and the collecting that follows
    then share one partitioning by entity.
    """
    first = entries.groupBy(column(entity), "token").agg(F.min(F.struct("seq", "value")).alias("first"))
    needed = first.join(wanted.select(column(entity), "_slots"), entity).filter(F.array_contains("_slots", F.col("token")))
    ordered = F.array_sort(F.collect_list(F.struct("first.seq", "token", "first.value")))
    pairs = F.transform(ordered, lambda e: F.struct(e["token"].alias("key"), e["value"].alias("value")))
    return needed.groupBy(column(entity)).agg(F.map_from_entries(pairs).alias("entries"))


def fill_templates(
    entities: DataFrame,
    templates: DataFrame,
    entries: DataFrame,
    entity: str,
    template: str,
    text: str = "template_text",
    label: str | None = None,
) -> DataFrame:
    """Each entity's template with its placeholders replaced; columns entity, template, ``filled_text``.

    ``entities`` has one row per entity with the template it uses, ``templates`` one row per
    template. ``{school}`` becomes the entity itself, or its ``label`` column. A placeholder
    without a value stays as it is; an entity whose template does not exist gets null.
    """
    found = F.array_distinct(F.regexp_extract_all(column(text), F.lit(PLACEHOLDER_PATTERN), F.lit(0)))
    known = templates.select(column(template), column(text), found.alias("_slots"))
    wanted = entities.join(known, template, "left")
    collected = _collected(entries, wanted, entity)
    name = column(label or entity).cast("string")
    start = F.replace(column(text), F.lit(ENTITY_PLACEHOLDER), name)
    pairs = F.coalesce(F.map_entries("entries"), F.array())
    filled = F.aggregate(pairs, start, lambda so_far, e: F.replace(so_far, e["key"], e["value"]))
    joined = wanted.join(collected, entity, "left")
    return joined.select(column(entity), column(template), filled.alias("filled_text"))
