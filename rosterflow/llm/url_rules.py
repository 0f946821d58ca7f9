"""Verdicts on URLs from host and path rules, found by equi-joins on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rosterflow.llm.common import col

# Rules up to this number are broadcast (about 200 bytes each); more are joined by a shuffle.
BROADCAST_RULES = 200_000

# Parts over which the rows of one hash prefix are spread in a shuffled join.
SALTS = 16

# Hexadecimal digits of the digest that are joined on; the full digest confirms.
PREFIX_DIGITS = 8

VERDICTS = ("allow", "block")


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; else empty."""
    return _lowered(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise(F.lit(""))


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Each row with ``host``, ``path``, ``rule`` and ``verdict``; columns of these names (in any case) give way.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block), all text. A rule fits its
    host and every subdomain of it, for paths that start with its own. Of several rules that fit the
    longest (host and path together, in code points) wins; of equally long ones that of the longer
    host, then a block. ``rule`` is its host and path. Without one ``rule`` is null and the verdict is ``default``.

    Each URL is expanded into the suffixes of its host, at label borders, with the prefixes of its
    path, for the pairs of lengths that rules have. Expressions meet rules on the first 32 bits of
    their digests, whole digests confirm, and the row takes the best. A row keeps a number of its own throughout,
    so hot hosts and copies are never brought together: rules are broadcast where there are few of
    them, else each hash prefix is spread over ``SALTS`` parts.

    A null, empty or odd URL has an empty host and path, which no rule fits; repeated rows are judged
    each by itself; URLs may be of any length, as only lengths of rules are tried. Without rules all rows get the default.
    A rule with a null or empty host, a null path or another verdict is an error.
    """
    if default not in VERDICTS:
        raise ValueError(f"the default must be one of {', '.join(VERDICTS)}")
    host, path = _lowered(F.col("host")), F.col("path")
    sound = F.coalesce((F.col("host") != "") & path.isNotNull() & F.col("verdict").isin(*VERDICTS), F.lit(False))
    shapes = rules.groupBy(F.char_length("host").alias("host_length")).agg(
        F.sort_array(F.collect_set(F.char_length("path"))).alias("path_lengths"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(~sound).alias("bad"),
    )
    # One row per length of a host, with the lengths of paths: integers, bounded by the longest rule.
    found = shapes.collect()
    if any(row["bad"] for row in found):
        raise ValueError("each rule needs a host, a path and a verdict of allow or block")
    keyed = rules.select(
        F.sha2(_expression(host, path), 256).alias("_rule_digest"),
        F.struct(
            (F.char_length("host") + F.char_length("path")).alias("length"),
            F.char_length("host").alias("host_length"),
            (F.col("verdict") == "block").alias("block"),
            F.concat(host, path).alias("rule"),
        ).alias("_rule"),
    ).withColumn("_prefix", F.substring("_rule_digest", 1, PREFIX_DIGITS))

    kept = [c for c in urls.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    payload = F.struct(host_of(col(url)).alias("host"), path_of(col(url)).alias("path"), F.struct(*[col(c) for c in kept]).alias("row"))
    # The row itself travels in the first element only; expressions carry its number.
    rows = urls.select(payload.alias("_row"), F.monotonically_increasing_id().alias("_number"))
    digests = F.transform(_expressions(F.col("_row.host"), F.col("_row.path"), found), lambda e: F.sha2(e, 256))
    own = F.concat(F.lit("row "), F.col("_number").cast("string"))
    tried = rows.select("_number", "_row", F.explode(F.concat(F.array(own), digests)).alias("_digest"))
    is_row = F.col("_digest").startswith("row ")
    tried = tried.select(
        "_number",
        F.when(is_row, F.col("_row")).alias("_row"),
        "_digest",
        F.when(is_row, F.col("_digest")).otherwise(F.substring("_digest", 1, PREFIX_DIGITS)).alias("_prefix"),
    )
    on = ["_prefix"]
    if sum(row["n"] for row in found) <= BROADCAST_RULES:
        keyed = F.broadcast(keyed)
    else:
        on.append("_salt")
        tried = tried.withColumn("_salt", F.pmod("_number", F.lit(SALTS)).cast("int"))
        keyed = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    met = tried.join(keyed, on, "left")
    confirmed = F.when(F.col("_digest") == F.col("_rule_digest"), F.col("_rule"))
    judged = met.groupBy("_number").agg(F.first("_row", ignorenulls=True).alias("_row"), F.max(confirmed).alias("_best"))
    verdict = F.when(F.col("_best.block"), "block").when(F.col("_best").isNotNull(), "allow").otherwise(default)
    return judged.select(
        *[F.col("_row.row").getField(c).alias(c) for c in kept],
        F.col("_row.host").alias("host"),
        F.col("_row.path").alias("path"),
        F.col("_best.rule").alias("rule"),
        verdict.alias("verdict"),
    )


def _expression(host: Column, path: Column) -> Column:
    """Host and path with a mark between them that no host has."""
    return F.concat(host, F.lit("#"), path)


def _expressions(host: Column, path: Column, shapes: list) -> Column:
    """The expressions of a URL whose lengths some rule has: suffixes at label borders times prefixes."""
    none = F.array().cast("array<string>")
    if not shapes:
        return none
    pairs = F.array(
        *[
            F.struct(F.lit(s["host_length"]).alias("host_length"), F.array(*[F.lit(p) for p in s["path_lengths"]]).alias("path_lengths"))
            for s in sorted(shapes, key=lambda s: s["host_length"])
        ]
    )
    size = F.char_length(host)

    def at_border(shape: Column) -> Column:
        cut = size - shape["host_length"]
        return (cut == 0) | ((cut > 0) & (F.substring(host, cut, F.lit(1)) == "."))

    def expand(shape: Column) -> Column:
        suffix = F.substring(host, size - shape["host_length"] + 1, shape["host_length"])
        fitting = F.filter(shape["path_lengths"], lambda p: p <= F.char_length(path))
        return F.transform(fitting, lambda p: _expression(suffix, F.substring(path, F.lit(1), p)))

    return F.flatten(F.transform(F.filter(pairs, at_border), expand))
