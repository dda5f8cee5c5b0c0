"""URL filters: host-suffix and path-prefix expressions against a rule table.

Every URL is expanded into (host suffix, path prefix) expressions, for those
label counts and prefix lengths that rules have.  Expressions meet the rules in
an equi-join on the first four bytes of their SHA-256; full digests confirm,
and among the rules that fit the longest wins.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, require_columns

#: Rules up to which the rule table is broadcast; beyond it, a shuffle join.
BROADCAST_RULES = 200_000


def rule_table(spark: SparkSession, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rows."""
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    no_host: str = "block",
) -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules`` has verdict, host and path.  A rule fits its host and all
    subdomains where the URL's path starts with the rule's path.  The longest
    host + path wins, then the longer host, then "block".  ``rule`` is host +
    path of the winner, or null; then the verdict is ``default``, or
    ``no_host`` for URLs without a host (null, no ``://``, empty host).

    Rules with a null part or an unknown verdict raise; an empty rule host fits
    no URL.  Null ids and repeated rows are judged like any; an empty table
    gives no rows; an empty rule table leaves the defaults.  Other columns are
    ignored.
    """
    require_columns(pages, id_col, url_col)
    require_columns(rules, "verdict", "host", "path")
    sound = F.col("verdict").isin("allow", "block") & F.col("host").isNotNull() & F.col("path").isNotNull()
    checked = F.when(sound, F.col("verdict")).otherwise(F.raise_error(F.lit("a rule needs host, path and verdict allow or block")))
    host = F.regexp_replace(ascii_lower(F.col("host")), r"^\.+", "")
    table = (
        rules.select(checked.alias("verdict"), host.alias("host"), "path")
        .filter(F.col("host") != "")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # "block" sorts last
    )
    shape = table.agg(
        F.count(F.lit(1)).alias("n"),
        F.sort_array(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()  # distinct small numbers: label counts and path lengths

    full = F.sha2(F.concat_ws(" ", "host", "path"), 256)  # the blank keeps host and path apart
    side = table.select(
        full.substr(1, 8).alias("r_short"),
        full.alias("r_full"),
        F.struct(
            F.length(F.concat("host", "path")).alias("len"),
            F.length("host").alias("host_len"),
            "verdict",
            F.concat("host", "path").alias("rule"),
        ).alias("r"),
    )
    if shape["n"] <= BROADCAST_RULES:
        side = F.broadcast(side)

    rows = (
        pages.groupBy(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("id", "url", "copies", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        .withColumn("labels", F.size(F.split("host", r"\.")))
    )
    expressions = [
        F.when(
            (F.col("host") != "") & (F.col("labels") >= m) & (F.length("path") >= n),
            F.sha2(F.concat_ws(" ", F.substring_index("host", ".", -m), F.substring("path", 1, n)), 256),
        )
        for m in shape["labels"]
        for n in shape["lengths"]
    ]
    listed = F.array_compact(F.array(*expressions)) if expressions else F.array().cast("array<string>")
    tried = rows.select("id", "url", "copies", "host", "path", F.explode_outer(listed).alias("full"))
    met = tried.join(side, tried["full"].substr(1, 8) == F.col("r_short"), "left")
    won = met.groupBy("id", "url", "copies", "host", "path").agg(F.max(F.when(F.col("full") == F.col("r_full"), F.col("r"))).alias("r"))
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("host") == "", F.lit(no_host)).otherwise(F.lit(default)))
    one = won.select(F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"), "copies")
    return one.withColumn("__i", F.explode(F.sequence(F.lit(1), "copies"))).drop("__i", "copies")
