"""Robots rules: parsing the files and filtering URLs by them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlflow.functions import url as U

AGENT = "crawlflow"


def parse(robots_txt: DataFrame, agent: str = AGENT) -> DataFrame:
    """``(host, kind, prefix)`` of the groups that address every robot or ours.

    A group runs from one user-agent line to the next. Each file is one row and is cut up in
    place, so nothing is shuffled.
    """
    groups = F.split(
        F.regexp_replace("body", "#[^\n\r]*", ""), r"(?im)^[ \t]*user-agent[ \t]*:"
    )
    group = F.trim(F.regexp_extract("_group", "^[^\n\r]*", 0))
    line_pattern = r"(?i)^[ \t]*(allow|disallow)[ \t]*:[ \t]*(.*?)[ \t]*$"
    prefix = F.regexp_extract("_line", line_pattern, 2)
    return (
        robots_txt.select("host", F.explode(F.slice(groups, F.lit(2), F.size(groups))).alias("_group"))
        .where((group == "*") | F.lower(group).contains(agent.lower()))
        .select("host", F.explode(F.split("_group", "[\n\r]+")).alias("_line"))
        .select(
            "host",
            F.lower(F.regexp_extract("_line", line_pattern, 1)).alias("kind"),
            F.trim(F.regexp_replace(prefix, r"\*$", "")).alias("prefix"),
        )
        .where("kind <> '' and prefix <> ''")
        .distinct()
    )


def with_denied(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Add ``denied``: whether the host forbids the URL.

    A URL is allowed when no disallowed prefix fits its path, or an allowed one does. Rules are
    gathered to one row per host, so the join adds no rows and a host with very many URLs can be
    split by adaptive skew handling. Spark broadcasts the rules only when they measure small.
    """
    by_host = rules.groupBy(F.col("host").alias("_host")).agg(
        F.collect_list(F.expr("if(kind = 'allow', prefix, null)")).alias("_allow"),
        F.collect_list(F.expr("if(kind = 'disallow', prefix, null)")).alias("_disallow"),
    )
    joined = urls.withColumn("_host", U.host(F.col(url))).withColumn("_path", U.path(F.col(url)))
    joined = joined.join(by_host, "_host", "left")

    def fits(prefixes: str):
        return F.exists(prefixes, lambda p: F.col("_path").startswith(p))

    denied = F.coalesce(fits("_disallow") & ~fits("_allow"), F.lit(False))
    return joined.select(*urls.columns, denied.alias("denied"))


def permit(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """Keep the URLs their host allows."""
    return with_denied(urls, rules, url).where("not denied").drop("denied")
