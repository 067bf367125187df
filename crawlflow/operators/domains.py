"""Registered domains by a table of public suffixes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from crawlflow.functions import url as U
from crawlflow.session import once

#: Parts that the URLs of one host are dealt to.
HOST_PARTS = 64

IP_HOST = r"^\[|^[0-9]{1,3}([.][0-9]{1,3}){3}$"


def parse_suffixes(lines: DataFrame, line: str = "value") -> DataFrame:
    """``(suffix, kind)`` of lines as public suffix lists have them.

    ``*.x`` is a ``wildcard`` on x, ``!a.x`` an ``exception`` to it, any other name is ``normal``. What
    follows a blank is ignored, as are comments and empty lines.
    """
    rule = F.lower(F.regexp_extract(F.trim(line), r"^[^\s]*", 0))
    kind = F.when(F.col("_rule").startswith("*."), "wildcard").when(F.col("_rule").startswith("!"), "exception").otherwise("normal")
    return (
        lines.select(rule.alias("_rule")).where("_rule <> '' and not startswith(_rule, '//')")
        .select(F.regexp_replace("_rule", r"^(\*\.|!)", "").alias("suffix"), kind.alias("kind")).distinct()
    )


def registered_domains(hosts: DataFrame, suffixes: DataFrame, host: str = "host") -> DataFrame:
    """``(host, domain)``, a row for each distinct host: its longest public suffix and one label more.

    A host names its own suffixes, at most one for each label, which are looked up by an equi-join.
    An exception beats all other rules; without a rule the last label is the suffix. An address, and a host
    that is a public suffix itself, is its own domain. A closing dot does not count.
    """
    named = hosts.select(F.col(host).alias("host")).where("host is not null").distinct().select(
        "host", F.regexp_replace("host", r"\.+$", "").alias("_name"), F.split(F.regexp_replace("host", r"\.+$", ""), "[.]").alias("_labels")
    )
    ends = F.transform(F.sequence(F.lit(1), F.size("_labels")), lambda k: F.array_join(F.slice("_labels", -k, k), "."))
    tails = named.where(~F.col("_name").rlike(IP_HOST)).select("host", F.size("_labels").alias("_n"), F.posexplode(once(ends)).alias("_at", "suffix"))
    known = tails.join(suffixes.select("suffix", "kind"), "suffix").groupBy("host").agg(
        F.max(F.when(F.col("kind") == "exception", F.col("_at") + 1)).alias("_exception"),
        F.max(
            F.when(F.col("kind") == "normal", F.col("_at") + 1)
            .when((F.col("kind") == "wildcard") & (F.col("_at") + 1 < F.col("_n")), F.col("_at") + 2)
        ).alias("_suffix"),
    )
    wanted = F.coalesce("_exception", F.coalesce("_suffix", F.lit(1)) + 1)
    last = F.least(wanted, F.size("_labels"))
    domain = F.when(F.col("_name").rlike(IP_HOST), F.col("_name")).otherwise(F.array_join(F.slice("_labels", -last, last), "."))
    return named.join(known, "host", "left").select("host", domain.alias("domain"))


def with_registered_domain(urls: DataFrame, suffixes: DataFrame, url: str = "url", name: str = "domain") -> DataFrame:
    """Add the registered domain of each URL; null for a null URL, empty for one without a host.

    Domains are found once for each host. The URLs of a host are dealt to ``HOST_PARTS`` parts by their hash, and a
    domain goes to the parts that its host has, so the URLs of a hot host do not all meet in one task.
    """
    part = F.pmod(F.xxhash64(url), F.lit(HOST_PARTS)).cast("int")
    placed = urls.withColumn("_host", U.host(F.col(url))).withColumn("_part", part)
    parts = placed.select("_host", "_part").distinct()
    found = registered_domains(parts, suffixes, "_host").select(F.col("host").alias("_host"), F.col("domain").alias(name))
    return placed.join(parts.join(found, "_host"), ["_host", "_part"], "left").select(*urls.columns, name)
