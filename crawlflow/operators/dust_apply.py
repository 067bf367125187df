"""Applying rewrite rules to URLs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from crawlflow.session import materialize

# Rule applications per URL unless told otherwise, and the result that drops a URL.
MAX_STEPS = 100
FILTERED = "--filtered--"

#: Scheme and host, which mined rules leave alone.
HOST = "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"


def one_direction(rules: DataFrame) -> DataFrame:
    """Of a rule and its inverse the one that shortens, or at equal length has the smaller beta.

    Mined sets hold many such pairs; applying both would turn a URL back and forth.
    """
    longer = F.length("beta") > F.length("alpha")
    same = F.length("beta") == F.length("alpha")
    backward = longer | (same & (F.col("beta") > F.col("alpha")))
    inverse = rules.select(F.col("beta").alias("alpha"), F.col("alpha").alias("beta")).distinct()
    return rules.where(~backward).unionByName(rules.where(backward).join(inverse, ["alpha", "beta"], "left_anti").select(*rules.columns))


def rule_list(rules: DataFrame, order: str = "pos", max_steps: int = MAX_STEPS) -> DataFrame:
    """The rules in order as one row with one array.

    Step i of the application takes rule i modulo their number, so only the first ``max_steps``
    rules can ever be used; that bounds the array. Tables without a position, as the rule sink
    writes them, go by beta and alpha.
    """
    place = F.col(order) if order in rules.columns else F.struct("beta", "alpha")
    first = rules.select(place.alias("pos"), "alpha", "beta").orderBy("pos").limit(max_steps)
    return first.agg(F.array_sort(F.collect_list(F.struct("pos", "alpha", "beta"))).alias("rules"))


def rewrite(url: Column, rules: Column, max_steps: int = MAX_STEPS) -> Column:
    """``url`` after rules have been applied in turn until a whole round changes nothing.

    At most ``max_steps`` applications are made. A rule replaces every occurrence of its alpha as text.
    """
    start = F.struct(url.alias("url"), F.lit(0).alias("idle"))

    def step(state: Column, i: Column) -> Column:
        rule = F.get(rules, i % F.size(rules))
        done = state["idle"] >= F.size(rules)
        fresh = F.when(done, state["url"]).otherwise(
            F.replace(state["url"], rule["alpha"], rule["beta"])
        )
        idle = F.when(fresh == state["url"], state["idle"] + 1).otherwise(0)
        return F.struct(fresh.alias("url"), idle.alias("idle"))

    steps = F.sequence(F.lit(0), F.lit(max_steps - 1))
    folded = F.aggregate(steps, start, step, lambda state: state["url"])
    return F.when(F.size(rules) > 0, folded).otherwise(url)


def apply_rules(
    urls: DataFrame, rules: DataFrame, url: str = "url", max_steps: int = MAX_STEPS
) -> DataFrame:
    """Add ``canonical_url``; URLs rewritten to the filter mark are dropped.

    The rule list comes from a scalar subquery: one small value, no join. The result is filtered
    inside an array that is then exploded, so that it is computed once.
    """
    result = rewrite(F.col(url), F.col("_rules"), max_steps)
    kept = F.filter(F.array(result), lambda u: u != FILTERED)
    return urls.withColumn("_rules", rule_list(rules, max_steps=max_steps).scalar()).select(
        *urls.columns, F.explode(kept).alias("canonical_url")
    )


def decreasing(rules: DataFrame) -> DataFrame:
    """The rules that make whatever they apply to shorter, or at equal length smaller as text.

    Rewriting by such rules alone ends, in whatever order they come: there is no endless descent.
    Of a rule and its inverse, which mined sets hold side by side, exactly one is kept.
    """
    shorter = F.length("beta") < F.length("alpha")
    smaller = (F.length("beta") == F.length("alpha")) & (F.col("beta") < F.col("alpha"))
    return rules.where(shorter | smaller)


def _substrings(text: str, lengths: str) -> Column:
    """The distinct substrings of the given lengths."""
    at = f"sequence(1, greatest(1, length({text}) - n + 1))"
    every = f"flatten(transform(filter({lengths}, n -> n <= length({text})), n -> transform({at}, p -> substring({text}, p, n))))"
    return F.expr(f"array_distinct({every})")


def apply_decreasing(urls: DataFrame, rules: DataFrame, url: str = "url", keep_host: bool = True) -> DataFrame:
    """Add ``canonical_url``: every decreasing rule is applied until none fits.

    A round finds the rules whose alpha a URL holds as the round begins, of equal alphas the first, and
    applies them in order (``pos`` if there is one, then beta and alpha), each to every occurrence of its
    alpha that is still there. Rounds go on for URLs that held a rule. As every rule decreases, they end,
    no result is longer than its URL, and there is neither a bound on the rules or steps nor a circle.

    With ``keep_host`` rules see what follows the host only. Rules that do not decrease are left out. Null
    URLs, and those rewritten to the filter mark, are dropped. Repeated URLs are worked on once.

    Rules are found by an equi-join of a URL's substrings, so the rule table is neither collected nor
    broadcast unless Spark measures it as small. What a round gathers for a URL is at most one rule for
    each of its substrings. Each round is written, and works on the URLs alone that moved in the one before.
    """
    order = [c for c in ("pos", "beta", "alpha") if c in rules.columns]
    place = F.min(F.struct(*order)).alias("due")
    known = decreasing(rules).groupBy("alpha").agg(place)
    known = materialize(known, "rules_by_alpha")
    sizes = known.agg(F.sort_array(F.collect_set(F.length("alpha"))))
    head = F.regexp_extract("origin", HOST, 0) if keep_host else F.lit("")
    active = urls.select(F.col(url).alias("origin")).where("origin is not null").distinct()
    active = active.select("origin", head.alias("head"), F.col("origin").alias("rest"))
    active = materialize(active.select("origin", "head", F.expr("substring(rest, length(head) + 1)").alias("rest")), "urls_to_rewrite")
    ended = []
    while True:
        held = active.withColumn("_sizes", sizes.scalar()).select("origin", F.explode(_substrings("rest", "_sizes")).alias("alpha"))
        found = held.join(known, "alpha").groupBy("origin").agg(F.array_sort(F.collect_list("due")).alias("due"))
        fresh = F.coalesce(F.aggregate("due", F.col("rest"), lambda u, r: F.replace(u, r["alpha"], r["beta"])), "rest")
        step = active.join(found, "origin", "left").select("origin", "head", fresh.alias("rest"), F.isnotnull("due").alias("moved"))
        step = materialize(step, "rewrite_round")
        ended.append(step.where(~F.col("moved")))
        active = step.where("moved").drop("moved")
        if active.isEmpty():
            break
    results = reduce(DataFrame.unionByName, ended).select(F.col("origin").alias("_origin"), F.concat("head", "rest").alias("canonical_url"))
    joined = urls.join(results.where(F.col("canonical_url") != FILTERED), F.col(url) == F.col("_origin"))
    return joined.select(*[urls[c] for c in urls.columns], "canonical_url")
