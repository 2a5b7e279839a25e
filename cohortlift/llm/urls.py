"""URL filters: rules by host and path, and a tree of path templates per host judged by labelled purity. DataFrame expressions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.common import SALTS, ascii_lower, columns, stored

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Words in host names that label a page as unwanted.
UNWANTED = r"(^|[.-])(casino|pills|adult|bets|spam|ads)([.-]|$)"
#: Effective number of values (the exponential of their entropy over distinct shapes) from which a segment is variable; least difference in
#: deviations that keeps branches apart; purity from which a template is blocked.
EFFECTIVE, APART, PURE = 16, 1.96, 0.8


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, or nulls."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def lexical(path: Column) -> Column:
    """Numbers and long hexadecimal names become *, digits within a name become #."""
    return F.regexp_replace(F.regexp_replace(path, r"(?<=/)([0-9]+|[0-9a-f]{8,})(?=[/.]|$)", "*"), "[0-9]+", "#")


def _under(parent: Column, segments: Column) -> Column:
    return F.concat(parent, F.array_join(F.transform(segments, lambda s: F.concat(F.lit("/"), s)), ""))


def branched(shapes: DataFrame) -> DataFrame:
    """Distinct (host, shape) -> (host, shape, template): the shape with * in place of variable segments, at any depth.

    The tree grows from the root. What all shapes below a node share goes to its name at once: the smallest and the largest of them tell how much
    that is, so long common paths take one round and rounds follow the branchings. Where they differ next, the node's segment is variable
    if the entropy of its values, each weighed by the distinct shapes below it, is that of EFFECTIVE values or more; so repeated pages change
    nothing, and a segment stays variable as a host gains values. The values of a variable segment share one node from there on. A shape
    leaves when it has no segment left. Nodes with many shapes meet them in SALTS groups, so no host gathers in one task.
    """
    salt = F.pmod(F.xxhash64("shape"), F.lit(SALTS)).alias("salt")
    rest = F.split("shape", "/")
    growing = shapes.select("host", "shape", salt, F.lit("").alias("template"), F.slice(rest, 2, F.size(rest)).alias("rest"))
    done = growing.where("false")
    while True:
        nodes = growing.groupBy("host", "template").agg(F.min("rest").alias("low"), F.max("rest").alias("high"), F.collect_set("salt").alias("salts"))
        differ = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False)
        nodes = nodes.select("host", "template", F.when(differ > 0, differ - 1).otherwise(F.size("low")).cast("int").alias("shared"), F.explode("salts").alias("salt"))
        at = growing.join(nodes, ["host", "template", "salt"]).select(
            "host", "shape", "salt", _under(F.col("template"), F.slice("rest", F.lit(1), F.col("shared"))).alias("template"),
            F.slice("rest", F.col("shared") + 1, F.size("rest")).alias("rest"))
        at = stored(at)
        done = done.unionByName(at.where(F.size("rest") == 0))
        growing = at.where(F.size("rest") > 0)
        if growing.isEmpty():
            return done.select("host", "shape", "template")
        weights = growing.groupBy("host", "template", F.get("rest", F.lit(0)).alias("value")).agg(F.count("*").alias("w"))
        sums = weights.groupBy("host", "template").agg(F.sum("w").alias("m"), F.sum(F.round(F.col("w") * F.log("w"), 6).cast("decimal(38,6)")).cast("double").alias("s"))
        variable = sums.where(F.log("m") - F.col("s") / F.col("m") >= math.log(EFFECTIVE) - 1e-6)
        # a variable node has EFFECTIVE shapes at least, so its rows don't outgrow them
        variable = variable.select("host", "template", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"), F.lit("*").alias("any"))
        growing = growing.join(variable, ["host", "template", "salt"], "left").select(
            "host", "shape", "salt", F.concat("template", F.lit("/"), F.coalesce("any", F.get("rest", F.lit(0)))).alias("template"),
            F.slice("rest", F.lit(2), F.size("rest")).alias("rest"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, labelled, bad) rows of pages -> (host, shape, template, n, bad, purity), one row per host and lexical shape.

    Variable segments become * (see `branched`). Branches that differ in their first fixed segment alone are merged if two or more have labels and
    no share of bad pages stands out (two-proportion z below APART against its siblings together). purity = (bad + 1) / (labelled + 2): a
    template without labels has 1/2.
    """
    shapes = stored(pages.groupBy("host", "shape").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("bad")))
    tree = shapes.join(branched(shapes), ["host", "shape"])
    fixed = F.transform(F.split("template", "/"), lambda s: (s != "") & ~s.contains("*"))
    tree = stored(tree.withColumn("first_fixed", F.array_position(fixed, True) - 1))
    parts = F.split("template", "/")
    merged_name = F.when(F.col("first_fixed") >= 0, F.array_join(F.transform(parts, lambda s, i: F.when(i == F.col("first_fixed"), "*").otherwise(s)), "/")).otherwise(F.col("template"))
    branches = tree.groupBy("host", "template", merged_name.alias("merged")).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    sums = branches.groupBy("host", "merged").agg(F.sum("n").alias("all_n"), F.sum("bad").alias("all_bad"), F.count(F.when(F.col("n") > 0, 1)).alias("with_labels"))
    known = branches.join(sums, ["host", "merged"])
    n, bad, rest, rest_bad = F.col("n"), F.col("bad"), F.col("all_n") - F.col("n"), F.col("all_bad") - F.col("bad")
    share, one = F.try_divide("all_bad", "all_n"), F.lit(1.0)
    deviation = F.sqrt(share * (1 - share) * (F.try_divide(one, n) + F.try_divide(one, rest)))
    difference = F.abs(F.try_divide(bad, n) - F.try_divide(rest_bad, rest))
    stands_out = (n > 0) & (rest > 0) & (share > 0) & (share < 1) & (difference >= APART * deviation)
    apart = known.groupBy("host", "merged").agg(F.max(F.when(stands_out, 1).otherwise(0)).alias("apart"))
    known = known.join(apart, ["host", "merged"])
    together = (F.col("with_labels") >= 2) & (F.col("apart") == 0)
    known = known.select(
        "host", F.col("template").alias("branch"), F.when(together, F.col("merged")).otherwise(F.col("template")).alias("template"),
        F.when(together, F.col("all_n")).otherwise(n).alias("n"), F.when(together, F.col("all_bad")).otherwise(bad).alias("bad"))
    leaves = tree.select("host", "shape", F.col("template").alias("branch"))
    return leaves.join(known, ["host", "branch"]).select("host", "shape", "template", "n", "bad", ((F.col("bad") + 1) / (F.col("n") + 2)).alias("purity"))


def judged(pages: DataFrame, rules=RULES, unwanted: str = UNWANTED) -> DataFrame:
    """pages -> (page_id, host, path, rule, verdict, template, purity), a row per row.

    A rule decides where one fits. Elsewhere the page's template does: labelled are pages under a rule (as it says) and pages of hosts with an
    unwanted word; a template of PURE purity or more is blocked. Pages are counted by host and lexical shape first, map-side, so a hot host is a
    few rows; the verdicts return by a join that Spark can split. Null urls and those without :// have an empty host and path, no rule, and are
    judged together; null or repeated ids are rows like others; no rows: no rows; other columns are not looked at.
    """
    url = F.col("url")
    rows = columns(pages, page_id="page_id", url="url").select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("said"), lexical(F.col("path")).alias("shape"))
    named = F.col("host").rlike(unwanted)
    labelled = F.when(F.col("said").isNotNull() | named, 1).otherwise(0)
    bad = F.when((F.col("said") == "block") | F.col("said").isNull() & named, 1).otherwise(0)
    known = templates(rows.select("host", "shape", labelled.alias("labelled"), bad.alias("bad")))
    out = rows.join(known, ["host", "shape"])
    return out.select(
        "page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("purity") >= PURE, "block").otherwise("allow")).alias("verdict"), "template", "purity")
