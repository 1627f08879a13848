"""URL filtering by rules and by a tree of path templates.

Rules decide first. Everything else is decided by the templates of its host:
path segments that vary (digits, or a position with many different values)
become wildcards, sibling branches whose counts of labels a chi-square test
cannot tell apart are merged, and a template is rejected when the smoothed share of bad labels among its urls is high. All of
it is grouping and joining of counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import ascii_lower

# The query's rules; fixed values.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


@dataclass(frozen=True)
class TreeSettings:
    vary: int = 20  # so many values at one place of a host make it a wildcard
    rare: float = 0.02  # and so do values with less than this share of the place
    apart: float = 3.84  # chi-square, one degree of freedom, above which two branches are not alike
    weight: int = 10  # of the prior, in labelled urls
    reject: float = 0.5  # smoothed bad share above which a template is rejected


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """Struct ``(rule, verdict)`` of the longest rule that fits, null without one."""
    found = [
        F.when(
            ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    ]
    return F.coalesce(*found)


def segments(path: Column) -> Column:
    """All path segments, digits as ``#``."""
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    return F.transform(parts, lambda x: F.regexp_replace(x, "[0-9]+", "#"))


def template_tree(pages: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """Verdict of every ``(host, segs)`` in ``pages(host, segs, bad)``.

    ``bad`` is 1, 0 or null for no label. Returns ``host``, ``segs``,
    ``template``, ``n``, ``labelled``, ``bad`` and ``share`` (smoothed). Rows
    are first counted by host and segments, so a host with most of the pages
    costs one row per distinct path shape.
    """
    s = settings
    shapes = pages.groupBy("host", "segs").agg(
        F.count("*").alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    # Variable segments: per host and place, rare values of places with many.
    places = shapes.select("host", "n", F.posexplode("segs").alias("place", "value"))
    values = places.groupBy("host", "place", "value").agg(F.sum("n").alias("n"))
    totals = values.groupBy("host", "place").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    kept = (
        values.join(totals, ["host", "place"])
        .where((F.col("kinds") < s.vary) | (F.col("n") >= s.rare * F.col("total")))
        .groupBy("host", "place")
        .agg(F.collect_set("value").alias("kept"))  # at most vary or 1 / rare values
        .groupBy("host")
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "kept"))).alias("kept"))  # one entry per place
    )
    general = shapes.join(kept, "host", "left").withColumn(
        "template",
        F.transform("segs", lambda x, i: F.when(F.array_contains(F.try_element_at("kept", i), x), x).otherwise("*")),
    )
    return _merged(general.select("host", "segs", "template", "n", "labelled", "bad"), s)


def _merged(general: DataFrame, s: TreeSettings) -> DataFrame:
    """Merge sibling branches of like share of bad labels, then smooth towards host and path."""
    branch = general.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "labelled", "bad")])
    parent = F.when(F.size("template") > 0, F.slice("template", 1, F.size("template") - 1)).otherwise(
        F.array().cast("array<string>")
    )
    branch = branch.withColumn("parent", parent).withColumn("places", F.size("template"))
    # Siblings in order of their share; a new band where one differs from the one before. Those
    # without a label say nothing about themselves and share one band.
    own = F.try_divide("bad", "labelled")
    siblings = Window.partitionBy("host", "parent", "places", F.col("labelled") > 0)
    order = siblings.orderBy(own, "labelled", "template")
    bad, labelled = F.col("bad").cast("double"), F.col("labelled").cast("double")
    bad0, labelled0 = F.lag(bad).over(order), F.lag(labelled).over(order)
    both, total = bad + bad0, labelled + labelled0
    cross = bad * labelled0 - bad0 * labelled
    differs = cross * cross * total > s.apart * (labelled * labelled0 * both * (total - both))
    branch = branch.withColumn("differs", F.coalesce(differs.cast("int"), F.lit(0)))
    branch = branch.withColumn("band", F.sum("differs").over(order))
    alike = Window.partitionBy("host", "parent", "places", F.col("labelled") > 0, "band")
    merged = branch.select(
        "host", "template", *[F.sum(c).over(alike).alias(c) for c in ("n", "labelled", "bad")]
    )
    # Priors: the same template on all hosts, behind it all labels.
    shared = branch.groupBy("template").agg(F.sum("labelled").alias("t_labelled"), F.sum("bad").alias("t_bad"))
    overall = branch.agg((F.sum("bad") + 1) / (F.sum("labelled") + 2)).scalar()
    prior = shared.select(
        "template", ((F.col("t_bad") + s.weight * overall) / (F.col("t_labelled") + s.weight)).alias("prior")
    )
    share = (F.col("bad") + s.weight * F.col("prior")) / (F.col("labelled") + s.weight)
    scored = merged.join(prior, "template", "left").select("host", "template", "labelled", "bad", "n", share.alias("share"))
    return general.select("host", "segs", "template").join(scored, ["host", "template"], "left")


def filter_urls(
    pages: DataFrame,
    rules=RULES,
    labels: DataFrame | None = None,
    settings: TreeSettings = TreeSettings(),
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """Judge every url by rules and, where none fits, by its path template.

    ``labels(host, path, bad)`` adds labelled urls of other origin; without it
    the urls that rules decide are the labelled ones. Returns one row per
    input row: the id, ``host``, ``path``, ``rule`` (null where none fits),
    ``verdict``, ``template`` and ``share`` (smoothed share of bad labels of
    the template). Null urls and urls without ``://`` have empty host and
    path and share one template. Repeated rows and null ids stay; an empty
    table gives an empty result; other columns are not carried.
    """
    url = F.col(f"`{url_col}`")
    rows = pages.select(F.col(f"`{id_col}`").alias(id_col), host_of(url).alias("host"), path_of(url).alias("path"))
    hit = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("hit", hit).select(
        id_col, "host", "path", F.col("hit.rule").alias("rule"), F.col("hit.verdict").alias("ruled"),
        segments(F.col("path")).alias("segs"),
    )
    bad = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    known = rows.select("host", "segs", bad.alias("bad"))
    if labels is not None:
        known = known.unionByName(
            labels.select("host", segments(F.col("path")).alias("segs"), F.col("bad").cast("int").alias("bad"))
        )
    tree = template_tree(known, settings).select("host", "segs", "template", "share")
    verdict = F.coalesce(F.col("ruled"), F.when(F.col("share") > settings.reject, F.lit("block")).otherwise("allow"))
    return rows.join(tree, ["host", "segs"], "left").select(
        id_col, "host", "path", "rule", verdict.alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "share",
    )
