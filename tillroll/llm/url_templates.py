"""URL filter: rules by host and path, then a tree of path templates per host.

A path is a list of segments.  Segments that are numbers, hexadecimal strings
or mixed identifiers become wildcards at once, so the tree is built on the
distinct templates of a host, not on its pages.  Then, level by level from the
root, the children of a template node are compared: children whose share of bad
labels doesn't differ from their siblings' by a two-proportion test are merged
into "*", and so are rare ones among many that have too few labels for the test.
What stays apart is apart for a reason.  Below the eighth segment a node is split
only while it has bad and good labels.  A template is rejected if its share of bad labels, smoothed
towards the share over all labels, reaches a threshold.

All of it is aggregates and joins on template rows; one host may hold any share
of the pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm._shared import cut

# fixed values of the contract: what is blocked or allowed by host and path
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow"))

DEPTH = 8                  # segments from which pages with like labels, or none, have one tail "**"
Z = 2.576                  # two-proportion test at 1 %
PRIOR, REJECT = 10.0, 0.5  # labels that the overall share counts for; share of bad labels that is rejected


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host after the first ``://``, A-Z lower-cased; both empty without one."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1))


def rule_columns(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def lexical_segments(path: Column) -> Column:
    """Path segments with variable ones generalised."""
    def general(s: Column) -> Column:
        return (F.when(s.rlike(r"^[0-9]+$"), F.lit("{number}"))
                .when(s.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.concat(F.lit("{number}"), F.regexp_extract(s, r"\.\w+$", 0)))
                .when(s.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("{hex}"))
                .when(s.rlike(r"[0-9]") & (F.length(s) >= 8), F.lit("{id}"))
                .otherwise(s))
    segments = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(segments, general)


def template_tree(urls: DataFrame, z: float = Z, prior: float = PRIOR, reject: float = REJECT) -> DataFrame:
    """(host, segments, template, n_pages, n_labels, n_bad, bad_share, rejected) from rows (host, segments, bad).

    ``bad`` is 1, 0 or null (no label); ``segments`` are lexical.  One row per
    distinct (host, segments), so the caller can join pages to their template."""
    totals = (F.count(F.lit(1)).alias("n"), F.count("bad").alias("labels"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    tree = cut(urls.groupBy("host", "segments").agg(*totals).withColumn("path", F.array().cast("array<string>"))
               .withColumn("ended", F.lit(False)), "url_tree")
    depth = tree.agg(F.max(F.size("segments"))).first()[0] or 0
    sums = [F.sum(c).alias(c) for c in ("n", "labels", "bad")]
    for d in range(depth):
        if d >= DEPTH:
            # nodes whose labels are alike end here; what is split further has bad and good ones
            more = (F.size("segments") > d) & ~F.col("ended")
            nodes = (tree.where(more).groupBy("host", "path").agg(F.sum("labels").alias("all_labels"),
                                                                  F.sum("bad").alias("all_bad"))
                     .where("all_bad > 0 and all_bad < all_labels").select("host", "path", F.lit(True).alias("mixed")))
            ends = more & F.col("mixed").isNull()
            tree = cut(tree.join(nodes, ["host", "path"], "left").select(
                "host", "segments", "n", "labels", "bad",
                F.when(ends, F.concat("path", F.array(F.lit("**")))).otherwise(F.col("path")).alias("path"),
                (F.col("ended") | ends).alias("ended")), "url_tree")
            if tree.where(more).isEmpty():
                break
        step = tree.withColumn("name", F.when(~F.col("ended"), F.get("segments", F.lit(d))))
        node = step.where("name is not null").groupBy("host", "path", "name").agg(*sums)
        parent = node.groupBy("host", "path").agg(
            F.count(F.lit(1)).alias("children"), *[F.sum(c).alias(f"all_{c}") for c in ("n", "labels", "bad")])
        rest_labels, rest_bad = F.col("all_labels") - F.col("labels"), F.col("all_bad") - F.col("bad")
        pooled = F.col("all_bad") / F.col("all_labels")
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labels") + 1 / rest_labels))
        differs = F.when((F.col("labels") > 0) & (rest_labels > 0) & (error > 0),
                         F.abs(F.col("bad") / F.col("labels") - rest_bad / rest_labels) > z * error).otherwise(False)
        merged = node.join(parent, ["host", "path"]).select(
            "host", "path", "name",
            F.when(F.col("children") == 1, F.col("name")).when(~differs, F.lit("*"))
            .otherwise(F.col("name")).alias("general"))
        tree = cut(step.join(merged, ["host", "path", "name"], "left").select(
            "host", "segments", "n", "labels", "bad", "ended",
            F.when(F.col("general").isNull(), F.col("path")).otherwise(F.concat("path", F.array("general"))).alias("path")),
            "url_tree")
    share = tree.agg(F.try_divide(F.sum("bad"), F.sum("labels")).alias("s")).first()[0] or 0.0
    groups = tree.groupBy("host", "path").agg(*[F.sum(c).alias(f"n_{c}") for c in ("n", "labels", "bad")])
    smoothed = (F.col("n_bad") + F.lit(prior * share)) / (F.col("n_labels") + F.lit(prior))
    return cut(tree.select("host", "segments", "path").join(groups, ["host", "path"]).select(
        "host", "segments", F.concat(F.lit("/"), F.array_join("path", "/")).alias("template"),
        F.col("n_n").alias("n_pages"), "n_labels", "n_bad", smoothed.alias("bad_share"),
        (smoothed >= reject).alias("rejected")), "url_templates")


def _segmented(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    return urls.withColumn("segments", lexical_segments(F.col("path")))


def judged(pages: DataFrame, labels: DataFrame | None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """Rows (page_id, host, path, segments, bad): ``bad`` is the worst label of the page's id, null without one."""
    urls = _segmented(pages, id_col, url_col)
    if labels is None:
        return urls.withColumn("bad", F.lit(None).cast("int"))
    worst = (labels.where(F.col("id").isNotNull() & F.col("bad").isNotNull())
             .groupBy(F.col("id").cast("long").alias("page_id")).agg(F.max("bad").cast("int").alias("bad")))
    return urls.join(worst, "page_id", "left")


def filter_urls(pages: DataFrame, labels: DataFrame | None = None, rules=RULES, id_col: str = "page_id",
                url_col: str = "url", **options) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, template, bad_share.

    ``labels`` has rows (id, bad 0/1); repeated labels of an id count as their
    worst, null ones as none.  A url that is null or has no ``://`` has an empty
    host and path and is judged by that template; templates without labels have
    the overall share, so nothing is blocked for want of labels alone unless
    that share reaches the threshold; repeated rows are judged alike (and count
    each); an empty table gives an empty result; other columns aren't read."""
    urls, rows = _segmented(pages, id_col, url_col), judged(pages, labels, id_col, url_col)
    tree = template_tree(rows.select("host", "segments", "bad"), **options)
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    by_tree = F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))
    return urls.join(tree, ["host", "segments"], "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_tree).alias("verdict"), "template",
        "bad_share")
