"""URL filter: host and path rules, then a path-template tree learned per host.

Paths are reduced to distinct (host, path) rows with the number of pages and of labelled pages.  The
tree grows level by level, each level one aggregation over (host, template so far, segment) and one over
(host, template so far), both combined before they shuffle.  A segment stays literal if it has ``MIN_LABELS`` labels and
their purity differs from its siblings', whatever it looks like and however small its share of the pages is; so does
the only segment of a node unless it looks like a value (digits, hex, dates).  All others merge into the wildcard branch.
Levels go on until no path has a further segment; a path alone in its node is named to its end at once.
A template is blocked when its smoothed share of bad pages is at least ``BLOCK_AT``; smoothing pulls small
templates towards the host's share, and that towards the share of all pages.

Joins back to paths are on (host, template, segment), with one row per key on one side, so adaptive
execution can split a hot host.

Defined cases: a null url, or one without ``://``, has empty host and path and is judged by the template of
those; repeated pages are judged each on its own; pages without labels lean on the prior; further
columns are not read; an empty table gives none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.common import LONGEST, lower_ascii
from contactloom.sources.staging import stage

#: A branch with fewer labels cannot be told from its siblings.
MIN_LABELS = 5
SMOOTHING = 10.0
BLOCK_AT = 0.5
SIMILAR_Z = 1.96

#: (host, path, verdict) as given.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; path: up to ``?``, ``#`` or end."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.substring(url, F.locate("://", url) + 3, F.lit(LONGEST))
    host = F.regexp_extract(rest, r"(?s)^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.lit(LONGEST)), r"(?s)^[^?#]*", 0)
    return F.when(has, lower_ascii(host)).otherwise(""), F.when(has, path).otherwise("")


def apply_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds ``rule`` and ``rule_verdict`` from columns ``host`` and ``path``: the longest rule that fits, else null."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, what in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((F.col("host") == host) | F.endswith("host", F.lit("." + host))) & F.startswith("path", F.lit(path))
        rule = F.when(fits, F.lit(host + path)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return df.withColumns({"rule": rule, "rule_verdict": verdict})


def _variable(segment: Column) -> Column:
    """Looks like a value: has a digit, or is long hex."""
    return segment.rlike(r"[0-9]") | segment.rlike(r"^[0-9a-fA-F-]{16,}$")


def templates(paths: DataFrame) -> DataFrame:
    """(host, path, template) for distinct rows of host, path, n, n_lab, n_bad."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = stage(paths.withColumns({"_seg": segments, "template": F.lit("")}))  # each level reads it twice
    done, level = [tree.where(F.size("_seg") == 0)], 0
    left = tree.where(F.size("_seg") > 0)
    while not left.isEmpty():
        here = left.withColumn("_s", F.get("_seg", F.lit(level)))
        child = here.groupBy("host", "template", "_s").agg(
            F.count(F.lit(1)).alias("c_rows"), F.sum("n").alias("c_n"), F.sum("n_lab").alias("c_lab"), F.sum("n_bad").alias("c_bad")
        )
        node = child.groupBy("host", "template").agg(
            F.sum("c_rows").alias("p_rows"), F.sum("c_n").alias("p_n"), F.sum("c_lab").alias("p_lab"), F.sum("c_bad").alias("p_bad")
        )
        rest_lab, rest_bad = F.col("p_lab") - F.col("c_lab"), F.col("p_bad") - F.col("c_bad")
        pooled = F.col("p_bad") / F.greatest(F.col("p_lab"), F.lit(1))
        spread = F.sqrt(
            pooled * (1 - pooled)
            * (1 / F.greatest(F.col("c_lab"), F.lit(1)) + 1 / F.greatest(rest_lab, F.lit(1)))
        )
        gap = F.abs(
            F.col("c_bad") / F.greatest(F.col("c_lab"), F.lit(1)) - rest_bad / F.greatest(rest_lab, F.lit(1))
        )
        unlike = (F.col("c_lab") >= MIN_LABELS) & (rest_lab > 0) & (gap > SIMILAR_Z * spread)
        literal = unlike | (~_variable(F.col("_s")) & (F.col("c_n") == F.col("p_n")))
        names = child.join(node, ["host", "template"]).select(
            "host", "template", "_s", F.when(literal, F.col("_s")).otherwise(F.lit("*")).alias("_name"), (F.col("p_rows") == 1).alias("_alone")
        )
        rest = F.transform(F.slice("_seg", level + 1, LONGEST), lambda s: F.when(_variable(s), F.lit("*")).otherwise(s))
        named = F.concat("template", F.lit("/"), F.when(F.col("_alone"), F.array_join(rest, "/")).otherwise(F.col("_name")))
        tree = stage(here.join(names, ["host", "template", "_s"]).withColumn("template", named).drop("_s", "_name"))
        level += 1
        ended = F.col("_alone") | (F.size("_seg") == level)
        done.append(tree.where(ended))
        left = tree.where(~ended).drop("_alone")
    columns = ["host", "path", "n", "n_lab", "n_bad", "template"]
    return reduce(DataFrame.unionByName, [d.select(*columns) for d in done])


def template_verdicts(tree: DataFrame) -> DataFrame:
    """(host, template, n, n_lab, n_bad, bad_share): smoothed purity of every template."""
    sums = [F.sum(c).alias(c) for c in ("n", "n_lab", "n_bad")]
    leaves = tree.groupBy("host", "template").agg(*sums)
    hosts = leaves.groupBy("host").agg(F.sum("n_lab").alias("h_lab"), F.sum("n_bad").alias("h_bad"))
    every = hosts.agg(F.sum("h_lab").alias("a_lab"), F.sum("h_bad").alias("a_bad"))
    overall = F.coalesce(F.col("a_bad") / F.nullif(F.col("a_lab"), F.lit(0)), F.lit(0.0))
    host_share = (F.col("h_bad") + SMOOTHING * overall) / (F.col("h_lab") + SMOOTHING)
    share = (F.col("n_bad") + SMOOTHING * host_share) / (F.col("n_lab") + SMOOTHING)
    joined = leaves.join(hosts, "host").join(F.broadcast(every))  # one row
    return joined.select("host", "template", "n", "n_lab", "n_bad", share.alias("bad_share"))


def judge(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, template, bad_share.

    ``labels`` has page_id and bad (boolean); only labelled pages count towards purity.
    """
    host, path = host_and_path(F.col("url"))
    cut = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = labels.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    marked = cut.join(known, "page_id", "left")
    paths = marked.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("n"), F.count("bad").alias("n_lab"), F.count_if("bad").alias("n_bad")
    )
    tree = templates(paths)
    shares = template_verdicts(tree).select("host", "template", "bad_share")
    by_path = tree.select("host", "path", "template").join(shares, ["host", "template"])
    judged = apply_rules(cut.join(by_path, ["host", "path"]))
    own = F.when(F.col("bad_share") >= BLOCK_AT, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"), "template", "bad_share"
    )
