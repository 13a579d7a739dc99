"""URL filter: block and allow rules, and a path-template tree for the rest.

Rules are (host, path) prefixes; the longest that fits decides.  All other
URLs are judged by a tree of path templates that is grown level by level:

1. A node is a host with a template of the path so far.  A child segment that
   at least ``SUPPORT`` per cent of the node's URLs share, by the lower end of
   the share's interval, stays as it is; rarer ones are variable and become a
   wildcard of their shape (digits, hexadecimal, word, other).
2. Literal children of a node are put in order of their labels and shapes, and
   neighbours that a two-sample test cannot tell apart are merged.
3. The rules' verdicts label the URLs they fit.  A template's purity is its
   share of blocked labels, smoothed towards its host's, which is smoothed
   towards that of all hosts.  Templates of at least ``REJECT`` are blocked,
   with or without labels of their own.

Every step groups or joins on nodes; counts are summed before they are
shuffled, and URLs are reduced to distinct (host, path) first.  Each counts
once, so how often its rows are repeated changes no verdict.

Defined cases: a null URL or one without "://" has an empty host and path and
is judged like any other; empty segments are segments; segments beyond
``DEPTH`` form one last segment; repeated rows are judged each; a null id is
kept; siblings of equal rank in the order are ordered by name; an empty table
gives no rows; paths of any length are read whole; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seawake.llm.common import UPPER, stored

#: (host, path, verdict) of the production rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Least share of a literal segment in its node, in per cent.
SUPPORT = 20
DEPTH = 8
REJECT = 0.5
#: Weight of the host's purity against a template's labels, and of all hosts' against a host's.
HOST_WEIGHT = 5.0
TOTAL_WEIGHT = 10.0


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z in lower case."""
    at = F.locate("://", url)
    host = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"(?s)^([^/?#]*)", 1)
    return F.when(F.coalesce(at, F.lit(0)) > 0, F.translate(host, UPPER, UPPER.lower())).otherwise("")


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    at = F.locate("://", url)
    path = F.regexp_extract(F.substring(url, at + 3, F.length(url)), r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.when(F.coalesce(at, F.lit(0)) > 0, path).otherwise("")


#: File endings that shapes of lower segments tell apart.
USUAL_ENDINGS = ("html", "htm", "php", "asp", "aspx", "jsp", "pdf", "jpg", "jpeg", "png", "gif", "xml", "json", "txt", "css", "js")


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for rule_host, rule_path, rule_verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(rule_verdict)).otherwise(verdict)
    return name, verdict


def shape(segment: Column) -> Column:
    """Wildcard for a variable segment; it keeps a file ending."""
    stem, ending = F.regexp_extract(segment, r"(?s)^(.*?)(\.[a-z]{2,5})?$", 1), F.regexp_extract(segment, r"(?s)^(.*?)(\.[a-z]{2,5})?$", 2)
    kind = (
        F.when(stem.rlike(r"^[0-9]+$"), "{number}")
        .when(stem.rlike(r"^[0-9a-fA-F-]{8,}$"), "{hex}")
        .when(stem.rlike(r"^[A-Za-z]+$"), "{word}")
        .when(stem == "", "{none}")
        .otherwise("{other}")
    )
    return F.concat(kind, ending)


def _segments(path: Column) -> Column:
    parts = F.split(F.regexp_replace(path, "^/", ""), "/", -1)
    rest = F.array_join(F.slice(parts, DEPTH + 1, F.greatest(F.size(parts), F.lit(1))), "/")
    return F.when(F.size(parts) > DEPTH, F.concat(F.slice(parts, 1, DEPTH), F.array(rest))).otherwise(parts)


def templates(urls: DataFrame, support: int = SUPPORT) -> DataFrame:
    """Template of each distinct (host, path); ``urls`` has these with n, n_block, n_label."""
    nodes = stored(urls.select("*", _segments(F.col("path")).alias("parts"), F.lit("").alias("template")), "url-level")
    depth = nodes.agg(F.max(F.size("parts"))).first()[0] or 0
    for level in range(depth):
        segment = F.when(F.size("parts") > level, F.element_at("parts", level + 1))
        here = nodes.withColumn("segment", segment)
        below = F.coalesce(_usual(shape(F.when(F.size("parts") > level + 1, F.element_at("parts", level + 2)))), F.lit("{end}"))
        children = here.filter("segment is not null").groupBy("host", "template", "segment", below.alias("below"))
        children = children.agg(F.sum("n").alias("n"), F.sum("n_block").alias("n_block"), F.sum("n_label").alias("n_label"))
        literal = children.groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"),
            F.sum("n_block").alias("n_block"),
            F.sum("n_label").alias("n_label"),
            # bounded: kinds with the usual file endings, and one for all others
            F.map_from_entries(F.array_sort(F.collect_list(F.struct("below", "n")))).alias("shapes"),
        )
        # every URL that reaches the node counts, also those that end here
        whole = here.groupBy("host", "template").agg(F.sum("n").alias("whole"))
        literal = literal.join(whole, ["host", "template"]).filter(_least_share(F.col("n"), F.col("whole")) * 100 >= support).drop("whole")
        literal = stored(_merged(literal), "url-literals")
        named = here.join(literal, ["host", "template", "segment"], "left")
        step = F.when(F.col("segment").isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("merged", shape(F.col("segment")))))
        grown = F.concat("template", step)
        nodes = stored(named.select(*[c for c in nodes.columns if c != "template"], grown.alias("template")), "url-level")
    return nodes.drop("parts")


def _usual(name: Column) -> Column:
    """A shape whose file ending, if it is not a usual one, is left open."""
    ending = F.regexp_extract(name, r"\.([a-z]{2,5})$", 1)
    return F.when((ending == "") | ending.isin(*USUAL_ENDINGS), name).otherwise(F.concat(F.regexp_extract(name, r"^(\{[a-z]+\})", 1), F.lit(".{other}")))


def _least_share(n: Column, whole: Column) -> Column:
    """Lower end of the Wilson interval of a share, one standard error wide."""
    share = n / whole
    return (share + 0.5 / whole - F.sqrt(share * (1 - share) / whole + 0.25 / (whole * whole))) / (1 + 1 / whole)


def _two_samples(one: Column, other: Column) -> Column:
    """Whether two counts by category (maps) differ: G statistic against the chi-squared distribution."""

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log(x)).otherwise(0.0)

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0.0), lambda acc, x: acc + x)

    keys = F.array_union(F.map_keys(one), F.map_keys(other))

    def counts(of: Column) -> Column:
        return F.transform(keys, lambda k: F.coalesce(of[k], F.lit(0)).cast("double"))

    left, right = counts(one), counts(other)
    sums = F.zip_with(left, right, lambda x, y: x + y)
    inner = total(F.transform(left, part)) + total(F.transform(right, part)) - total(F.transform(sums, part))
    g = 2 * (inner + part(total(sums)) - part(total(left)) - part(total(right)))
    # upper hundredth of chi-squared, by Wilson and Hilferty
    free = F.greatest(F.size(keys) - 1, F.lit(1)).cast("double")
    critical = free * F.pow(1 - 2 / (9 * free) + 2.326 * F.sqrt(2 / (9 * free)), F.lit(3.0))
    return F.coalesce((F.size(keys) > 1) & (g > critical), F.lit(False))


def _merged(literal: DataFrame) -> DataFrame:
    """One name for literal siblings that cannot be told apart: the first of each run.

    A node has few literal siblings, as each has a fifth of it.  They are put
    in order of their labels and shapes, and a run ends where two neighbours
    differ, in the shapes below or in how many are blocked, allowed and without
    a label, by a test that takes their sizes into account.
    """
    labels = F.create_map(
        F.lit("block"), F.col("n_block"), F.lit("allow"), F.col("n_label") - F.col("n_block"), F.lit("none"), F.col("n") - F.col("n_label")
    )
    rows = literal.withColumn("labels", F.map_filter(labels, lambda _, n: n > 0))
    largest = F.array_max(F.transform(F.map_entries("shapes"), lambda e: F.struct(e["value"], e["key"])))["key"]
    order = Window.partitionBy("host", "template").orderBy(F.col("n_block") / F.col("n"), F.col("n_label") / F.col("n"), largest, "segment")
    other, before = F.lag("shapes").over(order), F.lag("labels").over(order)
    rows = rows.withColumns({"other": other, "before": before})
    new = F.col("other").isNull() | _two_samples(F.col("shapes"), F.col("other")) | _two_samples(F.col("labels"), F.col("before"))
    rows = rows.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(order))
    run = Window.partitionBy("host", "template", "run")
    return rows.select("host", "template", "segment", F.min("segment").over(run).alias("merged"))


def judge(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", support: int = SUPPORT) -> DataFrame:
    """id, host, path, rule, verdict of each URL, with the template and its purity."""
    url = F.col(url_col).cast("string")
    rows = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = stored(rows, "urls")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    distinct = rows.select("host", "path").distinct().withColumn("n", F.lit(1).cast("long"))
    distinct = distinct.select("*", name.alias("rule"), verdict.alias("rule_verdict"))
    labelled = distinct.withColumn("n_block", F.when(F.col("rule_verdict") == "block", F.col("n")).otherwise(0))
    labelled = labelled.withColumn("n_label", F.when(F.col("rule_verdict").isNotNull(), F.col("n")).otherwise(0))
    known = templates(labelled, support)
    sums = [F.sum("n_block").alias("n_block"), F.sum("n_label").alias("n_label")]
    by_template = stored(known.groupBy("host", "template").agg(*sums), "url-templates")
    by_host = by_template.groupBy("host").agg(F.sum("n_block").alias("h_block"), F.sum("n_label").alias("h_label"))
    total = by_template.agg(*sums).first()
    rate = (total["n_block"] or 0) / max(1, total["n_label"] or 0)
    host_purity = (F.col("h_block") + TOTAL_WEIGHT * rate) / (F.col("h_label") + TOTAL_WEIGHT)
    purity = (F.col("n_block") + HOST_WEIGHT * host_purity) / (F.col("n_label") + HOST_WEIGHT)
    scored = stored(by_template.join(by_host, "host").select("host", "template", purity.alias("purity")), "url-purity")
    # also for a template without a label of its own: then the host's purity and the general rate decide
    rejected = F.col("purity") >= REJECT
    judged = known.join(scored, ["host", "template"]).select(
        "host",
        "path",
        "rule",
        F.coalesce("rule_verdict", F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        "template",
        "purity",
    )
    judged = stored(judged, "url-verdicts")
    return rows.join(judged, ["host", "path"]).select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "template", "purity")
