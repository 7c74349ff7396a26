"""URL filter by a path-template tree (operator 5), in DataFrame operations only.

1. A url is cut into host and path, and the listed rules (longest fitting one
   wins) label what they fit.
2. Per host, the path segments are generalised level by level: under one
   parent a segment stays literal if it isn't a number and repeats: two pages
   at least, and the parent's segments (numbers apart) have REPEATS pages each
   on average, or the segment has FREQUENT pages, or MIN_SHARE of the parent's.
   All other segments become the wildcard ``*``. There is no depth limit: a
   host's levels below its last repeated segment are wildcards at once, and each
   round takes, under every template, all segments that its pages share and then
   the level where they part. So the rounds are as many as the branchings above
   one another, not as the segments of the longest url.
3. Each template has counts of blocked and labelled pages. A branch is compared
   with its parent (its last literal made a wildcard) by a two-proportion z
   test; branches that don't differ are merged into the parent's counts. That
   takes labelled pages in the branch and in its siblings: a branch without any
   is scored by the same template on other hosts (4).
4. The purity of a template is its blocked share, smoothed by the same template
   over the site (the host's last two labels), that one by the template over all
   hosts, and that one by the overall share. Templates at REJECT or more are
   blocked, others allowed.

The pages are read once and stored as narrow rows; a round reads only those with
segments left. Counts by (host, template) are shuffled after partial sums; the
rows themselves meet the small tables of literals and templates in joins whose
hot hosts adaptive execution splits.

Defined cases: a null url, or one without ``://``, has an empty host and path,
no rule and the verdict of the empty host's templates; equal urls are equal, and
repeated rows come back as often; very long urls are judged whole; a purity of
exactly REJECT blocks; a table without any labelled page allows everything; an
empty table gives no rows; other columns of the table aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.session import materialize

# The rules of the contract, as (verdict, host, path).
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
         ("block", "net", "/es/"), ("block", "net", "/fr/")]
REPEATS, FREQUENT, MIN_SHARE = 2, 8, 0.05
Z, SMOOTH, REJECT = 1.96, 4.0, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.length(host) + 1, F.length(rest))
    return F.translate(host, UPPER, LOWER), F.regexp_extract(tail, r"^[^?#]*", 0)


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, rule verdict) of the longest fitting rule, else nulls."""
    name = verdict = F.lit(None).cast("string")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return name, verdict


def with_templates(pages: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """pages (host, path, ...) with a column template; other columns must not be called segs, seg, paged or run."""
    segs = F.filter(F.split("path", "/"), lambda s: s != "")
    deepest = pages.select("host", F.posexplode(segs).alias("at", "seg")).where(~_number(F.col("seg"))) \
        .groupBy("host", "at", "seg").count().where("count > 1") \
        .groupBy("host").agg((F.max("at") + 1).alias("deepest"))
    reach = F.coalesce("deepest", F.lit(0))
    # No segment repeats below `deepest`: the levels there are wildcards, whatever the tree above.
    rows = materialize(pages.withColumn("segs", segs).join(deepest, "host", "left").withColumns({
        "tail": F.repeat(F.lit("/*"), F.greatest(F.size("segs") - reach, F.lit(0))),
        "segs": F.slice("segs", F.lit(1), reach), "template": F.lit("")}).drop("deepest"), "pages")
    ready = []
    while True:
        ready.append(rows.where("size(segs) = 0"))
        rest = rows.where("size(segs) > 0")
        if rest.isEmpty():
            break
        rows = materialize(_next_branch(rest, min_share), "pages")
    out = ready[0]
    for part in ready[1:]:
        out = out.unionByName(part)
    return out.withColumn("template", F.concat("template", "tail")).drop("segs", "tail")


def _number(seg: Column) -> Column:
    return seg.rlike(r"^[0-9]+(\.[A-Za-z]+)?$")


def _next_branch(rest: DataFrame, min_share: float) -> DataFrame:
    """One round: under each template the segments that all its pages share, then one level where they part."""
    runs = rest.groupBy("host", "template").agg(F.min("segs").alias("lo"), F.max("segs").alias("hi"), F.count("*").alias("n"))
    # Arrays are ordered segment by segment, so what the first and the last one share, all share.
    parts_at = F.array_position(F.zip_with("lo", "hi", lambda a, b: ~a.eqNullSafe(b)), True)
    shared = F.slice("lo", F.lit(1), F.when(parts_at > 0, parts_at - 1).otherwise(F.size("lo")).cast("int"))
    runs = materialize(runs.select("host", "template", F.size(shared).alias("paged"), F.array_join(F.transform(
        shared, lambda s: F.when((F.col("n") > 1) & ~_number(s), F.concat(F.lit("/"), s)).otherwise(F.lit("/*"))), "").alias("run")), "runs")
    moved = rest.join(runs, ["host", "template"]).withColumns({
        "template": F.concat("template", "run"), "seg": F.get("segs", F.col("paged")),
        "segs": F.slice("segs", F.col("paged") + 2, F.size("segs"))}).drop("paged", "run")
    counts = materialize(moved.where("seg IS NOT NULL").groupBy("host", "template", "seg").agg(F.count("*").alias("n")), "segments")
    named = ~_number(F.col("seg"))
    totals = counts.groupBy("host", "template").agg(
        F.sum("n").alias("total"), F.sum(F.when(named, F.col("n"))).alias("named"), F.count_if(named).alias("values"))
    literal = counts.where(named & (F.col("n") >= 2)).join(totals, ["host", "template"]) \
        .where((F.col("named") >= REPEATS * F.col("values")) | (F.col("n") >= FREQUENT)
               | (F.col("n") >= min_share * F.col("total"))) \
        .select("host", "template", "seg", F.lit(True).alias("literal"))
    return moved.join(literal, ["host", "template", "seg"], "left").withColumn(
        "template", F.when(F.col("seg").isNull(), F.col("template")).otherwise(
            F.concat("template", F.lit("/"), F.when(F.col("literal"), F.col("seg")).otherwise(F.lit("*"))))) \
        .drop("literal", "seg")


def template_purity(nodes: DataFrame) -> DataFrame:
    """nodes (host, template, blocked, labelled) -> host, template, purity."""
    site = F.substring_index("host", ".", -2)
    nodes = nodes.withColumns({
        "site": site,
        # The last literal segment made a wildcard: the node that a branch may merge into.
        "parent": F.regexp_replace("template", r"/[^/*]+([/*]*)$", "/*$1")})
    sums = lambda keys, p: nodes.groupBy(*keys).agg(
        F.sum("blocked").alias(f"{p}_blocked"), F.sum("labelled").alias(f"{p}_labelled"))
    joined = nodes.join(sums(["host", "parent"], "up"), ["host", "parent"]) \
        .join(sums(["site", "template"], "site"), ["site", "template"]) \
        .join(sums(["template"], "all"), "template")
    total = nodes.agg(F.sum("blocked"), F.sum("labelled")).first()
    base = F.lit(total[0] / total[1] if total[1] else 0.0)
    b, n, ub, un = (F.col(c) for c in ("blocked", "labelled", "up_blocked", "up_labelled"))
    rb, rn = ub - b, un - n  # the siblings
    p = ub / un
    spread = F.sqrt(p * (1 - p) * (1 / n + 1 / rn))
    similar = F.when((n > 0) & (rn > 0), F.abs(b / n - rb / rn) <= Z * spread).otherwise(F.lit(False))
    smooth = lambda blocked, labelled, prior: (blocked + SMOOTH * prior) / (labelled + SMOOTH)
    over_all = smooth(F.col("all_blocked"), F.col("all_labelled"), base)
    over_site = smooth(F.col("site_blocked"), F.col("site_labelled"), over_all)
    own = F.when(similar, smooth(ub, un, over_site)).otherwise(smooth(b, n, over_site))
    return joined.select("host", "template", own.alias("purity"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity for each page."""
    host, path = host_and_path(F.col(url_col))
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    narrow = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path")) \
        .withColumns({"rule": rule, "known": verdict})
    rows = with_templates(narrow)
    nodes = rows.groupBy("host", "template").agg(
        F.sum(F.when(F.col("known") == "block", 1).otherwise(0)).alias("blocked"), F.count("known").alias("labelled"))
    purity = template_purity(materialize(nodes, "nodes"))
    return rows.join(purity, ["host", "template"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("known", F.when(F.col("purity") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template", "purity")


def op5(spark: SparkSession, pages: DataFrame) -> DataFrame:
    return judge(pages)
