"""URL filters by path-template trees (operator 4).

Hosts and paths are cut out of the urls, rules decide those they fit.  The
rest is decided by templates: per host, the segments of paths form a tree
level by level.  A segment keeps a branch of its own only where its labels
differ statistically from those of its siblings; all others (numbers, codes,
segments without labels, segments like the rest) share a wildcard.  Branches of
a node with similar shares are merged, and a branch is rejected when its
smoothed share of blocked labels reaches one half.  Labels are the rules'
decisions.  The tree depends on labels alone, so more rows or more siblings
without labels change no verdict, and levels go on while labels of a node differ.

Defined cases: a null url or one without "://" has an empty host and an empty
path, fits no rule and is judged by the branch of the empty host; an empty
path is the tree's root; urls and paths of any length are cut whole; repeated
rows are judged alike, each counting as a label; equally long rules are ordered
by their text; without labels everything is allowed; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from windrose.llm.common import materialise, prepare

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]
SMOOTH = 4.0        # weight of the parent's share in a branch's share
Z = 1.96            # branches whose shares differ by fewer standard errors are merged
GRID = 64           # steps of the share in which branches are looked at for merging
REJECT = 0.5

_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, ASCII letters lower-cased."""
    rest = _after_scheme(F.coalesce(url, F.lit("")))
    return F.coalesce(F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), *_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """Then up to "?", "#" or the end."""
    rest = _after_scheme(F.coalesce(url, F.lit("")))
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):     # the longest is tested first
        domain, _, rest = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _shape(segment: Column) -> Column:
    """A segment that is a number or a long code varies by its shape alone; an
    extension stays apart."""
    number = segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$")
    code = segment.rlike(r"^[0-9a-fA-F-]{16,}$") | (segment.rlike(r"[0-9]") & (F.length(segment) >= 20))
    return F.when(number | code, F.concat(F.lit("*"), F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})$", 1))).otherwise(segment)


def _apart(nodes: DataFrame, p0: float) -> DataFrame:
    """(_h, _t, _s): the segments with a branch of their own, from labelled counts
    (host, template, _s, b, n).

    A segment's share is tested against that of all its siblings together, which
    leans on the whole table's share with the weight SMOOTH.
    """
    total = nodes.groupBy("host", "template").agg(F.sum("b").alias("all_b"), F.sum("n").alias("all_n"))
    both = nodes.join(total, ["host", "template"])
    rest_n = F.col("all_n") - F.col("n") + SMOOTH
    rest_b = F.col("all_b") - F.col("b") + SMOOTH * p0
    mid = (F.col("b") + rest_b) / (F.col("n") + rest_n)
    error = F.sqrt(mid * (1 - mid) * (1 / F.col("n") + 1 / rest_n))
    return both.filter(F.abs(F.col("b") / F.col("n") - rest_b / rest_n) > Z * error).select(
        F.col("host").alias("_h"), F.col("template").alias("_t"), F.col("_s"))


def templates(pages: DataFrame) -> DataFrame:
    """Adds ``template`` to (host, path, verdict, ...): the path with wildcards, level by level.

    Each level is one grouped count of the labelled rows over (host, template so
    far, segment), combined map-side.  Where all labels of a node agree no deeper
    segment can differ, so only nodes with both labels go on; whatever follows
    in other paths is one wildcard.
    """
    segments = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), _shape)
    cur = pages.withColumns({"_seg": segments, "template": F.lit(""), "_depth": F.lit(0)})
    labels = cur.filter(F.col("verdict").isNotNull()).groupBy("host", "_seg", "template", "_depth").agg(
        F.count_if(F.col("verdict") == "block").alias("b"), F.count(F.lit(1)).alias("n"))
    labels = materialise(labels, "url-labels")
    share = labels.agg(F.sum("b") / F.sum("n")).first()[0] or 0.0
    level = 0
    while True:
        here = F.get("_seg", F.lit(level))
        # nodes reached at this level whose labels differ
        mixed = (labels.filter(F.col("_depth") == level).groupBy("host", "template").agg(F.sum("b").alias("_b"), F.sum("n").alias("_n"))
                 .filter((F.col("_b") > 0) & (F.col("_b") < F.col("_n"))).select("host", "template"))
        nodes = (labels.filter((F.col("_depth") == level) & here.isNotNull()).join(mixed, ["host", "template"], "left_semi")
                 .groupBy("host", "template", here.alias("_s")).agg(F.sum("b").alias("b"), F.sum("n").alias("n")))
        nodes = materialise(nodes, "url-nodes")
        if nodes.isEmpty():
            break
        apart = materialise(_apart(nodes, share).withColumn("_own", F.lit(True)), "url-apart")
        open_ = materialise(nodes.select(F.col("host").alias("_oh"), F.col("template").alias("_ot"), F.lit(True).alias("_open")).distinct(),
                            "url-open")
        cur, labels = _grown(cur, open_, apart, level), materialise(_grown(labels, open_, apart, level), "url-labels")
        level += 1
    tail = F.when(F.size("_seg") > F.col("_depth"), F.lit("/*")).otherwise(F.lit(""))
    return cur.withColumn("template", F.concat("template", tail)).drop("_seg", "_depth")


def _grown(df: DataFrame, open_: DataFrame, apart: DataFrame, level: int) -> DataFrame:
    """Rows of open nodes take one more segment into their template."""
    seg = F.get("_seg", F.lit(level))
    at = (F.col("_depth") == level) & seg.isNotNull()
    df = df.join(open_, at & (F.col("host") == F.col("_oh")) & (F.col("template") == F.col("_ot")), "left")
    df = df.join(apart, F.col("_open") & (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")) & (seg == F.col("_s")), "left")
    step = F.concat(F.lit("/"), F.when(F.col("_own"), seg).otherwise(F.lit("*")))
    return df.withColumns({"template": F.when(F.col("_open"), F.concat("template", step)).otherwise(F.col("template")),
                           "_depth": F.when(F.col("_open"), level + 1).otherwise(F.col("_depth"))}) \
        .drop("_oh", "_ot", "_open", "_h", "_t", "_s", "_own")


def template_shares(labelled: DataFrame) -> DataFrame:
    """(host, template, share): the smoothed share of blocked labels of each
    branch, from (host, template, verdict); statistically similar branches of a
    node share one value.

    A branch leans on its host, a host on the same template elsewhere and that
    on the whole table.  Branches are merged in GRID steps of their share, so the
    windows over a node's steps have a bounded number of rows.
    """
    block = F.count_if(F.col("verdict") == "block")
    known = F.count("verdict")
    per = materialise(labelled.groupBy("host", "template").agg(block.alias("b"), known.alias("n")), "url-branches")
    overall = per.agg(((F.sum("b") + 0.0) / F.greatest(F.sum("n"), F.lit(1))).alias("p0"))
    elsewhere = per.groupBy("template").agg(F.sum("b").alias("tb"), F.sum("n").alias("tn"))
    hosts = per.groupBy("host").agg(F.sum("b").alias("hb"), F.sum("n").alias("hn"))
    p0 = overall.first()["p0"] or 0.0
    rows = (per.join(elsewhere, "template").join(hosts, "host")
            .withColumn("tp", (F.col("tb") + SMOOTH * p0) / (F.col("tn") + SMOOTH))
            .withColumn("prior", (F.col("hb") + SMOOTH * F.col("tp")) / (F.col("hn") + SMOOTH))
            .withColumn("p", (F.col("b") + SMOOTH * F.col("prior")) / (F.col("n") + SMOOTH))
            .withColumn("parent", F.regexp_extract("template", r"(?s)^(.*)/[^/]*$", 1))
            .withColumn("step", F.least(F.floor(F.col("p") * GRID), F.lit(GRID - 1))))
    node = ["host", "parent"]
    steps = rows.groupBy(*node, "step").agg(F.sum("b").alias("b"), F.sum("n").alias("n"), F.avg("prior").alias("prior"))
    steps = steps.withColumn("p", (F.col("b") + SMOOTH * F.col("prior")) / (F.col("n") + SMOOTH))
    order = Window.partitionBy(*node).orderBy("step")
    gap = F.col("p") - F.lag("p").over(order)
    mid = (F.col("p") + F.lag("p").over(order)) / 2
    error = F.sqrt(mid * (1 - mid) * (1 / (F.col("n") + SMOOTH) + 1 / (F.lag("n").over(order) + SMOOTH)))
    cut = steps.withColumn("_cut", F.when(gap > Z * error, 1).otherwise(0)).withColumn("_run", F.sum("_cut").over(order))
    run = Window.partitionBy(*node, "_run")
    shares = cut.select(*node, "step", ((F.sum("b").over(run) + SMOOTH * F.avg("prior").over(run))
                                        / (F.sum("n").over(run) + SMOOTH)).alias("share"))
    return rows.select("host", "template", "parent", "step").join(shares, [*node, "step"]).select("host", "template", "share")


def judge(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, share) for every row."""
    prepare(pages.sparkSession)
    cut = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"),
                       path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_verdict(F.col("host"), F.col("path"), rules)
    known = materialise(templates(cut.withColumn("rule", rule).withColumn("verdict", verdict)), "url-templates")
    shares = template_shares(known.select("host", "template", "verdict")).select(
        F.col("host").alias("_h"), F.col("template").alias("_t"), "share")
    return (known.join(shares, (F.col("host") == F.col("_h")) & (F.col("template") == F.col("_t")), "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", F.when(F.col("share") >= REJECT, "block").otherwise("allow")).alias("verdict"),
                    "template", "share"))
