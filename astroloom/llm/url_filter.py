"""URL verdicts from rules and from a tree of path templates, in DataFrame operations only.

Pages that a rule decides are the labels. For the rest: each path becomes a
template whose variable segments (numbers, ids, children of very wide nodes)
are wildcards, and the templates of a host form a tree with the host as its root.
At each level, siblings whose share of blocked pages does not differ significantly
from that of their node pool their labels. The purity of a node is the share of
block among its labelled pages, smoothed towards its parent's purity, which fades
by half towards undecided (0.5) with each step down: labels of one branch tell
little of the others, and a branch without labels of its own never reaches the
bound by its parent alone. A page is rejected if the purity of its template
reaches the bound; a page of a host or branch without labels is
allowed. Pages without a label count nowhere. Pages are aggregated by (host,
template) before anything else, so a host with a third of all pages is a map-side
combined sum.

Defined results: a null url, or one without ://, has an empty host and path,
fits no rule and is allowed unless its template is rejected; repeated rows
count as often as they occur; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise, read

#: verdict and rule of the contract.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Rules that are held in the plan, and in a broadcast table, at most; beyond, the table is joined by a shuffle.
IN_PLAN, MAX_BROADCAST = 200, 500_000
#: A node with more children than this is a wildcard.
WIDE = 40
#: Levels of the tree after which the plan starts from a table again.
STEP = 4
#: Two-sided bound of the two-proportion test; bound of the smoothed purity, half the weight of its prior, and what is left of a parent's purity (less 0.5) a step below.
Z, PURITY, PRIOR, FADE = 1.96, 0.8, 1.0, 0.5

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or without ://."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(after, r"^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(raw, UP, LOW), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict; null where none does. The rules are held in the plan, for few of them."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, r in sorted(rules, key=lambda x: len(x[1])):
        h, _, p = r.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, F.lit(r)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def with_rules(p: DataFrame, rules=RULES, in_plan: int = IN_PLAN, broadcast: int = MAX_BROADCAST) -> DataFrame:
    """p (host, path) with rule and label. Many rules are a table that meets the ends of each host, once for each distinct host and path."""
    if len(rules) <= in_plan:
        rule, label = rule_of(F.col("host"), F.col("path"), rules)
        return p.withColumns({"rule": rule, "label": label})
    rows = [(r.partition("/")[0], "/" + r.partition("/")[2], r, v, len(r), k) for k, (v, r) in enumerate(rules)]
    table = p.sparkSession.createDataFrame(rows, "h string, prefix string, rule string, label string, length int, k int")
    own = p.select("host", "path").distinct().withColumn("parts", F.split("host", r"\."))
    ends = own.select("host", "path", F.explode(F.transform(F.sequence(F.lit(1), F.size("parts")), lambda i: F.array_join(F.slice("parts", i, F.size("parts")), "."))).alias("h"))
    met = ends.join(F.broadcast(table) if len(rules) <= broadcast else table, "h").where(F.startswith("path", "prefix"))
    best = met.groupBy("host", "path").agg(F.max_by(F.struct("rule", "label"), F.struct("length", "k")).alias("r"))
    return p.join(best, ["host", "path"], "left").select(*p.columns, "r.rule", "r.label")


def typed(segment: Column) -> Column:
    """A segment with its numbers and long hexadecimal ids as placeholders."""
    return F.regexp_replace(F.regexp_replace(segment, r"^[0-9a-fA-F-]{16,}", "<id>"), r"[0-9]+", "<n>")


def template_tree(pages: DataFrame, wide: int = WIDE, held: list | None = None) -> DataFrame:
    """Pages by (host, shape): the array of typed segments, its template, and n (labelled) and n_block, through all levels."""
    t = pages.groupBy("host", "shape").agg(F.count("label").alias("n"), F.count_if(F.col("label") == "block").alias("n_block"))
    held = [] if held is None else held  # the tables that are made on the way
    t = materialise(t.withColumn("template", F.col("shape")), "shapes")
    held.append(t)
    levels = t.agg(F.max(F.size("shape"))).first()[0] or 0
    for level in range(1, levels + 1):
        seg, parent = F.get("template", F.lit(level - 1)), F.array_join(F.slice("template", 1, level - 1), "/")
        keyed = t.withColumn("_p", parent).withColumn("_s", seg)
        broad = keyed.where(F.col("_s").isNotNull()).groupBy("host", "_p", "_s").agg(F.lit(1).alias("x")).groupBy("host", "_p").agg(F.count("x").alias("_k")).where(F.col("_k") > wide)
        starred = F.when(F.col("_k").isNotNull() & F.col("_s").isNotNull(), F.transform("template", lambda x, i: F.when(i == level - 1, F.lit("*")).otherwise(x))).otherwise(F.col("template"))
        t = keyed.join(broad, ["host", "_p"], "left").select("host", "shape", "n", "n_block", starred.alias("template"))
        if level % STEP == 0:
            t = materialise(t, "templates")
            held.append(t)
    return t


def purity(tree: DataFrame, z: float = Z, prior: float = PRIOR, fade: float = FADE, held: list | None = None) -> DataFrame:
    """host, node (the first segments of templates), own (its depth) and purity of each node, after similar siblings have pooled their labels."""
    depth = F.posexplode(F.transform(F.sequence(F.lit(0), F.size("template")), lambda d: F.array_join(F.slice("template", 1, d), "/"))).alias("depth", "node")
    node = tree.select("host", "n", "n_block", depth).groupBy("host", "depth", "node").agg(F.sum("n").alias("n"), F.sum("n_block").alias("b"))
    # A node's name ends with its last segment, which holds no slash.
    held = [] if held is None else held
    node = materialise(node.withColumn("parent", F.when(F.col("depth") > 1, F.regexp_replace("node", "/[^/]*$", "")).otherwise(F.lit(""))), "nodes")
    held.append(node)
    levels = node.agg(F.max("depth")).first()[0] or 0
    smoothed = lambda b, n, up: (F.col(b) + 2 * prior * up) / (F.col(n) + 2 * prior)
    above = node.where("depth = 0").select("host", "node", "depth", smoothed("b", "n", F.lit(0.5)).alias("purity"), "n", "b")
    out = above
    for d in range(1, levels + 1):
        parent = above.select("host", F.col("node").alias("parent"), F.col("purity").alias("up"), F.col("n").alias("pn"), F.col("b").alias("pb"))
        own = node.where(F.col("depth") == d).join(parent, ["host", "parent"])
        p, gap = F.col("pb") / F.col("pn"), F.col("b") / F.col("n") - F.col("pb") / F.col("pn")
        own = own.withColumn("similar", F.when(F.col("n") > 0, gap * gap * F.col("n") <= p * (1 - p) * (z * z) + 1e-12).otherwise(F.lit(False)))
        merged = own.where("similar").groupBy("host", "parent").agg(F.sum("n").alias("mn"), F.sum("b").alias("mb"))
        own = own.join(merged, ["host", "parent"], "left").withColumn("en", F.when(F.col("similar"), F.col("mn")).otherwise(F.col("n"))).withColumn("eb", F.when(F.col("similar"), F.col("mb")).otherwise(F.col("b")))
        above = own.select("host", "node", "depth", smoothed("eb", "en", 0.5 + fade * (F.col("up") - 0.5)).alias("purity"), "n", "b")
        if d % STEP == 0:
            above = materialise(above, "purities")
            held.append(above)
        out = out.unionByName(above)
    return out.select("host", "node", F.col("depth").alias("own"), "purity")


def judge(pages: DataFrame, rules=RULES, bound: float = PURITY) -> DataFrame:
    """page_id, host, path, rule, template and verdict of each row of pages."""
    host, path = host_path(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    shape = F.transform(F.filter(F.split("path", "/"), lambda s: s != ""), typed)
    p = with_rules(p, rules).withColumn("shape", shape)
    held: list[DataFrame] = []
    tree = materialise(template_tree(p, held=held), "tree")
    leaf = tree.select("host", "shape", F.array_join("template", "/").alias("node"), F.size("template").alias("own"))
    scored = leaf.join(purity(tree, held=held), ["host", "node", "own"])
    # Only rejected templates are joined to the pages, and only to pages without a rule.
    rejected = materialise(scored.where(F.col("purity") >= bound).select("host", "shape", F.lit(True).alias("_r")), "rejected")
    for table in (tree, *held):
        discard(table)
    verdict = F.coalesce("label", F.when(F.col("_r"), F.lit("block")).otherwise(F.lit("allow")))
    return p.join(rejected, ["host", "shape"], "left").select("page_id", "host", "path", "rule", F.array_join("shape", "/").alias("template"), verdict.alias("verdict"))


def mixed_hosts(judged: DataFrame) -> DataFrame:
    """host, n_block and n_allow (pages) of the hosts that have both verdicts; judged: what judge() returns."""
    block = F.col("verdict") == "block"
    return judged.groupBy("host").agg(F.count_if(block).alias("n_block"), F.count_if(~block).alias("n_allow")).where("n_block > 0 AND n_allow > 0")


def op7_url_filter(spark, sf_dir) -> DataFrame:
    return judge(read(spark, sf_dir, "pages", "page_id", "url")).select("page_id", "host", "path", "rule", "verdict")
