"""The learned verdict of the URL filter against a plain tree."""

from __future__ import annotations

import random
import re
from collections import defaultdict

from pyspark.sql import functions as F


def plain(urls: list, rules, wide: int, z=1.96, bound=0.8, prior=1.0, fade=0.5) -> list:
    """(rule, verdict) of each url."""
    pages = []
    for url in urls:
        host = path = ""
        if url and "://" in url:
            after = url.split("://", 1)[1]
            host = re.split(r"[/?#]", after)[0]
            path = re.split(r"[?#]", after[len(host) :])[0]
            host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        best = None
        for v, r in rules:
            h, _, p = r.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best[1])):
                best = v, r
        shape = tuple(re.sub(r"[0-9]+", "<n>", re.sub(r"^[0-9a-fA-F-]{16,}", "<id>", x)) for x in path.split("/") if x)
        pages.append((host, shape, best))
    shapes = {(h, s) for h, s, _ in pages}
    template = {x: list(x[1]) for x in shapes}
    for k in range(max((len(s) for _, s in shapes), default=0)):
        children = defaultdict(set)
        for x, t in template.items():
            if len(t) > k:
                children[x[0], "/".join(t[:k])].add(t[k])
        for x, t in template.items():
            if len(t) > k and len(children[x[0], "/".join(t[:k])]) > wide:
                t[k] = "*"
    n, b, kids = defaultdict(int), defaultdict(int), defaultdict(set)
    for h, s, best in pages:
        t = template[h, s]
        for d in range(len(t) + 1):
            node = (h, *t[:d])
            n[node] += best is not None
            b[node] += best is not None and best[0] == "block"
            if d:
                kids[node[:-1]].add(node)
    purity = {}

    def down(node, own):
        purity[node] = own
        faded = 0.5 + fade * (own - 0.5)
        p = b[node] / n[node] if n[node] else 0
        similar = [c for c in kids[node] if n[c] and (b[c] / n[c] - p) ** 2 * n[c] <= p * (1 - p) * z * z + 1e-12]
        pool = sum(n[c] for c in similar), sum(b[c] for c in similar)
        for c in kids[node]:
            cn, cb = pool if c in similar else (n[c], b[c])
            down(c, (cb + 2 * prior * faded) / (cn + 2 * prior))

    for h in {h for h, _, _ in pages}:
        down((h,), (b[h,] + prior) / (n[h,] + 2 * prior))
    return [(best[1], best[0]) if best else (None, "block" if purity[h, *template[h, s]] >= bound else "allow") for h, s, best in pages]


def test_verdicts_equal_a_plain_tree(spark):
    from astroloom.llm import url_filter as U

    r = random.Random(5)
    urls = [None, "", "no scheme", "http://", "HTTP://A.Example.NET?x", "https://b.com/#/x"]
    for _ in range(1500):
        host = r.choice(["a.example.com", "b.example.com", "example.net", "c.org", "D.org", "e.com", "f.example.com"])
        depth = r.randint(0, 5)
        urls.append("http://" + host + "".join("/" + r.choice(["de", "en", "fr", "a", "b", str(r.randint(1, 99)), f"w{chr(97 + r.randint(0, 25))}"]) for _ in range(depth)) + r.choice(["", "?q=1", "#t", "/"]))
    rules = [*U.RULES, ("block", "f.example.com/a"), ("allow", "f.example.com/a/b"), ("allow", "f.example.com/b")]
    pages = spark.createDataFrame([(i, u, "mine") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = {x.page_id: (x.rule, x.verdict) for x in U.judge(pages, rules).collect()}
    want = dict(enumerate(plain(urls, rules, U.WIDE)))
    assert got == want
    learned = [v for x, v in want.values() if x is None]
    assert learned.count("block") > 50 and learned.count("allow") > 50
    assert U.judge(pages.limit(0), rules).count() == 0


def test_rules_as_a_table_equal_rules_in_the_plan(spark):
    from astroloom.llm import url_filter as U

    r = random.Random(6)
    rules = [*U.RULES, ("block", "example.com/a"), ("allow", "example.com/a/b"), ("block", "b.example.com/"), ("allow", "com/"), ("block", "com/"), ("block", "com/a/b")]
    urls = [None, "x"] + ["http://" + r.choice(["a.example.com", "b.example.com", "xexample.com", "example.com", "y.net", "z.org", "com", "COM"]) + r.choice(["", "/", "/a", "/a/b", "/ab", "/fr/", "/de/1", "/en/"]) for _ in range(300)]
    host, path = U.host_path(F.col("url"))
    p = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").select("page_id", host.alias("host"), path.alias("path"))
    got = [{x.page_id: (x.rule, x.label) for x in U.with_rules(p, rules, n, b).collect()} for n, b in ((200, 0), (0, 500), (0, 0))]
    assert got[0] == got[1] == got[2] and len({v[0] for v in got[0].values()}) > 6


def test_labels_of_one_branch_leave_the_others_alone(spark):
    from astroloom.llm import url_filter as U

    h = "http://a.example.com"
    urls = [f"{h}/de/{k}" for k in range(50)] + [f"{h}/de"] + [f"{h}/en/{k}" for k in range(30)] + ["http://b.example.com/en/1"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    judged = U.judge(pages)
    got = {r.page_id: (r.rule, r.verdict) for r in judged.collect()}
    assert {got[k] for k in range(50)} == {("example.com/de/", "block")}
    assert got[50] == (None, "block")  # a page of the branch that no rule fits
    assert {got[k] for k in range(51, 82)} == {(None, "allow")}
    assert [tuple(r) for r in U.mixed_hosts(judged).collect()] == [("a.example.com", 51, 30)]
