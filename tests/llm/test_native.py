"""Fingerprints and URL filters against plain Python; no Python in their plans."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from reportlake.llm import fingerprints as M
from reportlake.llm import url_filter as U


def edited(rows):
    """(id, text, edited text, next text) of rows with distinct ids."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0]))
    for k, (i, t) in enumerate(rows):
        t, other = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(t) // 2
        yield i, t, t[: len(t) - half] + other[:half], other


def test_edit_report(spark, documents):
    source = documents.dropDuplicates(["doc_id"])
    rows = {r["doc_id"]: r for r in M.edit_report(source).collect()}
    want = list(edited([(r["doc_id"], r["text"]) for r in source.collect()]))
    assert len(rows) == len(want)
    prints = {}
    for i, text, new, other in want:
        r = rows[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (text == new)
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        if text == other:
            assert r["near_next"] == 1
    assert len(set(prints.values())) == len(prints)


def test_likeness_is_that_of_the_printed_leaves(spark):
    rng = random.Random(1)
    text = lambda: "\n".join(" ".join(rng.choice(["red fox.", "old dog!", "sun", "rain.", ""]) for _ in range(6)) for _ in range(5))
    documents = spark.createDataFrame([(i, text()) for i in range(30)], "doc_id long, text string")
    leaves = lambda p: {x for section in p.split("|")[1:] for line in section.split(":")[1].split(",") for x in line.split(".") if x}
    for r in M.edit_report(documents).collect():
        a, b = leaves(r["fingerprint"]), leaves(r["edited_fingerprint"])
        assert r["near_edited"] == pytest.approx(2 * len(a & b) / (len(a) + len(b)) if a or b else 1)


def test_an_edit_changes_only_its_branch(spark):
    lines = [f"line number {k} has its own words {k * 7919 % 1000}." for k in range(200)]
    other = list(lines)
    other[100] = "line number 100 was changed here."
    frame = M.with_tree(M.with_tree(spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string"), "a", "x_"), "b", "y_")
    r = frame.select("x_root", "y_root", "x_sections", M.changed_sections("x_", "y_").alias("changed")).first()
    assert r["x_root"] != r["y_root"] and len(r["x_sections"]) > 10
    assert 1 <= len(r["changed"]) <= 2 and any(s["start"] <= 101 < s["start"] + s["size"] + 1 for s in r["changed"])
    assert sum(s["size"] for s in r["x_sections"]) == 200


def test_fingerprint_edges(spark, documents, empty, widened):
    assert M.edit_report(empty).count() == 0
    assert M.edit_report(documents).count() == documents.count()
    assert M.edit_report(widened).count() == documents.count()
    one = M.edit_report(spark.createDataFrame([(None, "only. one.")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


URLS = [None, "", "no scheme", "http://A.Net", "HTTPS://x.EXAMPLE.net/en/1?x=/de/", "http://example.net/en", "http://example.net?en/", "http://notexample.com/de/", "http://b.example.com/de/x#y", "http://c.org/fr/://z", "http://org/fr/", "http://u:p@c.org:80/fr/", "ftp://d.example.com/fr/", "://example.com/de/", "http://İ.net/"]


def judged(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        stop = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:stop])
        rest = rest[stop:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [(h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits, key=lambda r: len(r[0])) if fits else (None, None))


def test_rules(spark):
    pages = spark.createDataFrame([(k, u, None) for k, u in enumerate(URLS)], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in U.judge(pages).collect()}
    for k, u in enumerate(URLS):
        host, path, rule, verdict = judged(u)
        assert (rows[k]["host"], rows[k]["path"], rows[k]["rule"]) == (host, path, rule), u
        assert rows[k]["verdict"] == verdict if verdict else rows[k]["verdict"] in ("allow", "block")


def propagate(edges, seeds, kind):
    """Plain rounds over (src, dst, weight)."""
    steps = [(a, b, w) if kind == 0 else (b, a, w) for a, b, w in edges]
    total = Counter()
    for a, _, w in steps:
        total[a] += w
    now = {h: s[kind] for h, s in seeds.items()}
    hosts = set(seeds) | {x for e in edges for x in e[:2]}
    for _ in range(U.ROUNDS):
        new = Counter({h: (1 - U.DAMPING) * seeds.get(h, (0, 0))[kind] for h in hosts})
        for a, b, w in steps:
            new[b] += U.DAMPING * now.get(a, 0) * w / total[a]
        for h in hosts:
            if h not in total:
                new[h] += U.DAMPING * now.get(h, 0)
        now = new
    return now


def test_propagation_matches_plain_rounds(spark):
    rng = random.Random(5)
    edges = sorted({(f"h{rng.randrange(12)}", f"h{rng.randrange(12)}"): rng.randint(1, 4) for _ in range(25)}.items())
    edges = [(a, b, float(w)) for (a, b), w in edges if a != b]
    seeds = {f"h{k}": (float(k % 3 == 0), float(k % 4 == 1)) for k in range(10)}
    got = U.propagate(spark.createDataFrame(edges, "src string, dst string, weight double"), spark.createDataFrame([(h, *s) for h, s in seeds.items()], "host string, trust double, distrust double"))
    rows = {r["host"]: r for r in got.collect()}
    for kind, name in enumerate(("trust", "distrust")):
        want = propagate(edges, seeds, kind)
        assert all((rows[h][name] if h in rows else 0) == pytest.approx(x) for h, x in want.items())


def test_hosts_that_lead_to_blocked_ones_are_blocked(spark):
    link = '<a HREF="http://Bad.net/x">x</a> <img src=//bad.net/y> <a href="/local">z</a>'
    pages = spark.createDataFrame([(1, "http://bad.net/", ""), (2, "http://feeder.com/a", link), (3, "http://fine.com/", '<a href="http://good.org/">'), (4, "http://good.org/fr/", ""), (4, "http://good.org/fr/", "")], "page_id long, url string, html string")
    rows = {r["page_id"]: r for r in U.judge(pages).collect()}
    assert {k: r["verdict"] for k, r in rows.items()} == {1: "block", 2: "block", 3: "allow", 4: "allow"}
    assert rows[2]["rule"] is None and rows[2]["distrust"] > 0.5


def test_url_edges(spark, empty):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert U.judge(pages).count() == 0


def test_no_python_in_the_plans(spark, documents):
    pages = spark.createDataFrame([(1, "http://a.net/", "")], "page_id long, url string, html string")
    for frame in (M.edit_report(documents), U.judge(pages.select("*", F.lit(1).alias("rule"), F.lit(1).alias("trust")))):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
