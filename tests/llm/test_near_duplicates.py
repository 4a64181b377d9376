"""Components of the exact similarity graph, by brute force; skewed groups; components alone."""

import random
from collections import Counter, defaultdict

import pytest

from reportlake.llm import near_duplicates as N
from reportlake.llm.components import components


def shingle_set(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """doc row number -> (set size, least id of the component)."""
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for g in s:
            holders[g].append(k)
    common = Counter((a, b) for h in holders.values() for i, b in enumerate(h) for a in h[:i])
    for (a, b), c in common.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[top(k)] = min(least.get(top(k), i), i)
    return Counter((i, len(sets[k]), least[top(k)], i == least[top(k)]) for k, (i, _) in enumerate(rows))


def check(spark, rows, **options):
    documents = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(tuple(r) for r in N.near_duplicates(documents, **options).collect())
    assert got == brute(rows)


def test_edge_cases(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    got = Counter(tuple(r) for r in N.near_duplicates(documents).collect())
    assert got == brute(rows)


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("options", [{}, {"node_limit": 4, "max_depth": 2}])
def test_groups_of_copies_and_shared_passages(spark, options):
    rng = random.Random(9)
    words = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows, template, passage = [], words(120), words(60)
    rows += [" ".join(template)] * 60  # exact copies
    rows += [edited(rng, template, rng.randint(1, 4)) for _ in range(60)]  # near copies, some at the threshold
    rows += [" ".join(passage + words(60)) for _ in range(60)]  # alike in part only
    rows += [" ".join(words(rng.randint(1, 40))) for _ in range(40)]
    chain = words(80)
    for _ in range(8):
        chain = chain[6:] + words(6)
        rows.append(" ".join(chain))
    rng.shuffle(rows)
    check(spark, list(enumerate(rows)), **options)


def test_empty_and_clashing_columns(empty, widened):
    assert N.near_duplicates(empty).count() == 0
    out = N.deduplicated(widened)
    assert out.columns == widened.columns
    kept = [r["text"] for r in out.collect()]
    assert len(kept) == len({t for t in kept if t}) + sum(not t for t in kept)
    assert sum(t is not None and t.lower() == "one two three" for t in kept) == 1


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = {r["u"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + k: 100 for k in range(1, 30)}, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_text_under_a_repeated_id_is_not_lost(spark):
    rows = [(5, "one two three four five six seven"), (2, "a b c d e f g h"), (5, "a b c d e f g h"), (None, "a b c d e f g h"), (7, None), (7, None)]
    got = N.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == [(0, rows[1][1]), (2, rows[1][1]), (5, rows[0][1]), (7, "")]


def test_candidate_rows_grow_with_members_not_pairs(spark):
    """A group around the threshold: candidates come as forests, links as unions of labels."""
    rng = random.Random(4)
    template = [f"t{k}" for k in range(100)]
    rows = [(k, edited(rng, template, rng.randint(1, 5))) for k in range(300)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    found = N.signatures(documents, "doc_id", "text").selectExpr("key", "sketch").distinct()
    node = found.selectExpr("1L AS node", "1 AS side", "key", "key AS label", "sketch")
    forest = N._node_forest(node, 0.5).collect()
    assert 0 < len(forest) < found.count()
    assert len({r["a"] for r in forest} | {r["b"] for r in forest}) > 250
    check(spark, rows)
