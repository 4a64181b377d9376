"""Ranked search against plain scores of every item and document, with small bundles and blocks."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.llm import term_pipeline as S

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
ITEMS = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(documents, items, top=10):
    found = [Counter(terms(t)) for _, t in documents]
    n = sum(1 for c in found if c)
    total = sum(c.total() for c in found)
    df = Counter(t for c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for k, c in enumerate(found):
            m = 10 + (90 * c.total() * n) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scores.append((-score, documents[k][0] is None, documents[k][0] or 0, k))
        for rank, (score, none, doc, _) in enumerate(sorted(scores)[:top], 1):
            out.append((item, rank, None if none else doc, -score))
    return sorted(out, key=str)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(300)] + ["é", "ÀÉ", "日本", "x1", "The"]
    weights = [1 / (k + 1) for k in range(len(vocabulary))]
    text = lambda k: ", ".join(rng.choices(vocabulary, weights, k=k))
    documents = [(k if rng.random() < 0.97 else None, text(rng.randint(1, 60))) for k in range(n)]
    documents += [(n + k, documents[3][1]) for k in range(25)] + [(5, "w1 w2"), (5, "w1 w2"), (n + 50, None), (n + 51, ""), (n + 52, "-- ;; `"), (n + 53, text(4000))]
    items = [(k, text(rng.randint(1, 25))) for k in range(30)] + [(30, None), (31, "nowhere-to-be-found"), (32, "..."), (None, "w5 w9"), (2, "w7 W7 w200"), (33, documents[3][1])]
    return documents, items


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"block_documents": 20}, {"block_documents": 13, "most_terms": 60, "shares": (0.02, 0.2)}, {"most_items": 3, "block_documents": 64, "shares": ()}])
def test_search_equals_plain(spark, sizes):
    documents, items = corpus(len(sizes))
    frame = spark.createDataFrame(documents, DOCUMENTS).repartition(1)
    got = S.search(frame, spark.createDataFrame(items, ITEMS).repartition(3), **sizes)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == plain_search(documents, items)


def test_few_best_and_ties(spark):
    documents = [(k, "same words here") for k in range(300, 0, -1)] + [(1000, "same other"), (1001, "unrelated")]
    items = [(1, "same words here"), (2, "other")]
    got = S.search(spark.createDataFrame(documents, DOCUMENTS), spark.createDataFrame(items, ITEMS), block_documents=16, top=4)
    assert found(got) == plain_search(documents, items, 4)
    assert [r["doc_id"] for r in got.where("item_id = 1").orderBy("rank").collect()] == [1, 2, 3, 4]


def test_full_filter_changes_nothing(spark, monkeypatch):
    """A bit set that lets every word through: owners sort out what belongs to no item."""
    documents, items = corpus(9, 150)
    monkeypatch.setattr(S, "FILTER_BITS", 8)
    assert found(S.search(spark.createDataFrame(documents, DOCUMENTS).repartition(1), spark.createDataFrame(items, ITEMS))) == plain_search(documents, items)


def test_empty_and_clashing(spark):
    documents, items = corpus(4, 60)
    frame, asked = spark.createDataFrame(documents, DOCUMENTS).repartition(1), spark.createDataFrame(items, ITEMS)
    assert S.search(frame.limit(0), asked).count() == 0
    assert S.search(frame, asked.limit(0)).count() == 0
    clash = [F.lit(1).alias(c) for c in ("id", "n", "terms", "item", "block", "bundle", "score", "rank", "owner", "doc_row")]
    assert found(S.search(frame.select("*", *clash), asked.select("*", *clash))) == plain_search(documents, items)


def test_carried_scores_are_pruned_exactly():
    """A bundle leaves behind only what can't reach the best, also where the rest of the gains is large."""
    import numpy as np
    import pyarrow as pa

    left = pa.table({"bundle": [0], "block": [0], "t_item": [[7, 7]], "t_term": [[1, 2]], "t_weight": [[10, 1]], "t_most": [[10 * 900000, 900000]], "t_owner": [[0, 1]], **{c: pa.array([[]], pa.list_(pa.int64())) for c in ("doc_rows", "doc_ids", "at_doc", "at_item", "scores", "floors")}})
    right = pa.table({"bundle": [0] * 4, "block": [0] * 4, "doc_row": [0, 1, 2, 3], "doc_id": [5, 6, 7, None], "n": [10] * 4, "terms": [[1], [1], [1], [3]], "tfs": [[9], [9], [1], [1]]})
    got = S._pass_on(0, 4, 40, 2)(left, right)
    assert got.column("doc_ids").to_pylist() == [[5, 6]] and len(got.column("floors").to_pylist()[0]) == 1
    assert np.all(np.array(got.column("scores").to_pylist()[0]) == got.column("floors").to_pylist()[0])
