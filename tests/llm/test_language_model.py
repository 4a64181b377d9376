"""Counts and base scores by brute force; the model's gradients and its gain on held-out text."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportlake.llm import language_model as L


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens(text):
    return (text or "").encode().lower().split() + [b"\n"]


def condition():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(7)) == 2


def check_base(frame, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((counts[x] + 1) / (n + v + 1)) for x in w)
        want[i, held(i), len(w), sum(counts[x] > 0 for x in w), n, round(base, 5)] += 1
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in frame.collect())
    assert got == want


@pytest.mark.parametrize("head", [400_000, 5])
def test_counts_and_base_scores(documents, head):
    out = L.score(documents, condition(), head=head).cache()
    check_base(out, documents)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out.collect())


def test_held_out_text_gains_on_the_base(spark):
    rng = random.Random(2)
    follow = {w: rng.sample(range(60), 3) for w in range(60)}

    def text():
        w, out = rng.randrange(60), []
        for _ in range(60):
            out.append(f"w{w}")
            w = rng.choice(follow[w])
        return " ".join(out)

    documents = spark.createDataFrame([(i, text()) for i in range(3000)], "doc_id long, text string").repartition(2)
    sums = L.score(documents, condition()).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert sums[0] > 0.99 * sums[1]  # about twenty windows of training


def test_probabilities_sum_to_one(spark):
    rows = spark.createDataFrame([(" ".join(f"w{k}" for k in range(n)),) for n in (3, 50, 1500)], "text string")
    v, _ = L.vocabulary(L.count_tokens(rows), head=1200)
    p = L.start_parameters(v)
    model = L.Recurrent(p)
    state = np.random.default_rng(0).normal(size=(1, L.HIDDEN)).astype(np.float32)
    at = np.arange(len(v.keys))
    logp, _ = model.output(np.repeat(state, len(at), axis=0), v.classes.astype(np.int64), v.numbers.astype(np.int64), None)
    total = np.exp(logp + v.inside).sum()
    rare, _ = model.output(state, np.array([v.word_classes + L.BINS]), np.array([0]), None)
    assert total + float(np.exp(rare[0])) == pytest.approx(1, abs=0.05)  # unused places and empty classes keep a little


def test_gradients_match_finite_differences(spark):
    rows = spark.createDataFrame([("a b c a b d e f g a",), ("b c d a a",)], "text string")
    v, _ = L.vocabulary(L.count_tokens(rows))
    p = {k: x.astype(np.float64) for k, x in L.start_parameters(v).items()}
    rng = np.random.default_rng(3)
    inputs, first = rng.integers(0, 10, (2, 5)), np.zeros((2, 5), bool)
    first[:, 0] = first[1, 3] = True
    classes, numbers = rng.integers(0, v.word_classes + 1, 10), rng.integers(0, 8, 10)

    def loss(q):
        m = L.Recurrent(q)
        states, _ = m.run(inputs, first, np.zeros((2, L.HIDDEN), np.float32))
        return -float(m.output(states.reshape(10, -1).astype(np.float64), classes, numbers, None)[0].sum())

    m, grad = L.Recurrent(p), {k: np.zeros_like(x) for k, x in p.items()}
    states, kept = m.run(inputs, first, np.zeros((2, L.HIDDEN), np.float32))
    _, d = m.output(states.reshape(10, -1).astype(np.float64), classes, numbers, grad)
    m.back(d.reshape(5, 2, -1), inputs, first, kept, grad)
    for k in p:
        for at in [tuple(int(rng.integers(0, s)) for s in p[k].shape) for _ in range(4)]:
            q = {n: x.copy() for n, x in p.items()}
            q[k][at] += 1e-2
            up = loss(q)
            q[k][at] -= 2e-2
            assert (up - loss(q)) / 2e-2 == pytest.approx(grad[k][at], abs=2e-2)


def test_lanes_hold_every_token_once():
    lengths = np.array([5, 1, 9, 2, 2, 7])
    grid, first = L.lanes(lengths, 3)
    assert sorted(grid[grid >= 0].tolist()) == list(range(26))
    assert sorted(grid[first].tolist()) == [0, 5, 6, 15, 17, 19]


def test_edges(empty, widened, documents):
    assert L.score(empty, condition()).count() == 0
    check_base(L.score(widened, condition()), documents)
    untrained = L.score(documents, F.lit(True)).collect()
    assert {r["train_tokens"] for r in untrained} == {0} and {r["n_known"] for r in untrained} == {0}


def test_lanes_are_the_inner_loop():
    """Units first in memory: with the lanes inside, numpy's loops are as long as there are lanes."""
    rng = np.random.default_rng(5)
    p = {"in": rng.normal(size=(9, 3 * L.HIDDEN)).astype(np.float32), "state": rng.normal(size=(L.HIDDEN, 3 * L.HIDDEN)).astype(np.float32)}
    first = np.zeros((50, 7), bool)
    first[3, 4] = True
    states, kept = L.Recurrent(p).run(rng.integers(0, 9, (50, 7)), first, np.zeros((50, L.HIDDEN), np.float32))
    assert states.shape == (7, 50, L.HIDDEN) and states.strides[1] == states.itemsize
    assert all(k.shape == (L.HIDDEN, 50) for step in kept for k in step)
