"""Held-out accuracy, calibration, and the parts against plain Python."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from reportlake.llm import language as L
from reportlake.llm.registry import table
from reportlake.llm.text_queries import op4_language


def test_held_out_accuracy(spark, sf_small):
    rows = op4_language(spark, sf_small).join(table(spark, sf_small, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == table(spark, sf_small, "documents").count()
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_ngrams_match_plain_python():
    texts = ["Añ b", None, "", "ÀÉß", "12"]
    bucket, owner, letter = L.ngrams(pa.array(texts, pa.string()))
    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" or ("À" <= c <= "Þ" and c != "×") else c for c in t or "")
    want = Counter(i for i, t in enumerate(texts) for n in (1, 2, 3) for j in range(len(t or "") - n + 1))
    assert Counter(owner.tolist()) == want
    assert letter.tolist() == [True, False, False, True, False]
    whole = L.ngrams(pa.array([lower(t) for t in texts]))[0]
    assert (whole == bucket).all()


def test_regression_is_sparse_and_separates(monkeypatch):
    rng = np.random.default_rng(0)
    examples, labels = [], []
    for k in range(300):
        c = k % 3
        at = np.unique(np.concatenate([rng.integers(0, 50, 10), 100 + 10 * c + rng.integers(0, 10, 5)]))
        examples.append((at, np.ones(len(at)) / len(at)))
        labels.append(c)
    weights, bias = L.ftrl(examples, labels, 3, epochs=6)
    guess = [int((v @ weights[at] + bias).argmax()) for at, v in examples]
    assert np.mean(np.array(guess) == labels) > 0.97
    used = np.unique(np.concatenate([at for at, _ in examples]))
    assert (weights[np.setdiff1d(np.arange(L.BUCKETS), used)] == 0).all()
    assert np.abs(weights[:50]).mean() < 0.3 * np.abs(weights[100:130]).mean()
    monkeypatch.setattr(L, "L1", 0.2)
    sparser, _ = L.ftrl(examples, labels, 3, epochs=6)
    assert (sparser[:50] == 0).mean() > 0.3 > (weights[:50] == 0).mean() > 0


def test_calibration_finds_the_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3)) * 2
    p = L._probabilities(logits)
    labels = np.array([rng.choice(3, p=x) for x in p])
    assert abs(np.log(L.calibrate(logits * 3, labels) / 3)) < 0.15


def test_edges(spark, documents, empty, widened):
    nothing = L.fit(empty)
    out = L.predict(documents, nothing).collect()
    assert len(out) == documents.count() and {(r["lang_pred"], r["score"]) for r in out} == {("und", 0.0)}
    model = L.fit(documents)
    rows = {r["doc_id"]: r for r in L.predict(documents, model).collect()}
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    for i, r in rows.items():
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text[i] or ""))
    kept = L.accepted(widened, model, least_score=0.0)
    assert kept.schema == widened.schema
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in rows.items() if r["lang_pred"] != "und"}
    assert L.predict(empty, model).count() == 0
    same = L.predict(documents.drop("lang").withColumn("lang", F.lit("zz")), model)
    assert sorted(map(tuple, same.collect()), key=str) == sorted(map(tuple, L.predict(documents, model).collect()), key=str)


def test_random_sample_is_bounded(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice(["ab", "cd", "ef"]) for _ in range(20)) + str(i), "xx" if i % 50 else "yy") for i in range(3000)]
    model = L.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=100)
    assert model.languages == ["xx", "yy"] and model.temperature > 0
