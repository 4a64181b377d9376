"""Language ID: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are the hashed runs of 1 to 3 characters of the whole text (A-Z and the upper-case letters
of Latin-1 lower-cased); a feature's value is its share of the text's n-grams times its inverse
document frequency over all training texts. Weights are learned by follow-the-regularised-leader
with elastic-net penalties: the L1 part keeps most of them at zero. A temperature, fitted on a fifth
of the sample that took no part in training, then calibrates the probabilities.

Document frequencies are counted over all training rows, each task adding up its own before the
shuffle. Only the regression itself is fitted on a sample, bounded by ``sample_rows``, drawn by a
hash of the text and spread evenly over the languages. Prediction needs no shuffle.

Defined cases: a null text or one without a letter is ``und`` with score 0; rows without a language
teach nothing; without training rows every text is ``und``; equal probabilities go to the first
language in alphabetical order; repeated rows count each. Columns other than the text and, for
training, the language are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm import words as W

BUCKETS = 1 << 16
SIZES = (1, 2, 3)
SAMPLE_ROWS = 2400
EPOCHS = 4
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.001
#: Bytes of text whose n-grams are in memory at once (about 60 bytes for each).
SLICE = 1 << 20
#: Features are shares of a text, so they are small; this brings them near 1.
SCALE = 10.0

_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[0x41:0x5B] += 32
_LOWER[0xC0:0xDF] += 32
_LOWER[0xD7] -= 32
_ASCII_LETTER = np.array([chr(b).isalpha() for b in range(128)])


def ngrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every n-gram, its text number, whether each text has a letter)."""
    data, offsets = W.text_buffers(column)
    n = len(offsets) - 1
    text = data.tobytes().decode("utf-8")
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    limits = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets] if len(data) else np.zeros(n + 1, np.int64)
    owner = np.repeat(np.arange(n), np.diff(limits))
    letter = np.zeros(n, bool)
    small = points < 128
    letter[owner[small][_ASCII_LETTER[points[small]]]] = True
    for row in np.flatnonzero(~letter & (np.diff(limits) > 0)):
        letter[row] = any(c.isalpha() for c in text[limits[row] : limits[row + 1]])
    points = np.where(points < 256, _LOWER[np.minimum(points, 255)], points).astype(np.uint64)
    buckets, owners, run = [], [], np.zeros(len(points), np.uint64)
    for size in range(1, max(SIZES) + 1):
        run = run[: len(points) - size + 1] * np.uint64(0x100000001B3) + points[size - 1 :] + np.uint64(size)
        if size in SIZES:
            same = owner[: len(run)] == owner[size - 1 :]
            buckets.append((W.mix(run[same]) & np.uint64(BUCKETS - 1)).astype(np.int64))
            owners.append(owner[: len(run)][same])
    return np.concatenate(buckets), np.concatenate(owners), letter


def _features(buckets: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, bucket, count) of every distinct feature of every text, in order."""
    keys = owner * BUCKETS + buckets
    keys = np.sort(keys.astype(np.uint32) if len(keys) and keys.max() < 1 << 32 else keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys64 = keys[first].astype(np.int64)
    return keys64 // BUCKETS, keys64 % BUCKETS, np.diff(np.append(first, len(keys)))


@dataclass
class Model:
    """Languages in alphabetical order, the weight of each feature times its IDF, the biases and
    the temperature."""

    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


def _probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray]], labels: list[int], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """(weights, biases) of a multinomial regression learned one example at a time."""
    z, squares = np.zeros((BUCKETS + 1, classes)), np.zeros((BUCKETS + 1, classes))

    def current(at: np.ndarray) -> np.ndarray:
        part = z[at]
        penalty = np.where(at == BUCKETS, 0.0, L1)[:, None]
        w = -(part - np.sign(part) * penalty) / ((BETA + np.sqrt(squares[at])) / ALPHA + L2)
        return np.where(np.abs(part) <= penalty, 0.0, w)

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            at, values = np.append(examples[k][0], BUCKETS), np.append(examples[k][1], 1.0)
            w = current(at)
            error = _probabilities(values @ w)
            error[labels[k]] -= 1.0
            gradient = values[:, None] * error
            before = squares[at]
            squares[at] = before + gradient**2
            z[at] += gradient - (np.sqrt(squares[at]) - np.sqrt(before)) / ALPHA * w
    w = current(np.arange(BUCKETS + 1))
    return w[:-1], w[-1]


def calibrate(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss (golden-section search over its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = _probabilities(logits / np.exp(log_t))
        return -float(np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean()) + 1e-4 * log_t**2

    a, b, g = -4.0, 4.0, (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - g * (b - a), a + g * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def _document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    def count(batches):
        totals, n = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in W.slices(batches, most=SLICE):
            buckets, owner, _ = ngrams(batch.column("text"))
            totals[:-1] += np.bincount(_features(buckets, owner)[1], minlength=BUCKETS)
            n += batch.num_rows
        totals[-1] = n
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(totals[at])], names=["bucket", "n"])

    df = np.zeros(BUCKETS + 1)
    for bucket, n in rows.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n")).collect():
        df[bucket] = n
    return df[:-1], int(df[-1])


def fit(training: DataFrame, text: str = "text", lang: str = "lang", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from the rows of ``training`` that have a language."""
    rows = training.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).dropna()
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 1.0)
    df, n = _document_frequencies(rows)
    idf = np.log((1 + n) / (1 + df)) + 1
    each = max(1, sample_rows // len(languages))
    place = F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 40)) / float(1 << 40)
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, each / counts[name]))])
    chosen = rows.where(place < share[F.col("lang")]).select("text", "lang", (F.pmod(F.xxhash64("lang", "text"), F.lit(5)) == 0).alias("calibration"))

    def features(batches):
        for batch in W.slices(batches, most=SLICE):
            buckets, owner, _ = ngrams(batch.column("text"))
            row, bucket, count = _features(buckets, owner)
            limits = np.searchsorted(row, np.arange(batch.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(bucket, pa.int32()))
            tallies = pa.ListArray.from_arrays(pa.array(limits, pa.int32()), pa.array(count, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("calibration"), lists, tallies], names=["lang", "calibration", "buckets", "counts"])

    sample = chosen.mapInArrow(features, "lang string, calibration boolean, buckets array<int>, counts array<int>").toArrow()
    examples, labels, held = [], [], []
    for name, calibration, buckets, count in zip(*[sample.column(c) for c in ("lang", "calibration", "buckets", "counts")]):
        at, n_at = buckets.values.to_numpy(), count.values.to_numpy()
        if len(at):
            examples.append((at, SCALE * idf[at] * n_at / n_at.sum()))
            labels.append(languages.index(name.as_py()))
            held.append(calibration.as_py())
    ordered = sorted(range(len(examples)), key=lambda k: (labels[k], len(examples[k][0]), examples[k][1].tobytes()))
    learn = [k for k in ordered if not held[k]] or ordered
    weights, bias = ftrl([examples[k] for k in learn], [labels[k] for k in learn], len(languages))
    check = [k for k in ordered if held[k]]
    logits = np.array([examples[k][1] @ weights[examples[k][0]] + bias for k in check]).reshape(-1, len(languages))
    temperature = calibrate(logits, np.array([labels[k] for k in check], np.int64))
    return Model(languages, (SCALE * idf[:, None] * weights).astype(np.float32), bias, temperature)


def _class_probabilities(m: Model, buckets: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    total = np.maximum(np.bincount(owner, minlength=n), 1)
    logits = [np.bincount(owner, weights=m.weights[buckets, k], minlength=n) / total + m.bias[k] for k in range(len(m.languages))]
    return _probabilities(np.stack(logits, axis=1) / m.temperature)


def predict(documents: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` (calibrated probability) of every row."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        for batch in W.slices(batches, most=SLICE):
            n, c = batch.num_rows, len(m.languages)
            buckets, owner, letter = ngrams(batch.column("text"))
            known = letter & (c > 0)
            p = _class_probabilities(m, buckets, owner, n) if c else np.zeros((n, 1))
            best = p.argmax(axis=1)
            names = [m.languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.string()), pa.array(np.where(known, p.max(axis=1), 0.0))], names=["id", "lang_pred", "score"])

    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, lang_pred string, score double").withColumnRenamed("id", doc_id)


def accepted(documents: DataFrame, model: Model, text: str = "text", least_score: float = 0.4) -> DataFrame:
    """The rows, with all their columns, whose text has a language of at least ``least_score``."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index(text)

    def run(batches):
        m = shared.value
        for batch in W.slices(batches, text, SLICE):
            n, c = batch.num_rows, len(m.languages)
            if not c:
                continue
            buckets, owner, letter = ngrams(batch.column(at))
            best = _class_probabilities(m, buckets, owner, n).max(axis=1)
            yield batch.filter(pa.array(letter & (best >= least_score)))

    return documents.mapInArrow(run, documents.schema)
