"""Language-model scoring: a gated recurrent model with a class-factored softmax, in numpy.

Counting: each task adds up its tokens (lower-cased words and an end token a document) before the
shuffle; the vocabulary table holds the count of every distinct training token. Its most frequent
part, at most ``HEAD`` tokens, is sent to the tasks; the rest stays a table that rare tokens of the
documents are joined to, so no count is approximate and no frequent token is shuffled.

Model: the ``WORDS`` most frequent tokens sit in classes of ``CLASS`` words, the others of the head
in classes by frequency, all rarer tokens and unknown ones in one last class. A gated recurrent unit
reads the tokens; P(token) = P(class | state) * P(token | class), where the second factor is a
softmax of the state for word classes and (count + 1) shares for the others. Biases start at the
training counts, so training starts from the unigram model.

Training: truncated backpropagation over windows of ``STEPS`` tokens, documents side by side in
lanes, the state carried from window to window. All training documents take part: a first
``WARM`` share of them and then the others are learned by each task on its own rows, and after each
of the two rounds the parameters are averaged by tokens. Scoring carries the state through the
whole document.

Defined cases: a null, empty or blank text is the end token alone; unknown tokens have count 0;
without training documents every count is 0 and the model is uniform over its classes; repeated rows
and ids are scored one by one; an empty table gives an empty result. Columns other than the id and
the text are not read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm import words as W
from reportlake.llm.shared import written

HEAD = 400_000
WORDS, CLASS, BINS = 960, 32, 6
HIDDEN = 16
LANES, STEPS = 384, 24
WARM = 1 / 16
RATE = 0.01
SLICE = 20 << 20
#: Distinct tokens a counting task holds before it hands them on.
HELD = 2_000_000
END = W.signed(W.word_hashes(np.array([10], np.uint8), np.array([0]), np.array([1])))[0]


@dataclass
class Vocabulary:
    """Head tokens by hash, with count, class and number; ``total`` N, ``distinct`` V."""

    keys: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    numbers: np.ndarray
    inside: np.ndarray  # natural log of the share within a frequency class
    total: int
    distinct: int
    rare: int  # sum of count + 1 of all rare tokens, and 1 for unknown ones
    class_weight: np.ndarray  # tokens of each class
    word_weight: np.ndarray  # counts of the words, (classes of words, CLASS)

    @property
    def base_total(self) -> int:
        return self.total + self.distinct + 1

    @property
    def word_classes(self) -> int:
        return len(self.word_weight)


def _tokens(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes of all texts, each text ended by END; token offsets of the texts)."""
    data, offsets = W.text_buffers(batch.column("text"))
    starts, ends, owner = W.word_spans(data, offsets, W.SPACED)
    hashes = W.signed(W.word_hashes(data, starts, ends))
    count = np.bincount(owner, minlength=batch.num_rows)
    limits = np.concatenate([[0], np.cumsum(count + 1)])
    return np.insert(hashes, np.cumsum(count), END), limits


def _tally(hashes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashes):
        return hashes, np.zeros(0, np.int64)
    if counts is None:
        ordered = np.sort(hashes)
        first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        return ordered[first], np.diff(np.append(first, len(ordered)))
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    return ordered[first], np.add.reduceat(counts[order], first)


def count_tokens(rows: DataFrame) -> DataFrame:
    """(h, c) of every distinct token; ``rows``: (text)."""

    def run(batches):
        keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        out = lambda: pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], names=["h", "c"])
        for batch in W.slices(batches):
            more, n = _tally(_tokens(batch)[0])
            keys, counts = _tally(np.concatenate([keys, more]), np.concatenate([counts, n]))
            if len(keys) > HELD:
                yield out()
                keys, counts = keys[:0], counts[:0]
        yield out()

    return written(rows.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "lm-vocabulary")


def vocabulary(counted: DataFrame, head: int = HEAD) -> tuple[Vocabulary, int]:
    """The head as arrays, and the least count it takes in."""
    level = F.floor(F.log2("c") * 8).cast("int")
    bins = sorted(counted.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c"), F.min("c").alias("least")).collect(), reverse=True)
    total, distinct = sum(b["c"] for b in bins), sum(b["n"] for b in bins)
    taken, least = 0, 1 << 62
    for b in bins:
        if taken + b["n"] > head:
            break
        taken, least = taken + b["n"], b["least"]
    top = counted.where(F.col("c") >= least).toArrow()
    keys, counts = (top.column(c).to_numpy().astype(np.int64) for c in ("h", "c"))
    order = np.lexsort((keys, -counts))
    keys, counts = keys[order], counts[order]
    ends = np.flatnonzero(keys == END)
    if len(ends):  # the end token is a word of the model, however few documents there are
        order = np.concatenate([ends, np.delete(np.arange(len(keys)), ends)])
        keys, counts = keys[order], counts[order]
    n = len(keys)
    words = min(WORDS, n)
    word_classes = max(1, -(-words // CLASS))
    classes, numbers = np.empty(n, np.int32), np.zeros(n, np.int32)
    classes[:words], numbers[:words] = np.arange(words) // CLASS, np.arange(words) % CLASS
    others = counts[words:]
    share = np.cumsum(others) / max(1, others.sum())
    classes[words:] = word_classes + np.minimum((share * BINS).astype(np.int64), BINS - 1)
    rare_class = word_classes + BINS
    weight = np.zeros(rare_class + 1)
    np.add.at(weight, classes, counts)
    weight[rare_class] = total - counts.sum()
    plus = np.zeros(rare_class + 1)
    np.add.at(plus, classes, counts + 1)
    inside = np.where(classes < word_classes, 0.0, np.log((counts + 1) / np.maximum(plus[classes], 1)))
    word_weight = np.zeros((word_classes, CLASS))
    word_weight[classes[:words], numbers[:words]] = counts[:words]
    by_key = np.argsort(keys)
    rare = int(total - counts.sum() + distinct - n + 1)
    return Vocabulary(keys[by_key], counts[by_key], classes[by_key], numbers[by_key], inside[by_key].astype(np.float32), int(total), int(distinct), rare, weight, word_weight), least


def look_up(v: Vocabulary, hashes: np.ndarray) -> np.ndarray:
    """Place of each token in the head, or -1."""
    place = pc.index_in(pa.array(hashes, pa.int64()), value_set=pa.array(v.keys, pa.int64()))
    return pc.fill_null(place, -1).to_numpy().astype(np.int64)


Parameters = dict[str, np.ndarray]


def start_parameters(v: Vocabulary, seed: int = 11) -> Parameters:
    """Random weights; biases at the training counts."""
    rng = np.random.default_rng(seed)
    inputs, classes = v.word_classes * CLASS + BINS + 1, v.word_classes + BINS + 1
    f = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    word = np.log(v.word_weight + 0.01)
    return {
        "in": f(inputs, 3 * HIDDEN),
        "state": f(HIDDEN, 3 * HIDDEN),
        "class": 0.1 * f(HIDDEN, classes),
        "class_bias": (np.log(v.class_weight + 0.5) - np.log(v.class_weight.sum() + 0.5 * classes)).astype(np.float32),
        "word": 0.1 * f(v.word_classes, HIDDEN, CLASS),
        "word_bias": (word - np.log(np.exp(word).sum(axis=1, keepdims=True))).astype(np.float32),
    }


def lanes(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(token numbers laid out in lanes, -1 beyond a lane's end; where documents start). The longest
    documents are dealt out first, each to the shortest lane."""
    n = max(1, min(most, len(lengths)))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    heap = [(0, k) for k in range(n)]
    dealt: list[list[int]] = [[] for _ in range(n)]
    for d in np.argsort(-lengths, kind="stable").tolist():
        filled, k = heapq.heappop(heap)
        dealt[k].append(d)
        heapq.heappush(heap, (filled + int(lengths[d]), k))
    width = max(x for x, _ in heap)
    grid, first = np.full((n, width), -1, np.int32), np.zeros((n, width), bool)
    for k, docs in enumerate(dealt):
        at = 0
        for d in docs:
            grid[k, at : at + lengths[d]] = np.arange(offsets[d], offsets[d + 1], dtype=np.int32)
            first[k, at] = True
            at += int(lengths[d])
    order = np.argsort(-(grid >= 0).sum(axis=1), kind="stable")
    return grid[order], first[order]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Recurrent:
    """The model over one slice laid out in lanes. Arrays have their units first and the lanes last, so
    that numpy's loops run over lanes; the methods take and give views with the units last."""

    def __init__(self, p: Parameters):
        self.p = p

    def run(self, inputs: np.ndarray, first: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, list]:
        """States before each token (steps, lanes, HIDDEN) -- after reading ``inputs`` -- and what
        backpropagation needs."""
        p, H = self.p, HIDDEN
        states, kept = np.empty((H, inputs.shape[1], len(inputs)), np.float32), []
        given = np.take(np.ascontiguousarray(p["in"].T), inputs.T, axis=1)
        weights, h, starts = np.ascontiguousarray(p["state"].T), h.T, first.any(axis=0)
        for t in range(inputs.shape[1]):
            if starts[t]:
                h = np.where(first[:, t], np.float32(0), h)
            moved = weights @ h
            gates = _sigmoid(given[: 2 * H, t] + moved[: 2 * H])
            z, r = gates[:H], gates[H:]
            new = np.tanh(given[2 * H :, t] + r * moved[2 * H :])
            kept.append((h, z, r, new, moved[2 * H :]))
            h = new + z * (h - new)
            states[:, t] = h
        return states.transpose(1, 2, 0), kept

    def back(self, grad: np.ndarray, inputs: np.ndarray, first: np.ndarray, kept: list, out: Parameters) -> None:
        """Gradients of the recurrent part from those of the states."""
        p, H = self.p, HIDDEN
        steps, n = grad.shape[:2]
        grad = grad.transpose(2, 0, 1)
        flat = np.empty((steps, n, 3 * H), np.float32)
        carry, starts = np.zeros((H, n), np.float32), first.any(axis=0)
        part, weights = np.empty((3 * H, n), np.float32), np.zeros((H, 3 * H), np.float32)
        for t in range(steps - 1, -1, -1):
            h, z, r, new, moved = kept[t]
            d = grad[:, t] + carry
            stay = d * z
            d_new = np.multiply(d - stay, 1 - new * new, out=part[2 * H :])
            np.multiply((h - new) * stay, 1 - z, out=part[:H])
            np.multiply(d_new * moved, r * (1 - r), out=part[H : 2 * H])
            flat[t] = part.T
            d_new *= r
            weights += h @ part.T
            carry = stay + p["state"] @ part
            if starts[t]:
                carry = np.where(first[:, t], np.float32(0), carry)
        out["state"] += weights
        ids = inputs.T.ravel().astype(np.int16)  # sorted by radix
        order = np.argsort(ids, kind="stable")
        ordered = ids[order]
        at = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        out["in"][ordered[at]] += np.add.reduceat(flat.reshape(-1, 3 * H)[order], at, axis=0)

    def output(self, states: np.ndarray, classes: np.ndarray, numbers: np.ndarray, out: Parameters | None) -> tuple[np.ndarray, np.ndarray | None]:
        """(log-probability of class and word, gradient of the states if ``out`` is given)."""
        p, n = self.p, len(states)
        states, rows = states.T, np.arange(n)
        logits = p["class"].T @ states
        logits += p["class_bias"][:, None]
        logp, e = _softmax(logits, classes, rows, out is not None)
        grad = None
        if out is not None:
            out["class"] += states @ e.T
            out["class_bias"] += e.sum(axis=1)
            grad = p["class"] @ e
        order = np.argsort(classes.astype(np.int16), kind="stable")
        limits = np.searchsorted(classes[order], np.arange(len(p["word"]) + 1))
        order = order[: limits[-1]]
        if len(order):
            some, parts = np.take(states, order, axis=1), []
            logits = np.empty((CLASS, len(order)), states.dtype)
            for c in range(len(p["word"])):
                part = slice(int(limits[c]), int(limits[c + 1]))
                if part.start < part.stop:
                    parts.append((c, part))
                    np.add(p["word"][c].T @ some[:, part], p["word_bias"][c][:, None], out=logits[:, part], casting="same_kind")
            more, e = _softmax(logits, numbers[order], np.arange(len(order)), out is not None)
            logp[order] += more
            if out is not None:
                for c, part in parts:
                    out["word"][c] += some[:, part] @ e[:, part].T
                    out["word_bias"][c] += e[:, part].sum(axis=1)
                    some[:, part] = p["word"][c] @ e[:, part]
                grad[:, order] += some
        return logp, None if grad is None else grad.T


def _softmax(logits: np.ndarray, chosen: np.ndarray, rows: np.ndarray, gradient: bool) -> tuple[np.ndarray, np.ndarray]:
    """(log-probability of the chosen row of each column, gradient of the logits if wanted)."""
    logits -= logits.max(axis=0)
    logp = logits[chosen, rows]
    e = np.exp(logits, out=logits)
    total = e.sum(axis=0)
    if gradient:
        e /= total
        e[chosen, rows] -= 1
    return logp - np.log(total), e


def _laid_out(v: Vocabulary, place: np.ndarray, limits: np.ndarray) -> tuple:
    """Lanes of a slice: token numbers, inputs, first flags, classes and word numbers."""
    rare = v.word_classes + BINS
    known = place >= 0
    classes = np.where(known, v.classes[place] if len(v.keys) else rare, rare).astype(np.int32)
    numbers = np.where(known, v.numbers[place] if len(v.keys) else 0, 0).astype(np.int32)
    ids = np.where(classes < v.word_classes, classes * CLASS + numbers, v.word_classes * CLASS + classes - v.word_classes)
    grid, first = lanes(np.diff(limits), LANES)
    end_id = ids[limits[1] - 1]
    inputs = np.full(grid.shape, end_id, np.int32)
    inputs[:, 1:] = np.where(grid[:, :-1] >= 0, ids[grid[:, :-1]], end_id)
    return grid, inputs, first, classes, numbers


class Adam:
    def __init__(self, p: Parameters, rate: float):
        self.p, self.rate, self.n = p, rate, 0
        self.mean = {k: np.zeros_like(x) for k, x in p.items()}
        self.square = {k: np.zeros_like(x) for k, x in p.items()}

    def step(self, grad: Parameters) -> None:
        self.n += 1
        norm = float(np.sqrt(sum(float((g * g).sum()) for g in grad.values())))
        scale = np.float32(min(1.0, 1.0 / max(norm, 1e-9)))
        rate = self.rate * np.sqrt(1 - 0.999**self.n) / (1 - 0.9**self.n)
        for k, g in grad.items():
            g *= scale
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            self.p[k] -= np.float32(rate) * self.mean[k] / (np.sqrt(self.square[k]) + np.float32(1e-8))


def learn_slice(v: Vocabulary, p: Parameters, adam: Adam, hashes: np.ndarray, limits: np.ndarray) -> None:
    """One pass of truncated backpropagation over a slice."""
    grid, inputs, first, classes, numbers = _laid_out(v, look_up(v, hashes), limits)
    model, h = Recurrent(p), np.zeros((len(grid), HIDDEN), np.float32)
    for t in range(0, grid.shape[1], STEPS):
        live = int((grid[:, t] >= 0).sum())
        part = slice(t, t + STEPS)
        x, f, g = inputs[:live, part], first[:live, part], grid[:live, part].T
        states, kept = model.run(x, f, h[:live])
        h = states[-1]
        real = g >= 0
        grad = {k: np.zeros_like(a) for k, a in p.items()}
        tokens, whole = g[real], real.all()
        units = states.transpose(2, 0, 1)
        _, d = model.output((units.reshape(HIDDEN, -1) if whole else units[:, real]).T, classes[tokens], numbers[tokens], grad)
        n = np.float32(STEPS * len(grid))  # windows with few lanes left count for less
        full = d.T.reshape(units.shape) if whole else np.zeros(units.shape, np.float32)
        if not whole:
            full[:, real] = d.T
        model.back(full.transpose(1, 2, 0), x, f, kept, grad)
        for a in grad.values():
            a /= n
        adam.step(grad)


def score_slice(v: Vocabulary, p: Parameters, place: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Natural log-probability of each token, rare ones without their share in the class."""
    grid, inputs, first, classes, numbers = _laid_out(v, place, limits)
    model, h, out = Recurrent(p), np.zeros((len(grid), HIDDEN), np.float32), np.zeros(len(place))
    for t in range(0, grid.shape[1], STEPS):
        live = int((grid[:, t] >= 0).sum())
        part = slice(t, t + STEPS)
        states, _ = model.run(inputs[:live, part], first[:live, part], h[:live])
        h = states[-1]
        g = grid[:live, part].T
        real = g >= 0
        tokens = g[real]
        units = states.transpose(2, 0, 1)
        out[tokens] = model.output((units.reshape(HIDDEN, -1) if real.all() else units[:, real]).T, classes[tokens], numbers[tokens], None)[0]
    known = place >= 0
    out[known] += v.inside[place[known]]
    return out


def _flat(p: Parameters) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _shaped(flat: np.ndarray, like: Parameters) -> Parameters:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def train(rows: DataFrame, v: Vocabulary) -> Parameters:
    """Two rounds of local learning and averaging over all rows (text, place: 0 to 1)."""
    p = start_parameters(v)
    context = rows.sparkSession.sparkContext
    for low, high, rate in ((0.0, WARM, RATE), (WARM, 1.1, RATE / 2)):
        shared = context.broadcast((v, p))

        def run(batches, shared=shared, rate=rate):
            v, start = shared.value
            p = {k: x.copy() for k, x in start.items()}
            adam, tokens = Adam(p, rate), 0
            for batch in W.slices(batches, most=SLICE):
                hashes, limits = _tokens(batch)
                learn_slice(v, p, adam, hashes, limits)
                tokens += len(hashes)
            if tokens:
                flat = np.append(_flat(p) * float(tokens), float(tokens))
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int32()), pa.array(flat, pa.float64())], names=["i", "x"])

        part = rows.where((F.col("place") >= low) & (F.col("place") < high)).select("text")
        learners = context.defaultParallelism * 4
        sums = part.coalesce(learners).mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).toArrow()
        if sums.num_rows:
            flat = np.empty(sums.num_rows)
            flat[sums.column("i").to_numpy()] = sums.column("x").to_numpy()
            p = _shaped(flat[:-1] / flat[-1], p)
    return p


def score(documents: DataFrame, held_out, doc_id: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """``doc_id``, held_out, n_tokens, n_known, train_tokens, base_score and score of every row,
    learned from the rows where the condition ``held_out`` is false."""
    rows = documents.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    training = rows.where("NOT held_out")
    counted = count_tokens(training)
    v, least = vocabulary(counted, head)
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / float(1 << 30)
    p = train(training.select("text", place.alias("place")), v)
    shared = rows.sparkSession.sparkContext.broadcast((v, p))

    def run(batches):
        v, p = shared.value
        number = TaskContext.get().partitionId() << 40
        shares = np.log10((v.counts + 1) / v.base_total)
        for batch in W.slices(batches, most=SLICE):
            hashes, limits = _tokens(batch)
            n = batch.num_rows
            owner = np.repeat(np.arange(n), np.diff(limits))
            at = look_up(v, hashes)
            known = at >= 0
            logp = score_slice(v, p, at, limits) / np.log(10.0)
            total = lambda x, rows: np.bincount(rows, weights=x, minlength=n).astype(np.float64)
            rare_at = np.flatnonzero(~known)
            order = np.lexsort((hashes[rare_at], owner[rare_at]))
            h, o = hashes[rare_at][order], owner[rare_at][order]
            new = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])])) if len(h) else np.zeros(0, np.int64)
            offsets = pa.array(np.searchsorted(o[new], np.arange(n + 1)), pa.int32())
            hs, ns = pa.ListArray.from_arrays(offsets, pa.array(h[new], pa.int64())), pa.ListArray.from_arrays(offsets, pa.array(np.diff(np.append(new, len(h))), pa.int32()))
            columns = [pa.array(number + np.arange(n)), batch.column("id"), batch.column("held_out"), pa.array(np.diff(limits)), pa.array(np.bincount(owner[known], minlength=n)), pa.array(total(shares[at[known]], owner[known])), pa.array(total(logp, owner)), hs, ns]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "id", "held_out", "n_tokens", "n_known", "base_score", "score", "rare", "rare_n"])
            number += n

    kind = rows.schema["id"].dataType.simpleString()
    scored = written(rows.mapInArrow(run, f"row long, id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rare array<long>, rare_n array<int>"), "lm-scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("t")).select("row", F.col("t.rare").alias("h"), F.col("t.rare_n").alias("n"))
    rare = rare.join(counted.where(F.col("c") < least), "h", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).cast("long").alias("more_known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(v.base_total)))).alias("more_base"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(float(v.rare)))).alias("more_score"),
    )
    out = scored.drop("rare", "rare_n").join(more, "row", "left")
    add = lambda a, b: (F.col(a) + F.coalesce(b, F.lit(0))).alias(a)
    return out.select(F.col("id").alias(doc_id), "held_out", "n_tokens", add("n_known", "more_known"), F.lit(v.total).cast("long").alias("train_tokens"), add("base_score", "more_base"), add("score", "more_score"))
