"""Secret scans: fixed formats plus two character Markov models compared by log-likelihood ratio.

Three fixed kinds come first: ``assign`` (a key name, ``=`` or ``:``, a value of 12 or more
characters), ``access`` (``AKIA`` keys of 18 or more characters) and ``hex`` (16 or more lower-case
hex digits). Their matches are never dropped. Kind ``random`` is added by the method: a run of 16 or
more characters of ``[A-Za-z0-9+/_=-]`` that touches no fixed match and whose transitions are
likelier under the model of random strings than under the model of ordinary identifiers, by
``threshold`` nats a transition on average.

Both models hold first-order transition counts. Counts add up over partitions, so all labelled
samples of all rows are used and the driver gets one small matrix a label.

Defined cases: a null or empty text has no spans; repeated rows are scanned one by one; spans that
start together are ordered by kind (assign, access, hex, random); an empty table gives an empty
result and a model of uniform transitions, whose ratio is below any positive threshold. Columns
other than the id and the text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reportlake.llm import words as W

KINDS = ("assign", "access", "hex", "random")
#: Fixed formats of the scan.
KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ASSIGN = re.compile(rb"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST, RANDOM_LEAST = 12, 18, 16, 16

ALPHABET = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
SIZE = len(ALPHABET)
IDENTIFIER_LEAST = 6
#: Share of a uniform transition mixed into each model: random strings may use any alphabet.
UNIFORM = (0.02, 0.3)
THRESHOLD = 1.0

_HEX = W.byte_table(lambda b: b in b"0123456789abcdef")
_RUN = W.byte_table(lambda b: b in ALPHABET)
_CODE = np.full(256, -1, np.int64)
_CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(SIZE)


def _joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a line feed after each, so that no run or match crosses texts."""
    data, offsets = W.text_buffers(column)
    return np.insert(data, offsets[1:], 10), offsets + np.arange(len(offsets))


def _runs(data: np.ndarray, keep: np.ndarray, least: int) -> np.ndarray:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = keep[data]
    step = np.diff(inside)
    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = ends - starts >= least
    return np.stack([starts[long], ends[long]], axis=1)


def _anchored(raw: bytes, found: bytes, keys: tuple[bytes, ...], pattern: re.Pattern) -> Iterator[re.Match]:
    """Leftmost non-overlapping matches of a pattern that begins with one of ``keys``."""
    places = []
    for key in keys:
        at = found.find(key)
        while at >= 0:
            places.append(at)
            at = found.find(key, at + 1)
    over = 0
    for at in sorted(places):
        if at >= over and (m := pattern.match(raw, at)):
            over = m.end()
            yield m


def fixed_matches(data: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind, end) of each fixed match, (start, end) of its secret value), in bytes."""
    raw = data.tobytes()
    spans, values = [], []
    for m in _anchored(raw, raw.lower(), KEYS, ASSIGN):
        if m.end(1) - m.start(1) >= ASSIGN_LEAST:
            spans.append((m.start(), 0, m.end()))
            values.append(m.span(1))
    for m in _anchored(raw, raw, (b"AKIA",), ACCESS):
        if m.end() - m.start() >= ACCESS_LEAST:
            spans.append((m.start(), 1, m.end()))
            values.append(m.span())
    for s, e in _runs(data, _HEX, HEX_LEAST).tolist():
        spans.append((s, 2, e))
        values.append((s, e))
    return spans, values


def _apart(runs: np.ndarray, taken: list[tuple[int, int]]) -> np.ndarray:
    """The runs that overlap none of the taken intervals."""
    if not taken or not len(runs):
        return runs
    order = np.array(sorted(taken))
    highest = np.maximum.accumulate(order[:, 1])
    before = np.searchsorted(order[:, 0], runs[:, 1], side="left")
    return runs[(before == 0) | (highest[np.maximum(before - 1, 0)] <= runs[:, 0])]


def _transitions(data: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Counts of (code, next code) within the runs; other bytes of a run are skipped."""
    if not len(runs):
        return np.zeros(SIZE * SIZE, np.int64)
    lengths = runs[:, 1] - runs[:, 0]
    at = np.repeat(runs[:, 0] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    run = np.repeat(np.arange(len(runs)), lengths)
    code = _CODE[data[at]]
    ok = (code[:-1] >= 0) & (code[1:] >= 0) & (run[:-1] == run[1:])
    return np.bincount(code[:-1][ok] * SIZE + code[1:][ok], minlength=SIZE * SIZE)


def _count_rows(totals: np.ndarray) -> pa.RecordBatch:
    label, pair = np.nonzero(totals)
    return pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(pair, pa.int32()), pa.array(totals[label, pair], pa.int64())], names=["label", "pair", "n"])


def _model(counts: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each transition; ``counts``: (label, pair, n), SIZE ** 2 pairs a label at most."""
    rows = counts.groupBy("label", "pair").agg(F.sum("n").alias("n")).collect()
    table = np.zeros((2, SIZE * SIZE))
    for label, pair, n in rows:
        table[label, pair] = n
    table = table.reshape(2, SIZE, SIZE) + 0.01
    share = table / table.sum(axis=2, keepdims=True)
    mixed = [(1 - u) * share[k] + u / SIZE for k, u in enumerate(UNIFORM)]
    return np.log(mixed[1]) - np.log(mixed[0])


def train(samples: DataFrame, text: str = "text", secret: str = "secret") -> np.ndarray:
    """Fit both models on labelled strings (``secret``: boolean; null labels and texts are left out)."""

    def count(batches):
        totals = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in W.slices(batches):
            labels = batch.column("secret").to_numpy(zero_copy_only=False).astype(bool)
            for label in (0, 1):
                data, _ = _joined(batch.column("text").filter(pa.array(labels == bool(label))))
                totals[label] += _transitions(data, _runs(data, _RUN, 2))
        yield _count_rows(totals)

    rows = samples.select(F.col(text).cast("string").alias("text"), F.col(secret).cast("boolean").alias("secret")).dropna()
    return _model(rows.mapInArrow(count, "label int, pair int, n long"))


def train_from_documents(documents: DataFrame, text: str = "text") -> np.ndarray:
    """Fit both models on the corpus: the values of fixed matches are random strings, every other
    run of IDENTIFIER_LEAST or more characters is an ordinary identifier."""

    def count(batches):
        totals = np.zeros((2, SIZE * SIZE), np.int64)
        for batch in W.slices(batches):
            data, _ = _joined(batch.column("text"))
            spans, values = fixed_matches(data)
            totals[1] += _transitions(data, np.array(values).reshape(-1, 2))
            totals[0] += _transitions(data, _apart(_runs(data, _RUN, IDENTIFIER_LEAST), [(s, e) for s, _, e in spans]))
        yield _count_rows(totals)

    return _model(documents.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "label int, pair int, n long"))


def scan_buffer(data: np.ndarray, ratio: np.ndarray, threshold: float) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes of all spans of texts ended by line feeds, in order."""
    spans, _ = fixed_matches(data)
    runs = _apart(_runs(data, _RUN, RANDOM_LEAST), [(s, e) for s, _, e in spans])
    if len(runs):
        lengths = runs[:, 1] - runs[:, 0] - 1
        at = np.repeat(runs[:, 0] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        each = ratio[_CODE[data[at]], _CODE[data[at + 1]]]
        mean = np.add.reduceat(each, np.concatenate([[0], np.cumsum(lengths)[:-1]])) / lengths
        spans += [(s, 3, e) for s, e in runs[mean >= threshold].tolist()]
    return sorted(spans)


SPANS = "array<struct<kind:string,start:long,end:long>>"


def find_secrets(documents: DataFrame, ratio: np.ndarray, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``spans`` (kind, start, end in code points, end exclusive) of every row."""

    def scan(batches):
        for batch in W.slices(batches):
            data, offsets = _joined(batch.column("text"))
            points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            rows: list[list] = [[] for _ in range(batch.num_rows)]
            for s, kind, e in scan_buffer(data, ratio, threshold):
                row = int(np.searchsorted(offsets, s, side="right")) - 1
                first = points[offsets[row]]
                rows[row].append({"kind": KINDS[kind], "start": int(points[s] - first), "end": int(points[e] - first)})
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, kind)], names=["id", "spans"])

    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(scan, f"id {rows.schema['id'].dataType.simpleString()}, spans {SPANS}")
    return out.withColumnRenamed("id", doc_id)


def redact(documents: DataFrame, ratio: np.ndarray, text: str = "text", mark: str = "[SECRET]", threshold: float = THRESHOLD) -> DataFrame:
    """The same rows and columns, each span of ``text`` replaced by ``mark``; null stays null."""
    at = documents.columns.index(text)
    schema = documents.schema

    def scan(batches):
        for batch in W.slices(batches, text):
            data, offsets = _joined(batch.column(at))
            raw, new = data.tobytes(), {}
            for s, _, e in scan_buffer(data, ratio, threshold):
                row = int(np.searchsorted(offsets, s, side="right")) - 1
                new.setdefault(row, []).append((s, e))
            texts = batch.column(at).to_pylist()
            for row, spans in new.items():
                parts, over = [], int(offsets[row])
                for s, e in spans:
                    if s >= over:
                        parts += [raw[over:s], mark.encode()]
                    over = max(over, e)
                texts[row] = b"".join([*parts, raw[over : offsets[row + 1] - 1]]).decode()
            columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays(columns, names=list(batch.schema.names))

    return documents.mapInArrow(scan, schema)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Counts of each fixed kind, their SHA-256 and the list of all spans."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select(doc_id, count("assign"), count("access"), count("hex"), F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
