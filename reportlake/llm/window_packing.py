"""Packing into fixed windows by dynamic programming, order of the documents preserved.

Documents are tokenised, ended by an end token and laid side by side in stored order. A window may
be cut at a document's end (free), after a sentence (``sentence_cut``) or, where a sentence leaves
no cut near, inside it (``token_cut``); a padded token costs 1. The cuts of a block of documents
minimise the total: with p(i) the place and c(i) the price of cut i,

    cost(i) = c(i) + window - p(i) + min over j, p(i) - p(j) <= window, of cost(j) + p(j),

and the minimum over the sliding range comes from a monotone queue, so a block takes linear time.
What is left at the end of a block is either one padded window or, if that is cheaper, cut by
``token_cut`` into sequences whose lengths are powers of two, which take no padding.

A block is a slice of a partition (about 4 MB of text), so nothing is shuffled and memory is
bounded. Sequence numbers start from the partition's number, shifted, and are stable under retries.

Defined cases: a null or empty text is the end token alone; a long text spans as many windows as it
needs; repeated rows are packed one by one; an empty table gives no pieces. Columns other than the
id and the text are not read.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm import tokens
from reportlake.llm import words as W

WINDOW = 4096
END_ID = 2
SENTENCE_CUT = 2
TOKEN_CUT = 8
#: A sentence longer than this many tokens gets possible cuts inside, this far apart.
GRID = 16


def candidates(limits: np.ndarray, sentences: np.ndarray, sentence_cut: int, token_cut: int, grid: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of possible cuts (0 and the end among them) and the price of each."""
    ends = np.unique(limits)
    soft = np.setdiff1d(sentences, ends)
    places = np.union1d(ends, soft)
    wide = np.flatnonzero(np.diff(places) > grid)
    inner = [np.arange(places[k] + grid, places[k + 1], grid) for k in wide]
    hard = np.concatenate(inner) if inner else np.zeros(0, np.int64)
    places, price = np.concatenate([ends, soft, hard]), np.concatenate([np.zeros(len(ends)), np.full(len(soft), sentence_cut), np.full(len(hard), token_cut)])
    order = np.argsort(places, kind="stable")
    return places[order], price[order].astype(np.int64)


def _powers(n: int) -> list[int]:
    return [1 << k for k in range(n.bit_length() - 1, -1, -1) if n >> k & 1]


def best_cuts(places: np.ndarray, price: np.ndarray, window: int, token_cut: int) -> list[int]:
    """Cut places (0 and the end among them) of least total cost."""
    p, c, n = places.tolist(), price.tolist(), len(places)
    if n < 2:
        return p
    cost, back = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(p[0], 0)])  # (cost + place, number), rising
    for i in range(1, n):
        here = p[i]
        while here - p[queue[0][1]] > window:
            queue.popleft()
        least, j = queue[0]
        cost[i], back[i] = c[i] + window - here + least, j
        if i == n - 1:
            break
        value = cost[i] + here
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, i))
    end, last = p[-1], n - 1
    j = last - 1
    tail: list[int] = []
    while j >= 0 and end - p[j] <= window:
        parts = _powers(end - p[j])
        if (total := cost[j] + (len(parts) - 1) * token_cut) < cost[last]:
            cost[last], back[last], tail = total, j, parts
        j -= 1
    cuts, i = [end], back[last]
    if len(tail) > 1:
        cuts = [p[i] + x for x in np.cumsum(tail).tolist()][::-1]
    while i:
        cuts.append(p[i])
        i = back[i]
    return [0, *cuts[::-1]]


def padded_length(length: int, window: int = WINDOW) -> int:
    """Tokens a sequence takes with its padding: none at a power of two."""
    return length if length & (length - 1) == 0 else window


def pack(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, end_id: int = END_ID, sentence_cut: int = SENTENCE_CUT, token_cut: int = TOKEN_CUT, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: its place in the document and in its sequence, the
    CRC-32 of its ids and, ``with_ids``, the ids as little-endian 32-bit values."""

    def run(batches):
        coder, sequence = tokens.encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in W.slices(batches):
            ids, limits, sentences = tokens.encode_column(batch.column("text"), coder, end_id)
            cuts = np.array(best_cuts(*candidates(limits, sentences, sentence_cut, token_cut, min(GRID, window)), window, token_cut))
            starts = np.union1d(cuts, limits)[:-1]
            stops = np.union1d(cuts, limits)[1:]
            row = np.searchsorted(limits, starts, side="right") - 1
            number = np.searchsorted(cuts, starts, side="right") - 1
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist())]
            columns = [batch.column("id").take(pa.array(row)), pa.array(starts - limits[row]), pa.array(stops - starts), pa.array(crc, pa.int64()), pa.array((limits[1:] - limits[:-1])[row]), pa.array(sequence + number), pa.array(starts - cuts[number])]
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns.append(pa.array([bytes(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), stops.tolist())], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)
            sequence += len(cuts) - 1

    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("id", doc_id)
