"""Token ids as packed matrices: best-fit-decreasing packing with a segment tree of capacities.

Documents are tokenised, ended by an end token and, where longer than a row, split without loss.
The pieces of a block (about 4 MB of text) are placed longest first into the open row with the
least room that still fits. A segment tree over room sizes finds that row in logarithmic time.
Each row of the result is one row of the id matrix, padded with ``pad_id``, with its cumulative
segment lengths (``cu_seqlens``), the offsets where positions restart (``position_resets``) and,
for each segment, its document and its place there, so every document can be put together again.

Blocks are slices of a partition: nothing is shuffled and memory is bounded.

Defined cases: a null or empty text is the end token alone; a long text takes several rows;
repeated rows and documents that share an id are packed one by one; equal lengths keep stored order;
an empty table gives no rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm import tokens
from reportlake.llm import words as W

ROW_TOKENS = 4096
END_ID = 2
PAD_ID = 0


class Capacities:
    """Open rows by room left; a segment tree tells the least room of at least a given size."""

    def __init__(self, most: int):
        self.base = 1 << most.bit_length()
        self.count = [0] * (2 * self.base)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, by: int) -> None:
        node = self.base + room
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, room: int) -> int:
        self._add(room, -1)
        return self.rows[room].pop()

    def least(self, size: int) -> int | None:
        """The smallest room of at least ``size`` that some row has left."""
        node = self.base + size
        if self.count[node]:
            return size
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.base:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.base
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], most: int) -> list[list[int]]:
    """Piece numbers of each row; no row holds more than ``most`` tokens."""
    open_rows, rows = Capacities(most), []
    for piece in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        room = open_rows.least(lengths[piece])
        if room is None:
            row, room = len(rows), most
            rows.append([])
        else:
            row = open_rows.take(room)
        rows[row].append(piece)
        if room > lengths[piece]:
            open_rows.put(room - lengths[piece], row)
    return rows


def pack(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", row_tokens: int = ROW_TOKENS, end_id: int = END_ID, pad_id: int = PAD_ID, id_bytes: int = 2) -> DataFrame:
    """One row for each matrix row: ``ids`` (``row_tokens`` little-endian ids of ``id_bytes`` bytes),
    n_tokens, cu_seqlens, position_resets, doc_ids and starts of its segments."""
    width = np.dtype(f"<u{id_bytes}")

    def run(batches):
        coder, sequence = tokens.encoder(tokenizer), TaskContext.get().partitionId() << 32
        for batch in W.slices(batches):
            ids, limits, _ = tokens.encode_column(batch.column("text"), coder, end_id)
            if int(ids.max()) > np.iinfo(width).max:
                raise ValueError(f"an id doesn't fit in {id_bytes} bytes")
            pieces = [(row, at) for row, (a, b) in enumerate(zip(limits[:-1].tolist(), limits[1:].tolist())) for at in range(a, b, row_tokens)]
            ends = limits.tolist()
            lengths = [min(row_tokens, ends[row + 1] - at) for row, at in pieces]
            rows = best_fit_decreasing(lengths, row_tokens)
            matrix = np.full((len(rows), row_tokens), pad_id, width)
            cumulative, owners, starts = [], [], []
            for k, row in enumerate(rows):
                limits_here = [0, *np.cumsum([lengths[piece] for piece in row]).tolist()]
                for piece, a in zip(row, limits_here):
                    at = pieces[piece][1]
                    matrix[k, a : a + lengths[piece]] = ids[at : at + lengths[piece]]
                cumulative.append(limits_here)
                owners.append([pieces[piece][0] for piece in row])
                starts.append([pieces[piece][1] - ends[pieces[piece][0]] for piece in row])
            flat = batch.column("id").take(pa.array([x for row in owners for x in row], pa.int64()))
            offsets = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in owners])]), pa.int32())
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(sequence + np.arange(len(rows))), pa.array([x[-1] for x in cumulative], pa.int32()), pa.array(cumulative, ints), pa.array([x[:-1] for x in cumulative], ints), pa.ListArray.from_arrays(offsets, flat), pa.array(starts, pa.list_(pa.int64())), pa.array([r.tobytes() for r in matrix], pa.binary())],
                names=["sequence_id", "n_tokens", "cu_seqlens", "position_resets", "doc_ids", "starts", "ids"],
            )
            sequence += len(rows)

    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"sequence_id long, n_tokens int, cu_seqlens array<int>, position_resets array<int>, doc_ids array<{kind}>, starts array<long>, ids binary")
