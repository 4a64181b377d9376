"""Best-fit packing of whole documents into few sequences: bin completion by branch and bound.

Documents are tokenised and ended by an end token; only those longer than a sequence are cut, into
full sequences and a rest. How the pieces go together depends on their lengths alone, and lengths
are whole numbers up to ``row_tokens``. So the corpus is tokenised once, in tasks, and written as one
row a piece; Spark counts the pieces of each length; and the search runs over that histogram, which
has at most ``row_tokens`` rows whatever the input. Its answer is a list of fillings, each with the
number of sequences that take it. Each piece then finds its own sequence and place from its rank
among the pieces of its length, without meeting the other pieces.

The search takes the longest piece left and enumerates the undominated fillings of the room beside it
(a filling is dominated if some pieces of it could be exchanged for one unused piece that takes at
least their room and still fits). It follows each, for as many sequences as the counts allow and then
for fewer; it turns back where the bound on waste shows that no fewer sequences can come of it; and
it completes states by best fit, whose result becomes the incumbent if it needs fewer sequences.
It ends when the incumbent meets the bound, when all is enumerated, or after ``max_nodes`` states (at
``max_fillings`` fillings each): a limit on effort only, as every piece is packed by any incumbent.

A rank is the piece's number among those of its length in its input partition plus the count in the
partitions before, so a length that a third of all documents share is ranked in parts.

Defined cases: a null or empty text is the end token alone; a long text takes several sequences;
repeated rows and documents that share an id (or have none) are packed one by one; pieces of equal
length go in stored order; an empty table gives no rows. Columns other than the id and the text are
not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm import tokens
from reportlake.llm import words as W
from reportlake.llm.shared import written

ROW_TOKENS = 2048
END_ID = 0
MAX_NODES = 1500
MAX_FILLINGS = 256
#: States of more than this many lengths are completed by best fit only every so many states.
FEW_LENGTHS, BEST_FIT_EVERY = 64, 16

Filling = tuple[tuple[int, int], ...]  # (length, copies), lengths falling


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Fillings of best-fit-decreasing with the number of sequences of each; equal pieces and equal
    sequences are handled at once, so the work depends on the distinct lengths."""
    open_rows: dict[int, list[tuple[Filling, int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(filling: Filling, room: int, times: int) -> None:
        if not open_rows[room]:
            insort(rooms, room)
        open_rows[room].append((filling, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                filling, times = open_rows[room].pop()
                if not open_rows[room]:
                    rooms.pop(at)
            else:
                room, filling, times = capacity, (), left
            copies = min(room // length, left)
            taken = min(times, left // copies)
            if taken < times and filling:
                put(filling, room, times - taken)
            left -= taken * copies
            put((*filling, (length, copies)), room - copies * length, taken)
    return [row for rows in open_rows.values() for row in rows]


def needed(counts: dict[int, int], capacity: int) -> int:
    """A number of sequences that no packing can go below: for each k, pieces over half a sequence take
    one each, and what their rooms can't hold of the pieces from k to a half takes more."""
    if not counts:
        return 0
    number = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        number[length] = count
    size = number * np.arange(capacity + 1)
    above, total = np.cumsum(number[::-1])[::-1], np.cumsum(size[::-1])[::-1]
    half = capacity // 2
    k = np.arange(half + 1)
    alone = above[half + 1] if half < capacity else 0
    large = np.where(k > 0, above[np.minimum(capacity - k + 1, capacity)], 0)
    paired, paired_size = alone - large, total[half + 1] - np.where(k > 0, total[np.minimum(capacity - k + 1, capacity)], 0)
    small = total[k] - total[half + 1]
    more = np.maximum(0, -((paired * capacity - paired_size - small) // capacity))
    return int((alone + more).max())


def _spread(bits: int, by: int) -> int:
    """Every set bit and the ``by`` bits above it."""
    done = 1
    while done <= by:
        step = min(done, by + 1 - done)
        bits |= bits << step
        done += step
    return bits


def dominated(filling: list[tuple[int, int]], slack: int, free: int) -> bool:
    """Whether some pieces of the filling could give way to one unused piece (``free``: a bit for each
    length that is left) of at least their length within the slack."""
    single = several = 0
    for length, copies in filling:
        for _ in range(copies):
            several |= (single | several) << length
            single |= 1 << length
    return bool(free & _spread(several, slack) or slack and free & _spread(single << 1, slack - 1))


def fillings(counts: dict[int, int], room: int, most: int) -> list[list[tuple[int, int]]]:
    """Undominated sets of pieces for a room, least waste first; at most ``most`` of them are looked at."""
    lengths = sorted((x for x in counts if x <= room), reverse=True)
    found: list[tuple[int, list[tuple[int, int]]]] = []
    looked = 0
    least, all_free = lengths[-1] if lengths else 0, 0
    for length in lengths:
        all_free |= 1 << length
    stack: list[tuple[int, int, list[tuple[int, int]]]] = [(0, room, [])]
    while stack and looked < most:
        at, left, chosen = stack.pop()
        while at < len(lengths) and lengths[at] > left:
            at += 1
        if at == len(lengths) or left < least:
            looked += 1
            free = all_free
            for length, copies in chosen:
                free &= ~(int(counts[length] == copies) << length)
            if not free & ((2 << left) - 1) and not dominated(chosen, left, free):
                found.append((left, chosen))
            continue
        length = lengths[at]
        for copies in range(0, min(counts[length], left // length) + 1):  # the most is followed first
            stack.append((at + 1, left - copies * length, chosen + [(length, copies)] if copies else chosen))
    found.sort(key=lambda x: x[0])
    return [chosen for _, chosen in found]


def _less(counts: dict[int, int], filling: Filling, times: int) -> dict[int, int]:
    left = dict(counts)
    for length, copies in filling:
        left[length] -= copies * times
        if not left[length]:
            del left[length]
    return left


def bin_completion(counts: dict[int, int], capacity: int, max_nodes: int = MAX_NODES, max_fillings: int = MAX_FILLINGS) -> list[tuple[Filling, int]]:
    """(filling, number of sequences) that pack all pieces into as few sequences as were found."""
    best = best_fit(counts, capacity)
    fewest, bound = sum(n for _, n in best), needed(counts, capacity)
    seen: dict[tuple, int] = {}

    def branches(left: dict[int, int]):
        top = max(left)
        beside = _less(left, ((top, 1),), 1)
        for chosen in fillings(beside, capacity - top, max_fillings):
            merged: dict[int, int] = defaultdict(int, {top: 1})
            for length, copies in chosen:
                merged[length] += copies
            filling = tuple(sorted(merged.items(), reverse=True))
            for times in range(min(left[length] // copies for length, copies in filling), 0, -1):
                yield filling, times

    path: list[tuple[Filling, int]] = []
    states = [(counts, 0, branches(counts))] if fewest > bound else []
    nodes = 0
    while states and nodes < max_nodes and fewest > bound:
        left, used, rest = states[-1]
        step = next(rest, None)
        if step is None:
            states.pop()
            if path:
                path.pop()
            continue
        nodes += 1
        after, now = _less(left, *step), used + step[1]
        key = tuple(sorted(after.items()))
        if seen.get(key, now + 1) <= now or now + needed(after, capacity) >= fewest:
            continue
        seen[key] = now
        path.append(step)
        if len(after) <= FEW_LENGTHS or nodes % BEST_FIT_EVERY == 1:
            rest_fit = best_fit(after, capacity)
            if (total := now + sum(n for _, n in rest_fit)) < fewest:
                fewest, best = total, [*path, *rest_fit]
        if after and now + needed(after, capacity) < fewest:
            states.append((after, now, branches(after)))
        else:
            path.pop()
    return best


def _places(found: list[tuple[Filling, int]]) -> np.ndarray:
    """One row for each (filling, length): length, first rank, sequences, first sequence, first offset;
    by length and rank. A filling has fewer than sqrt(2 x row_tokens) distinct lengths."""
    rows, ranked, sequence = [], defaultdict(int), 0
    for filling, times in found:
        offset = 0
        for length, copies in filling:
            rows.append((length, ranked[length], times, sequence, offset))
            ranked[length] += copies * times
            offset += copies * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


_RANKS = np.int64(1 << 42)  # ranks below it share a number with their length


def pieces(documents: DataFrame, tokenizer: str, doc_id: str, text: str, row_tokens: int, end_id: int, with_ids: bool) -> DataFrame:
    """One row a piece, with its input partition and its number among that partition's pieces of its
    length; as a written table, so later steps see the same numbers."""

    def run(batches):
        coder, part = tokens.encoder(tokenizer), TaskContext.get().partitionId()
        seen = np.zeros(row_tokens + 1, np.int64)
        for batch in W.slices(batches):
            ids, limits, _ = tokens.encode_column(batch.column("text"), coder, end_id)
            size = np.diff(limits)
            parts = -(-size // row_tokens)
            row = np.repeat(np.arange(len(size)), parts)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
            start = piece * row_tokens
            length = np.minimum(row_tokens, size[row] - start)
            order = np.argsort(length, kind="stable")
            first = np.searchsorted(length[order], length[order])
            number = np.empty(len(row), np.int64)
            number[order] = np.arange(len(row)) - first
            number += seen[length]
            seen += np.bincount(length, minlength=row_tokens + 1)
            raw = memoryview(ids.astype("<u4").tobytes())
            spans = [raw[4 * a : 4 * b] for a, b in zip((limits[row] + start).tolist(), (limits[row] + start + length).tolist())]
            columns = [batch.column("id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in spans], pa.int64()), pa.array(np.full(len(row), part)), pa.array(number)]
            names = ["id", "piece", "start", "length", "ids_crc32", "part", "number"]
            if with_ids:
                columns.append(pa.array([bytes(x) for x in spans], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, part long, number long" + ", ids binary" * with_ids
    return written(rows.mapInArrow(run, schema), "bin-completion-pieces")


def pack(documents: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", row_tokens: int = ROW_TOKENS, end_id: int = END_ID, max_nodes: int = MAX_NODES, max_fillings: int = MAX_FILLINGS, with_ids: bool = False) -> DataFrame:
    """One row for each piece of a document: its place in the document and in its sequence, the CRC-32
    of its ids and, ``with_ids``, the ids as little-endian 32-bit values."""
    table = pieces(documents, tokenizer, doc_id, text, row_tokens, end_id, with_ids)
    counted = written(table.groupBy("part", "length").agg(F.count("*").alias("n")), "bin-completion-counts")
    histogram = counted.groupBy("length").agg(F.sum("n").alias("n"))  # at most row_tokens rows
    places = _places(bin_completion({r["length"]: r["n"] for r in histogram.collect()}, row_tokens, max_nodes, max_fillings))
    keys = places[:, 0] * _RANKS + places[:, 1]

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            _, first, times, sequence, offset = places[np.searchsorted(keys, length * _RANKS + rank, side="right") - 1].T
            columns = [pa.array(sequence + (rank - first) % times), pa.array(offset + (rank - first) // times * length)]
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], names=[*kept.schema.names, "sequence_id", "offset"])

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counted.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = table.join(before, ["part", "length"]).withColumn("rank", F.col("number") + F.col("before"))
    kept = ["id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]
    ranked = ranked.select(*kept, "rank")
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.drop("rank").schema) + ", sequence_id long, offset long"
    return ranked.mapInArrow(place, schema).withColumnRenamed("id", doc_id)
