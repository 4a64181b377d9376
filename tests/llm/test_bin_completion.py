"""Bin completion: least numbers of sequences against exhaustive search, exact round trips, held bounds."""

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from reportlake.llm import bin_completion as B
from reportlake.llm import tokens as K


def optimum(lengths, capacity):
    """Fewest sequences by search over all assignments of falling lengths."""
    best = len(lengths)
    lengths = sorted(lengths, reverse=True)

    @lru_cache(None)
    def search(at, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if at == len(lengths):
            best = len(rooms)
            return
        for room in sorted({r for r in rooms if r >= lengths[at]}):
            rest = list(rooms)
            rest.remove(room)
            search(at + 1, tuple(sorted([*rest, room - lengths[at]])))
        search(at + 1, tuple(sorted([*rooms, capacity - lengths[at]])))

    search(0, ())
    return best


def check_plan(found, counts, capacity):
    got = Counter()
    for filling, times in found:
        assert sum(length * copies for length, copies in filling) <= capacity and times > 0
        for length, copies in filling:
            got[length] += copies * times
    assert got == Counter(counts)


@pytest.mark.parametrize("seed", range(6))
def test_fewest_sequences(seed):
    rng = random.Random(seed)
    for _ in range(25):
        capacity = rng.choice([10, 17, 30, 100])
        low = rng.choice([1, capacity // 5 + 1, capacity // 4 + 1])
        lengths = [rng.randint(low, capacity * rng.choice([1, 2]) // 2) for _ in range(rng.randint(1, 10))]
        found = B.bin_completion(Counter(lengths), capacity, max_nodes=100_000, max_fillings=100_000)
        check_plan(found, Counter(lengths), capacity)
        assert sum(n for _, n in found) == optimum(lengths, capacity), (capacity, sorted(lengths))
        assert B.needed(Counter(lengths), capacity) <= optimum(lengths, capacity)


def test_search_beats_best_fit():
    """A case where best fit needs a sequence more than there have to be, also many times over."""
    counts = {44: 2, 24: 2, 22: 2, 21: 2, 17: 2, 8: 2, 6: 4}
    better = 0
    rng = random.Random(11)
    for _ in range(300):
        lengths = Counter(rng.randint(21, 62) for _ in range(12))
        plain, found = B.best_fit(lengths, 100), B.bin_completion(lengths, 100, 5000, 5000)
        check_plan(found, lengths, 100)
        assert sum(n for _, n in found) <= sum(n for _, n in plain)
        better += sum(n for _, n in found) < sum(n for _, n in plain)
    assert better > 0
    many = {length: count * 1000 for length, count in counts.items()}
    check_plan(B.bin_completion(many, 100), many, 100)


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(3)
    for _ in range(60):
        lengths = [rng.randint(1, 60) for _ in range(rng.randint(1, 120))]
        rooms: list[int] = []
        for length in sorted(lengths, reverse=True):
            fit = [r for r in rooms if r >= length]
            if fit:
                rooms.remove(min(fit))
            rooms.append((min(fit) if fit else 60) - length)
        plan = B.best_fit(Counter(lengths), 60)
        check_plan(plan, Counter(lengths), 60)
        assert sorted(60 - sum(a * b for a, b in filling) for filling, n in plan for _ in range(n)) == sorted(rooms)


def test_dominance_is_by_one_unused_piece():
    assert B.dominated([(5, 1)], 2, 1 << 6) and B.dominated([(5, 1)], 2, 1 << 7)
    assert not B.dominated([(5, 1)], 2, 1 << 8) and not B.dominated([(5, 1)], 2, 1 << 5)
    assert B.dominated([(4, 1), (3, 1)], 0, 1 << 7) and not B.dominated([(4, 1), (3, 1)], 0, 1 << 8)
    assert B.dominated([(3, 3)], 0, 1 << 6)


@pytest.mark.parametrize("row_tokens", [2048, 32])
def test_round_trip(documents, row_tokens):
    coder = K.encoder(K.public_file())
    want = defaultdict(list)
    for r in documents.collect():
        want[r["doc_id"]].append(coder.tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [B.END_ID])
    rows = B.pack(documents, K.public_file(), row_tokens=row_tokens, with_ids=True).collect()
    by_sequence, by_doc = defaultdict(list), defaultdict(Counter)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert ids == want[r["doc_id"]][0][r["start"] : r["start"] + r["length"]]
        assert r["start"] == r["piece"] * row_tokens and zlib.crc32(bytes(r["ids"])) == r["ids_crc32"]
        by_doc[r["doc_id"]][r["piece"]] += 1
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, copies in want.items():
        pieces = -(-len(copies[0]) // row_tokens)
        assert by_doc[i] == {k: len(copies) for k in range(pieces)}
    for parts in by_sequence.values():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert 0 < at <= row_tokens
    total = sum(r["length"] for r in rows)
    assert len(by_sequence) <= sum(n for _, n in B.best_fit(Counter(r["length"] for r in rows), row_tokens))
    assert len(by_sequence) >= -(-total // row_tokens)


def test_empty_clashing_and_one_length(spark, empty, widened):
    assert B.pack(empty, K.public_file()).count() == 0
    got = B.pack(widened, K.public_file())
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() >= widened.count()
    same = spark.range(0, 5000, numPartitions=7).select(F.col("id").alias("doc_id"), F.lit("same text of a third of all rows").alias("text"))
    rows = B.pack(same, K.public_file(), row_tokens=64).collect()
    per = 64 // rows[0]["length"]
    sizes = Counter(r["sequence_id"] for r in rows)
    assert len(rows) == 5000 and len(sizes) == -(-5000 // per) and max(sizes.values()) == per
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 5000


def test_null_ids_and_repeated_rows(spark):
    rows = spark.createDataFrame([(None, "a b c"), (None, None), (1, "a b c"), (1, "a b c")], "doc_id long, text string")
    got = B.pack(rows, K.public_file()).collect()
    assert sorted((r["doc_id"] is None, r["piece"]) for r in got) == [(False, 0), (False, 0), (True, 0), (True, 0)]
    assert len({r["sequence_id"] for r in got}) == 1
