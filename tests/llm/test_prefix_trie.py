"""The conversation trie against a plain one, over many shards, hot paths and deep paths."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import types as T

from reportlake.llm import conversation_queries as Q
from reportlake.llm import prefix_trie as P

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])


def plain_paths(rows):
    out = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            out[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, x) for _, _, r, x in sorted(t, key=lambda v: v[:2])] for c, t in out.items()}


def plain_rebuilt(paths):
    out = {}
    for c, own in paths.items():
        h = zlib.crc32(str(c).encode()) % 6
        lead = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = paths.get(lead, [])[:h] + own[h:]
    return out


def plain_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = sum(saved[k] for k in kids[p]) + (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
    rows = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if len(paths[c]) == len(p)))
        rows.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def found(frame):
    return sorted((tuple(r[:8]) for r in frame.collect()), key=str)


def conversations(seed, convs=120, hot=0):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        same = hot and rng.random() < hot
        for t in range(3 if same else rng.choice([0, 1, 2, 3, 5, 9])):
            text = f"hot {t}" if same else rng.choice(["a", "b", "é😀", "", None, f"own {c}"])
            rows.append((c * rng.choice([1, 1, 3]) if not same else c, t if rng.random() < 0.97 else None, rng.choice(["user", None]) if not same else "user", text))
    return list(dict.fromkeys(rows))


def distinct_turns(rows):
    seen, out = set(), []
    for r in rows:
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            out.append(r)
    return out


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_trie_equals_plain(spark, shards):
    rows = distinct_turns(conversations(shards))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(P.trie(P.sequences(frame), shards)) == plain_trie(plain_paths(rows))
    assert found(P.trie(Q.rebuilt(P.sequences(frame)), shards)) == plain_trie(plain_rebuilt(plain_paths(rows)))


def test_hot_path_is_split(spark, monkeypatch):
    """A path of two thirds of all conversations lies in many shards; its ids come in chunks."""
    monkeypatch.setattr(P, "ID_CHUNK", 5)
    rows = distinct_turns(conversations(5, 400, hot=0.66))
    frame = spark.createDataFrame(rows, SCHEMA)
    assert found(P.trie(P.sequences(frame), 30)) == plain_trie(plain_paths(rows))
    sample = [(b"x" * 16, k) for k in range(90)] + [(b"x" * 16 + b"y" * 32, k) for k in range(5)]
    limits = P.splitters(sample, 10)
    assert len(limits) == 9 and len({p for p, _ in limits}) <= 2


def test_splitters_are_short_and_bounded():
    rng = random.Random(1)
    path = lambda: b"".join(bytes([rng.randrange(3)]) * 16 for _ in range(rng.randrange(1, 40)))
    sample = [(path(), k) for k in range(500)]
    limits = P.splitters(sample, 64)
    assert limits == sorted(set(limits))
    assert sum(len(p) for p, _ in P.splitters(sample, 64, most_bytes=300)) <= 300
    for a, b in zip(sorted(sample), sorted(sample)[1:]):
        assert P._shared(a[0], b[0]) == next((k for k in range(min(len(a[0]), len(b[0])) // 16) if a[0][16 * k : 16 * k + 16] != b[0][16 * k : 16 * k + 16]), min(len(a[0]), len(b[0])) // 16)


def test_deep_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (1, 2) for t in range(3000 + c)] + [(3, 0, "user", "turn 0")]
    got = P.trie(P.sequences(spark.createDataFrame(rows, SCHEMA)), 3)
    assert found(got) == plain_trie(plain_paths(rows))


def test_turnless_nulls_repeats_and_empty(spark):
    rows = [(100, None, None, None), (100, 0, "user", "x"), (100, 0, "user", "x"), (None, 0, "user", "lost"), (7, 0, "a", "b"), (8, 0, "ab", "")]
    frame = spark.createDataFrame(rows, SCHEMA)
    sequences = P.sequences(frame)
    assert {r["conv_id"]: len(r["turns"]) for r in sequences.collect()} == {100: 3, 7: 1, 8: 1}
    assert found(P.trie(sequences, 4)) == plain_trie(plain_paths(rows))  # ("a", "b") and ("ab", "") differ
    built = plain_rebuilt(plain_paths(rows))
    assert [] in built.values()  # an absent head and too few own turns
    assert found(P.trie(Q.rebuilt(sequences), 4)) == plain_trie(built)
    assert P.trie(P.sequences(spark.createDataFrame([], SCHEMA)), 4).count() == 0


def test_clashing_columns_and_texts(spark):
    from pyspark.sql import functions as F

    rows = distinct_turns(conversations(3, 30))
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("turns", "path", "chars", "shard", "node", "kind", "turn_key", "depth")])
    got = P.trie(P.sequences(wide), 4)
    assert found(got) == plain_trie(plain_paths(rows))
    texts = P.turn_texts(wide)
    assert got.where("depth > 0").join(texts, "turn_key", "left_anti").count() == 0
