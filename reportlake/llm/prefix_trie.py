"""The trie of conversation prefixes, built over range-partitioned sorted paths: splitters and skeleton.

A conversation is a path of turns; a turn is known by 16 bytes of the SHA-256 of its role and text. The
paths are dealt into shards by splitter paths, taken from a bounded sample: a shard holds a contiguous
range of (path, conv_id), so also the copies of one path that a third of all conversations share are
dealt over shards. All conversations of a trie node lie together in that order. So a node whose path
isn't a prefix of a splitter path lies within one shard, and that shard finishes it alone: it goes
through its sorted paths with a stack of open nodes. The other nodes are the trie of the splitter paths,
the skeleton, which is broadcast: each shard gives a partial aggregate for those it meets, these are
reduced by a grouped sum, and what they pass on to each other is added up from the deepest.

A splitter is the shortest path that parts two neighbours of the sample (with the conv_id where they are
equal). Between such neighbours there are about as many conversations as a shard has, and all of them
begin with what the neighbours share; so the splitters together hold about as many turns as the
average conversation times the number of shards. That is checked: beyond ``most_bytes`` every second
splitter is dropped, which leaves fewer, larger shards.

The digest of the ids that end at a node needs them in order: within a shard they come in order; for
a skeleton node the shards' lists are hashed one after the other in a task that streams them.

Defined cases: rows without a conversation id belong to no conversation; a null role or text is
empty; turns go by their number, null first, and those of one number by their digest; repeated rows are
turns of their own; a conversation's turns are held in one row, at 24 bytes a turn; an empty table gives
no rows (not even the root). Columns other than the four named are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm.shared import written

KEY = 16
SAMPLE = 16
MOST_BYTES = 64 << 20
ID_CHUNK = 1 << 16
BATCH = 1 << 15
NO_ENDS = hashlib.sha256(b"").hexdigest()
LOWEST = -(1 << 63)
ROOT = hashlib.sha256(b"").digest()  # below it, a skeleton node's digest is made of its parent's and its turn

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "turn_key"]
_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, turn_key binary"
#: kind: done, top (done, its parent is of the skeleton), part (of a skeleton node) or ends (of one).
_FOUND = f"kind string, {_NODE}, node binary, parent binary, chars long, shard long, chunk long, ids string"


def sequences(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: conv_id and its turns in order, each with its key and its code points."""
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.substring(F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)), 1, KEY)
    one = turns.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), key.alias("turn_key"), F.length(said).cast("long").alias("chars")).alias("t"))
    return one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def turn_texts(turns: DataFrame, role: str = "role", text: str = "text") -> DataFrame:
    """(turn_key, role, text) of every distinct turn, to show the texts of trie nodes."""
    who, said = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = F.substring(F.unhex(F.sha2(F.concat(F.length(who).cast("string"), F.lit(":"), who, said), 256)), 1, KEY)
    return turns.select(key.alias("turn_key"), who.alias("role"), said.alias("text")).dropDuplicates(["turn_key"])


def _packed(batches):
    """Turns as bytes: the keys one after the other, and the code points as 64-bit values."""
    for batch in batches:
        lists = batch.column("turns")
        at = lists.offsets.to_numpy()
        flat = lists.values
        keys = b"".join(flat.field("turn_key").slice(at[0], at[-1] - at[0]).to_pylist())
        chars = flat.field("chars").slice(at[0], at[-1] - at[0]).to_numpy(zero_copy_only=False).astype("<i8").tobytes()
        spans = list(zip((at[:-1] - at[0]).tolist(), (at[1:] - at[0]).tolist()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array([keys[KEY * a : KEY * b] for a, b in spans], pa.binary()), pa.array([chars[8 * a : 8 * b] for a, b in spans], pa.binary())],
            names=["conv_id", "path", "chars"],
        )


def _shared(a: bytes, b: bytes) -> int:
    """Turns that two paths have in common from the start."""
    n = min(len(a), len(b)) // KEY
    if a[: KEY * n] == b[: KEY * n]:
        return n
    x = np.frombuffer(a, np.uint8, KEY * n) != np.frombuffer(b, np.uint8, KEY * n)
    return int(x.argmax()) // KEY


def splitters(sample: list[tuple[bytes, int]], shards: int, most_bytes: int = MOST_BYTES) -> list[tuple[bytes, int]]:
    """Sorted (path, conv_id) limits: a shard ends before each of them."""
    sample = sorted(sample)
    found = set()
    for k in range(1, shards):
        at = k * len(sample) // shards
        if at == 0:
            continue
        (before, _), (path, number) = sample[at - 1], sample[at]
        if before == path:
            found.add((path, number))
        else:
            found.add((path[: KEY * (_shared(before, path) + 1)], LOWEST))
    limits = sorted(found)
    while sum(len(path) for path, _ in limits) > most_bytes:
        limits = limits[1::2]
    return limits


class _Node:
    __slots__ = ("key", "chars", "digest", "least", "members", "children", "leaves", "saved", "ends", "pending")

    def __init__(self, key: bytes, chars: int, digest: bytes | None):
        self.key, self.chars, self.digest = key, chars, digest  # a digest: of the skeleton
        self.least, self.members, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends: list[int] | hashlib._Hash | None = None
        self.pending: list[list] = []


class _Shard:
    """Open nodes of the last path of one shard; closed ones go to ``out`` as rows of _FOUND."""

    def __init__(self, shard: int, limits: list[tuple[bytes, int]], out: list[list]):
        self.shard, self.out, self.chunk = shard, out, 0
        self.around = [limits[k][0] for k in (shard - 1, shard) if 0 <= k < len(limits)]
        self.path = b""
        self.stack = [_Node(b"", 0, ROOT)]

    def _ids(self, node: _Node, depth: int) -> None:
        self.out.append(["ends", None, depth, *[None] * 7, node.digest, None, None, self.shard, self.chunk, ",".join(map(str, node.ends))])
        self.chunk += 1
        node.ends = []

    def _close(self) -> None:
        depth = len(self.stack) - 1
        node = self.stack.pop()
        if node.digest:
            if node.ends:
                self._ids(node, depth)
            parent = self.stack[-1].digest if depth else None
            self.out.append(["part", node.least, depth, None, node.members, node.children, node.leaves, node.saved, None, node.key, node.digest, parent, node.chars, self.shard, None, None])
            if depth:
                above = self.stack[-1]
                above.members += node.members
                above.least = node.least if above.least is None else min(above.least, node.least)
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.members - 1) * node.chars
        for row in node.pending:
            row[3] = node.least
        self.out += node.pending
        above = self.stack[-1]
        row = ["done", node.least, depth, None, node.members, node.children, leaves, saved, node.ends.hexdigest() if node.ends else NO_ENDS, node.key, None, None, None, None, None, None]
        if above.digest:
            row[0], row[11] = "top", above.digest
            self.out.append(row)
        else:
            above.pending.append(row)
        above.members += node.members
        above.least = node.least if above.least is None else min(above.least, node.least)
        above.children += 1
        above.leaves += leaves
        above.saved += saved

    def add(self, path: bytes, conv_id: int, chars: bytes) -> None:
        same = _shared(self.path, path)
        while len(self.stack) - 1 > same:
            self._close()
        self.path = path
        depth = len(path) // KEY
        if depth > same:
            skeleton = max((_shared(path, limit) for limit in self.around), default=0)
            sizes = np.frombuffer(chars, "<i8")[same:].tolist()
            for d in range(same + 1, depth + 1):
                key = path[KEY * (d - 1) : KEY * d]
                digest = hashlib.sha256(self.stack[-1].digest + key).digest() if d <= skeleton else None
                self.stack.append(_Node(key, sizes[d - same - 1], digest))
        node = self.stack[-1]
        node.members += 1
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        if node.digest:
            node.ends = node.ends or []
            node.ends.append(conv_id)
            if len(node.ends) == ID_CHUNK:
                self._ids(node, depth)
        elif node.ends is None:
            node.ends = hashlib.sha256(str(conv_id).encode())
        else:
            node.ends.update(b",%d" % conv_id)

    def end(self) -> None:
        while self.stack:
            self._close()


def _batches(out: list[list], schema: pa.Schema):
    columns = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _finish(limits):
    """mapInArrow body: sorted rows of shards to finished nodes and partial aggregates."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(_FOUND))

    def run(batches):
        shard, out = None, []
        for batch in batches:
            for number, path, conv_id, chars in zip(batch.column("shard").to_pylist(), batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), batch.column("chars").to_pylist()):
                if shard is None or shard.shard != number:
                    if shard:
                        shard.end()
                    shard = _Shard(number, limits.value, out)
                shard.add(path, conv_id, chars)
                if len(out) >= BATCH:
                    yield _batches(out, schema)
                    out.clear()
        if shard:
            shard.end()
        if out:
            yield _batches(out, schema)

    return run


def _hashed(batches):
    """Sorted chunks of ids to one digest a node."""
    node, digest = None, None
    for batch in batches:
        done = []
        for key, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if key != node:
                if node is not None:
                    done.append((node, digest.hexdigest()))
                node, digest = key, hashlib.sha256(ids.encode())
            else:
                digest.update(b"," + ids.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in done], pa.binary()), pa.array([x for _, x in done])], names=["node", "ends"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends"])


def _skeleton(frames):
    """Reduced partial aggregates of the skeleton (one partition, no more rows than the splitters have
    turns) to finished nodes: each passes its subtree's sums to its parent, the deepest first."""
    nodes = {r.node: r for rows in frames for r in rows.itertuples()}
    children = {k: r.n_children for k, r in nodes.items()}
    leaves = {k: r.n_leaves for k, r in nodes.items()}
    saved = {k: r.saved_tokens + (r.n_convs - 1) * r.chars for k, r in nodes.items()}
    for k in sorted(nodes, key=lambda k: -nodes[k].depth):
        if not children[k]:
            leaves[k] = 1
        if nodes[k].depth:
            above = nodes[k].parent
            children[above] += 1
            leaves[above] += leaves[k]
            saved[above] += saved[k]
    if nodes:
        yield pd.DataFrame({
            "conv_id": [r.conv_id for r in nodes.values()], "depth": [r.depth for r in nodes.values()],
            "parent_conv_id": pd.array([nodes[r.parent].conv_id if r.depth else None for r in nodes.values()], "Int64"),
            "n_convs": [r.n_convs for r in nodes.values()], "n_children": [children[k] for k in nodes],
            "n_leaves": [leaves[k] for k in nodes], "saved_tokens": [saved[k] for k in nodes], "ends_sha256": NO_ENDS,
            "turn_key": [r.turn_key if r.depth else None for r in nodes.values()], "node": list(nodes),
        })


def trie(sequences: DataFrame, shards: int | None = None, most_bytes: int = MOST_BYTES) -> DataFrame:
    """One row a trie node: conv_id (its smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, turn_key (null at the root). ``shards``: as many as the session
    has shuffle partitions unless given."""
    spark = sequences.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = written(sequences.select("conv_id", "turns").mapInArrow(_packed, "conv_id long, path binary, chars binary"), "prefix-trie-paths")
    drawn = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id", F.lit(7))).limit(shards * SAMPLE)
    limits = splitters([(bytes(r["path"]), r["conv_id"]) for r in drawn.collect()], shards, most_bytes)
    sent = spark.sparkContext.broadcast(limits)

    def deal(batches):
        for batch in batches:
            ids = batch.column("conv_id").to_pylist()
            number = [bisect_right(sent.value, x) for x in zip(batch.column("path").to_pylist(), ids)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(number, pa.int64())], names=[*batch.schema.names, "shard"])

    dealt = paths.mapInArrow(deal, "conv_id long, path binary, chars binary, shard long").repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    found = written(dealt.mapInArrow(_finish(sent), _FOUND), "prefix-trie-nodes")
    sent.destroy()
    sums = [F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent").alias("parent"), F.max("chars").alias("chars"), F.first("turn_key").alias("turn_key")]
    sums += [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = found.where("kind = 'part'").groupBy("node").agg(*sums)
    skeleton = written(parts.repartition(1).mapInPandas(_skeleton, f"{_NODE}, node binary"), "prefix-trie-skeleton")
    ends = found.where("kind = 'ends'").select("node", "shard", "chunk", "ids").repartition(shards, "node").sortWithinPartitions("node", "shard", "chunk").mapInArrow(_hashed, "node binary, ends string")
    upper = skeleton.join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends", "ends_sha256"))
    named = skeleton.select(F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    if sum(len(path) // KEY for path, _ in limits) <= most_bytes // 64:
        named = F.broadcast(named)  # no more rows than the splitters have turns, counted here
    top = found.where("kind = 'top'").join(named, "parent").withColumn("parent_conv_id", F.col("above"))
    done = found.where("kind = 'done'").select(*COLUMNS)
    return done.unionByName(top.select(*COLUMNS)).unionByName(upper.select(*COLUMNS))
