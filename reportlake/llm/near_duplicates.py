"""Near-duplicate documents by a chosen-path set-similarity join.

A document's set is its distinct 5-word shingles. Documents with equal sets form one class and one
member stands for it. Every class starts in the root of several independent trees; a tree branches
it by minwise tokens of its set: at the root by the tree's own token, further down by tokens chosen
by a hash of the path. Similar sets share a minwise token with a probability equal to their
similarity, so they stay together in some tree; unlike ones part.

- Every node, whatever its size, first compares its members with its least member. Confirmed links
  give components, which take in large groups of copies in linear work.
- A node whose members are all in one component is done. Nodes of at most ``node_limit`` members
  are compared exhaustively (members of different components only): candidates are pairs with like
  sketches. A node gives a spanning forest of its candidates, not the pairs.
- Larger nodes branch again, by two tokens each. A document with ``SMALL_ROOTS`` or more of its 16
  root tokens in nodes of at most ``node_limit`` members doesn't take part: at the threshold, at
  most a quarter of its set lies in the large nodes' tokens, so it meets a similar document in one
  of its small nodes but for a chance of 2e-6.
- A node still large at ``max_depth`` is compared exactly in blocks: members outside its main
  component against all.

Documents that the forests join are one cluster, so both ends of every candidate pair lie in one.
A cluster's members outside its main component are compared with all of the cluster, in blocks that
hold the full sets, and give the confirmed links that unite two components: rows grow with the members
of a group, not with its pairs.

Comparisons use 128 one-byte minwise tokens first and leave out pairs whose share of equal tokens
is below ``screen``, 4.5 standard deviations under the threshold; the rest is confirmed on the full
sets. With 16 trees the chance of losing a pair at the threshold is below 1e-6 for each of these
steps. Components come from grouped minima over written tables.

Defined cases: null, empty and blank texts have an empty set and are linked with nothing; a text of
fewer than 5 words is one shingle of all its words; repeated rows and texts share a class; ties take
the least id; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reportlake.llm import words as W
from reportlake.llm.components import components, forest_roots
from reportlake.llm.shared import written

SHINGLE = 5
TREES = 16
SKETCH = 128
NODE_LIMIT = 4000
MAX_DEPTH = 9
SCREEN = 0.58
SMALL_ROOTS = 12
#: Sets of a group that a task holds at once are two blocks of about this many, or this many bytes.
BLOCK, BLOCK_BYTES = 400, 16 << 20
#: The same for the members of a cluster of candidates, which come without pairs.
CLUSTER_BLOCK = 1000

_rng = np.random.default_rng(424242)
_FACTORS = _rng.integers(1, 1 << 63, TREES + SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def document_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hashes in order of texts, text number of each); repeats included."""
    data, offsets = W.text_buffers(column)
    starts, ends, owner = W.word_spans(data, offsets, W.SPACED)
    hashes = W.word_hashes(data, starts, ends)
    many, belongs = W.shingles(hashes, owner, SHINGLE)
    count = np.bincount(owner, minlength=len(offsets) - 1)
    first = np.cumsum(count) - count
    short = np.flatnonzero((count > 0) & (count < SHINGLE))
    if not len(short):
        return many, belongs
    whole = np.zeros(len(short), np.uint64)
    for k in range(SHINGLE - 1):
        has = count[short] > k
        whole[has] = whole[has] * np.uint64(0xD6E8FEB86659FD93) + hashes[first[short[has]] + k]
    few = W.mix(whole ^ (count[short].astype(np.uint64) << np.uint64(56)))
    owners = np.concatenate([belongs, short])
    order = np.argsort(owners, kind="stable")
    return np.concatenate([many, few])[order], owners[order]


def _distinct(hashes: np.ndarray, owner: np.ndarray, n: int) -> list[np.ndarray]:
    limits = np.searchsorted(owner, np.arange(n + 1))
    out = []
    for a, b in zip(limits[:-1].tolist(), limits[1:].tolist()):
        part = np.sort(hashes[a:b])
        out.append(part[np.concatenate([[True], part[1:] != part[:-1]])] if len(part) else part)
    return out


def _class_keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """16 bytes for each set, equal for equal sets; None for the empty set."""
    keys: list[bytes | None] = []
    for s in sets:
        one = W.mix(s).sum(dtype=np.uint64) + np.uint64(len(s))
        two = W.mix(s ^ np.uint64(0xA5A5A5A55A5A5A5A)).sum(dtype=np.uint64)
        keys.append(np.array([one, two], ">u8").tobytes() if len(s) else None)
    return keys


def signatures(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``id``, n_shingles, class key, root tokens and sketch of every document."""

    def run(batches):
        for batch in W.slices(batches):
            n = batch.num_rows
            hashes, owner = document_sets(batch.column("text"))
            sets = _distinct(hashes, owner, n)
            size = np.array([len(s) for s in sets], np.int64)
            some = np.flatnonzero(size)
            tokens = np.zeros((n, TREES + SKETCH), np.uint32)
            if len(some):
                at = np.searchsorted(owner, some)
                for k, factor in enumerate(_FACTORS):
                    tokens[some, k] = np.minimum.reduceat(W.mix(hashes * factor) if k < TREES else hashes * factor, at) >> np.uint64(24)
            roots, sketch = tokens[:, :TREES].view(np.int32), W.mix(tokens[:, TREES:].astype(np.uint64)).astype(np.uint8)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * TREES, pa.int32()), pa.array(roots.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(size), pa.array(_class_keys(sets), pa.binary()), lists, pa.array([r.tobytes() for r in sketch], pa.binary())], names=["id", "n_shingles", "key", "roots", "sketch"])

    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, n_shingles long, key binary, roots array<int>, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH)


def _screened(pairs: DataFrame, members: DataFrame, screen: float) -> DataFrame:
    """Pairs (a, b) whose sketches agree in at least ``screen`` of the tokens, with that share."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                share = (_matrix(batch.column("sa")) == _matrix(batch.column("sb"))).mean(axis=1)
                ok = np.flatnonzero(share >= screen)
                yield pa.RecordBatch.from_arrays([batch.column("a").take(pa.array(ok)), batch.column("b").take(pa.array(ok)), pa.array(share[ok])], names=["a", "b", "share"])

    one = members.select(F.col("key").alias("a"), F.col("sketch").alias("sa"))
    two = members.select(F.col("key").alias("b"), F.col("sketch").alias("sb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary, share double")


def _alike(x: np.ndarray, y: np.ndarray, per_cent: int) -> bool:
    if 100 * min(len(x), len(y)) < per_cent * max(len(x), len(y)):
        return False
    both = np.sort(np.concatenate([x, y]))
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= per_cent * (len(x) + len(y) - common)


def _sets(need: DataFrame, members: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(key, content) of the classes in ``need``, content being the full set."""
    ids = written(need.join(members, "key").select(F.col("id").alias("need_id")).distinct(), "near-need")
    rows = documents.select(F.col(doc_id).alias("need_id"), F.col(text).cast("string").alias("text")).join(ids, "need_id", "left_semi").select("text")

    def sets_of(batches):
        for batch in W.slices(batches):
            hashes, owner = document_sets(batch.column("text"))
            sets = _distinct(hashes, owner, batch.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(_class_keys(sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["key", "content"])

    sets = rows.mapInArrow(sets_of, "key binary, content binary").where("key IS NOT NULL").dropDuplicates(["key"])
    return written(sets, "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """The pairs (a, b, label) whose full sets have 100 * |intersection| >= per_cent * |union|. Sets are
    not sent with each pair: the documents of all pairs of a label are dealt into blocks of about
    BLOCK, and each pair of blocks gets its sets once, before its pairs."""
    cluster = pairs.select("label", F.col("a").alias("key")).unionByName(pairs.select("label", F.col("b").alias("key"))).distinct()
    cluster = cluster.join(sets.select("key", F.length("content").alias("bytes")), "key")
    parts = cluster.groupBy("label").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("bytes") / BLOCK_BYTES)).cast("int").alias("parts"))
    cluster = cluster.drop("bytes").join(parts, "label")

    def block(i, j):
        return F.xxhash64("label", F.least(i, j), F.greatest(i, j)).alias("block")

    part = lambda key: F.pmod(F.xxhash64(key), F.col("parts")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    held = cluster.select("key", "label", part("key").alias("part"), every).join(sets, "key").select(block(F.col("part"), F.col("other")), "key", F.lit(None).cast("binary").alias("b"), "content")
    asked = pairs.join(parts, "label").select(block(part("a"), part("b")), F.col("a").alias("key"), "b", F.lit(None).cast("binary").alias("content"))

    def compare(batches):
        now, known = None, {}
        for batch in batches:
            ok = []
            for k, (where, key, other, content) in enumerate(zip(batch.column("block").to_pylist(), batch.column("key").to_pylist(), batch.column("b").to_pylist(), batch.column("content"))):
                if where != now:
                    now, known = where, {}
                if other is None:
                    known[key] = np.frombuffer(content.as_buffer().to_pybytes(), np.uint64)
                    continue
                if _alike(known[key], known[other], per_cent):
                    ok.append(k)
            at = pa.array(ok, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), batch.column("b").take(at)], names=["a", "b"])

    together = held.unionByName(asked).repartition("block").sortWithinPartitions("block", F.col("b").asc_nulls_first())
    return together.mapInArrow(compare, "a binary, b binary")


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels.withColumnRenamed("u", "key"), "key", "left").withColumn("label", F.coalesce("label", "key"))


def _united(top: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Places of the pairs that join two trees of ``top`` (each row's tree), which is brought up to date."""
    parent = top.tolist()

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    kept = []
    for k in np.flatnonzero(top[one] != top[two]).tolist():
        x, y = find(int(one[k])), find(int(two[k]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            kept.append(k)
    if kept:
        top[:] = parent
        while (top[top] != top).any():
            top[:] = top[top]
    return np.array(kept, np.int64)


def _node_forest(rows: DataFrame, screen: float) -> DataFrame:
    """Candidate links inside nodes: members of different labels whose sketches are alike. Of each
    node a spanning forest of its candidate links is given, (a, b), one link a member at most:
    enough to say which members have candidates and which of them belong together.
    ``rows``: (node, side, key, label, sketch); members of side 1 are compared with all of the
    node, those of side 0 only with side 1."""

    def run(batches):
        rest: pa.Table | None = None

        def compared(t: pa.Table):
            node, side, sketch = t.column("node").to_numpy(), t.column("side").to_numpy(), _matrix(t.column("sketch"))
            label = np.unique(np.array(t.column("label").to_pylist(), "S16"), return_inverse=True)[1]
            top = np.arange(t.num_rows)
            one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for lag in range(1, t.num_rows):
                at = np.flatnonzero(node[lag:] == node[:-lag])
                if not len(at):
                    break
                at = at[(top[at] != top[at + lag]) & (label[at] != label[at + lag]) & ((side[at] == 1) | (side[at + lag] == 1))]
                for part in np.array_split(at, len(at) // 20_000 + 1):
                    like = part[(sketch[part] == sketch[part + lag]).mean(axis=1) >= screen]
                    like = like[_united(top, like, like + lag)]
                    one.append(like)
                    two.append(like + lag)
            keys = t.column("key").combine_chunks()
            yield from pa.table({"a": keys.take(pa.array(np.concatenate(one))), "b": keys.take(pa.array(np.concatenate(two)))}).to_batches()

        for batch in batches:
            if not batch.num_rows:
                continue
            now = pa.Table.from_batches([batch])
            now = pa.concat_tables([rest, now]) if rest is not None else now
            node = now.column("node").to_numpy()
            cut = int(np.searchsorted(node, node[-1], side="left"))
            if cut:
                yield from compared(now.slice(0, cut))
            rest = now.slice(cut)
        if rest is not None:
            yield from compared(rest)

    ordered = rows.select("node", "side", "key", "label", "sketch").repartition("node").sortWithinPartitions("node", "key")
    return ordered.mapInArrow(run, "a binary, b binary").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _cluster_links(involved: DataFrame, sets: DataFrame, members: DataFrame, screen: float, per_cent: int) -> DataFrame:
    """Confirmed links (a, b) that join the labels inside each cluster of candidates.
    ``involved``: (key, cluster, label). The members outside a cluster's main label (the one with most
    members) meet all of the cluster, in blocks of bounded size; a block gets each full set once,
    confirms its candidates, most alike first, and gives only links that unite two labels."""
    rows = involved.join(sets.select("key", F.length("content").alias("bytes")), "key")
    size = lambda n, b: F.ceil(F.greatest(n / CLUSTER_BLOCK, b / BLOCK_BYTES)).cast("int")
    by_label = rows.groupBy("cluster", "label").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
    most = F.struct("n", "bytes", "label")
    shape = by_label.groupBy("cluster").agg(F.count("*").alias("labels"), F.max(most).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("labels > 1")
    shape = shape.select("cluster", F.col("most.label").alias("main"), size(F.col("n"), F.col("bytes")).alias("parts"), size(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("asking"))
    dealt = written(rows.drop("bytes").join(shape, "cluster").withColumn("outer", F.col("label") != F.col("main")).drop("main"), "near-clusters")

    part = lambda parts: F.pmod(F.xxhash64("key"), F.col(parts)).cast("int")
    upto = lambda parts: F.explode(F.sequence(F.lit(0), F.col(parts) - 1))
    block = lambda i, j: F.xxhash64("cluster", i, j).alias("block")
    asked = dealt.where("outer").select("cluster", "key", "label", "outer", part("asking").alias("i"), upto("parts").alias("j")).withColumn("side", F.lit(0))
    given = dealt.select("cluster", "key", "label", "outer", upto("asking").alias("i"), part("parts").alias("j")).withColumn("side", F.lit(1))
    full = sets.join(members.select("key", "sketch"), "key")
    rows = asked.unionByName(given).select(block("i", "j"), "side", "key", "label", "outer").join(full, "key")

    def links_of(block_rows: pa.Table):
        side = block_rows.column("side").to_numpy()
        first = int(np.searchsorted(side, 1))
        sketch, outer = _matrix(block_rows.column("sketch")), block_rows.column("outer").to_numpy()
        keys, content = block_rows.column("key").to_pylist(), block_rows.column("content")
        label = np.unique(np.array(block_rows.column("label").to_pylist(), "S16"), return_inverse=True)[1]
        found = [np.zeros((0, 3))]
        names = np.array(keys, "S16")
        for a in range(first):
            b = first + np.flatnonzero((label[first:] != label[a]) & (~outer[first:] | (names[first:] > names[a])))
            share = (sketch[b] == sketch[a]).mean(axis=1)
            ok = share >= screen
            found.append(np.column_stack([-share[ok], np.full(int(ok.sum()), a), b[ok]]))
        pairs = np.concatenate(found)
        pairs = pairs[np.lexsort((pairs[:, 2], pairs[:, 1], pairs[:, 0]))][:, 1:].astype(np.int64)
        label = label.tolist()
        top, known, out = list(range(len(label))), {}, []

        def of(k: int) -> np.ndarray:
            if k not in known:
                known[k] = np.frombuffer(content[k].as_buffer(), np.uint64)
            return known[k]

        for a, b in pairs.tolist():
            x, y = label[a], label[b]
            while top[x] != x:
                x = top[x]
            while top[y] != y:
                y = top[y]
            if x != y and _alike(of(a), of(b), per_cent):
                top[max(x, y)] = min(x, y)
                out.append((keys[a], keys[b]))
        return pa.table({"a": pa.array([a for a, _ in out], pa.binary()), "b": pa.array([b for _, b in out], pa.binary())})

    def run(batches):
        rest: list[pa.Table] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            where = t.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(where[1:] != where[:-1]) + 1).tolist(), t.num_rows]
            for a, b in zip(edges[:-1], edges[1:]):
                if rest and rest[0].column("block")[0].as_py() != where[a]:
                    yield from links_of(pa.concat_tables(rest)).to_batches()
                    rest = []
                rest.append(t.slice(a, b - a))
        if rest:
            yield from links_of(pa.concat_tables(rest)).to_batches()

    return rows.repartition("block").sortWithinPartitions("block", "side").mapInArrow(run, "a binary, b binary").distinct()


def _open_nodes(rows: DataFrame) -> DataFrame:
    """(node, n) of nodes with members of two components or more."""
    return rows.groupBy("node").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("node", "n")


def _children(rows: DataFrame) -> DataFrame:
    """Members of large nodes in their child nodes: two tokens, chosen by a hash of the node."""
    out = []
    for branch in (1, 2):
        place = F.pmod(F.xxhash64("node", F.lit(branch)), F.lit(SKETCH)).cast("int")
        token = F.substring("sketch", place + 1, F.lit(1))
        out.append(rows.withColumn("node", F.xxhash64("node", F.lit(branch), token)))
    return out[0].unionByName(out[1])


def _blocks(rows: DataFrame, main: DataFrame, limit: int) -> DataFrame:
    """Large nodes dealt into block pairs: members outside the node's main component (side 1)
    meet every member; (node, side, key, label, sketch)."""
    rows = rows.join(main, "node").withColumn("parts", F.ceil(F.col("n") / limit).cast("int"))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    rest = rows.where("label <> main")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    asked = rest.select("node", "key", "label", "sketch", F.lit(1).alias("side"), F.explode(F.transform(every, lambda p: F.struct(F.col("part").alias("i"), p.alias("j")))).alias("c"))
    given = rows.select("node", "key", "label", "sketch", F.lit(0).alias("side"), F.explode(F.transform(every, lambda p: F.struct(p.alias("i"), F.col("part").alias("j")))).alias("c"))
    return asked.unionByName(given).withColumn("node", F.xxhash64("node", "c.i", "c.j")).drop("c")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", per_cent: int = 75, screen: float = SCREEN, node_limit: int = NODE_LIMIT, max_depth: int = MAX_DEPTH) -> DataFrame:
    """``doc_id``, n_shingles, component_id (the least id of the component) and kept of every row."""
    found = written(signatures(documents, doc_id, text), "near-signatures")
    members = written(found.where("key IS NOT NULL").groupBy("key").agg(F.min("id").alias("id"), F.first("roots").alias("roots"), F.first("sketch").alias("sketch")), "near-members")
    placed = members.select("key", F.posexplode("roots").alias("tree", "token")).select(F.xxhash64("tree", "token").alias("node"), "tree", "key")
    nodes = placed.groupBy("node").agg(F.count("*").alias("n"), F.min("key").alias("b")).where("n > 1")
    shared = written(placed.join(nodes, "node").select("node", "key", "n", "b"), "near-nodes")

    star = shared.where("key <> b").select(F.col("key").alias("a"), "b").distinct()
    star = _screened(star, members, screen)
    best = written(star.groupBy("a").agg(F.max_by("b", F.struct("share", "b")).alias("b")), "near-star")  # b < a: a forest
    ends = lambda pairs: pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    links = written(_confirmed(best.withColumn("label", F.col("b")), _sets(ends(best), members, documents, doc_id, text), per_cent), "near-links")
    labels = forest_roots(links.select(F.col("a").alias("u"), F.col("b").alias("parent")), "near-labels")

    rows = written(_labelled(shared.select("node", "key", "n"), labels), "near-rows")
    small_nodes = rows.where(F.col("n") <= node_limit)
    small_nodes = small_nodes.join(_open_nodes(small_nodes).select("node"), "node", "left_semi").join(members.select("key", "sketch"), "key")
    wanted = _node_forest(small_nodes.withColumn("side", F.lit(1)), screen)

    large = rows.where(F.col("n") > node_limit)
    deep = large.groupBy("key").agg(F.count("*").alias("large")).where(F.col("large") > TREES - SMALL_ROOTS).select("key")
    large = large.join(deep, "key", "left_semi").drop("n")
    large = large.join(_open_nodes(large), "node").join(members.select("key", "sketch"), "key")
    for depth in range(1, max_depth + 1):
        large = written(large.select("node", "n", "key", "label", "sketch"), f"near-depth{depth}")
        if not large.head(1):
            break
        wanted = wanted.unionByName(_node_forest(large.where(F.col("n") <= node_limit).withColumn("side", F.lit(1)), screen))
        large = large.where(F.col("n") > node_limit)
        if depth < max_depth:
            large = _children(large.drop("n")).dropDuplicates(["node", "key"])
            large = large.join(_open_nodes(large), "node")
        elif large.head(1):
            by_label = large.groupBy("node", "label").agg(F.count("*").alias("size"))
            main = by_label.groupBy("node").agg(F.max_by("label", F.struct("size", "label")).alias("main"))
            wanted = wanted.unionByName(_node_forest(_blocks(large, main, node_limit), screen))
    wanted = written(wanted.distinct(), "near-wanted")
    if wanted.head(1):
        involved = written(ends(wanted), "near-involved")
        clusters = _labelled(involved, components(wanted, "near-groups")).withColumnRenamed("label", "cluster")
        involved = _labelled(clusters, labels)
        links = links.unionByName(_cluster_links(involved, _sets(involved.select("key"), members, documents, doc_id, text), members, screen, per_cent))
        labels = components(links, "near-labels")

    classes = _labelled(members.select("key", "id"), labels)
    least = classes.groupBy("label").agg(F.min("id").alias("component_id"))
    classes = classes.join(least, "label").select("key", "component_id")
    out = found.select("id", "n_shingles", "key").join(classes, "key", "left").withColumn("component_id", F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(doc_id), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def deduplicated(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows, with all their columns, that stand for their component. Rows without an id stay; rows
    with equal id and text count as one; where an id stands for several texts, each (id, text) is a
    document of its own, so no text is lost with another one of its id."""
    repeated = not documents.where(F.col(doc_id).isNotNull()).groupBy(doc_id).count().where("count > 1").isEmpty()
    if repeated:
        one = F.struct(F.col(doc_id).alias("id"), F.xxhash64(text).alias("h"))
        named = documents.where(F.col(doc_id).isNotNull()).select(one.alias("one"), F.col(text).alias("text")).distinct()
        found = near_duplicates(named, "one", "text", **options).where("NOT kept").select("one.id", "one.h").distinct()
        gone = written(found.withColumnsRenamed({"id": doc_id, "h": "_text_hash"}), "near-gone")
        left = documents.withColumn("_text_hash", F.xxhash64(text)).join(gone, [doc_id, "_text_hash"], "left_anti")
        return left.select(*documents.columns).dropDuplicates([doc_id, text])
    gone = written(near_duplicates(documents, doc_id, text, **options).where("NOT kept").select(doc_id).distinct(), "near-gone")
    return documents.join(gone, doc_id, "left_anti").select(*documents.columns)
