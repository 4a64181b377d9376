"""Ranked lexical search by pipelined term partitioning: bundles of items visit the owners of their terms.

The documents are read once: each gives its length and, for the words that may belong to an item (a bit
set of fixed size tells), how often they occur. Corpus counts follow from that table. The terms are
dealt to owners by document frequency, rarest first, and the postings are dealt out to the owners in
blocks of documents. Then bundles of items go through the owners one after the other. At each owner a
cogroup brings together a bundle, with the scores gathered so far, and the owner's postings of a block;
the owner adds its integer contributions and passes the bundle on. After the last owner each bundle
gives its best documents of each block, and the best of all blocks are selected.

A bundle carries its scores sparsely: a document that can't come among the first ``top`` is left
behind. It can't if its score plus the largest contributions of the owners still to come stays below
the score that ``top`` documents of the block have already. So the result is exact, ties included.

Sizes: a bundle has about MOST_TERMS terms or MOST_ITEMS items at most, a block so many documents that a
bundle and a block make about MOST_CELLS scores; both are dealt by hash. The terms of the owners but the
first are frequent: of those that a share s of all documents hold there are no more than the average
document has distinct terms / s, whatever the corpus, so their list can be sent to all tasks. Postings
are partitioned by block, never by term, so frequent words make no hot partition.

Terms are 64-bit hashes (see words.py): with 10,000 item terms and 10^9 distinct words of the corpus
two of them meet with a chance of about 5e-7.

Defined cases: a null or empty text has no terms; an item without terms, or whose terms no document
holds, gives no rows; every row is a document (or an item) of its own, also where ids repeat; equal scores go by
doc_id, then documents without an id, then rows in stored order; an empty table gives no rows. Ids
are whole numbers. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm import words as W
from reportlake.llm.shared import written

TOP = 10
FILTER_BITS = 1 << 22
#: Owners by the share of documents that hold a term; below the first share is the first owner's.
SHARES = (0.001, 0.01, 0.1)
MOST_TERMS, MOST_ITEMS, MOST_CELLS, BLOCK_DOCUMENTS = 1 << 14, 512, 1 << 22, 8192

_DOCUMENT = "doc_row long, doc_id long, n long, terms array<long>, tfs array<long>"
_TERMS = "t_item array<long>, t_term array<long>, t_weight array<long>, t_most array<long>, t_owner array<long>"
_BUNDLE = f"bundle long, block long, {_TERMS}, doc_rows array<long>, doc_ids array<long>, at_doc array<int>, at_item array<int>, scores array<long>, floors array<long>"
_BEST = "item long, doc_row long, doc_id long, score long"


def _row_numbers():
    """Numbers for the rows of this task's partition that no other partition gives."""
    return TaskContext.get().partitionId() << 33


def _counted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, term, occurrences), by text number."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])]) if len(owner) else np.zeros(0, bool))
    return owner[first], hashes[first], np.diff(np.append(first, len(owner)))


def _lists(values: np.ndarray, sizes: np.ndarray, kind=pa.int64()) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, kind))


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, term): every distinct term of every item row."""

    def run(batches):
        number = _row_numbers()
        for batch in W.slices(batches):
            data, offsets = W.text_buffers(batch.column("text"))
            starts, ends, owner = W.word_spans(data, offsets, W.ALNUM)
            row, term, _ = _counted(owner, W.word_hashes(data, starts, ends))
            yield pa.RecordBatch.from_arrays([pa.array(number + row), batch.column("id").take(pa.array(row)), pa.array(W.signed(term))], names=["item", "item_id", "term"])
            number += batch.num_rows

    rows = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "item long, item_id long, term long"), "term-pipeline-items")


def document_terms(documents: DataFrame, wanted: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """One row a document: its number of terms and the counts of those that ``wanted`` lets through."""

    def run(batches):
        number = _row_numbers()
        for batch in W.slices(batches):
            data, offsets = W.text_buffers(batch.column("text"))
            starts, ends, owner = W.word_spans(data, offsets, W.ALNUM)
            hashes = W.word_hashes(data, starts, ends)
            n = np.bincount(owner, minlength=batch.num_rows)
            slot = (hashes % np.uint64(FILTER_BITS)).astype(np.int64)
            asked = (wanted[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
            row, term, tf = _counted(owner[asked], hashes[asked])
            sizes = np.bincount(row, minlength=batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number + np.arange(batch.num_rows)), batch.column("id"), pa.array(n), _lists(W.signed(term), sizes), _lists(tf, sizes)],
                names=["doc_row", "doc_id", "n", "terms", "tfs"],
            )
            number += batch.num_rows

    rows = documents.select(F.col(doc_id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return written(rows.mapInArrow(run, _DOCUMENT), "term-pipeline-documents")


def _gains(tf: np.ndarray, n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """What a term of weight 1 adds to a document of n terms with tf of it."""
    m = 10 + (90 * n * documents) // total
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _flat(table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, row numbers) of a list column."""
    column = table.column(name)
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return pc.list_flatten(column).to_numpy(zero_copy_only=False), np.repeat(np.arange(len(sizes)), sizes)


def _statistics(counted: DataFrame, documents: int, total: int) -> DataFrame:
    """(term, df, most): documents with the term and its largest gain; each batch is counted before the exchange."""

    def run(batches):
        for batch in batches:
            term, row = _flat(batch, "terms")
            tf, _ = _flat(batch, "tfs")
            gain = _gains(tf, batch.column("n").to_numpy()[row], documents, total)
            order = np.argsort(term, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], np.diff(term[order]) != 0])) if len(term) else np.zeros(0, np.int64)
            most = np.maximum.reduceat(gain[order], first) if len(term) else gain
            yield pa.RecordBatch.from_arrays([pa.array(term[order][first]), pa.array(np.diff(np.append(first, len(term)))), pa.array(most)], names=["term", "df", "most"])

    parts = counted.where("size(terms) > 0").select("n", "terms", "tfs").mapInArrow(run, "term long, df long, most long")
    return parts.groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))


def _owners(terms: np.ndarray, frequent: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Owner of each term: those that aren't frequent belong to the first."""
    if not len(frequent):
        return np.zeros(len(terms), np.int64)
    at = np.minimum(np.searchsorted(frequent, terms), len(frequent) - 1)
    return np.where(frequent[at] == terms, owner[at], 0)


class _Cells:
    """Scores of a bundle's items (columns) for the documents of a block (rows) while at an owner."""

    def __init__(self, left: pa.Table, right: pa.Table, owner: int, documents: int, total: int):
        one = {name: _flat(left, name)[0] for name in left.schema.names if name not in ("bundle", "block")}
        self.items, column = np.unique(one["t_item"], return_inverse=True)
        here, later = one["t_owner"] == owner, one["t_owner"] > owner
        self.rest = np.zeros(len(self.items), np.int64)
        np.add.at(self.rest, column[later], one["t_most"][later])
        coming = self.rest.copy()
        np.add.at(coming, column[here], one["t_most"][here])
        floors = one["floors"] if len(one["floors"]) else np.zeros(len(self.items), np.int64)

        ids = right.column("doc_id")
        rows = np.concatenate([one["doc_rows"], right.column("doc_row").to_numpy()]).astype(np.int64)
        self.doc_rows, at, back = np.unique(rows, return_index=True, return_inverse=True)
        names = pa.concat_arrays([left.column("doc_ids").combine_chunks().flatten(), *ids.chunks]) if len(rows) else pa.array([], pa.int64())
        self.doc_ids = names.take(pa.array(at))
        old, new = back[: len(one["doc_rows"])], back[len(one["doc_rows"]) :]

        self.scores = np.zeros((len(self.doc_rows), len(self.items)), np.int64)
        self.scores[old[one["at_doc"]], one["at_item"]] = one["scores"]
        kept = (self.scores > 0) | (coming >= floors)  # else a document that is new here stays out
        term, row = _flat(right, "terms")
        tf, _ = _flat(right, "tfs")
        if len(term) and here.any():
            asked, start, number = np.unique(one["t_term"][here], return_index=True, return_inverse=True)
            by_term = np.argsort(number, kind="stable")
            limits = np.searchsorted(number[by_term], np.arange(len(asked) + 1))
            place = np.minimum(np.searchsorted(asked, term), len(asked) - 1)
            held = np.flatnonzero(asked[place] == term)
            held = held[np.argsort(place[held], kind="stable")]
            gain = _gains(tf[held], right.column("n").to_numpy()[row[held]], documents, total)
            cuts = np.searchsorted(place[held], np.arange(len(asked) + 1))
            weight, item = one["t_weight"][here][by_term], column[here][by_term]
            for k in range(len(asked)):
                a, b, c, d = cuts[k], cuts[k + 1], limits[k], limits[k + 1]
                if a < b:
                    self.scores[np.ix_(new[row[held[a:b]]], item[c:d])] += gain[a:b, None] * weight[None, c:d]
        self.scores[~kept] = 0

    def floors(self, top: int) -> np.ndarray:
        """For each item the score that ``top`` documents have at least; 0 if fewer have any."""
        if len(self.scores) < top:
            return np.zeros(len(self.items), np.int64)
        return np.partition(self.scores, len(self.scores) - top, axis=0)[len(self.scores) - top]


def _pass_on(owner: int, documents: int, total: int, top: int):
    """Cogroup body of every owner but the last: the bundle with the scores that may still count."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return left
        cells = _Cells(left, right, owner, documents, total)
        floors = cells.floors(top)
        kept = (cells.scores > 0) & (cells.scores + cells.rest >= floors)
        doc, item = np.nonzero(kept)
        used, at_doc = np.unique(doc, return_inverse=True)
        new = {
            "doc_rows": pa.array([cells.doc_rows[used]], pa.list_(pa.int64())), "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(used)], pa.int32()), cells.doc_ids.take(pa.array(used))),
            "at_doc": pa.array([at_doc], pa.list_(pa.int32())), "at_item": pa.array([item], pa.list_(pa.int32())),
            "scores": pa.array([cells.scores[doc, item]], pa.list_(pa.int64())), "floors": pa.array([floors], pa.list_(pa.int64())),
        }
        return pa.table([new.get(name, left.column(name)) for name in left.schema.names], names=left.schema.names)

    return run


def _select(owner: int, documents: int, total: int, top: int):
    """Cogroup body of the last owner: the best documents of the block for each item."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        if left.num_rows == 0:
            return pa.table([pa.array(empty)] * 4, names=["item", "doc_row", "doc_id", "score"])
        cells = _Cells(left, right, owner, documents, total)
        missing = pc.is_null(cells.doc_ids).to_numpy(zero_copy_only=False)
        ids = pc.fill_null(cells.doc_ids, 0).to_numpy(zero_copy_only=False)
        doc, item = np.nonzero((cells.scores > 0) & (cells.scores >= cells.floors(top)))
        score = cells.scores[doc, item]
        order = np.lexsort((cells.doc_rows[doc], ids[doc], missing[doc], -score, item))
        doc, item, score = doc[order], item[order], score[order]
        first = np.arange(len(item)) - np.searchsorted(item, item) < top
        return pa.table(
            [pa.array(cells.items[item[first]]), pa.array(cells.doc_rows[doc[first]]), cells.doc_ids.take(pa.array(doc[first])), pa.array(score[first])],
            names=["item", "doc_row", "doc_id", "score"],
        )

    return run


def search(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, shares: tuple[float, ...] = SHARES, block_documents: int = BLOCK_DOCUMENTS, most_terms: int = MOST_TERMS, most_items: int = MOST_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item with a score above 0."""
    spark = documents.sparkSession
    asked = item_terms(items, item_id, item_text)
    slots = asked.select(F.expr(f"CAST(term & {FILTER_BITS - 1} AS BIGINT)").alias("slot")).distinct().toArrow()  # FILTER_BITS rows at most
    bits = np.zeros(FILTER_BITS, bool)
    bits[slots.column("slot").to_numpy()] = True
    counted = document_terms(documents, np.packbits(bits, bitorder="little"), doc_id, text)
    size = counted.agg(F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count_if(F.size("terms") > 0).alias("held")).first()
    n_documents, total = size["documents"], max(1, size["total"])

    weight = F.floor(1000 * F.log(F.lit(2.0 * n_documents + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    owner = sum((F.when(F.col("df") >= F.lit(share * n_documents), 1).otherwise(0) for share in shares), F.lit(0))
    statistics = _statistics(counted, n_documents, total).select("term", "df", weight.alias("weight"), (weight * F.col("most")).alias("most"), owner.cast("long").alias("owner"))
    terms = written(asked.join(statistics, "term"), "term-pipeline-terms")  # those that some document holds
    frequent = terms.where("owner > 0").select("term", "owner").distinct().orderBy("term").toArrow()
    often, owned = frequent.column("term").to_numpy(), frequent.column("owner").to_numpy()

    sums = terms.agg(F.count("*").alias("terms"), F.count_distinct("item").alias("items")).first()
    bundles = max(1, math.ceil(sums["terms"] / most_terms), math.ceil(sums["items"] / most_items))
    per_bundle = max(1, math.ceil(sums["items"] / bundles))
    blocks = max(1, math.ceil(size["held"] / max(top, min(block_documents, MOST_CELLS // per_bundle))))

    def deal(batches):
        """Rows of one owner each: the document with its terms of that owner."""
        for batch in batches:
            term, row = _flat(batch, "terms")
            tf, _ = _flat(batch, "tfs")
            whose = _owners(term, often, owned)
            for k in range(len(shares) + 1):
                mine = whose == k
                sizes = np.bincount(row[mine], minlength=batch.num_rows)
                some = np.flatnonzero(sizes)
                kept = batch.take(pa.array(some))
                columns = [pa.array(np.full(len(some), k)), kept.column("doc_row"), kept.column("doc_id"), kept.column("n"), _lists(term[mine], sizes[some]), _lists(tf[mine], sizes[some])]
                yield pa.RecordBatch.from_arrays(columns, names=["owner", "doc_row", "doc_id", "n", "terms", "tfs"])

    index = written(counted.where("size(terms) > 0").mapInArrow(deal, f"owner long, {_DOCUMENT}"), "term-pipeline-index")
    index = index.withColumn("block", F.pmod(F.xxhash64("doc_row"), F.lit(blocks)))

    listed = terms.select(F.pmod(F.xxhash64("item"), F.lit(bundles)).alias("bundle"), F.struct("item", "term", "weight", "most", "owner").alias("t"))
    listed = listed.groupBy("bundle").agg(F.sort_array(F.collect_list("t")).alias("t"))
    listed = listed.select("bundle", *[F.col(f"t.{c}").alias(f"t_{c}") for c in ("item", "term", "weight", "most", "owner")])
    salts = blocks // 256 + 1
    salted = listed.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    places = spark.range(bundles * blocks).select((F.col("id") / blocks).cast("long").alias("bundle"), (F.col("id") % blocks).alias("block"))
    places = places.withColumn("salt", (F.col("block") % salts).cast("int"))
    none = [F.array().cast(kind).alias(name) for name, kind in (("doc_rows", "array<long>"), ("doc_ids", "array<long>"), ("at_doc", "array<int>"), ("at_item", "array<int>"), ("scores", "array<long>"), ("floors", "array<long>"))]
    carried = places.join(salted, ["bundle", "salt"]).select("bundle", "block", *[c for c in listed.columns if c != "bundle"], *none)
    for k in range(len(shares) + 1):
        postings = index.where(F.col("owner") == k).select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bundles - 1).cast("long"))).alias("bundle"), "block", "doc_row", "doc_id", "n", "terms", "tfs")
        body, schema = (_select, _BEST) if k == len(shares) else (_pass_on, _BUNDLE)
        carried = carried.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block")).applyInArrow(body(k, n_documents, total, top), schema)

    by = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "doc_row")
    best = carried.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    names = asked.select("item", "item_id").distinct()
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
