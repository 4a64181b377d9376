"""Benchmark decontamination with a generalised suffix automaton of the test items.

Items are normalised to lower-case words (ASCII letters and digits, and every character beyond
ASCII) and numbered; an automaton of all item word sequences then accepts every run of words of any
item. Training texts are streamed through it as word numbers, and after each word the automaton
holds the longest matching length. A word is hit if it lies in an occurrence of a window: ``window``
consecutive item words, or a whole item of fewer words.

Words that no item has, and neighbours that no item has side by side, bring the automaton back to
its start, so only the runs between them are streamed; runs too short for any window are left out,
which changes no hit.

The items are cut into blocks of ``block_words`` words. A block's automaton is built in the tasks
from its word numbers, which are the only thing sent to them; texts stream past one block after
the other, so memory doesn't grow with the benchmark.

Defined cases: a null, empty or wordless text has no words, no hits and longest match 0; items
without words are left out; repeated items each count in the list of matched items; repeated
documents are judged one by one; without items nothing is hit. Other columns are not read.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.llm import words as W
from reportlake.llm.shared import written

WINDOW = 10
BLOCK_WORDS = 1_000_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normalise(text: str | None) -> list[str]:
    return _WORD.findall((text or "").translate(_LOWER))


class Automaton:
    """Generalised suffix automaton of word-number sequences.

    State 0 is the start. ``length`` is the longest run of a state, ``link`` its longest suffix in
    another state, ``ends`` the items whose windows end there (filled for window-long runs)."""

    def __init__(self, items: list[list[int]], window: int):
        self.step: list[dict[int, int]] = [{}]
        self.length, self.link = [0], [-1]
        self.window = window
        for item in items:
            at = 0
            for word in item:
                at = self._extend(at, word)
        self.items: dict[tuple[int, int], set[int]] = defaultdict(set)
        self.whole: dict[int, set[int]] = defaultdict(set)
        for number, item in enumerate(items):
            size = min(window, len(item))
            state, matched = 0, 0
            for k, word in enumerate(item):
                state, matched = self.advance(state, matched, word)
                if k + 1 >= size:
                    self.items[self.suffix(state, size), size].add(number)
            if size < window:
                self.whole[size].add(number)
        self.sizes = sorted({size for _, size in self.items}, reverse=True)

    def _clone(self, p: int, q: int, word: int) -> int:
        copy = len(self.step)
        self.step.append(dict(self.step[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = copy
            p = self.link[p]
        return copy

    def _extend(self, last: int, word: int) -> int:
        if (q := self.step[last].get(word)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, q, word)
        new = len(self.step)
        self.step.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, word)
        return new

    def advance(self, state: int, matched: int, word: int) -> tuple[int, int]:
        """State and longest matching length after one more word."""
        while state and word not in self.step[state]:
            state = self.link[state]
            matched = self.length[state]
        if word in self.step[state]:
            return self.step[state][word], matched + 1
        return 0, 0

    def suffix(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of a run that is in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def windows(self, words: list[int]):
        """(end, window length, items, longest match) wherever a window ends in ``words``."""
        state = matched = 0
        for end, word in enumerate(words, 1):
            state, matched = self.advance(state, matched, word)
            for size in self.sizes:
                if matched >= size and (found := self.items.get((self.suffix(state, size), size))):
                    yield end, size, found, matched


def _block(rows: list, window: int) -> dict:
    """What tasks need of a block: sorted word hashes, their numbers, items and neighbours."""
    items, names = [], []
    for name, text in rows:
        if found := normalise(text):
            items.append(np.array([W.hash_text(w) for w in found], np.uint64))
            names.append("" if name is None else str(name))
    vocabulary = np.unique(np.concatenate(items)) if items else np.zeros(0, np.uint64)
    numbered = [np.searchsorted(vocabulary, x).astype(np.int64) for x in items]
    pairs = [x[:-1] * len(vocabulary) + x[1:] for x in numbered if len(x) > 1]
    return {
        "vocabulary": vocabulary,
        "items": [x.tolist() for x in numbered],
        "names": names,
        "pairs": np.unique(np.concatenate(pairs)) if pairs else np.zeros(0, np.int64),
        "least": min([window, *map(len, numbered)]),
        "window": window,
    }


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values


def _matches(hashes: np.ndarray, owner: np.ndarray, block: dict, automaton: Automaton):
    """(first word, end word, items, longest match) of every window, words counted over the slice."""
    vocabulary, n = block["vocabulary"], len(hashes)
    if not n or not len(vocabulary):
        return
    number = np.searchsorted(vocabulary, hashes)
    number[number == len(vocabulary)] = 0
    known = vocabulary[number] == hashes
    joined = known[:-1] & known[1:] & (owner[:-1] == owner[1:])
    at = np.flatnonzero(joined)
    joined[at] = _member(number[at] * len(vocabulary) + number[at + 1], block["pairs"])
    opens = np.flatnonzero(known & ~np.concatenate([[False], joined]))
    closes = np.flatnonzero(known & ~np.concatenate([joined, [False]])) + 1
    long = closes - opens >= block["least"]
    for a, b in zip(opens[long].tolist(), closes[long].tolist()):
        for end, size, found, matched in automaton.windows(number[a:b].tolist()):
            yield a + end - size, a + end, found, matched


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


_FOUND = "n_words long, spans array<struct<start:int,end:int>>, chars array<struct<start:int,end:int>>, items array<string>, longest int"


def _scan_block(documents: DataFrame, block, kind: str) -> DataFrame:
    def scan(batches):
        content = block.value
        automaton = Automaton(content["items"], content["window"])
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in W.slices(batches):
            data, offsets = W.text_buffers(batch.column("text"))
            starts, ends, owner = W.word_spans(data, offsets, W.ALNUM)
            n_words = np.bincount(owner, minlength=batch.num_rows)
            first = np.concatenate([[0], np.cumsum(n_words)])
            hits: dict[int, list] = defaultdict(list)
            items: dict[int, set] = defaultdict(set)
            longest = np.zeros(batch.num_rows, np.int32)
            for s, e, found, matched in _matches(W.word_hashes(data, starts, ends), owner, content, automaton):
                row = int(owner[s])
                hits[row].append((s, e))
                items[row] |= found
                longest[row] = max(longest[row], matched)
            rows, chars = [[] for _ in n_words], [[] for _ in n_words]
            for row, found in hits.items():
                lead = (data[offsets[row] : offsets[row + 1]] & 0xC0) != 0x80
                points = np.concatenate([[0], np.cumsum(lead)])
                for s, e in _merged(found):
                    rows[row].append({"start": int(s - first[row]), "end": int(e - first[row])})
                    chars[row].append({"start": int(points[starts[s] - offsets[row]]), "end": int(points[ends[e - 1] - offsets[row]])})
            names = [sorted({content["names"][k] for k in items[row]}) if row in items else [] for row in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(n_words, pa.int64()), pa.array(rows, spans_type), pa.array(chars, spans_type), pa.array(names, pa.list_(pa.string())), pa.array(longest)], names=["id", "n_words", "spans", "chars", "items", "longest"])

    return documents.mapInArrow(scan, f"id {kind}, {_FOUND}")


def item_blocks(items: DataFrame, item_id: str, text: str, window: int, block_words: int):
    """The items in blocks of about ``block_words`` words, one in memory at a time."""
    rows = items.select(F.col(item_id).cast("string").alias("i"), F.col(text).cast("string").alias("t")).where("t IS NOT NULL")
    total = rows.select(F.sum(F.length("t"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (5 * block_words)))
    for k in range(blocks):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k)
        yield _block(part.orderBy("i", "t").collect(), window)


def match_items(documents: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id``, n_words, hit word spans, the same spans in code points, item ids and the longest
    match of every document, one row each.

    With more than one block the rows are written under a number, by which the blocks' spans are
    merged; one block needs no shuffle at all."""
    spark = documents.sparkSession
    rows = documents.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    blocks = [spark.sparkContext.broadcast(content) for content in item_blocks(items, item_id, item_text, window, block_words)]
    if len(blocks) == 1:
        return _scan_block(rows, blocks[0], kind).withColumnRenamed("id", doc_id)
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    rows = rows.select(F.struct("row", "id").alias("id"), "text")
    found = _scan_block(rows, blocks[0], f"struct<row:bigint,id:{kind}>")
    for block in blocks[1:]:
        found = found.unionByName(_scan_block(rows, block, f"struct<row:bigint,id:{kind}>").where("size(spans) > 0"))
    return _merge_blocks(found).withColumn("id", F.col("id.id")).withColumnRenamed("id", doc_id)


def _merge_blocks(found: DataFrame) -> DataFrame:
    """One row for each id, which must be a row's own: spans of all blocks laid together as those of
    one block are, by their words."""
    both = F.transform(F.arrays_zip("spans", "chars"), lambda x: F.struct(x["spans"]["start"].alias("start"), x["spans"]["end"].alias("end"), x["chars"]["start"].alias("first"), x["chars"]["end"].alias("last")))

    def add(acc, span):
        last = F.element_at(acc, -1)
        grow = (F.size(acc) > 0) & (span["start"] <= last["end"])
        merged = F.struct(last["start"].alias("start"), F.greatest(last["end"], span["end"]).alias("end"), last["first"].alias("first"), F.greatest(last["last"], span["last"]).alias("last"))
        return F.when(F.size(acc) == 0, F.array(span)).when(grow, F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(merged))).otherwise(F.concat(acc, F.array(span)))

    merged = F.aggregate(F.sort_array(F.flatten(F.collect_list(both))), F.expr("CAST(array() AS array<struct<start:int,end:int,first:int,last:int>>)"), add)
    out = found.groupBy("id").agg(F.max("n_words").alias("n_words"), merged.alias("both"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.max("longest").alias("longest"))
    spans = F.transform("both", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))
    chars = F.transform("both", lambda x: F.struct(x["first"].alias("start"), x["last"].alias("end")))
    return out.select("id", "n_words", spans.alias("spans"), chars.alias("chars"), "items", "longest")


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(doc_id, "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


def remove_matches(documents: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, max_coverage: float = 0.8, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The same columns with hit spans cut out of ``text``; a document whose hit words are more
    than ``max_coverage`` of its words goes. A cut leaves one blank. Null texts stay.

    With more than one block the spans of all of them are found in the original texts, written
    under a row number, and merged before anything is cut."""
    spark = documents.sparkSession
    at, schema = documents.columns.index(text), documents.schema

    def cut(batch, data, offsets, starts, ends, owner, hits):
        """The batch's first columns, with merged word spans (counted over the slice) cut out."""
        n_words = np.bincount(owner, minlength=batch.num_rows)
        texts, keep = batch.column(at).to_pylist(), np.ones(batch.num_rows, bool)
        for row, merged in hits.items():
            keep[row] = sum(e - s for s, e in merged) <= max_coverage * n_words[row]
            parts, over = [], int(offsets[row])
            for s, e in merged:
                parts += [data[over : starts[s]].tobytes(), b" "]
                over = int(ends[e - 1])
            texts[row] = b"".join([*parts, data[over : offsets[row + 1]].tobytes()]).decode()
        columns = [pa.array(texts, pa.string()) if k == at else batch.column(k) for k in range(len(schema))]
        return pa.RecordBatch.from_arrays(columns, names=schema.names).filter(pa.array(keep))

    def clean(batches):
        content = blocks[0].value
        automaton = Automaton(content["items"], content["window"])
        for batch in W.slices(batches, text):
            data, offsets = W.text_buffers(batch.column(at))
            starts, ends, owner = W.word_spans(data, offsets, W.ALNUM)
            hits: dict[int, list] = defaultdict(list)
            for s, e, _, _ in _matches(W.word_hashes(data, starts, ends), owner, content, automaton):
                hits[int(owner[s])].append((s, e))
            yield cut(batch, data, offsets, starts, ends, owner, {row: _merged(found) for row, found in hits.items()})

    def clean_given(batches):
        for batch in W.slices(batches, text):
            data, offsets = W.text_buffers(batch.column(at))
            starts, ends, owner = W.word_spans(data, offsets, W.ALNUM)
            first = np.searchsorted(owner, np.arange(batch.num_rows))
            hits = {row: [(int(first[row]) + x["start"], int(first[row]) + x["end"]) for x in spans] for row, spans in enumerate(batch.column(len(schema)).to_pylist()) if spans}
            yield cut(batch, data, offsets, starts, ends, owner, hits)

    blocks = [spark.sparkContext.broadcast(content) for content in item_blocks(items, item_id, item_text, window, block_words)]
    if len(blocks) == 1:
        return documents.mapInArrow(clean, schema)
    number, spans = "decontaminate_row", "decontaminate_spans"
    numbered = written(documents.withColumn(number, F.monotonically_increasing_id()), "decontaminate-rows")
    rows = numbered.select(F.col(number).alias("id"), F.col(text).cast("string").alias("text"))
    found = None
    for block in blocks:
        part = _scan_block(rows, block, "bigint").where("size(spans) > 0")
        found = part if found is None else found.unionByName(part)
    found = _merge_blocks(found).select(F.col("id").alias(number), F.col("spans").alias(spans))
    return numbered.join(found, number, "left").select(*documents.columns, spans).mapInArrow(clean_given, schema)
