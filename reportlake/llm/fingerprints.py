"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

A paragraph is a line; its leaves are its sentences, long ones cut every 200 characters. A
paragraph's hash is that of its leaves, a section's that of its paragraphs, the root's the SHA-256
of all sections. A section ends at a blank line or where a paragraph's hash is a multiple of
``SECTION``, so an edit changes only the branches around it. Equal texts have equal roots; unequal
ones are told apart by descending where hashes differ, and their likeness is the share of common
leaves, 2 * common / (both), of distinct leaves.

The printed fingerprint is ``root|section:leaf.leaf,leaf|section:...`` in hex: ``,`` ends a
paragraph, leaves show their last 32 bits. Everything is DataFrame functions.

Defined cases: null is the empty text, which has one empty paragraph, no leaves and likeness 1 to
another text without leaves; equal rows count each and have equal fingerprints; rows that share an
id are ordered by a hash of their text; an empty table gives an empty result; very long texts take
time in proportion. Columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportlake.llm.shared import written

PIECE = r"[^.!?]{1,200}[.!?]*|[.!?]+"
SECTION = 4


def _hex32(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h.bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")


def _hex64(h: Column) -> Column:
    return F.lpad(F.lower(F.hex(h)), 16, "0")


def with_tree(df: DataFrame, text: str, prefix: str) -> DataFrame:
    """Add ``<prefix>leaves`` (a list for each paragraph), ``<prefix>paragraphs``,
    ``<prefix>sections`` (struct: start, hash, size) and ``<prefix>root``."""
    leaves, paragraphs, sections = f"{prefix}leaves", f"{prefix}paragraphs", f"{prefix}sections"
    ends = f"{prefix}ends"
    df = df.withColumn(leaves, F.transform(F.split(F.coalesce(F.col(text), F.lit("")), "\n"), lambda p: F.transform(F.regexp_extract_all(p, F.lit(PIECE), 0), lambda x: F.xxhash64(x))))
    df = df.withColumn(paragraphs, F.transform(leaves, lambda x: F.xxhash64(x, F.size(x))))
    stops = F.filter(F.sequence(F.lit(1), F.size(paragraphs)), lambda k: (k == F.size(paragraphs)) | (F.size(F.element_at(F.col(leaves), k)) == 0) | (F.pmod(F.element_at(F.col(paragraphs), k), F.lit(SECTION)) == 0))
    df = df.withColumn(ends, stops)
    starts = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    df = df.withColumn(sections, F.transform(F.arrays_zip(starts.alias("a"), F.col(ends).alias("b")), lambda s: F.struct((s["a"] + 1).alias("start"), (s["b"] - s["a"]).alias("size"), F.xxhash64(F.slice(paragraphs, s["a"] + 1, s["b"] - s["a"]), s["b"] - s["a"]).alias("hash"))))
    return df.withColumn(f"{prefix}root", F.sha2(F.array_join(F.transform(sections, lambda s: _hex64(s["hash"])), ""), 256)).drop(ends)


def printed(prefix: str) -> Column:
    """The fingerprint of the tree columns as text."""
    body = lambda s: F.array_join(F.transform(F.slice(f"{prefix}leaves", s["start"], s["size"]), lambda p: F.array_join(F.transform(p, _hex32), ".")), ",")
    return F.array_join(F.concat(F.array(F.col(f"{prefix}root")), F.transform(f"{prefix}sections", lambda s: F.concat(_hex64(s["hash"]), F.lit(":"), body(s)))), "|")


def likeness(a: Column, b: Column) -> Column:
    """Share of common leaves of two distinct leaf lists, 0 to 1."""
    total = F.size(a) + F.size(b)
    return F.when(total == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def changed_sections(a: str, b: str) -> Column:
    """The sections of tree ``a`` whose hash tree ``b`` doesn't have: where to look for an edit."""
    other = F.transform(f"{b}sections", lambda s: s["hash"])
    return F.filter(f"{a}sections", lambda s: ~F.array_contains(other, s["hash"]))


def _distinct_leaves(prefix: str) -> Column:
    return F.array_distinct(F.flatten(f"{prefix}leaves"))


def next_rows(keys: DataFrame, *order: str) -> DataFrame:
    """``keys`` (distinct in ``order``) with the ``next_*`` columns of the following row; the last is
    followed by the first. Rows are dealt out by range, so only the first row of each range (one
    row a partition) comes together."""
    ranged = written(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ranges")
    here = Window.partitionBy("part").orderBy(*order)
    first = ranged.groupBy("part").agg(F.min(F.struct(*order)).alias("first"))
    whole = Window.orderBy("part")
    first = first.select("part", F.coalesce(F.lead("first").over(whole), F.first("first").over(whole)).alias("after"))
    joined = ranged.join(F.broadcast(first), "part")
    return joined.select(*keys.columns, *[F.coalesce(F.lead(c).over(here), F.when(F.row_number().over(here) == F.count("*").over(Window.partitionBy("part")), F.col(f"after.{c}"))).alias(f"next_{c}") for c in order])


def edit_report(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is replaced by as much
    of the start of the next document, with the likeness to both."""
    base = documents.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("body")).withColumn("h", F.xxhash64("body"))
    # one column that is never null: joins on it keep the exchange of the texts as it is
    key = lambda i, h: F.concat_ws(":", F.coalesce(i.cast("string"), F.lit("-")), h.cast("string"))
    order = next_rows(base.select("id", "h", F.length("body").cast("long").alias("n_chars")).distinct(), "id", "h")
    order = order.select(key(F.col("id"), F.col("h")).alias("of"), "id", "n_chars", key(F.col("next_id"), F.col("next_h")).alias("next_key"))
    placed = base.select(key(F.col("id"), F.col("h")).alias("key"), "body").repartition("key")
    once = placed.dropDuplicates(["key"]).select(F.col("key").alias("next_key"), F.col("body").alias("next_body"))
    asked = order.join(once, "next_key").select("of", "id", "n_chars", F.substring("next_body", F.lit(1), F.shiftright("n_chars", 1).cast("int")).alias("head"), "next_body")
    asked = with_tree(asked, "next_body", "n_").select("of", "id", "n_chars", "head", _distinct_leaves("n_").alias("next_leaves"))
    both = placed.join(asked, placed["key"] == asked["of"])
    keep = (F.col("n_chars") - F.shiftright("n_chars", 1)).cast("int")
    both = both.select("id", "n_chars", "body", F.concat(F.substring("body", F.lit(1), keep), "head").alias("edited"), "next_leaves")
    both = with_tree(with_tree(both, "body", "a_"), "edited", "b_")
    both = both.select("id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), printed("a_").alias("fingerprint"), printed("b_").alias("edited_fingerprint"), "next_leaves", _distinct_leaves("a_").alias("mine"), _distinct_leaves("b_").alias("theirs"))
    return both.select(F.col("id").alias(doc_id), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("mine"), F.col("theirs")).alias("near_edited"), likeness(F.col("mine"), F.col("next_leaves")).alias("near_next"))
