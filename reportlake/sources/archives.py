"""Zip archives of report CSVs.

Archives are read with ``binaryFile`` (one row per archive) and opened inside
a ``mapInPandas`` task with the standard ``zipfile`` module: Spark spreads the
archives over tasks, each task streams its entries line by line in batches,
so no archive passes through the driver. The central directory is checked
before anything is extracted: declared uncompressed total over ``max_bytes``
or an unreadable archive rejects it, a ratio over ``max_ratio`` is flagged.
Entries are flattened to their base name; ``__MACOSX`` metadata is skipped.
Records are read as RFC 4180 has them: a quoted line break doesn't end one.
``binaryFile`` holds one archive in memory, so archives must stay under 2 GiB.

For loading, an entry is a file with the path ``<archive>!/<entry>``: ``entry_listing`` lists them for a
catalog, ``entry_heads`` and ``entry_rows`` read them as a lake's files are read, and ``archive_rejects``
names the archives that the guard keeps out.
"""

from __future__ import annotations

import csv
import io
import zipfile
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.functions import values as V
from reportlake.sources import csvlake

# Fixed values that must equal the reference's for equal results.
MAX_UNCOMPRESSED = 1024 * 1024 * 1024  # 1 GiB
MAX_RATIO = 100
MAC_METADATA = "__MACOSX"

ENTRY_SCHEMA = (
    "archive string, entry string, entry_base string, file_size bigint, compress_size bigint, "
    "is_csv boolean, is_metadata boolean, archive_bytes bigint, error string"
)
LINE_SCHEMA = "archive string, entry string, line_no bigint, line string, is_head boolean"
LINE_BATCH = 50_000
#: Broken, encrypted or unknown compression, or text that is no CSV.
UNREADABLE = (zipfile.BadZipFile, zlib.error, csv.Error, RuntimeError, ValueError, OSError, EOFError)
ENTRY_MARK = "!/"  # between the path of an archive and that of its entry


def _read_archives(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
        .load(root).select("path", "length", "content")
    )


def _entries(batches):
    for pdf in batches:
        out = []
        for path, length, content in zip(pdf["path"], pdf["length"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for info in zf.infolist():
                        if info.is_dir():
                            continue
                        name = info.filename
                        out.append((
                            path, name, name.rsplit("/", 1)[-1], info.file_size, info.compress_size,
                            name.lower().endswith(".csv"), MAC_METADATA in name, int(length), None,
                        ))
            except zipfile.BadZipFile:
                out.append((path, None, None, None, None, False, False, int(length), "bad_zip"))
        yield pd.DataFrame(out, columns=[c.split()[0] for c in ENTRY_SCHEMA.split(", ")])


def archive_entries(spark: SparkSession, root: str, glob: str = "*.zip") -> DataFrame:
    """Central-directory entries of every archive (no entry is decompressed)."""
    return _read_archives(spark, root, glob).mapInPandas(_entries, ENTRY_SCHEMA)


def audit(entries: DataFrame, max_bytes: int = MAX_UNCOMPRESSED, max_ratio: float = MAX_RATIO) -> DataFrame:
    """Per archive: entries, CSV entries, uncompressed total, ratio and a status."""
    per = entries.groupBy("archive").agg(
        F.max("error").alias("error"),
        F.count("entry").alias("n_entries"),
        F.count_if(F.col("is_csv") & ~F.col("is_metadata")).alias("n_csv"),
        F.count_if(F.col("is_metadata")).alias("n_skipped"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("uncompressed_bytes"),
        F.max("archive_bytes").alias("archive_bytes"),
    )
    ratio = F.when(F.col("archive_bytes") > 0, F.col("uncompressed_bytes") / F.col("archive_bytes"))
    return per.withColumn("ratio", ratio).withColumn(
        "status",
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("uncompressed_bytes") > max_bytes, F.lit("too_large"))
        .when(F.col("n_csv") == 0, F.lit("no_csv"))
        .when(F.col("ratio") > max_ratio, F.lit("high_ratio"))
        .otherwise(F.lit("ok")),
    )


def _records(raw) -> Iterator[tuple[int, str, list[str]]]:
    """(number, text, cells) of every record of an entry that isn't blank."""
    csv.field_size_limit((1 << 31) - 1)
    consumed: list[str] = []

    def lines():
        for line in io.TextIOWrapper(raw, encoding="utf-8-sig", errors="replace", newline=""):
            consumed.append(line)
            yield line

    number = 0
    for cells in csv.reader(lines()):
        text = "".join(consumed).rstrip("\r\n")
        consumed.clear()
        if cells:
            yield number, text, cells
            number += 1


def _csv_entries(zf: zipfile.ZipFile) -> list[zipfile.ZipInfo]:
    return [i for i in zf.infolist() if not i.is_dir() and MAC_METADATA not in i.filename and i.filename.lower().endswith(".csv")]


def _titled(records: list[list[str]]) -> bool:
    """A title is a one-cell first record above a real (multi-cell) header."""
    return len(records) == 2 and len(records[0]) == 1 and len(records[1]) > 1


def _lines(max_bytes: int):
    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    zf = zipfile.ZipFile(io.BytesIO(content))
                except zipfile.BadZipFile:
                    continue  # ``audit`` names it
                with zf:
                    if sum(i.file_size for i in zf.infolist() if not i.is_dir()) > max_bytes:
                        continue  # rejected by the guard, nothing extracted
                    for info in _csv_entries(zf):
                        base = info.filename.rsplit("/", 1)[-1]
                        rows, first = [], []
                        with zf.open(info) as raw:
                            for n, text, cells in _records(raw):
                                first = [*first, cells] if n < 2 else first
                                rows.append((path, base, n, text, n == 0 or n == 1 and _titled(first)))
                                if len(rows) >= LINE_BATCH:
                                    yield pd.DataFrame(rows, columns=["archive", "entry", "line_no", "line", "is_head"])
                                    rows = []
                        if rows:
                            yield pd.DataFrame(rows, columns=["archive", "entry", "line_no", "line", "is_head"])

    return run


def archive_lines(spark: SparkSession, root: str, max_bytes: int = MAX_UNCOMPRESSED, glob: str = "*.zip") -> DataFrame:
    """Records of every CSV entry of every safe archive as text, titles and headers flagged ``is_head``."""
    return _read_archives(spark, root, glob).mapInPandas(_lines(max_bytes), LINE_SCHEMA)


def archive_rows(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Data lines parsed into all-STRING columns named ``columns`` (quoted fields handled by ``from_csv``)."""
    ddl = ", ".join(f"`{c}` string" for c in columns)
    parsed = F.from_csv(F.col("line"), ddl, {"mode": "PERMISSIVE", "quote": '"', "escape": '"', "multiLine": "true"})
    return lines.where(~F.col("is_head")).select(
        "archive", "entry", *[parsed[c].alias(c) for c in columns]
    )


def is_entry(path: str) -> bool:
    return ENTRY_MARK in path


def archive_paths(entries: list[str]) -> list[str]:
    return sorted({p.split(ENTRY_MARK, 1)[0] for p in entries})


def entry_listing(spark: SparkSession, root: str, max_bytes: int = MAX_UNCOMPRESSED, glob: str = "*.zip") -> DataFrame:
    """(path, length, modificationTime) of every CSV entry of every safe archive, as ``list_files`` gives files."""
    safe = audit(archive_entries(spark, root, glob), max_bytes).where("status IN ('ok', 'high_ratio')").select("archive")
    times = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root).select(F.col("path").alias("archive"), "modificationTime")
    entries = archive_entries(spark, root, glob).where("is_csv AND NOT is_metadata").join(safe, "archive").join(times, "archive")
    return entries.select(F.concat("archive", F.lit(ENTRY_MARK), "entry").alias("path"), F.col("file_size").alias("length"), "modificationTime")


def archive_rejects(spark: SparkSession, root: str, max_bytes: int = MAX_UNCOMPRESSED, glob: str = "*.zip") -> DataFrame:
    """(src_file, bytes, reason) of the archives that can't be loaded: bad_zip, too_large or no_csv."""
    found = audit(archive_entries(spark, root, glob), max_bytes).where("status NOT IN ('ok', 'high_ratio')")
    return found.select(csvlake.plain_path(F.col("archive")).alias("src_file"), F.col("archive_bytes").alias("bytes"), F.col("status").alias("reason"))


def _opened(spark: SparkSession, paths: list[str]) -> DataFrame:
    files = spark.read.format("binaryFile").load([csvlake.literal_path(p) for p in paths])
    return files.select(csvlake.source_file().alias("path"), "content")


def _entry_heads(batches):
    for pdf in batches:
        out = []
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for info in _csv_entries(zf):
                    first: list[list[str]] = []
                    readable = True
                    try:
                        with zf.open(info) as raw:
                            for _, _, cells in _records(raw):
                                first.append(cells)
                                if len(first) == 2:
                                    break
                    except UNREADABLE:
                        first, readable = [], False
                    out.append((f"{path}{ENTRY_MARK}{info.filename}", _titled(first), first[_titled(first)] if first else None, readable))
        yield pd.DataFrame(out, columns=["file_path", "has_title", "header", "readable"])


def entry_heads(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, has_title, header, columns, readable) of every CSV entry of the archives (``csvlake.file_heads``)."""
    heads = _opened(spark, paths).mapInPandas(_entry_heads, "file_path string, has_title boolean, header array<string>, readable boolean")
    named = V.normalize_names(F.concat(F.array(F.lit(N.PARTITION_KEY)), F.col("header")))
    return heads.select("file_path", "has_title", "header", F.when(F.col("header").isNotNull(), F.slice(named, 2, 1 << 30)).alias("columns"), "readable")


def _entry_cells(batches):
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as zf:
                for info in _csv_entries(zf):
                    name, rows = f"{path}{ENTRY_MARK}{info.filename}", []
                    try:
                        with zf.open(info) as raw:
                            for n, _, cells in _records(raw):
                                if n:
                                    rows.append((name, n - 1, [c or None for c in cells]))
                                if len(rows) >= LINE_BATCH:
                                    yield pd.DataFrame(rows, columns=["src_file", "_place", "cells"])
                                    rows = []
                    except UNREADABLE as e:
                        raise ValueError(f"unreadable entry {quote(name)} \n{e}") from e
                    yield pd.DataFrame(rows, columns=["src_file", "_place", "cells"])


def entry_rows(spark: SparkSession, paths: list[str], files: DataFrame, layouts: tuple[csvlake.Layout, ...], columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Rows of the archives' entries that ``files`` has, as ``csvlake.read_files`` gives those of files."""
    width = max(len(layout.columns) for layout in layouts)
    rows = _opened(spark, paths).mapInPandas(_entry_cells, "src_file string, _place long, cells array<string>")
    rows = rows.select("src_file", "_place", *[F.get("cells", F.lit(i)).alias(f"_c{i}") for i in range(width)])
    return csvlake.by_name(rows, files, layouts, columns, "src_file", width, ["src_file", *keep])
