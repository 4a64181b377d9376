"""Reading report lakes: gzip CSV files under ``report_date=`` folders, with mixed layouts.

Files of a lake need not agree: some carry a one-cell title row above the header, some do not,
columns may change their order or number, and names do not tell. ``file_heads`` takes the header
of every file from its first bytes, and ``read_raw`` reads all files in one scan: the reader drops
record 1 of each file (title or header), record 2 goes where it is the header under a title (by its
place, not by its value, so a data row equal to the header stays), and cells are mapped to columns by
the names in their own file's header.

gzip is not splittable, so parallelism is one task per file; partition
filters on ``report_date`` prune whole folders before any file is opened.
"""

from __future__ import annotations

import csv
import io
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions import names as N
from reportlake.functions import values as V
from reportlake.session import shared_dir

GZ_GLOB = "*.csv.gz"
SCHEMA_DIR = "_schema"  # beside landed data: its columns in order
#: RFC 4180: doubled quotes, quoted line breaks. gzip isn't splittable, so multiLine costs no task.
CSV_READ = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "PERMISSIVE"}
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"', "compression": "gzip", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@dataclass(frozen=True)
class Layout:
    header: list[str]  # raw cells of the header row
    columns: list[str]  # normalised, de-duplicated, never clashing with the partition key
    n_files: int
    n_titled: int
    last_path: str = ""  # the greatest path with this header, and whether that file has a title
    last_titled: bool = False
    n_bytes: int = 0  # of the per-file rows of these files, about


@dataclass(frozen=True)
class LakeHead:
    newest_path: str
    header: list[str]  # raw cells of the newest file's header row
    has_title: bool
    columns: list[str]  # of all files: the newest file's, then what other files have besides
    layouts: tuple[Layout, ...] = ()  # one for each distinct header; none for folders landed by us
    files: DataFrame | None = None  # file_path, has_title, header, columns of every file


def plain_path(path: Column) -> Column:
    """A listed path with one slash after ``file:``; listings aren't URL-encoded."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def source_file() -> Column:
    """The plain path of the file a row comes from (always encoded in the scan's metadata)."""
    path = F.col("_metadata.file_path")
    encoded = F.replace(path, F.lit("+"), F.lit("%2B"))  # a plus is no blank here
    plain = F.when(path.contains("%"), F.url_decode(encoded)).otherwise(path)  # for every row, so no more than needed
    return F.when(plain.startswith("file:/"), F.concat(F.lit("file:/"), F.ltrim(F.substring(plain, 7, CONTENT_LIMIT), F.lit("/")))).otherwise(plain)


def literal_path(path: str) -> str:
    """A path for a reader: characters that globs give a meaning are escaped."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)


LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


SHARES_PER_CORE = 8


@contextmanager
def listed_in_shares(spark: SparkSession):
    """Readers made here list their paths in a few tasks a core. Spark gives each of up to 10,000 paths a
    task of its own, which costs more than the listing."""
    before = spark.conf.get(LISTING_TASKS)
    spark.conf.set(LISTING_TASKS, str(min(int(before), SHARES_PER_CORE * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(LISTING_TASKS, before)


def in_shares(files: DataFrame) -> DataFrame:
    """One row a file, to be written by a few tasks a core: a scan of many small files has a task, and its
    output a file, for some dozens of them."""
    return files.coalesce(SHARES_PER_CORE * files.sparkSession.sparkContext.defaultParallelism)


def folder_columns(spark: SparkSession, dest: str) -> list[str]:
    """The data columns of a folder that was landed by us, in order ([] for any other folder)."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{dest}/{SCHEMA_DIR}")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return []
    kept = spark.read.schema("position int, column_name string").parquet(f"{dest}/{SCHEMA_DIR}")
    first = kept.groupBy("column_name").agg(F.min("position").alias("position"))
    return [r["column_name"] for r in first.orderBy("position", "column_name").collect()]  # one row a column


PREFIX = 64 << 10  # stored bytes that show the first two records of nearly every file
CONTENT_LIMIT = (1 << 31) - 1  # a file of more is read as text lines
HEAD_SCHEMA = "file_path string, has_title boolean, header array<string>, settled boolean, readable boolean"


def _first_records(raw: bytes, complete: bool, packed: bool) -> tuple[list[list[str]], bool]:
    """The first two records that aren't blank, and whether the bytes suffice to tell them."""
    text, left = b"" if packed else raw, raw if packed else b""
    while left:  # gzip members one after the other
        member = zlib.decompressobj(31)
        text += member.decompress(left)
        left = member.unused_data
    if not complete:
        text = text[: text.rfind(b"\n") + 1]
    lines = io.StringIO(text.decode("utf-8-sig", "replace"), newline="")
    size = lines.seek(0, io.SEEK_END)
    lines.seek(0)
    found: list[list[str]] = []
    for record in csv.reader(iter(lines.readline, "")):
        if any(cell.strip() for cell in record):
            found.append(record)
        if len(found) == 2:
            break
    return found, complete or len(found) == 2 and lines.tell() < size


def _heads(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    csv.field_size_limit(CONTENT_LIMIT)
    for frame in frames:
        out = []
        for path, length, packed, start in zip(frame["file_path"], frame["length"], frame["packed"], frame["start"]):
            try:
                records, settled = _first_records(bytes(start), len(start) == length, packed)
                readable = True
            except (zlib.error, csv.Error):  # no header, as for an empty file
                records, settled, readable = [], True, False
            # A title is a one-cell first record above a real (multi-cell) header.
            titled = len(records) == 2 and len(records[0]) == 1 and len(records[1]) > 1
            out.append((path, titled, records[titled] if records else None, settled, readable))
        yield pd.DataFrame(out, columns=["file_path", "has_title", "header", "settled", "readable"])


def file_heads(spark: SparkSession, root: str | None, glob: str | None = GZ_GLOB, paths: list[str] | None = None, recursive: bool = False, longest: int | None = None) -> DataFrame:
    """(file_path, has_title, header, columns, readable) of every file, as a written table; header is
    null where a file is empty or its start can't be read.

    The stored bytes of each file are read, but only their first PREFIX go to Python and are
    decompressed, the whole only of files whose first two records don't end there. ``longest``: the
    length of the longest file, if it is known.
    """
    def reader(kind: str):
        r = spark.read.format(kind)
        if recursive:
            r = r.option("recursiveFileLookup", "true")
        if glob is not None and paths is None:
            r = r.option("pathGlobFilter", glob)
        return r

    def start_of(files: DataFrame, most: int) -> DataFrame:
        small = files.where(F.col("length") <= CONTENT_LIMIT)
        return small.select(source_file().alias("file_path"), "length", source_file().endswith(".gz").alias("packed"), F.substring("content", 1, most).alias("start"))

    where = [literal_path(p) for p in paths] if paths is not None else root
    with listed_in_shares(spark):
        files = reader("binaryFile").load(where)
    starts = start_of(files, PREFIX)
    large = []
    if longest is None or longest > CONTENT_LIMIT:
        large = [r["p"] for r in files.where(F.col("length") > CONTENT_LIMIT).select(source_file().alias("p")).collect()]
    if large:
        lines = file_layouts(spark, None, paths=large)
        shown = F.encode(F.concat("first_line", F.lit("\n"), F.when(F.col("has_title"), F.col("header_line")).otherwise("")), "UTF-8")
        starts = starts.unionByName(lines.select("file_path", F.length(shown).cast("long").alias("length"), F.lit(False).alias("packed"), shown.alias("start")))
    kept = shared_dir(spark, "file-heads")

    def settle(some: DataFrame, name: str) -> tuple[DataFrame, int]:
        """Heads as a table with their normalised columns, and how many aren't settled."""
        named = V.normalize_names(F.concat(F.array(F.lit(N.PARTITION_KEY)), F.col("header")))
        heads = in_shares(some).mapInPandas(_heads, HEAD_SCHEMA).withColumn("columns", F.when(F.col("header").isNotNull(), F.slice(named, 2, CONTENT_LIMIT)))
        seen = Observation()
        heads.observe(seen, F.count_if(~F.col("settled")).alias("open")).write.parquet(f"{kept}/{name}")
        return spark.read.schema(heads.schema).parquet(f"{kept}/{name}"), seen.get["open"] or 0

    heads, still_open = settle(starts, "first")
    if still_open:
        unsettled = [r["file_path"] for r in heads.where("NOT settled").select("file_path").collect()]
        with listed_in_shares(spark):
            again = spark.read.format("binaryFile").load([literal_path(p) for p in unsettled])
        whole, _ = settle(start_of(again, CONTENT_LIMIT), "whole")
        heads = heads.where("settled").unionByName(whole)
    return heads.select("file_path", "has_title", "header", "columns", "readable")


def layouts_of(heads: DataFrame) -> tuple[Layout, ...]:
    """The distinct headers of some files, the one of the greatest path first: one row a header."""
    found = heads.where("header IS NOT NULL").groupBy("header", "columns").agg(
        F.max(F.struct("file_path", "has_title")).alias("last"), F.count(F.lit(1)).alias("n"), F.count_if("has_title").alias("titled"), F.sum(F.length("file_path") + 200).alias("size"))
    return tuple(Layout(r["header"], r["columns"], r["n"], r["titled"], *r["last"], r["size"]) for r in found.orderBy(F.desc("last")).collect())


def united(layouts: tuple[Layout, ...], known: list[str] | None = None) -> list[str]:
    """The columns of all layouts, those known first, in the order of their first layout."""
    return list(dict.fromkeys([*(known or []), *[c for layout in layouts for c in layout.columns]]))


def lake_head(spark: SparkSession, root: str, glob: str = GZ_GLOB, recursive: bool = False) -> LakeHead | None:
    """The headers of all files of a folder, or the kept columns of a folder that was landed by us;
    ``None`` when the folder has no file or none has a header."""
    from reportlake.operators.catalog import list_files

    listed = list_files(spark, root, glob).agg(F.max("path").alias("newest"), F.max("length").alias("longest")).first()
    if listed["newest"] is None:
        return None
    if known := folder_columns(spark, root):
        columns = ["src_file", *known]
        return LakeHead(listed["newest"], columns, False, columns)
    heads = file_heads(spark, root, glob, recursive=recursive, longest=listed["longest"])
    layouts = layouts_of(heads)
    if not layouts:
        return None
    return LakeHead(layouts[0].last_path, layouts[0].header, layouts[0].last_titled, united(layouts), layouts, heads)


def _string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


@F.pandas_udf(T.LongType())
def _place_in_run(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """0, 1, 2, ... for each run of equal keys; runs go on over batches. A scan gives the rows of a file
    that isn't split one after the other, so this numbers the rows of each file. Only the key goes
    to Python."""
    last, count = None, 0
    for some in keys:
        values = some.to_numpy()
        if not len(values):
            yield pd.Series([], dtype="int64")
            continue
        new = np.flatnonzero(np.concatenate([[last is None or values[0] != last], values[1:] != values[:-1]]))
        first = np.zeros(len(values), np.int64)
        first[new] = new
        place = np.arange(len(values)) - np.maximum.accumulate(first)
        go_on = new[0] if len(new) else len(values)
        place[:go_on] += count
        last, count = values[-1], int(place[-1]) + 1
        yield pd.Series(place)


#: Bytes of a per-file table up to which it is sent to all tasks; beyond, the rows are joined with it.
SENT_BYTES = 32 << 20


def by_name(rows: DataFrame, files: DataFrame, layouts: tuple[Layout, ...], columns: list[str], key: str, width: int, keep: list[str]) -> DataFrame:
    """Rows of cells ``_c0``, ``_c1``, ... to the named ``columns`` of their own file's header.

    ``files`` has ``key``, has_title and columns. Rows come without the first record of their file;
    those of titled files also lose the next one, the header (place 0). Rows of files that ``files`` doesn't have are left
    out. ``keep``: other columns of ``rows`` or ``files`` that stay.
    """
    titled = any(layout.n_titled for layout in layouts)
    drifted = any(layout.columns != columns for layout in layouts)
    if titled and "_place" not in rows.columns:
        rows = rows.withColumn("_place", _place_in_run(F.xxhash64(key)))
    known = rows.columns
    if titled or drifted or set(keep) - set(known):
        places = F.transform(F.array(*[F.lit(c) for c in columns]), lambda c: F.array_position("columns", c).cast("int") - 1)
        extra = [c for c in keep if c not in known]
        each = files.select(key, "has_title", places.alias("_places"), *extra)
        small = sum(layout.n_bytes for layout in layouts) <= SENT_BYTES
        rows = rows.join(F.broadcast(each) if small else each, key)
    stays = ~(F.col("has_title") & (F.col("_place") == 0)) if titled else None
    cells = F.array(*[F.col(f"_c{i}") for i in range(width)])
    out = []
    for k, c in enumerate(columns):
        cell = F.get(cells, F.get("_places", F.lit(k))) if drifted else F.col(f"_c{k}")
        # a row's cells depend on its place, so no filter on them moves below the numbering
        out.append((F.when(stays, cell) if titled else cell).alias(c))
    if titled:
        rows = rows.where(stays)
    return rows.select(*out, *keep)


def read_raw(
    spark: SparkSession,
    root: str,
    head: LakeHead,
    glob: str = GZ_GLOB,
    with_source: bool = True,
    recursive: bool = False,
) -> DataFrame:
    """All-STRING rows of every file under ``root``, titles and headers removed per file, cells by the
    names of their own file's header (S11, S12).

    Short rows give NULL cells, extra cells are dropped (PERMISSIVE). The ``report_date`` partition
    column comes from the folder names, and filters on it prune folders.
    """
    reader = spark.read.options(**CSV_READ).option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if not head.layouts:  # landed by us: one order of columns, no titles
        df = reader.schema(_string_schema(head.columns)).csv(root)
        return df.withColumn("src_file", source_file()) if with_source and "src_file" not in head.columns else df
    width = max(len(layout.columns) for layout in head.layouts)
    rows = reader.schema(_string_schema([f"_c{i}" for i in range(width)])).csv(literal_path(root) if root == head.newest_path else root)
    others = [c for c in rows.columns if not c.startswith("_c")]
    rows = rows.withColumn("file_path", source_file())
    df = by_name(rows, head.files, head.layouts, head.columns, "file_path", width, [*others, "file_path"])
    return df.withColumnRenamed("file_path", "src_file") if with_source else df.drop("file_path")


def read_files(spark: SparkSession, paths: list[str], files: DataFrame, layouts: tuple[Layout, ...], columns: list[str], keep: list[str] = ()) -> DataFrame:
    """Rows of the given files in one scan, all STRING, as the named ``columns``, with ``src_file`` and
    what ``keep`` names of ``files`` (src_file, has_title, columns, ...)."""
    width = max(len(layout.columns) for layout in layouts)
    with listed_in_shares(spark):
        rows = spark.read.schema(_string_schema([f"_c{i}" for i in range(width)])).options(**CSV_READ).csv([literal_path(p) for p in paths])
    return by_name(rows.withColumn("src_file", source_file()), files, layouts, columns, "src_file", width, ["src_file", *keep])


TYPE_TO_SPARK = {
    "INT64": T.LongType(),
    "BOOL": T.BooleanType(),
    "BIGNUMERIC": T.DecimalType(38, 18),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "STRING": T.StringType(),
}


def typed_value(raw: Column, type_name: str, strings_null_tokens: bool = False) -> Column:
    """One raw cell to its inferred type; text that does not convert becomes NULL."""
    v = V.null_if_token(raw)
    if type_name == "INT64":
        return v.try_cast("bigint")
    if type_name == "BOOL":
        lc = F.lower(v)
        return F.when(lc.isin("true", "yes", "1"), F.lit(True)).when(lc.isin("false", "no", "0"), F.lit(False))
    if type_name == "BIGNUMERIC":
        return v.try_cast(T.DecimalType(38, 18))
    if type_name == "TIMESTAMP":
        return F.try_to_timestamp(F.translate(v, "/", "-"))
    if type_name == "DATE":
        return F.try_to_date(F.translate(v, "/", "-"), "yyyy-MM-dd")
    return v if strings_null_tokens else raw


def apply_types(
    raw: DataFrame, columns: list[str], types: list[str], on_error: str = "null", strings_null_tokens: bool = False
) -> DataFrame:
    """Typed projection of an all-STRING frame.

    ``on_error``: ``'null'`` leaves failed conversions NULL; ``'quarantine'``
    adds ``_rejected`` (names of columns whose non-null text did not convert);
    ``'fail'`` raises when any row has a rejected cell (one bounded check,
    ``limit(1)``, before the frame is returned).
    """
    if on_error == "fail":
        checked = apply_types(raw, columns, types, "quarantine", strings_null_tokens)
        bad = checked.where(F.size("_rejected") > 0).limit(1).collect()
        if bad:
            raise ValueError(f"cells that do not convert to the inferred type: {bad[0]['_rejected']}")
        return checked.drop("_rejected")
    typed = [typed_value(F.col(c), t, strings_null_tokens).alias(c) for c, t in zip(columns, types)]
    keep = [c for c in raw.columns if c not in columns]
    out = raw.select(*typed, *keep, *[F.col(c).alias(f"__raw_{c}") for c in columns])
    if on_error == "quarantine":
        bad = [
            F.when(V.null_if_token(F.col(f"__raw_{c}")).isNotNull() & F.col(c).isNull(), F.lit(c))
            for c, t in zip(columns, types)
            if t != "STRING"
        ]
        out = out.withColumn("_rejected", F.filter(F.array(*bad), lambda x: x.isNotNull()) if bad else F.array())
    elif on_error != "null":
        raise ValueError("on_error must be 'null', 'quarantine' or 'fail'")
    return out.drop(*[f"__raw_{c}" for c in columns])


def file_layouts(spark: SparkSession, root: str | None, glob: str = GZ_GLOB, paths: list[str] | None = None) -> DataFrame:
    """Per file: first line, header line, field count of line 1 and the title flag.

    One text scan keeps the first split of each file and numbers its lines that aren't blank with
    ``monotonically_increasing_id`` (consecutive in a split). A partial aggregate per file takes line 1;
    only files whose line 1 has one field need line 2, the one with the next number, from a second
    scan. Nothing is collected. A file is titled when line 1 has one field and line 2 has more.
    """
    fields = lambda line: F.size(F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)')).cast("bigint")
    # a file that breaks off still shows its first lines here; reading its rows fails
    reader = spark.read.option("ignoreCorruptFiles", "true")
    scan = reader.text([literal_path(p) for p in paths]) if paths is not None else reader.option("pathGlobFilter", glob).text(root)
    lines = (
        scan.where((F.col("_metadata.file_block_start") == 0) & (F.trim("value") != ""))
        .select(source_file().alias("file_path"), F.monotonically_increasing_id().alias("i"), "value")
    )
    first = lines.groupBy("file_path").agg(F.min(F.struct("i", "value")).alias("a"))
    first = first.select("file_path", F.col("a.i").alias("i"), F.col("a.value").alias("first_line"), fields(F.col("a.value")).alias("first_fields"))
    asked = first.where("first_fields = 1").select("file_path", (F.col("i") + 1).alias("i"))
    second = lines.join(asked, ["file_path", "i"]).select("file_path", F.col("value").alias("second_line"))
    titled = (F.col("first_fields") == 1) & F.coalesce(fields(F.col("second_line")) > 1, F.lit(False))
    return first.join(second, "file_path", "left").select(
        "file_path", "first_line", "first_fields", titled.alias("has_title"),
        F.when(titled, F.col("second_line")).otherwise(F.col("first_line")).alias("header_line"),
    )
