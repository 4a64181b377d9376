"""The file catalog as a DataFrame: listing, source matching, name parsing, and the
set/aggregate operators over it (duplicates, versions, diffs, folder summaries).

Scale notes
- Source matching turns each spec into literal tests (``contains``/``endswith``
  for the usual ``*base*ext`` globs, regex only for real wildcards) inside one
  projection (an array of per-source hit structs, exploded). No join, no
  shuffle, and each regex compiles once per task, whatever the catalog size.
- Grouped reports use ``groupBy`` with partial aggregation; lists are bounded
  (top-3 samples via a row_number limit that Spark applies before the shuffle).
- Diffs are anti/semi joins on names; AQE picks broadcast for a small side at
  run time and splits skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions import names as N
from reportlake.sources.specs import SourceSpec, exclude_glob, glob_condition, glob_to_regex, include_glob

LISTING_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType(), False),
        T.StructField("length", T.LongType(), True),
        T.StructField("modificationTime", T.TimestampType(), True),
    ]
)

# Attributes that get their own catalog columns; other regex groups stay in ``attrs``.
OWNER_GROUP = "content_owner"
DATE_GROUP = "file_date_key"
VERSION_GROUP = "file_version"


# ---------------------------------------------------------------- S1 / S7 listing


def list_files(spark: SparkSession, root: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Recursive listing of a tree as ``path, length, modificationTime`` (content never read).

    ``binaryFile`` with only metadata columns selected prunes the content
    column from the scan. Spark's file index hides ``_``/``.`` names itself.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select("path", "length", "modificationTime")


def with_prefix(listing: DataFrame, prefix: str, path_col: str = "path") -> DataFrame:
    """Everything under a prefix."""
    return listing.where(F.col(path_col).startswith(prefix))


# ---------------------------------------------------------------- S2-S4, J5 matching


def _selected(name_lc: Column, spec: SourceSpec, extension: str | None) -> Column:
    cond = glob_condition(name_lc, include_glob(spec, extension))
    exc = exclude_glob(spec)
    if exc is not None:
        cond = cond & ~glob_condition(name_lc, exc)
    return cond


def _source_match(spec: SourceSpec, i: int, name: Column) -> Column:
    """Struct computed once per (file, source): index, pattern hit, regex groups as a map."""
    if spec.regex_pattern and spec.regex_group_names:
        pat = "^(?:" + spec.regex_pattern + ")"
        groups = list(spec.regex_group_names)
        ok = name.rlike(pat)
        attrs = F.map_from_arrays(
            F.array(*[F.lit(g) for g in groups]),
            F.array(*[F.regexp_extract(name, pat, j + 1) for j in range(len(groups))]),
        )
    else:
        ok = F.lit(True)
        attrs = F.create_map().cast("map<string,string>")
    return F.struct(F.lit(i).alias("source_idx"), ok.alias("name_ok"), attrs.alias("attrs"))


def match_sources(
    files: DataFrame, specs: list[SourceSpec], extension: str | None = None, name_col: str = "file_name"
) -> DataFrame:
    """One row per (file, enabled source whose selectors take the file), with ``source_idx``.

    Include is a case-insensitive "contains" glob (plus extension), exclude
    likewise; lock files never match. A file taken by two sources appears twice.
    Each hit is a struct built before the explode, so every regex runs once per
    (file, source) and later expressions only read fields of the exploded column.
    """
    enabled = [(i, s) for i, s in enumerate(specs) if s.is_enabled]
    name = F.col(name_col)
    lc = F.lower(name)
    not_lock = ~N.is_lock_file(name)
    hits = F.array(*[F.when(_selected(lc, s, extension) & not_lock, _source_match(s, i, name)) for i, s in enabled])
    # explode_outer + a filter on the generated column: a plain explode makes Spark infer
    # size(array) > 0 and push it below the projections, evaluating every test twice.
    return (
        files.select("*", F.explode_outer(F.filter(hits, lambda x: x.isNotNull())).alias("_m"))
        .where(F.col("_m").isNotNull())
        .select("*", F.col("_m.source_idx").alias("source_idx"))
    )


def _spec_lookup(specs: list[SourceSpec], idx: Column, attr: str) -> Column:
    values = [getattr(s, attr) for s in specs]
    arr = F.array(*[F.lit(v).cast("string") for v in values])
    return F.element_at(arr, idx + 1)


def enrich(matched: DataFrame, specs: list[SourceSpec], replace_override: bool = False) -> DataFrame:
    """Matched files (with the ``_m`` hit struct) to catalog rows (P1-P11): attributes, dates,
    version, folder, size, and ``error``."""
    idx = F.col("source_idx")
    name = F.col("file_name")
    base = _spec_lookup(specs, idx, "select_file_name_base")
    folder = _spec_lookup(specs, idx, "storage_folder_name")
    table = _spec_lookup(specs, idx, "table_name")
    mode = F.lit("replace") if replace_override else _spec_lookup(specs, idx, "table_append_or_replace")
    attrs = F.col("_m.attrs")
    date_key = attrs[DATE_GROUP]
    version = F.coalesce(F.nullif(attrs[VERSION_GROUP], F.lit("")), N.file_version(name))
    folder0 = N.folder_or_base(folder, base)
    df = matched.select(
        *[c for c in matched.columns if c not in ("_m", "source_idx")],
        _spec_lookup(specs, idx, "source_id").alias("source_id"),
        base.alias("base_name"),
        F.coalesce(F.nullif(table, F.lit("")), base).alias("table_name"),
        mode.alias("table_append_or_replace"),
        F.coalesce(version, F.lit("")).alias("file_version"),
        F.nullif(attrs[OWNER_GROUP], F.lit("")).alias("content_owner"),
        N.month_end(N.date_key_to_date(date_key)).alias("report_date"),
        F.map_filter(attrs, lambda k, v: ~k.isin(OWNER_GROUP, DATE_GROUP, VERSION_GROUP)).alias("attrs"),
        F.when(~F.col("_m.name_ok"), F.lit("name_mismatch"))
        .when(date_key.isNotNull(), N.date_key_error(date_key))
        .alias("error"),
        folder0.alias("_folder"),
    )
    return (
        df.withColumn("report_date_str", F.date_format("report_date", "yyyy-MM-dd"))
        .withColumn("report_date_key", F.date_format("report_date", "yyyyMMdd").cast("bigint"))
        .withColumn("storage_folder_name", N.versioned_folder(F.col("_folder"), F.col("file_version")))
        .drop("_folder")
    )


def _file_columns(listing: DataFrame) -> DataFrame:
    return listing.select(
        F.col("path").alias("file_path"),
        N.base_name("path").alias("file_name"),
        N.parent_dir("path").alias("file_dir"),
        F.col("length").cast("bigint").alias("file_size_in_bytes"),
        N.readable_size("length").alias("file_size"),
        F.col("modificationTime").alias("modified_at"),
    )


CATALOG_COLUMNS = [
    "source_id",
    "file_name",
    "file_path",
    "file_dir",
    "base_name",
    "table_name",
    "table_append_or_replace",
    "storage_folder_name",
    "content_owner",
    "report_date",
    "report_date_key",
    "report_date_str",
    "file_version",
    "file_size_in_bytes",
    "file_size",
    "modified_at",
    "attrs",
    "error",
]


def build_catalog(listing: DataFrame, specs: list[SourceSpec], extension: str | None = None) -> DataFrame:
    """All enabled sources against a listing (S9): one row per (file, source), ``error`` NULL when valid."""
    files = _file_columns(listing)
    return enrich(match_sources(files, specs, extension), specs).select(*CATALOG_COLUMNS)


def catalog_for_source(
    listing: DataFrame, specs: list[SourceSpec], select_base: str, replace_override: bool = False
) -> DataFrame:
    """Given files against the one source whose selector base is ``select_base``.

    Selectors are not applied (the caller named the files); the override
    sets the mode of these rows only. Version folders are applied as in S9.
    """
    hit = [i for i, s in enumerate(specs) if s.select_file_name_base == select_base]
    files = _file_columns(listing)
    i = hit[0] if hit else 0
    m = files.select("*", _source_match(specs[i], i, F.col("file_name")).alias("_m"))
    m = m.select("*", F.col("_m.source_idx").alias("source_idx"))
    if not hit:
        m = m.where(F.lit(False))
    return enrich(m, specs, replace_override).select(*CATALOG_COLUMNS)


def accepted(catalog: DataFrame) -> DataFrame:
    return catalog.where(F.col("error").isNull())


def rejected(catalog: DataFrame) -> DataFrame:
    """Quarantine rows: name not matching the source pattern, bad date key."""
    return catalog.where(F.col("error").isNotNull())


def assert_no_rejects(catalog: DataFrame) -> DataFrame:
    """Strict mode: raise on the first rejected file (one bounded ``limit(1)`` check), else return the catalog."""
    bad = rejected(catalog).select("file_path", "error").limit(1).collect()
    if bad:
        raise ValueError(f"rejected file {bad[0]['file_path']}: {bad[0]['error']}")
    return catalog


# ---------------------------------------------------------------- stored side


def match_stored(
    stored: DataFrame, specs: list[SourceSpec], extension: str = ".csv.gz", path_col: str = "path"
) -> DataFrame:
    """Stored objects per enabled source (S6/S8): under the source folder (or a versioned
    sibling ``folder_v..``) and taken by the same name selectors as the local side."""
    p = F.col(path_col)
    name = N.base_name(p)
    lc = F.lower(name)
    conds = []
    for i, s in enumerate(specs):
        if not s.is_enabled:
            continue
        folder = s.storage_folder_name or s.select_file_name_base
        parent, _, leaf = folder.rpartition("/")
        prefix = (parent + "/") if parent else ""
        folder_re = "^" + glob_to_regex(prefix)[1:-1] + glob_to_regex(leaf)[1:-1] + "[^/]*/"
        cond = p.rlike(folder_re) & _selected(lc, s, extension)
        conds.append(F.when(cond, F.lit(i)))
    hits = F.filter(F.array(*conds), lambda x: x.isNotNull())
    return (
        stored.select(p.alias("path"), name.alias("file_name"), F.explode_outer(hits).alias("source_idx"))
        .where(F.col("source_idx").isNotNull())
        .withColumn("source_id", _spec_lookup(specs, F.col("source_idx"), "source_id"))
        .withColumn("base_name", _spec_lookup(specs, F.col("source_idx"), "select_file_name_base"))
    )


def storage_state(stored_files: DataFrame, samples: int = 0) -> DataFrame:
    """Stored files per base name: count, and the first ``samples`` names when asked (A2).

    The name list is bounded (a row_number limit evaluated per task before the
    shuffle), so one hot base with millions of files never becomes one array;
    the full list is ``stored_files`` itself, one row per file.
    """
    counts = stored_files.groupBy("base_name").agg(F.count(F.lit(1)).alias("file_count"))
    if not samples:
        return counts
    w = Window.partitionBy("base_name").orderBy("file_name")
    firsts = (
        stored_files.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= samples)
        .groupBy("base_name")
        .agg(F.array_join(F.array_sort(F.collect_list("file_name")), ",").alias("sample_files"))
    )
    return counts.join(firsts, "base_name")


# ---------------------------------------------------------------- A1, A3, A4, A6, A8


def files_by_base(catalog: DataFrame) -> DataFrame:
    """Files per base name (A1): count, bytes and version count, partial-aggregated."""
    return catalog.groupBy("base_name").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size_in_bytes").alias("total_bytes"),
        F.count_distinct("file_version").alias("version_count"),
    )


def duplicate_files(catalog: DataFrame, key: str = "file_name") -> DataFrame:
    """Every copy of a name that occurs more than once, across sources (A3).

    Names are counted with partial aggregation (skew-safe), then the repeated
    names are semi-joined back; that side is small and AQE broadcasts it.
    """
    repeated = catalog.groupBy(key).count().where(F.col("count") > 1).select(key)
    return catalog.join(repeated, on=key, how="left_semi")


def mixed_versions(catalog: DataFrame) -> DataFrame:
    """Files of base names that carry more than one version (A4)."""
    mixed = (
        catalog.groupBy("base_name")
        .agg(F.count_distinct("file_version").alias("n_versions"))
        .where(F.col("n_versions") > 1)
        .select("base_name")
    )
    return catalog.join(mixed, on="base_name", how="left_semi")


def match_counts(spark: SparkSession, catalog: DataFrame, specs: list[SourceSpec]) -> DataFrame:
    """Files matched per enabled source, zero kept."""
    counts = catalog.groupBy("source_id").agg(F.count(F.lit(1)).alias("matched_files"))
    src = spark.createDataFrame(
        [(s.source_id, s.select_file_name_base) for s in specs if s.is_enabled],
        "source_id string, select_file_name_base string",
    )
    return F.broadcast(src).join(counts, "source_id", "left").select(
        "source_id", "select_file_name_base", F.coalesce("matched_files", F.lit(0)).cast("bigint").alias("matched_files")
    )


def newest_files(stored: DataFrame, path_col: str = "path") -> DataFrame:
    """Newest (greatest) ``.csv.gz`` path per stored folder (A8): a max, no sort."""
    p = F.col(path_col)
    return (
        stored.where(p.endswith(".csv.gz"))
        .groupBy(N.stored_folder(p).alias("storage_folder_name"))
        .agg(F.max(p).alias("newest_path"))
    )


# ---------------------------------------------------------------- A5 folder summary


def folder_summary(stored: DataFrame, path_col: str = "path", samples: int = 3) -> DataFrame:
    """Stored ``.csv.gz`` objects grouped by folder.

    Per folder: file count, partitioned?, the first ``samples`` paths, table,
    version and proposed warehouse table name. The sample list is bounded: a
    row_number limit that Spark evaluates per task before the shuffle.
    """
    p = F.col(path_col)
    files = stored.where(p.endswith(".csv.gz") & (F.size(F.split(p, "/")) >= 2)).select(
        p.alias("path"), N.stored_folder(p).alias("storage_folder_name")
    )
    counts = files.groupBy("storage_folder_name").agg(
        F.count(F.lit(1)).alias("file_count"),
        F.max(N.is_partitioned_path("path").cast("int")).cast("boolean").alias("has_partitioning"),
    )
    w = Window.partitionBy("storage_folder_name").orderBy("path")
    firsts = (
        files.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") <= samples)
        .groupBy("storage_folder_name")
        .agg(F.array_join(F.array_sort(F.collect_list("path")), ",").alias("sample_files"))
    )
    return (
        counts.join(firsts, "storage_folder_name")
        .withColumn("table_name", N.folder_table("storage_folder_name"))
        .withColumn("file_version", N.folder_version("storage_folder_name"))
        .withColumn("proposed_table_name", N.warehouse_table_name("table_name", "file_version"))
    )


# ---------------------------------------------------------------- J1-J4


def compare_files(catalog: DataFrame, stored_state: DataFrame) -> DataFrame:
    """Local vs stored counts per base name; missing side is 0; sorted by base name."""
    local = catalog.groupBy("base_name").agg(F.count(F.lit(1)).alias("source_file_count"))
    db = stored_state.select("base_name", F.col("file_count").alias("db_file_count"))
    return (
        local.join(db, "base_name", "full_outer")
        .select(
            "base_name",
            F.coalesce("db_file_count", F.lit(0)).cast("bigint").alias("db_file_count"),
            F.coalesce("source_file_count", F.lit(0)).cast("bigint").alias("source_file_count"),
        )
        .orderBy("base_name")
    )


def new_files(catalog: DataFrame, stored_files: DataFrame, key: list[str] | str = "file_name") -> DataFrame:
    """Catalog rows whose key is not stored under any source.

    Default key is the bare file name, across all sources; pass
    ``["source_id", "file_name"]`` to compare per source.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return catalog.join(stored_files.select(*keys).distinct(), on=keys, how="left_anti")


def missing_tables(folders: DataFrame, existing: DataFrame, name_col: str = "table_name") -> DataFrame:
    """Folders whose proposed table does not exist yet."""
    ex = existing.select(F.col(name_col).alias("proposed_table_name"))
    return folders.join(ex, "proposed_table_name", "left_anti")


def selected_tables(tables: DataFrame, names: str | list[str], name_col: str = "table_name") -> DataFrame:
    """Tables named by the user: one name or a comma list."""
    wanted = [n.strip() for n in names.split(",")] if isinstance(names, str) else [n.strip() for n in names]
    return tables.where(F.col(name_col).isin(*[w for w in wanted if w]))


def preview(df: DataFrame, order_col: str, k: int) -> DataFrame:
    """First ``k`` rows by ``order_col`` plus the number not shown."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (
        df.orderBy(order_col)
        .limit(k)
        .withColumn("more_count", F.greatest(total - F.lit(k), F.lit(0)).cast("bigint"))
    )
