"""[cat] queries: the file catalog built from a landing inventory and a store listing
(both derived from ``orders``), and the reports over them.

The oracle side re-implements the catalog in DuckDB SQL: GLOB selectors,
per-source anchored regexes, date-key validation by parts, version folders
and the size text, so it shares no code with the Spark operators it checks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.operators import catalog as C
from reportlake.operators import load as L
from reportlake.plans.fixtures import (
    FIXTURE_SPECS,
    LANDING_SQL,
    STORE_SQL,
    landing_listing,
    specs_values_sql,
    store_listing,
)
from reportlake.plans.registry import register

SPECS = FIXTURE_SPECS


def _sql_str(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def _duck_group_columns() -> str:
    """Per-source regex columns for the oracle, generated from the spec rows."""
    groups = sorted({g for s in SPECS if s.regex_group_names for g in s.regex_group_names})
    ok_cases, cols = [], []
    for s in SPECS:
        if s.regex_pattern and s.regex_group_names:
            ok_cases.append(
                f"WHEN source_id = {_sql_str(s.source_id)} THEN regexp_matches(file_name, {_sql_str('^(?:' + s.regex_pattern + ')')})"
            )
    for g in groups:
        cases = []
        for s in SPECS:
            if s.regex_pattern and s.regex_group_names and g in s.regex_group_names:
                j = list(s.regex_group_names).index(g) + 1
                cases.append(
                    f"WHEN source_id = {_sql_str(s.source_id)} THEN "
                    f"regexp_extract(file_name, {_sql_str('^(?:' + s.regex_pattern + ')')}, {j})"
                )
        cols.append(f"CASE {' '.join(cases)} END AS g_{g}")
    return f"CASE {' '.join(ok_cases)} ELSE TRUE END AS name_ok, " + ", ".join(cols)


SIZE_SQL = """CASE WHEN {n} >= 1024::BIGINT*1024*1024*1024*1024 THEN format('{{:.2f}}', {n} / 1024.0^5) || ' PB'
     WHEN {n} >= 1024::BIGINT*1024*1024*1024 THEN format('{{:.2f}}', {n} / 1024.0^4) || ' TB'
     WHEN {n} >= 1024*1024*1024 THEN format('{{:.2f}}', {n} / 1024.0^3) || ' GB'
     WHEN {n} >= 1024*1024 THEN format('{{:.2f}}', {n} / 1024.0^2) || ' MB'
     WHEN {n} >= 1024 THEN format('{{:.2f}}', {n} / 1024.0) || ' KB'
     ELSE format('{{:.2f}}', {n} * 1.0) || ' B' END"""

DUCK_CATALOG = (
    "WITH "
    + LANDING_SQL.strip()
    + STORE_SQL
    + ",\n"
    + specs_values_sql(SPECS)
    + """,
files AS (
  SELECT path AS file_path, regexp_extract(path, '[^/]*$') AS file_name,
         CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '' END AS file_dir,
         length AS file_size_in_bytes
  FROM landing
),
matched AS (
  SELECT f.*, s.* FROM files f JOIN specs s
    ON s.is_enabled
   AND lower(f.file_name) GLOB '*' || lower(s.select_file_name_base) || '*'
   AND NOT (coalesce(s.exclude_file_name_base, '') <> ''
            AND lower(f.file_name) GLOB '*' || lower(s.exclude_file_name_base) || '*')
   AND NOT starts_with(f.file_name, '.~lock')
),
grouped AS (SELECT *, """
    + _duck_group_columns()
    + """ FROM matched),
keyed AS (
  SELECT *,
    TRY_CAST(substr(g_file_date_key, 1, 4) AS INTEGER) AS ky,
    TRY_CAST(substr(g_file_date_key, 5, 2) AS INTEGER) AS km,
    CASE WHEN length(g_file_date_key) = 8 THEN TRY_CAST(substr(g_file_date_key, 7, 2) AS INTEGER) ELSE 1 END AS kd
  FROM grouped
),
dated AS (
  SELECT *,
    CASE WHEN length(g_file_date_key) IN (6, 8) AND regexp_matches(g_file_date_key, '^[0-9]+$')
          AND ky BETWEEN 1900 AND 2100 AND km BETWEEN 1 AND 12
          AND kd BETWEEN 1 AND day(last_day(make_date(ky, km, 1)))
         THEN make_date(ky, km, kd) END AS key_date
  FROM keyed
),
catalog AS (
  SELECT source_id, file_name, file_path, file_dir,
    select_file_name_base AS base_name,
    coalesce(nullif(table_name, ''), select_file_name_base) AS table_name,
    table_append_or_replace,
    coalesce(nullif(storage_folder_name, ''), select_file_name_base)
      || CASE WHEN fv <> '' THEN '_' || fv ELSE '' END AS storage_folder_name,
    nullif(g_content_owner, '') AS content_owner,
    g_desk AS desk,
    last_day(key_date) AS report_date,
    CAST(strftime(last_day(key_date), '%Y%m%d') AS BIGINT) AS report_date_key,
    strftime(last_day(key_date), '%Y-%m-%d') AS report_date_str,
    fv AS file_version,
    file_size_in_bytes,
    """
    + SIZE_SQL.format(n="file_size_in_bytes")
    + """ AS file_size,
    CASE WHEN NOT name_ok THEN 'name_mismatch'
         WHEN g_file_date_key IS NOT NULL AND length(g_file_date_key) NOT IN (6, 8) THEN 'date_key_length'
         WHEN g_file_date_key IS NOT NULL AND key_date IS NULL THEN 'date_key_invalid'
    END AS error
  FROM (SELECT *, coalesce(nullif(g_file_version, ''), regexp_extract(file_name, '_(v[0-9]+(-[0-9]+)?)', 1)) AS fv
        FROM dated)
),
store_files AS (
  SELECT path, regexp_extract(path, '[^/]*$') AS file_name FROM store
),
stored AS (
  SELECT sf.path, sf.file_name, s.source_id, s.select_file_name_base AS base_name
  FROM store_files sf JOIN specs s
    ON s.is_enabled
   AND regexp_matches(sf.path, '^' || regexp_replace(coalesce(nullif(s.storage_folder_name, ''), s.select_file_name_base), '([.+()\\-])', '\\\\\\1', 'g') || '[^/]*/')
   AND lower(sf.file_name) GLOB '*' || lower(s.select_file_name_base) || '*.csv.gz'
   AND NOT (coalesce(s.exclude_file_name_base, '') <> ''
            AND lower(sf.file_name) GLOB '*' || lower(s.exclude_file_name_base) || '*')
),
folders AS (
  SELECT path,
    CASE WHEN contains(path, 'report_date=')
         THEN regexp_extract(path, '^(.*?)/[^/]*report_date=', 1)
         ELSE regexp_replace(path, '/[^/]*$', '') END AS storage_folder_name
  FROM store WHERE ends_with(path, '.csv.gz') AND contains(path, '/')
),
folder_summary AS (
  SELECT storage_folder_name, count(*) AS file_count,
    bool_or(contains(path, 'report_date=')) AS has_partitioning,
    array_to_string(list_sort(list(path ORDER BY path))[1:3], ',') AS sample_files,
    regexp_replace(regexp_extract(storage_folder_name, '[^/]*$'), '_(v[0-9]+(-[0-9]+)?)$', '') AS table_name,
    regexp_extract(regexp_extract(storage_folder_name, '[^/]*$'), '_(v[0-9]+(-[0-9]+)?)$', 1) AS file_version
  FROM folders GROUP BY storage_folder_name
)
"""
)


def _cat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.build_catalog(landing_listing(spark, sf_dir), SPECS)


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.match_stored(store_listing(spark, sf_dir), SPECS)


CAT_COLS = [
    "source_id", "file_name", "file_path", "file_dir", "base_name", "table_name", "table_append_or_replace",
    "storage_folder_name", "content_owner", "report_date", "report_date_key", "report_date_str", "file_version",
    "file_size_in_bytes", "file_size", "error",
]


@register("select_files", DUCK_CATALOG + "SELECT source_id, file_name, file_path FROM matched")
def select_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Include/exclude selectors and lock-file filter against every enabled source."""
    files = landing_listing(spark, sf_dir).select(
        F.col("path").alias("file_path"), N.base_name("path").alias("file_name")
    )
    m = C.match_sources(files, SPECS)
    return m.select(
        F.element_at(F.array(*[F.lit(s.source_id) for s in SPECS]), F.col("source_idx") + 1).alias("source_id"),
        "file_name",
        "file_path",
    )


@register("build_catalog", DUCK_CATALOG + f"SELECT {', '.join(CAT_COLS)} FROM catalog")
def build_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All enabled sources against the inventory: names parsed, dates, versions, folders, sizes."""
    return _cat(spark, sf_dir).select(*CAT_COLS)


@register(
    "name_attrs",
    DUCK_CATALOG
    + """SELECT file_path, source_id, content_owner, report_date_str, file_version,
              'desk=' || desk AS extra_attrs
       FROM catalog WHERE error IS NULL""",
)
def name_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regex groups of accepted names as columns; other groups kept in ``attrs``."""
    cat = C.accepted(_cat(spark, sf_dir))
    pairs = F.transform(F.map_entries("attrs"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    extra = F.when(F.size("attrs") > 0, F.array_join(pairs, ","))
    return cat.select("file_path", "source_id", "content_owner", "report_date_str", "file_version",
                      extra.alias("extra_attrs"))


@register("name_rejects", DUCK_CATALOG + "SELECT source_id, file_path, error FROM catalog WHERE error IS NOT NULL")
def name_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selected names that do not fit the source pattern or carry a bad date key."""
    return C.rejected(_cat(spark, sf_dir)).select("source_id", "file_path", "error")


@register(
    "file_versions",
    "WITH " + LANDING_SQL.strip()
    + """ SELECT path, regexp_extract(regexp_extract(path, '[^/]*$'), '_(v[0-9]+(-[0-9]+)?)', 1) AS file_version
          FROM landing""",
)
def file_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ``_v<d>[-<d>]`` of every inventory name."""
    return landing_listing(spark, sf_dir).select("path", N.file_version(N.base_name("path")).alias("file_version"))


@register(
    "build_catalog_override",
    DUCK_CATALOG
    + """, forced AS (
      SELECT f.*, 'price_list' AS source_id,
             regexp_matches(f.file_name, '^(?:price_list_(.+)_ed(.+)\\.csv)') AS ok,
             regexp_extract(f.file_name, '^(?:price_list_(.+)_ed(.+)\\.csv)', 2) AS g_v
      FROM files f WHERE starts_with(f.file_name, 'price_list_')
    )
    SELECT source_id, file_path, 'replace' AS table_append_or_replace,
           CASE WHEN ok THEN 'office-store/price_list' || CASE WHEN coalesce(nullif(g_v, ''), regexp_extract(file_name, '_(v[0-9]+(-[0-9]+)?)', 1)) <> '' THEN '_' || coalesce(nullif(g_v, ''), regexp_extract(file_name, '_(v[0-9]+(-[0-9]+)?)', 1)) ELSE '' END END AS storage_folder_name,
           CASE WHEN NOT ok THEN 'name_mismatch' END AS error
    FROM forced""",
)
def build_catalog_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named files against one named source with the replace override."""
    listing = landing_listing(spark, sf_dir).where(N.base_name("path").startswith("price_list_"))
    cat = C.catalog_for_source(listing, SPECS, "price_list", replace_override=True)
    return cat.select(
        "source_id", "file_path", "table_append_or_replace",
        F.when(F.col("error").isNull() | (F.col("error") != "name_mismatch"), F.col("storage_folder_name")).alias(
            "storage_folder_name"
        ),
        "error",
    )


@register(
    "destination_paths",
    DUCK_CATALOG
    + """SELECT file_path, storage_folder_name,
              CASE WHEN report_date_str IS NOT NULL
                   THEN storage_folder_name || '/report_date=' || report_date_str || '/' || file_name
                   ELSE storage_folder_name || '/' || file_name END AS destination_path
       FROM catalog WHERE error IS NULL""",
)
def destination_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing path of each accepted file: versioned folder, dated partition."""
    cat = C.accepted(_cat(spark, sf_dir))
    return cat.select(
        "file_path", "storage_folder_name",
        N.destination_path("storage_folder_name", "report_date_str", "file_name").alias("destination_path"),
    )


@register(
    "load_rejects",
    DUCK_CATALOG
    + """SELECT file_path, 'bad_extension' AS reason FROM catalog
       WHERE error IS NULL AND report_date_str IS NOT NULL AND NOT ends_with(file_name, '.csv.gz')""",
)
def load_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated files that are not ``.csv.gz`` cannot land in a partitioned folder (K5)."""
    return L.load_rejects(C.accepted(_cat(spark, sf_dir))).select("file_path", "reason")


@register(
    "load_summary",
    DUCK_CATALOG
    + """SELECT table_name, count(*) AS files, CAST(sum(file_size_in_bytes) AS BIGINT) AS total_bytes,
              round(sum(file_size_in_bytes) / 1048576.0, 2) AS total_mb,
              count(*) FILTER (WHERE NOT (report_date_str IS NOT NULL AND NOT ends_with(file_name, '.csv.gz'))) AS ok,
              count(*) FILTER (WHERE report_date_str IS NOT NULL AND NOT ends_with(file_name, '.csv.gz')) AS failed
       FROM catalog WHERE error IS NULL GROUP BY table_name""",
)
def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Planned load per table: files, bytes, MB, ok and failed counts."""
    return L.plan_summary(C.accepted(_cat(spark, sf_dir)))


@register(
    "files_by_base",
    DUCK_CATALOG
    + """SELECT base_name, count(*) AS file_count, CAST(sum(file_size_in_bytes) AS BIGINT) AS total_bytes,
              count(DISTINCT file_version) AS version_count
       FROM catalog WHERE error IS NULL GROUP BY base_name""",
)
def files_by_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted files grouped by base name (A1)."""
    return C.files_by_base(C.accepted(_cat(spark, sf_dir)))


@register(
    "duplicate_files",
    DUCK_CATALOG
    + """SELECT source_id, file_name, file_path FROM catalog
       WHERE error IS NULL AND file_name IN (
         SELECT file_name FROM catalog WHERE error IS NULL GROUP BY file_name HAVING count(*) > 1)""",
)
def duplicate_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of a file name seen more than once, across sources (A3)."""
    return C.duplicate_files(C.accepted(_cat(spark, sf_dir))).select("source_id", "file_name", "file_path")


@register(
    "mixed_versions",
    DUCK_CATALOG
    + """SELECT base_name, file_path, file_version FROM catalog
       WHERE error IS NULL AND base_name IN (
         SELECT base_name FROM catalog WHERE error IS NULL GROUP BY base_name HAVING count(DISTINCT file_version) > 1)""",
)
def mixed_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of base names that come in more than one version (A4)."""
    return C.mixed_versions(C.accepted(_cat(spark, sf_dir))).select("base_name", "file_path", "file_version")


@register(
    "match_counts",
    DUCK_CATALOG
    + """SELECT s.source_id, s.select_file_name_base, count(m.file_path) AS matched_files
       FROM specs s LEFT JOIN matched m ON m.source_id = s.source_id
       WHERE s.is_enabled GROUP BY s.source_id, s.select_file_name_base""",
)
def match_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files matched per enabled selector, zero kept."""
    return C.match_counts(spark, _cat(spark, sf_dir), SPECS)


@register(
    "stored_files",
    DUCK_CATALOG + "SELECT source_id, base_name, file_name, path FROM stored",
)
def stored_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store objects per enabled source: folder or versioned sibling, same name selectors."""
    return _stored(spark, sf_dir).select("source_id", "base_name", "file_name", "path")


@register(
    "storage_state",
    DUCK_CATALOG
    + """SELECT base_name, count(*) AS file_count,
              array_to_string(list_sort(list(file_name))[1:3], ',') AS sample_files
       FROM stored GROUP BY base_name""",
)
def storage_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored files per base name: count and the first three names (A2; the full list is ``stored_files``)."""
    return C.storage_state(_stored(spark, sf_dir), samples=3)


@register(
    "prefix_scan",
    DUCK_CATALOG + "SELECT path FROM store WHERE starts_with(path, 'office-store/ledger_v1')",
)
def prefix_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored object under a prefix."""
    return C.with_prefix(store_listing(spark, sf_dir), "office-store/ledger_v1")


@register(
    "newest_files",
    DUCK_CATALOG + "SELECT storage_folder_name, max(path) AS newest_path FROM folders GROUP BY 1",
)
def newest_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest object per stored folder, by name."""
    return C.newest_files(store_listing(spark, sf_dir))


FOLDER_COLS = [
    "storage_folder_name", "file_count", "has_partitioning", "sample_files", "table_name", "file_version",
    "proposed_table_name",
]


@register(
    "folder_summary",
    DUCK_CATALOG
    + """SELECT storage_folder_name, file_count, has_partitioning, sample_files, table_name, file_version,
              CASE WHEN file_version <> '' THEN table_name || '_' || replace(file_version, '-', '_')
                   ELSE table_name END AS proposed_table_name
       FROM folder_summary ORDER BY proposed_table_name""",
)
def folder_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored folders: count, partitioned?, first three files, table, version."""
    return C.folder_summary(store_listing(spark, sf_dir)).select(*FOLDER_COLS).orderBy("proposed_table_name")


@register(
    "compare_files",
    DUCK_CATALOG
    + """, l AS (SELECT base_name, count(*) AS n FROM catalog WHERE error IS NULL GROUP BY 1),
         d AS (SELECT base_name, count(*) AS n FROM stored GROUP BY 1)
    SELECT coalesce(l.base_name, d.base_name) AS base_name, coalesce(d.n, 0) AS db_file_count,
           coalesce(l.n, 0) AS source_file_count
    FROM l FULL OUTER JOIN d ON l.base_name = d.base_name ORDER BY 1""",
)
def compare_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local vs stored file counts per base name."""
    return C.compare_files(C.accepted(_cat(spark, sf_dir)), C.storage_state(_stored(spark, sf_dir)))


@register(
    "new_files",
    DUCK_CATALOG
    + """SELECT source_id, base_name, file_name, file_path FROM catalog
       WHERE error IS NULL AND file_name NOT IN (SELECT file_name FROM stored)
       ORDER BY source_id, base_name, file_name""",
)
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted files whose name is not stored under any source."""
    nf = C.new_files(C.accepted(_cat(spark, sf_dir)), _stored(spark, sf_dir))
    return nf.select("source_id", "base_name", "file_name", "file_path").orderBy("source_id", "base_name", "file_name")


@register(
    "new_files_preview",
    DUCK_CATALOG
    + """, nf AS (SELECT file_name, file_path FROM catalog
               WHERE error IS NULL AND file_name NOT IN (SELECT file_name FROM stored))
    SELECT file_name, file_path, greatest((SELECT count(*) FROM nf) - 10, 0) AS more_count
    FROM nf ORDER BY file_path LIMIT 10""",
)
def new_files_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First ten new files by path and how many are not shown."""
    nf = C.new_files(C.accepted(_cat(spark, sf_dir)), _stored(spark, sf_dir)).select("file_name", "file_path")
    return C.preview(nf, "file_path", 10)


EXISTING_TABLES_SQL = """existing AS (
  SELECT DISTINCT CASE WHEN file_version <> '' THEN table_name || '_' || replace(file_version, '-', '_')
                       ELSE table_name END AS table_name
  FROM folder_summary WHERE file_version LIKE 'v1%')"""


def _existing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables taken as already published: those of the v1 folders."""
    fs = C.folder_summary(store_listing(spark, sf_dir))
    return fs.where(F.col("file_version").startswith("v1")).select(
        F.col("proposed_table_name").alias("table_name")
    ).distinct()


@register(
    "missing_tables",
    DUCK_CATALOG + ", " + EXISTING_TABLES_SQL
    + """ SELECT storage_folder_name, proposed_table_name FROM (
        SELECT *, CASE WHEN file_version <> '' THEN table_name || '_' || replace(file_version, '-', '_')
                       ELSE table_name END AS proposed_table_name FROM folder_summary) f
       WHERE proposed_table_name NOT IN (SELECT table_name FROM existing)""",
)
def missing_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored folders that have no table yet."""
    fs = C.folder_summary(store_listing(spark, sf_dir))
    return C.missing_tables(fs, _existing_tables(spark, sf_dir)).select("storage_folder_name", "proposed_table_name")


@register(
    "selected_tables",
    DUCK_CATALOG + ", " + EXISTING_TABLES_SQL
    + " SELECT table_name FROM existing WHERE table_name IN ('ledger_v1_1', 'stock_v1', 'freight_v1_2')",
)
def selected_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables named by the user as a comma list, unknown names ignored."""
    return C.selected_tables(_existing_tables(spark, sf_dir), "ledger_v1_1, stock_v1,freight_v1_2,no_such")


@register(
    "table_names",
    DUCK_CATALOG
    + """SELECT storage_folder_name,
              CASE WHEN file_version <> '' THEN table_name || '_' || replace(file_version, '-', '_')
                   ELSE table_name END AS warehouse_table,
              'reports.office_lake.' || CASE WHEN file_version <> '' THEN table_name || '_' || replace(file_version, '-', '_')
                   ELSE table_name END AS full_table_id,
              CASE WHEN has_partitioning THEN 'lake://store/' || storage_folder_name || '/*'
                   ELSE 'lake://store/' || storage_folder_name || '/*.csv.gz' END AS source_uri
       FROM folder_summary""",
)
def table_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warehouse name, fully qualified id and source URI pattern per stored folder."""
    fs = C.folder_summary(store_listing(spark, sf_dir))
    return fs.select(
        "storage_folder_name",
        N.warehouse_table_name("table_name", "file_version").alias("warehouse_table"),
        N.full_table_id(F.lit("reports"), F.lit("office_lake"),
                        N.warehouse_table_name("table_name", "file_version")).alias("full_table_id"),
        N.source_uri_pattern(F.lit("lake://store"), "storage_folder_name", "has_partitioning").alias("source_uri"),
    )


URI_SQL = """CASE WHEN has_partitioning THEN 'lake://store/' || storage_folder_name || '/report_date=*/*.csv.gz'
                  ELSE 'lake://store/' || storage_folder_name || '/*.csv.gz' END"""


@register(
    "partition_columns",
    DUCK_CATALOG
    + f"""SELECT storage_folder_name, {URI_SQL} AS source_uri,
               array_to_string(regexp_extract_all({URI_SQL}, '/([A-Za-z0-9_]+)=\\*', 1), ',') AS partition_columns
       FROM folder_summary""",
)
def partition_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partition column names read from a table's source URI pattern."""
    fs = C.folder_summary(store_listing(spark, sf_dir))
    uri = F.when(
        F.col("has_partitioning"),
        F.concat(F.lit("lake://store/"), F.col("storage_folder_name"), F.lit("/report_date=*/*.csv.gz")),
    ).otherwise(F.concat(F.lit("lake://store/"), F.col("storage_folder_name"), F.lit("/*.csv.gz")))
    return fs.select(
        "storage_folder_name", uri.alias("source_uri"),
        F.array_join(N.partition_columns(uri), ",").alias("partition_columns"),
    )


@register(
    "uri_folders",
    DUCK_CATALOG
    + f"""SELECT {URI_SQL} AS source_uri, storage_folder_name AS folder FROM folder_summary""",
)
def uri_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder behind each table URI: bucket, partition part and wildcard stripped."""
    fs = C.folder_summary(store_listing(spark, sf_dir))
    uri = F.when(
        F.col("has_partitioning"),
        F.concat(F.lit("lake://store/"), F.col("storage_folder_name"), F.lit("/report_date=*/*.csv.gz")),
    ).otherwise(F.concat(F.lit("lake://store/"), F.col("storage_folder_name"), F.lit("/*.csv.gz")))
    return fs.select(uri.alias("source_uri"), N.uri_folder(uri, "lake://store/").alias("folder"))
