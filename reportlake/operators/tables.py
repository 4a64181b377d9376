"""External tables over lake folders (T1-T6), so plain Spark SQL answers the rest.

A published table is two catalog objects:

* ``<name>__raw``: an EXTERNAL CSV table over the folder, every column STRING,
  partitioned by ``report_date`` when the folder is; dropping it never touches the files.
  Partitions of a landed folder come from its load log, others from ``MSCK REPAIR TABLE``.
  Each republish makes another generation, ``<name>__raw_1``, ``<name>__raw_2``, ...
* ``<name>``: a view with the inferred types applied, null tokens removed and
  the header row under a title filtered out, per file. Its text says which generation it reads,
  and a republish changes it by one ``ALTER VIEW``, so readers find a table at any time.

Queries on the view keep partition pruning on ``report_date`` and the pushed
header filter. Catalog operations are metadata-only and run on the driver;
the data work (inference, reads) stays in Spark jobs.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.operators import catalog as C
from reportlake.operators import infer
from reportlake.operators import load as L
from reportlake.operators.load import LOG_DIR
from reportlake.sources import csvlake

RAW_SUFFIX = "__raw"
#: Partitions of one ``ALTER TABLE ADD PARTITION``.
PARTITIONS_A_CALL = 200
# Character-set trim of ASCII whitespace (same set as values.WHITESPACE), written with SQL unicode escapes.
TRIM = r"trim(BOTH ' \u0009\u000A\u000B\u000C\u000D' FROM {c})"


def _q(name: str) -> str:
    return ".".join(f"`{p}`" for p in name.split("."))


def _lit(v: str | None) -> str:
    if v is None:
        return "NULL"
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def typed_sql(col: str, type_name: str, strings_null_tokens: bool = True) -> str:
    """SQL text of one raw cell converted to its inferred type (I8, P18), for view definitions."""
    t = TRIM.format(c=f"`{col}`")
    v = f"CASE WHEN lower({t}) IN ('', 'null', 'none') THEN NULL ELSE {t} END"
    if type_name == "INT64":
        return f"try_cast({v} AS BIGINT)"
    if type_name == "BOOL":
        return (f"CASE WHEN lower({v}) IN ('true', 'yes', '1') THEN TRUE "
                f"WHEN lower({v}) IN ('false', 'no', '0') THEN FALSE END")
    if type_name == "BIGNUMERIC":
        return f"try_cast({v} AS DECIMAL(38,18))"
    if type_name == "TIMESTAMP":
        return f"try_to_timestamp(translate({v}, '/', '-'))"
    if type_name == "DATE":
        return f"try_to_date(translate({v}, '/', '-'), 'yyyy-MM-dd')"
    return v if strings_null_tokens else f"`{col}`"


def _partitions(spark: SparkSession, folder: str) -> list[str]:
    """Partition columns of the folder's paths, in order."""
    listed = C.list_files(spark, folder, csvlake.GZ_GLOB)
    row = listed.agg(*[F.max(F.col("path").contains(f"/{k}=")).alias(k) for k in (N.PARTITION_KEY, "load_id")]).first()
    return [k for k in (N.PARTITION_KEY, "load_id") if row[k]]


def _log_of(spark: SparkSession, folder: str) -> str | None:
    """The load log of the lake that holds the folder, if there is one."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    here = path(folder)
    fs = here.getFileSystem(spark._jsc.hadoopConfiguration())
    while here is not None:
        log = path(here, LOG_DIR)
        if fs.exists(log):
            return log.toString()
        here = here.getParent()
    return None


def _in_lake(folder: str, log: str) -> tuple[str, str]:
    """Lake root and the folder's name in it."""
    root = log.removesuffix(f"/{LOG_DIR}")
    tail = re.sub("^file:/+", "/", folder.rstrip("/")).removeprefix(re.sub("^file:/+", "/", root))
    return root, tail.strip("/")


def _schema(spark: SparkSession, folder: str, scope: str) -> infer.InferredSchema | None:
    """The folder's schema: a vote over its rows, which landed folders kept with their loads."""
    log = _log_of(spark, folder) if scope == "all_rows" else None
    if log is None or not L.path_exists(spark, f"{folder}/{L.PROFILE_DIR}"):
        return infer.infer_lake_schema(spark, folder, scope=scope)
    head = csvlake.lake_head(spark, folder)
    if head is None:
        return None
    voted = {r["column_name"]: r["inferred_type"] for r in infer.decide(L.folder_profile(spark, *_in_lake(folder, log))).collect()}
    return infer.InferredSchema(head.columns, [voted.get(c, "STRING") for c in head.columns], False, head)


def _partition_sql(cells: dict[str, str | None]) -> str:
    return "PARTITION (" + ", ".join(f"`{k}` = {_lit(v)}" for k, v in cells.items()) + ")"


def _add_partitions(spark: SparkSession, raw: str, folder: str, parts: list[str]) -> None:
    """Partitions that the raw table doesn't have yet: those of loads in the log, or, for a folder without
    a log, what a repair finds if the listing has others than the table."""
    had = {r[0] for r in spark.sql(f"SHOW PARTITIONS {_q(raw)}").collect()}
    log = _log_of(spark, folder) if "load_id" in parts else None
    if log is None:
        p = F.col("path")
        there = C.list_files(spark, folder, csvlake.GZ_GLOB).select(F.concat_ws("/", *[F.regexp_extract(p, f"/({k}=[^/]*)/", 1) for k in parts]))
        if {r[0] for r in there.distinct().collect()} - had:
            spark.sql(f"MSCK REPAIR TABLE {_q(raw)}")
        return
    root, name = _in_lake(folder, log)
    loads = L.read_log(spark, root).where((F.col("storage_folder_name") == name) & (F.col("status") == "ok") & (F.col("rows") > 0))
    cells = [{k: None if r[k] is None else str(r[k]) for k in parts} for r in loads.select(*parts).distinct().collect()]
    new = [c for c in cells if "/".join(f"{k}={v}" for k, v in c.items()) not in had]
    for k in range(0, len(new), PARTITIONS_A_CALL):
        spark.sql(f"ALTER TABLE {_q(raw)} ADD IF NOT EXISTS " + " ".join(_partition_sql(c) for c in new[k : k + PARTITIONS_A_CALL]))


def _current_sql(log: str) -> str:
    """(load_id, src_file) of the newest version of every file, as ``load.current_files`` has them."""
    ok = f"SELECT *, coalesce(file_key, src_file) AS k FROM parquet.`{log}` WHERE status = 'ok'"
    newest = f"SELECT storage_folder_name AS nf, k AS nk, max(struct(coalesce(version, 0) AS v, finished_at, load_id)).load_id AS nl FROM ({ok}) GROUP BY 1, 2"
    return f"SELECT load_id AS l, src_file AS f FROM ({ok}) LEFT SEMI JOIN ({newest}) ON storage_folder_name = nf AND k = nk AND load_id = nl"


def _create_raw(spark: SparkSession, raw: str, folder: str, schema: infer.InferredSchema | None, parts: list[str]) -> str:
    """Make the raw table and return the SELECT of its typed view."""
    reader = ", ".join(f"{k} {_lit(v)}" for k, v in csvlake.CSV_READ.items())
    opts = f"path {_lit(folder)}, {reader}, pathGlobFilter '{csvlake.GZ_GLOB}'"
    if schema is None:
        spark.sql(f"CREATE TABLE {_q(raw)} USING csv OPTIONS ({opts}, inferSchema 'true')")
        return f"SELECT * FROM {_q(raw)}"
    if len({tuple(layout.columns) for layout in schema.head.layouts}) > 1:
        raise ValueError(f"the files of {folder} have {len(schema.head.layouts)} headers and a catalog table reads by position; land them first")
    types = {N.PARTITION_KEY: "DATE", "load_id": "STRING"}
    part_col = "".join(f", `{k}` {types[k]}" for k in parts)
    part_by = f" PARTITIONED BY ({', '.join(f'`{k}`' for k in parts)})" if parts else ""
    cols = ", ".join(f"`{c}` STRING" for c in schema.columns)
    spark.sql(f"CREATE TABLE {_q(raw)} ({cols}{part_col}) USING csv OPTIONS ({opts}){part_by}")
    if parts:
        _add_partitions(spark, raw, folder, parts)
    cells = list(schema.head.header) + [None] * (len(schema.columns) - len(schema.head.header))
    header_row = " AND ".join(f"`{c}` <=> {_lit(v)}" for c, v in zip(schema.columns, cells))
    select = ", ".join(f"{typed_sql(c, t)} AS `{c}`" for c, t in zip(schema.columns, schema.types))
    select += "".join(f", `{k}`" for k in parts)
    titled = any(layout.n_titled for layout in schema.head.layouts)
    source = f"(SELECT * FROM {_q(raw)} WHERE NOT ({header_row}))" if titled else _q(raw)
    log = _log_of(spark, folder) if "load_id" in parts else None
    if log:
        source += f" r LEFT SEMI JOIN ({_current_sql(log)}) c ON r.load_id = c.l AND r.src_file = c.f"
    return f"SELECT {select} FROM {source}"


def create_table(
    spark: SparkSession,
    name: str,
    folder: str,
    schema: infer.InferredSchema | None = None,
    partitioned: bool | None = None,
    autodetect_fallback: bool = True,
    scope: str = "all_rows",
) -> bool:
    """Create the raw table and the typed view over ``folder`` (T2). ``False`` if it exists or fails.

    The view of a landed folder shows committed rows only: those of the newest version of their file
    in the load log, looked up when the view is read."""
    raw = name + RAW_SUFFIX
    if spark.catalog.tableExists(name) or spark.catalog.tableExists(raw):
        return False
    schema = schema or _schema(spark, folder, scope)
    parts = _partitions(spark, folder) if partitioned is not False else []
    if schema is None and (not autodetect_fallback or C.list_files(spark, folder, csvlake.GZ_GLOB).isEmpty()):
        return False
    spark.sql(f"CREATE VIEW {_q(name)} AS {_create_raw(spark, raw, folder, schema, parts)}")
    return True


def _generations(spark: SparkSession, name: str) -> dict[int, str]:
    """Generation -> raw table, of the published table ``db.name``."""
    db, t = name.rsplit(".", 1) if "." in name else (spark.catalog.currentDatabase(), name)
    shape = re.compile(rf"{re.escape(t)}{RAW_SUFFIX}(?:_(\d+))?", re.IGNORECASE)
    found = [(shape.fullmatch(x.name), x.name) for x in spark.catalog.listTables(db)]
    return {int(m.group(1) or 0): f"{db}.{raw}" for m, raw in found if m}


def _raw_of(spark: SparkSession, name: str) -> str:
    """The raw table that the view reads."""
    text = " ".join(r["data_type"] or "" for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(name)}").collect() if r["col_name"] == "View Text")
    read = [(text.lower().find(f"`{raw.rsplit('.', 1)[1]}`".lower()), raw) for raw in _generations(spark, name).values()]
    return min((at, raw) for at, raw in read if at >= 0)[1]


def refresh_table(spark: SparkSession, name: str) -> None:
    """Take in files and partitions that came after the table was created."""
    raw = _raw_of(spark, name)
    info = _describe(spark, name)
    if info.is_partitioned:
        _add_partitions(spark, raw, info.location, info.partition_columns)
    spark.catalog.refreshTable(raw)


def table_exists(spark: SparkSession, name: str) -> bool:
    """(T3)"""
    return spark.catalog.tableExists(name)


@dataclass(frozen=True)
class TableInfo:
    table_name: str
    location: str | None
    is_partitioned: bool
    n_columns: int
    partition_columns: list[str]
    created: str | None


def _describe(spark: SparkSession, name: str) -> TableInfo:
    """Location, partitioning (read from the catalog, Q13), column count and creation time."""
    raw = _raw_of(spark, name)
    info = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_q(raw)}").collect()}
    parts = [c.name for c in spark.catalog.listColumns(raw) if c.isPartition]
    n_cols = len(spark.catalog.listColumns(name))
    return TableInfo(name, info.get("Location"), bool(parts), n_cols, parts, info.get("Created Time"))


def _published(spark: SparkSession, db: str) -> list[str]:
    """Views with a raw table of some generation."""
    names = {t.name for t in spark.catalog.listTables(db)}
    raw = {m.group(1) for m in (re.fullmatch(rf"(.+){RAW_SUFFIX}(?:_\d+)?", t) for t in names) if m}
    return sorted(names & raw)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """Published tables with location, partitioned flag and column count."""
    db = database or spark.catalog.currentDatabase()
    rows = []
    for t in _published(spark, db):
        i = _describe(spark, f"{db}.{t}")
        rows.append((t, db, i.location, i.is_partitioned, ",".join(i.partition_columns), i.n_columns, i.created))
    return spark.createDataFrame(
        rows,
        "table_name string, database string, location string, is_partitioned boolean, partition_columns string, "
        "n_columns int, created string",
    )


def drop_tables(
    spark: SparkSession, names: list[str] | None = None, database: str | None = None, dry_run: bool = True
) -> DataFrame:
    """Drop published tables (metadata only, files stay); dry run by default returns the plan (T4)."""
    listed = list_tables(spark, database)
    if names is not None:
        listed = C.selected_tables(listed, names)
    plan = listed.select("table_name", "database", "location")
    todo = plan.collect()  # catalog-sized
    action = "would_drop"
    if not dry_run:
        for r in todo:
            name = f"{r['database']}.{r['table_name']}"
            raws = _generations(spark, name).values()
            spark.sql(f"DROP VIEW IF EXISTS {_q(name)}")
            for raw in raws:
                spark.sql(f"DROP TABLE IF EXISTS {_q(raw)}")
        action = "dropped"
    return spark.createDataFrame(
        [(r["table_name"], r["database"], r["location"], action) for r in todo],
        "table_name string, database string, location string, action string",
    )


def _plain(path: str) -> str:
    return re.sub("^file:/+", "file:/", path if ":" in path else f"file:{path}").rstrip("/")


def publish_missing(
    spark: SparkSession, store_root: str, database: str | None = None, scope: str = "all_rows"
) -> DataFrame:
    """Create a table for every stored folder that has none yet, continue past errors (T5); tables that
    exist take in new partitions.

    Folders come from one listing of the store (A5). Names are made fit for the catalog as a whole
    (``names.catalog_name``). Folders that propose one name are a collision: none of them takes it, and
    a folder whose name belongs to a table over another folder doesn't either; each is reported with
    the folders it collides with (Q16).
    """
    db = database or spark.catalog.currentDatabase()
    folders = C.folder_summary(C.list_files(spark, store_root, csvlake.GZ_GLOB))
    folders = folders.withColumn("proposed_table_name", N.catalog_name("proposed_table_name"))
    held, results = [], []
    for t in _published(spark, db):
        try:
            refresh_table(spark, f"{db}.{t}")
            held.append((t, _plain(_describe(spark, f"{db}.{t}").location or "")))
        except Exception as e:  # noqa: BLE001 - report and continue with the next table
            results.append((t, None, False, f"not refreshed: {str(e)[:500]}"))
    existing = spark.createDataFrame(held, "table_name string, location string")
    todo = folders.join(existing, folders["proposed_table_name"] == existing["table_name"], "left").select(
        "storage_folder_name", "proposed_table_name", "has_partitioning", "location"
    ).collect()  # one row per folder
    claims: dict[str, list[str]] = {}
    for r in todo:
        claims.setdefault(r["proposed_table_name"], []).append(r["storage_folder_name"])
    for r in sorted(todo, key=lambda r: r["storage_folder_name"]):
        folder, t = r["storage_folder_name"], r["proposed_table_name"]
        if r["location"] is not None:
            if _plain(folder) != r["location"]:
                results.append((t, folder, False, f"collision: the table is over {r['location']}"))
            continue
        others = sorted(f for f in claims[t] if f != folder)
        if others:
            results.append((t, folder, False, "collision with " + ", ".join(others)))
            continue
        try:
            ok = create_table(spark, f"{db}.{t}", folder, partitioned=r["has_partitioning"], scope=scope)
            results.append((t, folder, ok, None if ok else "exists, or no data"))
        except Exception as e:  # noqa: BLE001 - report and continue with the next folder
            results.append((t, folder, False, str(e)[:500]))
    return spark.createDataFrame(results, "table_name string, folder string, ok boolean, error string")


def republish(
    spark: SparkSession, names: list[str], database: str | None = None, scope: str = "all_rows"
) -> DataFrame:
    """Recreate tables with a fresh schema (T6, Q12): infer, make the next generation's raw table, then turn
    the view to it by one ``ALTER VIEW``. A failure before that leaves the table as it was. The
    generation before stays for readers that have looked up the old view; older ones are dropped (readers
    of partitioned tables that are two republishes behind fail when they list partitions)."""
    db = database or spark.catalog.currentDatabase()
    out = []
    for t in names:
        full, raw = f"{db}.{t}", None
        try:
            info, before = _describe(spark, full), _raw_of(spark, full)
            schema = _schema(spark, info.location, scope)
            if schema is None:
                out.append((t, False, "no data to infer from; table kept"))
                continue
            raw = f"{full}{RAW_SUFFIX}_{max(_generations(spark, full)) + 1}"
            select = _create_raw(spark, raw, info.location, schema, _partitions(spark, info.location) if info.is_partitioned else [])
            spark.sql(f"ALTER VIEW {_q(full)} AS {select}")
            for old in _generations(spark, full).values():
                if old.lower() not in (raw.lower(), before.lower()):
                    spark.sql(f"DROP TABLE IF EXISTS {_q(old)}")
            out.append((t, True, None))
        except Exception as e:  # noqa: BLE001 - report and continue with the next table
            if raw is not None and _raw_of(spark, full).lower() != raw.lower():
                spark.sql(f"DROP TABLE IF EXISTS {_q(raw)}")
            out.append((t, False, str(e)[:500]))
    return spark.createDataFrame(out, "table_name string, ok boolean, error string")
