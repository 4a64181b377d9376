"""Inputs derived from the driver tables, so every registered query grows with them.

* ``landing_listing``: a file inventory (``path, length, modificationTime``),
  one file per ``orders`` row, names shaped like monthly report files (report
  family, version, date key, owner, desk, extension, lock files, bad names).
* ``store_listing``: objects already in the store, from the same orders.
* ``report_lake``: a test table written as gzip CSV report files under
  ``report_date=`` folders, half of the months with a one-cell title row.

Each Spark builder has a DuckDB twin (``*_SQL``) that the oracle queries use.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.session import shared_dir, spread
from reportlake.sources.specs import SourceSpec

# An invented office: ledgers, stock and freight reports of several desks. The family of a file is
# chosen by o_custkey % 8. ``ledger_notes`` files are selected by the ledger source but carry no key.
FAMILIES = ["ledger", "ledger_fx", "stock", "stock_moves", "freight", "tariff", "price_list", "ledger_notes"]
#: ``<family>[_v<a>-<b>]__<yyyymm[dd]>__<owner>__d<desk>``
KEYED_PATTERN = r"[a-z_]+?(?:_v\d+(?:-\d+)?)?__(\d{8}|\d{6})__([^_]+)__d(\d)"
KEYED_GROUPS = ("file_date_key", "content_owner", "desk")
STORE_PREFIX = "office-store"


def _keyed(family: str, excluded: str | None = None, folder: str | None = None, **options) -> SourceSpec:
    """A source of dated files of one family; ``excluded`` keeps a longer family name out."""
    return SourceSpec(
        family, family, exclude_file_name_base=excluded, regex_pattern=KEYED_PATTERN, regex_group_names=KEYED_GROUPS,
        storage_folder_name=f"{STORE_PREFIX}/{family}" if folder is None else folder, table_name=family, **options,
    )


FIXTURE_SPECS: list[SourceSpec] = [
    _keyed("ledger", "ledger_fx"),
    _keyed("ledger_fx"),
    _keyed("stock", "stock_moves"),
    _keyed("stock_moves"),
    _keyed("freight", "freight_void"),
    _keyed("freight_void", is_enabled=False),
    _keyed("tariff", folder=""),
    SourceSpec("price_list", "price_list", regex_pattern=r"price_list_(.+)_ed(.+)\.csv",
               regex_group_names=("content_owner", "file_version"), storage_folder_name=f"{STORE_PREFIX}/price_list",
               table_name="price_list", table_append_or_replace="replace"),
]


def _s(c: Column) -> Column:
    return c.cast("string")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"
    ))


def _name_parts(o: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    fam = F.element_at(F.array(*[F.lit(f) for f in FAMILIES]), (c % 8 + 1).cast("int"))
    owner = F.regexp_replace("o_orderpriority", " ", "-")
    ym = F.date_format("o_orderdate", "yyyyMM")
    datekey = (
        F.when(k % 101 == 0, F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("13")))
        .when(k % 2 == 0, ym)
        .otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    )
    major = _s(1 + c % 2)
    vtag = (
        F.when(k % 5 == 0, F.lit(""))
        .when(k % 5 == 1, F.concat(F.lit("v"), major))
        .otherwise(F.concat(F.lit("v"), major, F.lit("-"), _s(k % 3)))
    )
    ext = F.when(k % 13 == 0, F.lit(".csv")).when(k % 17 == 0, F.lit(".csv.zip")).otherwise(F.lit(".csv.gz"))
    core = (
        F.when(fam == "price_list", F.concat(F.lit("price_list_"), owner, F.lit("_ed"), _s(1 + k % 3)))
        .when(fam == "ledger_notes", F.concat(F.lit("ledger_notes-"), _s(k)))
        .otherwise(
            F.concat(
                fam, F.when(vtag != "", F.concat(F.lit("_"), vtag)).otherwise(F.lit("")),
                F.lit("__"), datekey, F.lit("__"), owner, F.lit("__d"), _s(c % 4),
            )
        )
    )
    return o.select("*", fam.alias("fam"), vtag.alias("vtag"), ext.alias("ext"), core.alias("core"))


def landing_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File inventory of a landing folder, one file per order."""
    k = F.col("o_orderkey")
    p = _name_parts(_orders(spark, sf_dir))
    lock = F.when(k % 29 == 0, F.lit(".~lock.")).otherwise(F.lit(""))
    d = F.concat(F.lit("landing/drop_"), _s(k % 4), F.when(k % 3 == 0, F.lit("/nested")).otherwise(F.lit("")))
    size = F.round(F.col("o_totalprice") * 100).cast("bigint")
    size = F.when(k % 7 == 0, size * 1000).otherwise(size)
    return p.select(
        F.concat(d, F.lit("/"), lock, F.col("core"), F.col("ext")).alias("path"),
        size.alias("length"),
        F.col("o_orderdate").cast("timestamp").alias("modificationTime"),
    )


def store_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects already in the store: orders with status F (partitioned) or P (flat)."""
    p = _name_parts(_orders(spark, sf_dir)).where(F.col("o_orderstatus").isin("F", "P"))
    folder = F.concat(
        F.lit(STORE_PREFIX + "/"), F.col("fam"),
        F.when(F.col("vtag") != "", F.concat(F.lit("_"), F.col("vtag"))).otherwise(F.lit("")),
    )
    part = F.when(
        F.col("o_orderstatus") == "F",
        F.concat(F.lit("/report_date="), F.date_format(F.last_day(F.to_date("o_orderdate")), "yyyy-MM-dd")),
    ).otherwise(F.lit(""))
    return p.select(F.concat(folder, part, F.lit("/"), F.col("core"), F.lit(".csv.gz")).alias("path"))


# DuckDB twins of the builders above (tables are pre-registered views).
_FAMILIES_SQL = "[" + ", ".join(f"'{f}'" for f in FAMILIES) + "]"
NAME_PARTS_SQL = f"""
name_base AS (
  SELECT o.*, {_FAMILIES_SQL}[(o_custkey % 8) + 1] AS fam,
         replace(o_orderpriority, ' ', '-') AS owner,
         CASE WHEN o_orderkey % 101 = 0 THEN strftime(o_orderdate, '%Y') || '13'
              WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y%m')
              ELSE strftime(o_orderdate, '%Y%m%d') END AS datekey,
         CASE WHEN o_orderkey % 5 = 0 THEN ''
              WHEN o_orderkey % 5 = 1 THEN 'v' || CAST(1 + o_custkey % 2 AS VARCHAR)
              ELSE 'v' || CAST(1 + o_custkey % 2 AS VARCHAR) || '-' || CAST(o_orderkey % 3 AS VARCHAR) END AS vtag,
         CASE WHEN o_orderkey % 13 = 0 THEN '.csv' WHEN o_orderkey % 17 = 0 THEN '.csv.zip' ELSE '.csv.gz' END AS ext
  FROM orders o
),
name_parts AS (
  SELECT *,
         CASE WHEN fam = 'price_list' THEN 'price_list_' || owner || '_ed' || CAST(1 + o_orderkey % 3 AS VARCHAR)
              WHEN fam = 'ledger_notes' THEN 'ledger_notes-' || CAST(o_orderkey AS VARCHAR)
              ELSE fam || CASE WHEN vtag <> '' THEN '_' || vtag ELSE '' END || '__' || datekey || '__' || owner
                   || '__d' || CAST(o_custkey % 4 AS VARCHAR)
         END AS core
  FROM name_base
)"""

LANDING_SQL = NAME_PARTS_SQL + """,
landing AS (
  SELECT 'landing/drop_' || CAST(o_orderkey % 4 AS VARCHAR) || CASE WHEN o_orderkey % 3 = 0 THEN '/nested' ELSE '' END
         || '/' || CASE WHEN o_orderkey % 29 = 0 THEN '.~lock.' ELSE '' END || core || ext AS path,
         CASE WHEN o_orderkey % 7 = 0 THEN CAST(round(o_totalprice * 100) AS BIGINT) * 1000
              ELSE CAST(round(o_totalprice * 100) AS BIGINT) END AS length,
         CAST(o_orderdate AS TIMESTAMP) AS modificationTime
  FROM name_parts
)"""

STORE_SQL = """,
store AS (
  SELECT 'office-store/' || fam || CASE WHEN vtag <> '' THEN '_' || vtag ELSE '' END
         || CASE WHEN o_orderstatus = 'F' THEN '/report_date=' || strftime(last_day(CAST(o_orderdate AS DATE)), '%Y-%m-%d') ELSE '' END
         || '/' || core || '.csv.gz' AS path
  FROM name_parts WHERE o_orderstatus IN ('F', 'P')
)"""


def specs_values_sql(specs: list[SourceSpec] = FIXTURE_SPECS) -> str:
    """The specs as a DuckDB VALUES relation ``specs(...)`` with the selector globs lower-cased."""

    def q(v):
        if v is None:
            return "NULL"
        return "'" + str(v).replace("'", "''") + "'"

    rows = []
    for i, s in enumerate(specs):
        groups = "NULL" if s.regex_group_names is None else "[" + ", ".join(q(g) for g in s.regex_group_names) + "]"
        rows.append(
            f"({i}, {q(s.source_id)}, {str(s.is_enabled).upper()}, {q(s.select_file_name_base)}, "
            f"{q(s.exclude_file_name_base)}, {q(s.regex_pattern)}, {groups}, {q(s.storage_folder_name)}, "
            f"{q(s.table_name)}, {q(s.table_append_or_replace)})"
        )
    return (
        "specs AS (SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(source_idx, source_id, is_enabled, "
        "select_file_name_base, exclude_file_name_base, regex_pattern, regex_group_names, storage_folder_name, "
        "table_name, table_append_or_replace))"
    )


# ---------------------------------------------------------------- report lakes


@dataclass(frozen=True)
class LakeColumn:
    header: str  # raw header cell as written in the file
    duck: str  # the cell as DuckDB SQL text (VARCHAR or NULL), for oracles
    build: object  # zero-arg callable giving the Spark Column (built lazily: needs a session)

    @property
    def spark(self) -> Column:
        return self.build()


def _fmt2(c: Column) -> Column:
    """``%.2f``; a positive number goes by its decimal, which rounds alike and is cheaper."""
    return F.when(c > 0, F.coalesce(c.try_cast("decimal(18,2)").cast("string"), F.format_string("%.2f", c))).otherwise(F.format_string("%.2f", c))


def _mixed_units() -> Column:
    q, d = F.col("l_quantity"), F.col("l_discount")
    return F.when(d == 0, _s(q.cast("bigint"))).otherwise(_fmt2(q * (1 - d)))


_MIXED_DUCK = (
    "CASE WHEN l_discount = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) "
    "ELSE printf('%.2f', l_quantity * (1 - l_discount)) END"
)


def _comment() -> Column:
    k = F.col("o_orderkey")
    return (
        F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit("NULL")).when(k % 4 == 2, F.lit(" none "))
        .otherwise(F.concat(F.lit("c"), _s(F.col("o_custkey"))))
    )


LAKE_LAYOUTS: dict[str, tuple[str, list[LakeColumn]]] = {
    "orders": ("o_orderdate", [
        LakeColumn("Order Key", "CAST(o_orderkey AS VARCHAR)", lambda: _s(F.col("o_orderkey"))),
        LakeColumn("Cust Key", "CAST(o_custkey AS VARCHAR)", lambda: _s(F.col("o_custkey"))),
        LakeColumn("Order Status", "o_orderstatus", lambda: F.col("o_orderstatus")),
        LakeColumn("Total Price (USD)", "printf('%.2f', o_totalprice)", lambda: _fmt2(F.col("o_totalprice"))),
        LakeColumn("Order Date", "strftime(o_orderdate, '%Y-%m-%d')", lambda: F.date_format("o_orderdate", "yyyy-MM-dd")),
        LakeColumn("Order Priority", "o_orderpriority", lambda: F.col("o_orderpriority")),
        LakeColumn(
            "Is Urgent?", "CASE WHEN o_orderpriority = '1-URGENT' THEN 'yes' ELSE 'no' END",
            lambda: F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("yes")).otherwise(F.lit("no")),
        ),
        LakeColumn(
            "Comment",
            "CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'NULL' "
            "WHEN o_orderkey % 4 = 2 THEN ' none ' ELSE 'c' || CAST(o_custkey AS VARCHAR) END",
            _comment,
        ),
    ]),
    "lineitem": ("l_shipdate", [
        LakeColumn("Order Key", "CAST(l_orderkey AS VARCHAR)", lambda: _s(F.col("l_orderkey"))),
        LakeColumn("Part Key", "CAST(l_partkey AS VARCHAR)", lambda: _s(F.col("l_partkey"))),
        LakeColumn("Supp Key", "CAST(l_suppkey AS VARCHAR)", lambda: _s(F.col("l_suppkey"))),
        LakeColumn("Line Number", "CAST(l_linenumber AS VARCHAR)", lambda: _s(F.col("l_linenumber"))),
        LakeColumn("Quantity", "printf('%.2f', l_quantity)", lambda: _fmt2(F.col("l_quantity"))),
        LakeColumn("Extended Price", "printf('%.2f', l_extendedprice)", lambda: _fmt2(F.col("l_extendedprice"))),
        LakeColumn("Discount", "printf('%.2f', l_discount)", lambda: _fmt2(F.col("l_discount"))),
        LakeColumn("Tax", "printf('%.2f', l_tax)", lambda: _fmt2(F.col("l_tax"))),
        LakeColumn("Return Flag", "l_returnflag", lambda: F.col("l_returnflag")),
        LakeColumn("Line Status", "l_linestatus", lambda: F.col("l_linestatus")),
        LakeColumn(
            "Ship Date", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')",
            lambda: F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
        ),
        LakeColumn("Net Revenue", _MIXED_DUCK, _mixed_units),
        LakeColumn("Net Units", _MIXED_DUCK, _mixed_units),
    ]),
    "events": ("ts", [
        LakeColumn("Event Id", "CAST(event_id AS VARCHAR)", lambda: _s(F.col("event_id"))),
        LakeColumn("TS", "strftime(ts, '%Y-%m-%d %H:%M:%S')", lambda: F.date_format("ts", "yyyy-MM-dd HH:mm:ss")),
        LakeColumn("User Id", "CAST(user_id AS VARCHAR)", lambda: _s(F.col("user_id"))),
        LakeColumn("Event Type", "event_type", lambda: F.col("event_type")),
        LakeColumn("Value", "printf('%.2f', value)", lambda: _fmt2(F.col("value"))),
        # Ragged rows: the last cell is missing on even event ids.
        LakeColumn("Props", "CASE WHEN event_id % 2 = 1 THEN props END", lambda: F.col("props")),
    ]),
}


def lake_columns(table: str) -> tuple[str, list[LakeColumn]]:
    """Raw header and value expressions of the report lake of a driver table, with its date column."""
    if table not in LAKE_LAYOUTS:
        raise ValueError(f"no report lake layout for {table}")
    return LAKE_LAYOUTS[table]


# Rows whose last cell is left out (short rows), per table.
RAGGED = {"events": lambda: F.col("event_id") % 2 == 0}


TITLE = "Monthly report"


def _title_month(rd: Column) -> Column:
    """Months whose files carry a title row: even months."""
    return F.month(rd) % 2 == 0


@F.pandas_udf(T.BooleanType())
def _first_of_key(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Whether a row is the first of its key in its task. Only the key goes to Python."""
    seen: set = set()
    for some in keys:
        first = ~some.duplicated() & ~some.isin(seen)
        seen.update(some[first])
        yield first


def write_report_lake(
    df: DataFrame,
    date_col: str,
    columns: list[LakeColumn],
    root: str,
    files_per_month: int = 2,
    short_row: Column | None = None,
    group: Column | None = None,
) -> str:
    """Write rows as gzip CSV report files under ``root/report_date=<month end>/``.

    Rows of a month are spread over ``files_per_month`` hash buckets, so a hot
    month is several tasks and files, never one. Each file starts with the
    header (and the title in even months): the first row of a month in its task
    brings them along, and a local sort puts them first.
    """
    rd = F.last_day(F.to_date(F.col(date_col))) if group is None else group
    line = F.to_csv(
        F.struct(*[c.spark.alias(f"c{i}") for i, c in enumerate(columns)]),
        {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"},
    )
    if short_row is not None:
        line = F.when(short_row, F.regexp_replace(line, ",[^,]*$", "")).otherwise(line)
    rows = df.select(rd.alias("report_date"), line.alias("line"))
    header_line = ",".join(c.header if "," not in c.header else '"' + c.header + '"' for c in columns)
    titled = _title_month(F.col("report_date")) if group is None else F.substring_index("report_date", "|", -1).substr(5, 2).cast("int") % 2 == 0
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    n_tasks = max(parallelism, df.rdd.getNumPartitions()) * files_per_month
    bucket = F.pmod(F.xxhash64("line"), F.lit(files_per_month))
    dealt = rows.repartition(n_tasks, "report_date", bucket).withColumn("first", _first_of_key(F.col("report_date").cast("string")))
    entry = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("line"))
    title, header, row = entry(0, F.lit(TITLE)), entry(1, F.lit(header_line)), entry(2, F.col("line"))
    lines = F.when(F.col("first") & titled, F.array(title, header, row)).when(F.col("first"), F.array(header, row)).otherwise(F.array(row))
    out = dealt.select("report_date", F.inline(lines)).sortWithinPartitions("report_date", "kind")
    (
        out.select("report_date", "line")
        .write.mode("overwrite")
        .option("sep", "\u0001")
        .option("quote", "")
        .option("escapeQuotes", "false")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .option("compression", "gzip")
        .partitionBy("report_date")
        .csv(root)
    )
    return root


_LAKES: dict = {}


def report_lake(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Path of the report lake for a driver table, written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), table)
    if key not in _LAKES:
        date_col, cols = lake_columns(table)
        src = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        short = RAGGED[table]() if table in RAGGED else None
        _LAKES[key] = write_report_lake(src, date_col, cols, shared_dir(spark, f"lake-{table}"), short_row=short)
    return _LAKES[key]


def lake_values_sql(table: str) -> str:
    """DuckDB relation ``lake_<table>`` with the lake's raw string cells and ``report_date``."""
    date_col, cols = lake_columns(table)
    sel = ", ".join(f'{c.duck} AS "{c.header}"' for c in cols)
    return f"lake_{table} AS (SELECT {sel}, last_day(CAST({date_col} AS DATE)) AS report_date FROM {table})"


def _fs_path(uri: str):
    """pyarrow filesystem and path for a Spark path URI (``file:/x``, ``hdfs://..``, ``s3://..``)."""
    import pyarrow.fs as pafs

    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = "file://" + uri[len("file:"):]
    if "://" not in uri:
        uri = "file://" + uri
    return pafs.FileSystem.from_uri(uri)


def _zip_writer(root: str):
    def run(batches):
        import gzip
        import io
        import zipfile

        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                folder = path.rsplit("/", 2)[-2]  # report_date=...
                base = path.rsplit("/", 1)[-1][: -len(".csv.gz")]
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
                    zf.writestr(f"exports/nested/{base}.csv", gzip.decompress(content))
                    zf.writestr(f"__MACOSX/exports/nested/._{base}.csv", b"\x00\x05\x16\x07")
                fs, p = _fs_path(f"{root}/{folder}/{base}.zip")
                fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(p) as f:
                    f.write(buf.getvalue())
                out.append((f"{root}/{folder}/{base}.zip",))
            yield pd.DataFrame(out, columns=["zip_path"])

    return run


def write_named_gzip(files: DataFrame, root: str) -> None:
    """Write (name, content) rows as gzip files (plain where the name doesn't end in ``.gz``), one file a
    row, in the tasks."""

    def run(batches):
        import gzip
        import urllib.parse

        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"]):
                fs, p = _fs_path(f"{root}/{urllib.parse.quote(name)}")
                fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(p, compression=None) as f:
                    f.write(gzip.compress(content.encode()) if name.endswith(".gz") else content.encode())
            yield pd.DataFrame({"n": [len(pdf)]})

    files.select("name", "content").mapInPandas(run, "n long").count()


_ZIPS: dict = {}


def zip_lake(spark: SparkSession, sf_dir: str, table: str) -> str:
    """Every file of the table's report lake repacked as a zip archive (nested entry, macOS junk)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), table)
    if key not in _ZIPS:
        src = report_lake(spark, sf_dir, table)
        root = shared_dir(spark, f"zips-{table}")
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv.gz").load(src).select("path", "content")
        )
        files.mapInPandas(_zip_writer(root), "zip_path string").count()
        _ZIPS[key] = root
    return _ZIPS[key]


_STORES: dict = {}
STORE_TABLES = {"orders": f"{STORE_PREFIX}/orders_v1-0", "lineitem": f"{STORE_PREFIX}/lineitem"}


def report_store(spark: SparkSession, sf_dir: str) -> str:
    """A store root holding the orders lake (versioned folder) and the lineitem lake side by side."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STORES:
        root = shared_dir(spark, "store")
        for table, folder in STORE_TABLES.items():
            date_col, cols = lake_columns(table)
            src = spark.read.parquet(f"{sf_dir}/{table}.parquet")
            write_report_lake(src, date_col, cols, f"{root}/{folder}")
        _STORES[key] = root
    return _STORES[key]


_LANDING: dict = {}
LANDING_BASE = "ledger"
LANDING_SPEC = _keyed("ledger", "ledger_fx")


def landing_files(spark: SparkSession, sf_dir: str) -> str:
    """A flat landing folder of named report files: one gzip CSV per (priority, month) of ``orders``,
    named ``ledger_v1-0__<yyyymm>__<priority>__d0.csv.gz``; even months carry a title row.

    Spark writes one file per group (a hash repartition on the group puts each
    group in one task), then the driver renames the part files to report names
    through the Hadoop FileSystem API (metadata operations only).
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _LANDING:
        return _LANDING[key]
    date_col, cols = lake_columns("orders")
    base = shared_dir(spark, "landing")
    staging, root = f"{base}/_staging", f"{base}/files"
    src = spark.read.parquet(f"{sf_dir}/orders.parquet")
    grp = F.concat(F.regexp_replace("o_orderpriority", " ", "-"), F.lit("|"), F.date_format("o_orderdate", "yyyyMM"))
    write_report_lake(src, date_col, cols, staging, files_per_month=1, group=grp)
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    staging_path = jvm.org.apache.hadoop.fs.Path(staging)
    fs = staging_path.getFileSystem(conf)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(root))
    it = fs.listFiles(staging_path, True)
    while it.hasNext():
        st = it.next().getPath()
        name = st.getName()
        if not name.endswith(".csv.gz"):
            continue
        from urllib.parse import unquote

        owner, ym = unquote(st.getParent().getName().split("=", 1)[1]).rsplit("|", 1)
        target = f"{LANDING_BASE}_v1-0__{ym}__{owner}__d0.csv.gz"
        fs.rename(st, jvm.org.apache.hadoop.fs.Path(f"{root}/{target}"))
    _LANDING[key] = root
    return root


def write_named_zips(files: DataFrame, root: str) -> None:
    """Write (name, entries: array of (entry, content)) rows as zip archives, one a row, in the tasks."""

    def run(batches):
        import io
        import urllib.parse
        import zipfile

        for pdf in batches:
            for name, entries in zip(pdf["name"], pdf["entries"]):
                buf = io.BytesIO()
                with zipfile.ZipFile(buf, "w", compression=zipfile.ZIP_DEFLATED) as zf:
                    for e in entries:
                        zf.writestr(e["entry"], e["content"])
                fs, p = _fs_path(f"{root}/{urllib.parse.quote(name)}")
                fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                with fs.open_output_stream(p, compression=None) as f:
                    f.write(buf.getvalue())
            yield pd.DataFrame({"n": [len(pdf)]})

    files.select("name", "entries").mapInPandas(run, "n long").count()
