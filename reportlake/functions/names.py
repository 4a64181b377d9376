"""Column expressions over file names and paths (pure, JVM-side, codegen-friendly).

Every function takes and returns ``Column`` objects so callers can use them in
``select``/``withColumn``/``where`` and Catalyst keeps them inside whole-stage
codegen. Nothing here collects or calls Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
# Version token in a file name: first "_v<digits>" with optional "-<digits>".
VERSION_PATTERN = r"_(v[0-9]+(-[0-9]+)?)"
# Same token anchored at the end of a folder name.
FOLDER_VERSION_PATTERN = r"_(v[0-9]+(-[0-9]+)?)$"
# Size units, 1024 apart.
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]
# Hive partition directory that marks a partitioned folder.
PARTITION_KEY = "report_date"
# Editor lock files are never data.
LOCK_PREFIX = ".~lock"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def base_name(path: Column | str) -> Column:
    """Last path segment (``Path.name``)."""
    return F.substring_index(_c(path), "/", -1)


def parent_dir(path: Column | str) -> Column:
    """Everything before the last ``/`` (``Path.parent``); '' for a bare name."""
    p = _c(path)
    return F.when(F.instr(p, "/") > 0, F.regexp_replace(p, r"/[^/]*$", "")).otherwise(F.lit(""))


def file_version(name: Column | str) -> Column:
    """First ``_v<d>[-<d>]`` in the name without the underscore, else ''."""
    return F.regexp_extract(_c(name), VERSION_PATTERN, 1)


def date_key_to_date(key: Column | str) -> Column:
    """YYYYMMDD or YYYYMM text to a date; NULL when malformed, invalid or year outside 1900-2100."""
    k = _c(key).cast("string")
    parsed = (
        F.when(F.length(k) == 8, F.try_to_date(k, "yyyyMMdd"))
        .when(F.length(k) == 6, F.try_to_date(F.concat(k, F.lit("01")), "yyyyMMdd"))
    )
    ok = k.rlike("^[0-9]+$") & F.year(parsed).between(1900, 2100)
    return F.when(ok, parsed)


def date_key_error(key: Column | str) -> Column:
    """Reason a date key is rejected, NULL when it is fine (or absent)."""
    k = _c(key).cast("string")
    return (
        F.when(k.isNull(), F.lit(None).cast("string"))
        .when(~F.length(k).isin(6, 8), F.lit("date_key_length"))
        .when(date_key_to_date(k).isNull(), F.lit("date_key_invalid"))
    )


def month_end(d: Column | str) -> Column:
    """Last day of the month of a date or timestamp, as DATE."""
    return F.last_day(F.to_date(_c(d)))


def month_end_str(d: Column | str) -> Column:
    return F.date_format(month_end(d), "yyyy-MM-dd")


def month_end_key(d: Column | str) -> Column:
    return F.date_format(month_end(d), "yyyyMMdd").cast("bigint")


def readable_size(size: Column | str) -> Column:
    """Bytes as "2.50 MB": 1024 steps up to PB, two decimals, ties to even.

    Computed in exact integer arithmetic (the value is size / 1024**k, a
    dyadic fraction), so the text equals formatting the binary float with
    round-half-even, with no float or locale drift across engines.
    """
    s = _c(size).cast("bigint")
    # k = number of 1024 steps taken (0..5): a sum of comparisons, no nested CASE.
    k = sum((s >= F.lit(1024**i)).cast("int") for i in range(1, len(SIZE_UNITS)))
    sh = k * 10

    def shl(x, n):
        return F.call_function("shiftleft", x, n)

    def shr(x, n):
        return F.call_function("shiftright", x, n)

    # size = q_hi * 2**sh + r; all steps are exact integer shifts.
    q_hi = shr(s, sh)
    r100 = (s - shl(q_hi, sh)) * 100
    q_lo = shr(r100, sh)
    rem = r100 - shl(q_lo, sh)
    d = shl(F.lit(1).cast("bigint"), sh)
    q = q_hi * 100 + q_lo
    up = (k > 0) & ((rem * 2 > d) | ((rem * 2 == d) & (F.pmod(q, F.lit(2)) == 1)))
    qr = q + up.cast("bigint")
    units = F.array(*[F.lit(u) for u in SIZE_UNITS])
    return F.concat(
        (qr / 100).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad(F.pmod(qr, F.lit(100)).cast("string"), 2, "0"),
        F.lit(" "),
        F.element_at(units, k + 1),
    )


def folder_or_base(folder: Column | str, base: Column | str) -> Column:
    """Folder defaults to the selector base when empty or missing."""
    return F.coalesce(F.nullif(_c(folder), F.lit("")), _c(base))


def versioned_folder(folder: Column | str, version: Column | str) -> Column:
    """``folder_<version>`` when the file carries a version, else the folder unchanged."""
    v = _c(version)
    return F.when(F.coalesce(v, F.lit("")) != "", F.concat_ws("_", _c(folder), v)).otherwise(_c(folder))


def warehouse_table_name(table: Column | str, version: Column | str) -> Column:
    """``table_<version with - as _>`` when versioned, else the table name."""
    v = F.coalesce(_c(version), F.lit(""))
    return F.when(v != "", F.concat(_c(table), F.lit("_"), F.translate(v, "-", "_"))).otherwise(_c(table))


def catalog_name(name: Column | str) -> Column:
    """A table name the catalog takes: lower case, every other character than letters, digits and
    underscores as one underscore each (Q16)."""
    return F.regexp_replace(F.lower(_c(name)), "[^a-z0-9_]", "_")


def full_table_id(project: Column | str, dataset: Column | str, table: Column | str) -> Column:
    return F.concat_ws(".", _c(project), _c(dataset), _c(table))


def destination_path(folder: Column | str, report_date_str: Column | str, name: Column | str) -> Column:
    """``folder/report_date=D/name`` for dated files, ``folder/name`` otherwise."""
    d = _c(report_date_str)
    return F.when(
        d.isNotNull(), F.concat_ws("/", _c(folder), F.concat(F.lit(PARTITION_KEY + "="), d), _c(name))
    ).otherwise(F.concat_ws("/", _c(folder), _c(name)))


def source_uri_pattern(root: Column | str, folder: Column | str, partitioned: Column | str) -> Column:
    """``root/folder/*`` for a partitioned table, ``root/folder/*.csv.gz`` for a flat one."""
    return F.when(
        _c(partitioned), F.concat_ws("/", _c(root), _c(folder), F.lit("*"))
    ).otherwise(F.concat_ws("/", _c(root), _c(folder), F.lit("*.csv.gz")))


def partition_columns(uri: Column | str) -> Column:
    """Names of ``/<col>=*`` parts in a URI pattern, in order."""
    return F.regexp_extract_all(_c(uri), F.lit(r"/([A-Za-z0-9_]+)=\*"), 1)


def stored_folder(path: Column | str) -> Column:
    """Folder of a stored path: the part before the first ``report_date=`` segment, else its directory."""
    parts = F.split(_c(path), "/")
    hit = F.array_position(F.transform(parts, lambda p: p.contains(PARTITION_KEY + "=")), True)
    n = F.size(parts)
    return F.when(hit > 0, F.array_join(F.slice(parts, 1, hit - 1), "/")).otherwise(
        F.array_join(F.slice(parts, 1, F.greatest(n - 1, F.lit(0))), "/")
    )


def is_partitioned_path(path: Column | str) -> Column:
    return _c(path).contains(PARTITION_KEY + "=")


def folder_table(folder: Column | str) -> Column:
    """Table part of a folder's last segment (version suffix removed)."""
    last = F.substring_index(_c(folder), "/", -1)
    return F.regexp_replace(last, FOLDER_VERSION_PATTERN, "")


def folder_version(folder: Column | str) -> Column:
    last = F.substring_index(_c(folder), "/", -1)
    return F.regexp_extract(last, FOLDER_VERSION_PATTERN, 1)


def uri_folder(uri: Column | str, bucket_prefix: str) -> Column:
    """Folder behind a table's source URI: drop the bucket prefix, any partition part and the wildcard file part."""
    u = _c(uri)
    if bucket_prefix:
        u = F.when(u.startswith(bucket_prefix), F.substring(u, len(bucket_prefix) + 1, 1 << 30)).otherwise(u)
    u = F.regexp_replace(u, "/" + PARTITION_KEY + "=.*$", "")
    u = F.regexp_replace(u, r"/\*[^/]*$", "")
    return u


def is_lock_file(name: Column | str) -> Column:
    return _c(name).startswith(LOCK_PREFIX)
