"""Name, date, size and folder expressions on names put together from their parts."""

import calendar
import datetime as dt
import itertools
from decimal import ROUND_HALF_EVEN, Decimal

from pyspark.sql import functions as F

from frames import one_col
from reportlake.functions import names as N


def col_values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_file_version_is_the_first_tag(spark):
    tags = ["", "v3", "v0-12", "v44-0"]
    made = [(f"harvest{'_' + a if a else ''}_north{'_' + b if b else ''}.csv.gz", a or b) for a, b in itertools.product(tags, tags)]
    made += [("harvestv3.csv", ""), ("harvest_w3.csv", ""), ("harvest_v.csv", "")]
    assert col_values(one_col(spark, [n for n, _ in made]), N.file_version("v")) == [v for _, v in made]


def test_date_keys_by_the_calendar(spark):
    keys, days = [], []
    for year, month, day in itertools.product((1899, 1900, 1996, 2019, 2100, 2101), (0, 1, 2, 12, 13), (None, 0, 1, 28, 29, 30, 32)):
        keys.append(f"{year:04d}{month:02d}" + ("" if day is None else f"{day:02d}"))
        known = 1900 <= year <= 2100 and 1 <= month <= 12 and (day is None or 1 <= day <= calendar.monthrange(year, month)[1])
        days.append(dt.date(year, month, day or 1) if known else None)
    df = one_col(spark, keys)
    assert col_values(df, N.date_key_to_date("v")) == days
    assert [e is None for e in col_values(df, N.date_key_error("v"))] == [d is not None for d in days]
    odd = one_col(spark, ["", "1", "19960", "1996010", "199601011", None])
    assert col_values(odd, N.date_key_to_date("v")) == [None] * 6
    assert col_values(odd, N.date_key_error("v"))[1:] == ["date_key_length"] * 4 + [None]


def test_month_ends_of_four_years(spark):
    days = [dt.date(y, m, 1 + (7 * m) % 27) for y in (1999, 2000, 2004, 2100) for m in range(1, 13)]
    ends = [dt.date(d.year, d.month, calendar.monthrange(d.year, d.month)[1]) for d in days]
    rows = one_col(spark, days, dtype="date").select(N.month_end("v"), N.month_end_str("v"), N.month_end_key("v")).collect()
    assert [tuple(r) for r in rows] == [(e, e.isoformat(), int(e.strftime("%Y%m%d"))) for e in ends]


def size_text(size):
    """Two decimals of the largest unit that is not above the size, by exact arithmetic."""
    power = min(max(size.bit_length() - 1, 0) // 10, 5)
    shown = (Decimal(size) / Decimal(1 << (10 * power))).quantize(Decimal("0.01"), ROUND_HALF_EVEN)
    return f"{shown} {'B KB MB GB TB PB'.split()[power]}"


def test_readable_size_is_exact(spark):
    sizes = [0, 1, 9 * 10**18] + [max(0, (m << (10 * p)) + d) for p in range(6) for m in (1, 3, 999, 1023) for d in (-1, 0, 1, 5 << max(0, 10 * p - 10))]
    assert col_values(one_col(spark, sizes, dtype="bigint"), N.readable_size("v")) == [size_text(s) for s in sizes]


def test_folders_tables_and_uris(spark):
    made = [(folder, base, version) for folder in ("barn/grain", "grain", "", None) for base in ("grain", "seed_corn") for version in ("", "v2", "v2-7")]
    df = spark.createDataFrame(made, "folder string, base string, version string")
    want = [(f or b) + (f"_{v}" if v else "") for f, b, v in made]
    assert col_values(df, N.versioned_folder(N.folder_or_base("folder", "base"), "version")) == want
    assert col_values(df, N.warehouse_table_name("base", "version")) == [b + (f"_{v.replace('-', '_')}" if v else "") for _, b, v in made]
    keys = [[], ["season"], ["season", "field"], ["report_date"]]
    uris = one_col(spark, ["gs://farm/grain/" + "".join(f"{k}=*/" for k in ks) + "*.csv.gz" for ks in keys])
    assert col_values(uris, F.array_join(N.partition_columns("v"), ",")) == [",".join(k) for k in keys]
    assert col_values(one_col(spark, ["gs://farm/grain/report_date=*/*.csv.gz", "gs://farm/barn/hay/*"]), N.uri_folder("v", "gs://farm/")) == ["grain", "barn/hay"]


def test_stored_paths_come_apart(spark):
    made = [(parent, table, version, day) for parent in ("", "barn/", "barn/old/") for table in ("grain", "seed_corn") for version in ("", "v1", "v8-2") for day in (None, "2011-11-30")]
    tag = lambda v: f"_{v}" if v else ""
    df = one_col(spark, [f"{p}{t}{tag(v)}/" + (f"report_date={d}/" if d else "") + "file-1.csv.gz" for p, t, v, d in made])
    folder = N.stored_folder("v")
    assert col_values(df, folder) == [f"{p}{t}{tag(v)}" for p, t, v, _ in made]
    assert col_values(df, N.folder_table(folder)) == [t for _, t, _, _ in made]
    assert col_values(df, N.folder_version(folder)) == [v for _, _, v, _ in made]
    assert col_values(df, N.is_partitioned_path("v")) == [d is not None for *_, d in made]


def test_destination_path(spark):
    df = spark.createDataFrame([("grain", "2011-11-30", "x.csv.gz"), ("grain", None, "y.csv")], "f string, d string, n string")
    assert col_values(df, N.destination_path("f", "d", "n")) == ["grain/report_date=2011-11-30/x.csv.gz", "grain/y.csv"]


def test_catalog_name_keeps_letters_digits_and_underscores(spark):
    assert col_values(one_col(spark, ["Ebb-tide", "a.b c", "x_1", None]), N.catalog_name("v")) == ["ebb_tide", "a_b_c", "x_1", None]
