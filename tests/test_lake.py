"""Reading lakes with mixed layouts, ragged rows, null tokens; loading and the stream
(reference inference integration tests, round trips over written lakes)."""

import gzip

import pytest
from pyspark.sql import functions as F

from reportlake.operators import catalog as C
from reportlake.operators import infer
from reportlake.operators import load as L
from reportlake.sources import csvlake
from reportlake.sources.specs import SourceSpec
from reportlake.streaming import ingest


def write_gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)


HEADER = "Asset ID,Revenue (USD),Date"


def rows(n, start=0):
    return "".join(f"A{i},{i}.5,2023-06-{(i % 28) + 1:02d}\n" for i in range(start, start + n))


@pytest.fixture()
def mixed_lake(tmp_path):
    root = tmp_path / "tide_v1-1"
    write_gz(root / "report_date=2018-01-31" / "a.csv.gz", HEADER + "\n" + rows(20))
    write_gz(root / "report_date=2018-06-30" / "b.csv.gz", "Invalid Single Column\n" + HEADER + "\n" + rows(30, 100))
    write_gz(root / "report_date=2018-06-30" / "c.csv.gz", HEADER + "\n" + rows(5, 500))
    return str(root)


def test_head_of_newest_file_detects_title(spark, mixed_lake):
    head = csvlake.lake_head(spark, mixed_lake)
    assert head.newest_path.endswith("c.csv.gz") or head.newest_path.endswith("b.csv.gz")
    assert head.header == HEADER.split(",")
    assert head.columns == ["asset_id", "revenue__usd", "date"]


def test_mixed_layout_read_per_file(spark, mixed_lake):
    head = csvlake.lake_head(spark, mixed_lake)
    raw = csvlake.read_raw(spark, mixed_lake, head)
    counts = {str(r[0]): r[1] for r in raw.groupBy("report_date").count().collect()}
    assert counts == {"2018-01-31": 20, "2018-06-30": 35}
    assert raw.where(F.col("asset_id").isin("Asset ID", "Invalid Single Column")).count() == 0


def test_file_layouts(spark, mixed_lake):
    lay = {r["file_path"].rsplit("/", 1)[-1]: r for r in csvlake.file_layouts(spark, mixed_lake).collect()}
    assert lay["b.csv.gz"]["has_title"] and not lay["a.csv.gz"]["has_title"] and not lay["c.csv.gz"]["has_title"]
    assert {r["header_line"] for r in lay.values()} == {HEADER}


def test_one_column_csv_is_not_a_title(spark, tmp_path):
    write_gz(tmp_path / "t" / "x.csv.gz", "only\n1\n2\n")
    head = csvlake.lake_head(spark, str(tmp_path / "t"))
    assert not head.has_title and head.columns == ["only"]


def test_infer_and_typed_read(spark, mixed_lake):
    schema = infer.infer_lake_schema(spark, mixed_lake, scope="all_rows")
    assert schema.types == ["STRING", "BIGNUMERIC", "DATE"]
    typed = infer.read_typed(spark, mixed_lake, schema)
    assert dict(typed.dtypes)["revenue__usd"] == "decimal(38,18)" and dict(typed.dtypes)["date"] == "date"
    assert typed.where(F.col("date").isNull()).count() == 0


def test_header_only_file_gives_all_string(spark, tmp_path):
    write_gz(tmp_path / "h" / "x.csv.gz", "header1,header2,header3\nv1,v2,v3\n")
    schema = infer.infer_lake_schema(spark, str(tmp_path / "h"))
    assert schema.types == ["STRING"] * 3


def test_no_file_no_schema_and_fallback(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "x.csv").write_text("a,b\n1,2\n")
    assert infer.infer_lake_schema(spark, str(tmp_path / "empty")) is None
    df = infer.read_typed(spark, str(tmp_path / "empty"), autodetect_fallback=True)
    assert dict(df.dtypes) == {"a": "int", "b": "int"}
    with pytest.raises(ValueError):
        infer.read_typed(spark, str(tmp_path / "empty"), autodetect_fallback=False)


def test_ragged_and_null_tokens(spark, tmp_path):
    body = "".join(f"{i},{i}\n" for i in range(50)) + "".join(f"{i}\n" for i in range(50))
    body += "".join(f"x{i}, null \n" for i in range(10)) + "y,\n"
    write_gz(tmp_path / "r" / "x.csv.gz", "a,b\n" + body)
    schema = infer.infer_lake_schema(spark, str(tmp_path / "r"), scope="all_rows")
    assert schema.types[1] == "INT64"
    typed = infer.read_typed(spark, str(tmp_path / "r"), schema, on_error="quarantine")
    assert typed.where(F.col("b").isNotNull()).count() == 50
    assert typed.where(F.size("_rejected") > 0).count() == 0


def by_date(df):
    return {str(r[0]): r[1] for r in df.groupBy("report_date").count().collect()}


def test_load_twice_replace_a_file_and_reconcile(spark, mixed_lake, tmp_path):
    src = csvlake.read_raw(spark, mixed_lake, csvlake.lake_head(spark, mixed_lake))
    lake = str(tmp_path / "lake")
    L.land(spark, src, lake, "tide")
    L.land(spark, src, lake, "tide")  # nothing new
    landed = lambda: L.committed(spark, L.read_landed(spark, f"{lake}/tide"), lake)
    rec = L.reconcile(src, landed()).collect()
    assert {r["status"] for r in rec} == {"ok"} and len(rec) == 3
    assert L.read_log(spark, lake).agg(F.count("*"), F.sum("rows")).first()[:] == (3, 55)
    one_file = src.where(F.col("src_file").endswith("c.csv.gz"))  # 5 rows of the 35 of its month
    L.land(spark, one_file.limit(2), lake, "tide", mode="replace")
    assert by_date(landed()) == {"2018-01-31": 20, "2018-06-30": 32}
    assert by_date(L.read_landed(spark, f"{lake}/tide")) == {"2018-01-31": 20, "2018-06-30": 37}  # old rows are hidden, not lost


def test_committed_hides_a_crashed_load(spark, mixed_lake, tmp_path, monkeypatch):
    src = csvlake.read_raw(spark, mixed_lake, csvlake.lake_head(spark, mixed_lake))
    lake = str(tmp_path / "lake2")
    L.land(spark, src.where("report_date = '2018-01-31'"), lake, "t")
    with monkeypatch.context() as m:
        m.setattr(L, "append_log", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            L.land(spark, src.where("report_date = '2018-06-30'"), lake, "t")
    rows = L.read_landed(spark, f"{lake}/t")
    assert rows.count() == 55 and L.committed(spark, rows, lake).count() == 20
    L.land(spark, src, lake, "t")  # the crashed files land again, the others don't
    assert by_date(L.committed(spark, L.read_landed(spark, f"{lake}/t"), lake)) == {"2018-01-31": 20, "2018-06-30": 35}


def test_schema_drift_lands_by_name(spark, tmp_path):
    lake = str(tmp_path / "drift")
    frame = lambda columns, rows, day: spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns)).withColumn("src_file", F.lit(f"file:/{day}")).withColumn("report_date", F.lit(day).cast("date"))
    L.land(spark, frame(["a", "b"], [("1", "x")], "2020-01-31"), lake, "t")
    L.land(spark, frame(["b", "c", "a"], [("y", "new", "2")], "2020-02-29"), lake, "t")
    L.land(spark, frame(["a"], [("3",)], "2020-03-31"), lake, "t")
    got = L.committed(spark, L.read_landed(spark, f"{lake}/t"), lake).orderBy("a").select("a", "b", "c").collect()
    assert [tuple(r) for r in got] == [("1", "x", None), ("2", "y", "new"), ("3", None, None)]
    assert L.folder_columns(spark, f"{lake}/t") == ["a", "b", "c"]


def test_quotes_blanks_and_line_breaks_survive(spark, tmp_path):
    cells = ['He said ""hi"", ok', "two\nlines", "C:\\", " padded ", "", "a,b"]
    write_gz(tmp_path / "q" / "one.csv.gz", "\n\nkey,note\n" + "".join(f'{i},"{c}"\n' for i, c in enumerate(cells)))
    root = str(tmp_path / "q")
    head = csvlake.lake_head(spark, root)
    assert head.columns == ["key", "note"]
    raw = csvlake.read_raw(spark, root, head).withColumn("report_date", F.lit("2020-01-31").cast("date"))
    want = [c.replace('""', '"') for c in cells]
    shown = lambda df: [r["note"] or "" for r in df.orderBy("key").collect()]
    assert shown(raw) == want
    L.land(spark, raw, str(tmp_path / "lake"), "q")
    assert shown(L.read_landed(spark, str(tmp_path / "lake" / "q"))) == want


def test_plan_summary_and_rejects(spark):
    cat = spark.createDataFrame(
        [("t", "a.csv.gz", "2023-06-30", 1024), ("t", "b.csv", "2023-06-30", 2048), ("t", "c.csv", None, 10)],
        "table_name string, file_name string, report_date_str string, file_size_in_bytes bigint",
    )
    assert [r["file_name"] for r in L.load_rejects(cat).collect()] == ["b.csv"]
    r = L.plan_summary(cat).first()
    assert (r["files"], r["total_bytes"], r["ok"], r["failed"]) == (3, 3082, 2, 1)


def test_incremental_stream_only_new_files(spark, mixed_lake, tmp_path):
    schema = infer.infer_lake_schema(spark, mixed_lake, scope="all_rows")
    sink, ckpt = str(tmp_path / "sink"), str(tmp_path / "ckpt")
    # 55 data rows; the header row under a title is dropped (inside the CSV reader when the
    # filter is pushed down, so it may or may not count as an input row)
    assert ingest.run_once(spark, mixed_lake, schema, sink, ckpt) in (55, 56)
    assert spark.read.parquet(sink).count() == 55
    assert ingest.run_once(spark, mixed_lake, schema, sink, ckpt) == 0
    write_gz(tmp_path / "tide_v1-1" / "report_date=2018-07-31" / "d.csv.gz", HEADER + "\n" + rows(4, 900))
    assert ingest.run_once(spark, mixed_lake, schema, sink, ckpt) == 4
    assert spark.read.parquet(sink).count() == 59


def test_on_error_fail_and_strict_catalog(spark, tmp_path):
    body = "".join(f"{i}\n" for i in range(40)) + "not-a-number\n"
    write_gz(tmp_path / "f" / "x.csv.gz", "n\n" + body)
    root = str(tmp_path / "f")
    schema = infer.infer_lake_schema(spark, root, scope="all_rows")
    assert schema.types == ["INT64"]
    assert infer.read_typed(spark, root, schema, on_error="null").where("n is null").count() == 1
    with pytest.raises(ValueError):
        infer.read_typed(spark, root, schema, on_error="fail")
    cat = spark.createDataFrame([("a.csv", "name_mismatch")], "file_path string, error string")
    with pytest.raises(ValueError):
        C.assert_no_rejects(cat)
    ok = spark.createDataFrame([("a.csv", None)], "file_path string, error string")
    assert C.assert_no_rejects(ok).count() == 1


def test_corrupt_gzip_gives_no_schema(spark, tmp_path):
    d = tmp_path / "bad"
    d.mkdir()
    (d / "x.csv.gz").write_bytes(b"this is not gzip data at all")
    assert csvlake.lake_head(spark, str(d)) is None
    assert infer.infer_lake_schema(spark, str(d)) is None


def test_sample_scope(spark, mixed_lake):
    s = infer.infer_lake_schema(spark, mixed_lake, scope="sample", fraction=0.8, seed=7)
    assert s.types == ["STRING", "BIGNUMERIC", "DATE"]


def test_file_layouts_one_column_and_quoted_title(spark, tmp_path):
    write_gz(tmp_path / "o" / "one.csv.gz", "only\n1\n2\n")
    write_gz(tmp_path / "o" / "quoted.csv.gz", '"Report, June"\nA,B\n1,2\n')
    lay = {r["file_path"].rsplit("/", 1)[-1]: r for r in csvlake.file_layouts(spark, str(tmp_path / "o")).collect()}
    assert not lay["one.csv.gz"]["has_title"] and lay["one.csv.gz"]["header_line"] == "only"
    q = lay["quoted.csv.gz"]
    assert q["first_fields"] == 1 and q["has_title"] and q["header_line"] == "A,B"


def test_file_layouts_go_by_the_second_line(spark, tmp_path):
    write_gz(tmp_path / "p" / "late.csv.gz", "only\n1\n2,3\n")
    write_gz(tmp_path / "p" / "blank.csv.gz", "\nTitle\n\nA,B\n1,2\n")
    lay = {r["file_path"].rsplit("/", 1)[-1]: r for r in csvlake.file_layouts(spark, str(tmp_path / "p")).collect()}
    assert (lay["late.csv.gz"]["has_title"], lay["late.csv.gz"]["header_line"]) == (False, "only")
    assert (lay["blank.csv.gz"]["has_title"], lay["blank.csv.gz"]["header_line"]) == (True, "A,B")


SHAPE = r"(\d{8}|\d{6})\.([^.]+)\.tide"
TIDE = SourceSpec("tide", "tide", regex_pattern=SHAPE, regex_group_names=("file_date_key", "content_owner"), storage_folder_name="sea/tide")


def uploaded(spark, landing, lake, **options):
    cat = C.build_catalog(C.list_files(spark, str(landing)), [TIDE, SourceSpec("loose", "loose", storage_folder_name="sea/loose")])
    (L.upload(spark, cat, lake, **options)).collect()
    return {(r["file_name"], r["status"], r["rows"]) for r in L.read_log(spark, lake).collect()}


def test_upload_accounts_for_every_file(spark, tmp_path):
    land_dir, lake = tmp_path / "landing", str(tmp_path / "lake")
    write_gz(land_dir / "202306.North Pier.tide.csv.gz", HEADER + "\n" + rows(10))
    write_gz(land_dir / "20230715.50%+.tide.csv.gz", "Title\n" + HEADER + "\n" + rows(7, 50))
    write_gz(land_dir / "deep" / "202306.Süd#1.tide.csv.gz", HEADER + "\n" + rows(3, 90))
    write_gz(land_dir / "deep" / "202306.North Pier.tide.csv.gz", HEADER + "\n" + rows(10))  # same bare name
    write_gz(land_dir / "202307.head.tide.csv.gz", HEADER + "\n")
    write_gz(land_dir / "202307.none.tide.csv.gz", "")
    write_gz(land_dir / "202305.drift.tide.csv.gz", "Date,Extra,Asset ID\n2023-05-01,e,A1\n")
    write_gz(land_dir / "202304.other.tide.csv.gz", "Alpha,Beta\n1,2\n")
    (land_dir / "202308.plain.tide.csv").write_text(HEADER + "\n" + rows(2))
    (land_dir / "202308.broken.tide.csv.gz").write_bytes(gzip.compress((HEADER + "\n" + rows(5000)).encode())[:-900])
    (land_dir / "loose.csv").write_text("k,v\n1,2\n3,4\n")
    write_gz(land_dir / "202313.late.tide.csv.gz", HEADER + "\n" + rows(1))
    log = uploaded(spark, land_dir, lake)
    assert log == {
        ("202306.North Pier.tide.csv.gz", "ok", 10), ("20230715.50%+.tide.csv.gz", "ok", 7), ("202306.Süd#1.tide.csv.gz", "ok", 3),
        ("202306.North Pier.tide.csv.gz", "duplicate", 0), ("202307.head.tide.csv.gz", "ok", 0), ("202307.none.tide.csv.gz", "ok", 0),
        ("202305.drift.tide.csv.gz", "ok", 1), ("202304.other.tide.csv.gz", "quarantined", 0), ("202308.plain.tide.csv", "rejected", 0),
        ("202308.broken.tide.csv.gz", "failed", 0), ("loose.csv", "ok", 2), ("202313.late.tide.csv.gz", "rejected", 0),
    }
    tide = L.committed(spark, L.read_landed(spark, f"{lake}/sea/tide"), lake)
    assert by_date(tide) == {"2023-06-30": 13, "2023-07-31": 7, "2023-05-31": 1}
    assert [r["extra"] for r in tide.where("extra IS NOT NULL").collect()] == ["e"]
    loose = L.read_landed(spark, f"{lake}/sea/loose")
    assert [tuple(r) for r in loose.select("k", "v", "report_date").orderBy("k").collect()] == [("1", "2", None), ("3", "4", None)]
    again = uploaded(spark, land_dir, lake) - log
    assert {s for _, s, _ in again} == {"skipped"} and len(again) == 7
    summary = L.throughput(L.read_log(spark, lake)).collect()
    assert all(r["mb_per_s"] >= 0 for r in summary)


def test_upload_replaces_a_redelivered_file_only(spark, tmp_path):
    land_dir, lake = tmp_path / "landing", str(tmp_path / "lake")
    write_gz(land_dir / "202306.a.tide.csv.gz", HEADER + "\n" + rows(5))
    write_gz(land_dir / "202306.b.tide.csv.gz", HEADER + "\n" + rows(3))
    uploaded(spark, land_dir, lake, mode="replace")
    write_gz(land_dir / "202306.b.tide.csv.gz", HEADER + "\n" + rows(4, 70))
    log = uploaded(spark, land_dir, lake, mode="replace")
    assert ("202306.a.tide.csv.gz", "skipped", 0) in log and ("202306.b.tide.csv.gz", "ok", 4) in log
    assert by_date(L.committed(spark, L.read_landed(spark, f"{lake}/sea/tide"), lake)) == {"2023-06-30": 9}


def test_sample_rows_from_newest_file(spark, tmp_path):
    write_gz(tmp_path / "s" / "report_date=2023-01-31" / "a.csv.gz", HEADER + "\n" + rows(50))
    write_gz(tmp_path / "s" / "report_date=2023-02-28" / "b.csv.gz", "Title\n" + HEADER + "\n" + rows(150, 1000))
    head = csvlake.lake_head(spark, str(tmp_path / "s"))
    assert head.newest_path.endswith("b.csv.gz") and head.has_title
    sample = csvlake.read_raw(spark, head.newest_path, head, with_source=False).limit(100).collect()
    assert [r["asset_id"] for r in sample] == [f"A{i}" for i in range(1000, 1100)]


def test_strict_uploads_quarantine_any_other_header(spark, tmp_path):
    land_dir, lake = tmp_path / "landing2", str(tmp_path / "lake3")
    write_gz(land_dir / "202305.a.tide.csv.gz", HEADER + "\n" + rows(4))
    write_gz(land_dir / "202306.a.tide.csv.gz", "Title\n" + HEADER + "\n" + rows(5, 10))
    write_gz(land_dir / "202304.a.tide.csv.gz", "Title\nAsset ID,Views,Date\n" + rows(3, 20))
    log = uploaded(spark, land_dir, lake, on_drift="quarantine")
    assert {(n[:6], s, r) for n, s, r in log} == {("202305", "ok", 4), ("202306", "ok", 5), ("202304", "quarantined", 0)}


def test_two_files_of_one_name_are_two_files(spark, tmp_path):
    lake = str(tmp_path / "names")
    frame = lambda path, n: spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit(path).alias("src_file"), F.lit("2020-01-31").cast("date").alias("report_date"))
    L.land(spark, frame("/x/a/r.csv.gz", 3).unionByName(frame("/x/b/r.csv.gz", 5)), lake, "t")
    shown = lambda: {r["src_file"]: r["count"] for r in L.committed(spark, L.read_landed(spark, f"{lake}/t"), lake).groupBy("src_file").count().collect()}
    assert shown() == {"/x/a/r.csv.gz": 3, "/x/b/r.csv.gz": 5}
    L.land(spark, frame("/x/b/r.csv.gz", 2), lake, "t", mode="replace")
    assert shown() == {"/x/a/r.csv.gz": 3, "/x/b/r.csv.gz": 2}
    named = frame("/y/r.csv.gz", 4).withColumn("file_key", F.lit("/x/a/r.csv.gz"))  # a declared name takes that file's place
    L.land(spark, named, lake, "t", mode="append", key="file_key")
    assert shown() == {"/x/a/r.csv.gz": 3, "/x/b/r.csv.gz": 2}
    L.land(spark, named, lake, "t", mode="replace", key="file_key")
    assert shown() == {"/y/r.csv.gz": 4, "/x/b/r.csv.gz": 2} and L.folder_columns(spark, f"{lake}/t") == ["k"]


def test_any_order_of_loads_shows_the_newest_versions(spark, tmp_path):
    """Random appends and replaces of files of equal names, against a dictionary."""
    import random

    rng = random.Random(8)
    lake, want, schema = str(tmp_path / "order"), {}, "k string, src_file string, report_date date"
    for load in range(7):
        mode, some = rng.choice(["append", "replace"]), rng.sample(["/a/r.csv.gz", "/b/r.csv.gz", "/c/r.csv.gz", "/a/s.csv.gz"], rng.randint(1, 3))
        rows, days = [], ["2020-01-31", "2020-02-29"]
        import datetime as dt

        for f in some:
            cells = [(f"{load}-{i}", f, dt.date.fromisoformat(rng.choice(days))) for i in range(rng.randint(1, 4))]
            rows += cells
            if mode == "replace" or f not in want:
                want[f] = sorted((k, str(d)) for k, _, d in cells)
        L.land(spark, spark.createDataFrame(rows, schema), lake, "t", mode=mode)
    got: dict = {}
    for r in L.committed(spark, L.read_landed(spark, f"{lake}/t"), lake).collect():
        got.setdefault(r["src_file"], []).append((r["k"], str(r["report_date"])))
    assert {f: sorted(v) for f, v in got.items()} == want
    assert {r["status"] for r in L.verify(spark, lake, "t").collect()} == {"ok"}


def test_verify_names_changed_lost_and_missing_rows(spark, tmp_path):
    lake = str(tmp_path / "checked")
    rows = spark.range(40).select(F.col("id").cast("string").alias("k"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('a "b",\n '), "id")).alias("note"), F.concat(F.lit("f"), F.col("id") % 4).alias("src_file"), F.lit("2020-01-31").cast("date").alias("report_date"))
    L.land(spark, rows, lake, "t")
    wider = rows.where("k = '1'").withColumn("extra", F.lit("e")).withColumn("src_file", F.lit("g"))
    L.land(spark, wider, lake, "t")  # a column more doesn't change what was logged
    landed = L.read_landed(spark, f"{lake}/t")
    assert {r["src_file"]: r["status"] for r in L.verify(spark, lake, "t").collect()} == {"f0": "ok", "f1": "ok", "f2": "ok", "f3": "ok", "g": "ok"}
    harmed = landed.where("src_file <> 'f3' AND k <> '9'").withColumn("note", F.when(F.col("k") == "10", F.lit("x")).otherwise(F.col("note")))
    assert {r["src_file"]: r["status"] for r in L.verify(spark, lake, "t", harmed).collect()} == {"f0": "ok", "f1": "count_mismatch", "f2": "changed", "f3": "missing", "g": "ok"}


def test_what_doesnt_arrive_whole_isnt_logged(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lossy")
    rows = spark.range(9).select(F.col("id").cast("string").alias("k"), F.lit("f").alias("src_file"), F.lit("2020-01-31").cast("date").alias("report_date"))
    write = L.write_rows
    with monkeypatch.context() as m:
        m.setattr(L, "write_rows", lambda df, *a, **o: write(df.withColumn("k", F.when(F.col("k") == "3", "33").otherwise(F.col("k"))), *a, **o))
        with pytest.raises(ValueError, match="isn't logged"):
            L.land(spark, rows, lake, "t")
    assert L.read_log(spark, lake) is None
    L.land(spark, rows, lake, "t")
    assert L.committed(spark, L.read_landed(spark, f"{lake}/t"), lake).count() == 9


def test_drifted_lake_reads_by_name(spark, tmp_path):
    """Changed order, an added column, repeated rows equal to the header, titles, quoted headers."""
    root = tmp_path / "drifted"
    write_gz(root / "report_date=2020-01-31" / "a.csv.gz", "k,v\n1,x\n")
    write_gz(root / "report_date=2020-02-29" / "b.csv.gz", "Title\nv,k,Extra (New)\ny,2,e\nv,k,Extra (New)\n")
    write_gz(root / "report_date=2020-03-31" / "c.csv.gz", 'v,"k"\n"two\nlines",3\nshort\n')
    write_gz(root / "report_date=2020-03-31" / "d.csv.gz", "")
    write_gz(root / "report_date=2020-03-31" / "e.csv.gz", "v,k\n")
    head = csvlake.lake_head(spark, str(root))
    assert head.columns == ["v", "k", "extra__new"] and len(head.layouts) == 3
    got = sorted(tuple("" if x is None else str(x) for x in r) for r in csvlake.read_raw(spark, str(root), head, with_source=False).collect())
    assert got == sorted([("x", "1", "", "2020-01-31"), ("y", "2", "e", "2020-02-29"), ("v", "k", "Extra (New)", "2020-02-29"), ("two\nlines", "3", "", "2020-03-31"), ("short", "", "", "2020-03-31")])
    typed = infer.read_typed(spark, str(root))
    assert {r["k"] for r in typed.collect()} == {"1", "2", "k", "3", None}


def test_heads_beyond_the_prefix(spark, tmp_path, monkeypatch):
    import random

    rng = random.Random(2)
    wide = ",".join(f"c{rng.random()}" for _ in range(3000))
    write_gz(tmp_path / "wide" / "a.csv.gz", "Title\n" + wide + "\n" + ",".join("1" * 3000) + "\n")
    monkeypatch.setattr(csvlake, "PREFIX", 512)
    head = csvlake.lake_head(spark, str(tmp_path / "wide"))
    assert head.has_title and len(head.columns) == 3000


def test_stream_through_the_log_once(spark, tmp_path):
    """Two arrivals with drift and misfits, a replayed batch; equal to one upload of the same files."""
    land_dir, lake, plain, ckpt = tmp_path / "arrive", str(tmp_path / "lake"), str(tmp_path / "plain"), str(tmp_path / "ckpt")
    specs = [TIDE]
    write_gz(land_dir / "202301.a.tide.csv.gz", HEADER + "\n" + rows(4))
    write_gz(land_dir / "202313.bad.tide.csv.gz", HEADER + "\n")
    ingest.run_uploads(spark, str(land_dir), specs, lake, ckpt)
    write_gz(land_dir / "202302.b.tide.csv.gz", "Title\nDate,Extra,Asset ID\n2023-02-01,e,A1\n")
    write_gz(land_dir / "202212.c.tide.csv.gz", "Alpha,Beta\n1,2\n")
    write_gz(land_dir / "deep" / "202301.a.tide.csv.gz", HEADER + "\n" + rows(9))
    ingest.run_uploads(spark, str(land_dir), specs, lake, ckpt)
    before = L.read_log(spark, lake).count()
    (sorted((tmp_path / "ckpt" / "commits").glob("[0-9]*"))[-1]).unlink()  # a crash before the stream's own commit
    for crc in (tmp_path / "ckpt" / "commits").glob(".*.crc"):
        crc.unlink()
    ingest.run_uploads(spark, str(land_dir), specs, lake, ckpt)
    assert L.read_log(spark, lake).count() == before
    log = lambda at: {(r["file_name"], r["rows"], r["status"] if r["status"] != "duplicate" else "skipped") for r in L.read_log(spark, at).collect()}
    L.upload(spark, C.build_catalog(C.list_files(spark, str(land_dir)), specs), plain).collect()
    assert log(lake) == log(plain)
    cells = lambda at: sorted(str(tuple(r)) for r in L.committed(spark, L.read_landed(spark, f"{at}/sea/tide"), at).select("asset_id", "date", "extra", "report_date").collect())
    assert cells(lake) == cells(plain) and len(cells(lake)) == 5


def test_stream_reads_drift_by_name(spark, tmp_path):
    root, sink, ckpt = tmp_path / "s", str(tmp_path / "sink2"), str(tmp_path / "ckpt2")
    write_gz(root / "report_date=2020-01-31" / "a.csv.gz", "k,v\n" + "".join(f"{i},x\n" for i in range(20)))
    schema = infer.infer_lake_schema(spark, str(root))
    assert ingest.run_once(spark, str(root), schema, sink, ckpt) == 20
    write_gz(root / "report_date=2020-02-29" / "b.csv.gz", "v,k\ny,21\nz,misfit\n")
    assert ingest.run_once(spark, str(root), schema, sink, ckpt) == 2
    late = spark.read.parquet(sink).where("report_date = DATE'2020-02-29'").collect()
    assert {(r["v"], r["k"], tuple(r["_rejected"])) for r in late} == {("y", 21, ()), ("z", None, ("k",))}
