"""Zip archives: entries at any depth flattened, macOS metadata skipped, guard (reference zip tests)."""

import io
import zipfile

from reportlake.sources import archives


def make_zip(path, entries):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED) as zf:
        for name, data in entries.items():
            zf.writestr(name, data)


def test_nested_and_macosx(spark, tmp_path):
    make_zip(tmp_path / "z" / "a.zip", {"test.csv": "h1,h2\n1,2\n3,4\n"})
    make_zip(tmp_path / "z" / "b.zip", {"folder/subfolder/data.csv": "Title\nh1,h2\n5,6\n",
                                         "__MACOSX/folder/._data.csv": "junk", "readme.txt": "x"})
    lines = archives.archive_lines(spark, str(tmp_path / "z"))
    data = sorted((r["entry"], r["line"]) for r in lines.where("not is_head").collect())
    assert data == [("data.csv", "5,6"), ("test.csv", "1,2"), ("test.csv", "3,4")]
    rows = archives.archive_rows(lines, ["h1", "h2"]).orderBy("h1").collect()
    assert [(r["h1"], r["h2"]) for r in rows] == [("1", "2"), ("3", "4"), ("5", "6")]
    audit = {r["archive"].rsplit("/", 1)[-1]: r for r in archives.audit(archives.archive_entries(spark, str(tmp_path / "z"))).collect()}
    assert audit["b.zip"]["n_csv"] == 1 and audit["b.zip"]["n_skipped"] == 1 and audit["b.zip"]["status"] == "ok"


def test_bomb_and_bad_zip_rejected(spark, tmp_path):
    big = "0" * 3_000_000
    make_zip(tmp_path / "y" / "bomb.zip", {f"part{i}.csv": big for i in range(4)})
    (tmp_path / "y" / "bad.zip").write_bytes(b"not a zip at all")
    audit = {r["archive"].rsplit("/", 1)[-1]: r["status"]
             for r in archives.audit(archives.archive_entries(spark, str(tmp_path / "y")), max_bytes=10_000_000).collect()}
    assert audit == {"bomb.zip": "too_large", "bad.zip": "bad_zip"}
    ratio = archives.audit(archives.archive_entries(spark, str(tmp_path / "y")), max_bytes=10**12).where(
        "archive like '%bomb.zip'").first()
    assert ratio["status"] == "high_ratio"
    assert archives.archive_lines(spark, str(tmp_path / "y"), max_bytes=10_000_000).count() == 0


def test_quoted_line_breaks_are_one_record(spark, tmp_path):
    make_zip(tmp_path / "q" / "a.zip", {"x.csv": 'h1,h2\n1,"two\nlines"\r\n"3","a ""b"""\n'})
    rows = archives.archive_rows(archives.archive_lines(spark, str(tmp_path / "q")), ["h1", "h2"]).orderBy("h1").collect()
    assert [(r["h1"], r["h2"]) for r in rows] == [("1", "two\nlines"), ("3", 'a "b"')]


def test_zip_entries_and_plain_files_land(spark, tmp_path):
    from pyspark.sql import functions as F

    from reportlake.operators import catalog as C
    from reportlake.operators import load as L
    from reportlake.sources.specs import SourceSpec

    spec = SourceSpec("tide", "tide", regex_pattern=r"(\d{6})\.([^.]+)\.tide", regex_group_names=("file_date_key", "content_owner"), storage_folder_name="sea")
    at, lake = tmp_path / "land", str(tmp_path / "lake")
    make_zip(at / "one pack.zip", {"a/202301.n.tide.csv": 'k,v\n1,"two\nlines"\n', "b/202302.n.tide.csv": "Title\nv,k\nx,2\ny,3\n", "__MACOSX/a/._202301.n.tide.csv": "junk"})
    make_zip(at / "two.zip", {"deep/202301.n.tide.csv": "k,v\n9,again\n", "202399.bad.tide.csv": "k\n", "readme.txt": "x"})
    make_zip(at / "none.zip", {"readme.txt": "x"})
    (at / "bad.zip").write_bytes(b"not a zip at all")
    (at / "202303.n.tide.csv").write_text("k,v,w\n4,p,q\n")
    broken = tmp_path / "land" / "broken.zip"
    make_zip(broken, {"202304.n.tide.csv": "k,v\n" + "5,lost\n" * 4000})
    raw = bytearray(broken.read_bytes())
    raw[60:70] = b"\x00" * 10
    broken.write_bytes(bytes(raw))

    L.upload_archives(spark, str(at), [spec], lake).collect()
    plain = C.build_catalog(C.list_files(spark, str(at), "*.csv"), [spec])
    L.upload(spark, plain, lake, recompress=True).collect()
    log = {(r["file_name"], r["status"], r["rows"]) for r in L.read_log(spark, lake).collect()}
    assert log == {
        ("202301.n.tide.csv", "ok", 1), ("202302.n.tide.csv", "ok", 2), ("202301.n.tide.csv", "duplicate", 0), ("202399.bad.tide.csv", "rejected", 0),
        ("none.zip", "rejected", 0), ("bad.zip", "rejected", 0), ("202304.n.tide.csv", "failed", 0), ("202303.n.tide.csv", "ok", 1),
    }
    got = L.committed(spark, L.read_landed(spark, f"{lake}/sea"), lake).select("k", "v", "w", F.col("report_date").cast("string")).collect()
    assert sorted(tuple("" if x is None else x for x in r) for r in got) == [("1", "two\nlines", "", "2023-01-31"), ("2", "x", "", "2023-02-28"), ("3", "y", "", "2023-02-28"), ("4", "p", "q", "2023-03-31")]
    L.upload_archives(spark, str(at), [spec], lake).collect()
    again = L.read_log(spark, lake).where("status = 'ok'").count()
    assert again == 3
