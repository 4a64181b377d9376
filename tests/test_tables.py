"""External table lifecycle over a small mixed-layout lake (reference table manager tests)."""

import gzip
import threading

import pytest
from pyspark.sql import functions as F

from reportlake.operators import load as L
from reportlake.operators import tables as T


def write_gz(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)


def build_store(root):
    hdr = "Asset ID,Views,Revenue (USD),Date"
    body = lambda a, n: "".join(f"A{i},{i},{i}.25,2023-06-{(i % 28) + 1:02d}\n" for i in range(a, a + n))
    write_gz(root / "reports" / "tide_v1-1" / "report_date=2023-05-31" / "a.csv.gz", hdr + "\n" + body(0, 30))
    write_gz(root / "reports" / "tide_v1-1" / "report_date=2023-06-30" / "b.csv.gz",
             "Title\n" + hdr + "\n" + body(30, 20))
    write_gz(root / "reports" / "wind" / "flat.csv.gz", hdr + "\n" + body(100, 15))
    return str(root)


def test_publish_query_list_drop_republish(spark, tmp_path):
    store = build_store(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS t_life")
    res = {r["table_name"]: r for r in T.publish_missing(spark, store, database="t_life", scope="all_rows").collect()}
    assert set(res) == {"tide_v1_1", "wind"} and all(r["ok"] for r in res.values())
    # second run: nothing missing any more
    assert T.publish_missing(spark, store, database="t_life").count() == 0
    assert T.table_exists(spark, "t_life.tide_v1_1")

    q = spark.sql("SELECT report_date, count(*) n, sum(views) v FROM t_life.tide_v1_1 GROUP BY report_date")
    got = {str(r["report_date"]): (r["n"], r["v"]) for r in q.collect()}
    assert got == {"2023-05-31": (30, sum(range(30))), "2023-06-30": (20, sum(range(30, 50)))}
    types = dict(spark.table("t_life.tide_v1_1").dtypes)
    assert types["views"] == "bigint" and types["revenue__usd"] == "decimal(38,18)" and types["date"] == "date"
    assert spark.table("t_life.wind").count() == 15

    listed = {r["table_name"]: r for r in T.list_tables(spark, "t_life").collect()}
    assert listed["tide_v1_1"]["is_partitioned"] and listed["tide_v1_1"]["partition_columns"] == "report_date"
    assert not listed["wind"]["is_partitioned"]
    assert listed["wind"]["created"]

    plan = T.drop_tables(spark, ["wind"], database="t_life").collect()
    assert [(r["table_name"], r["action"]) for r in plan] == [("wind", "would_drop")]
    assert T.table_exists(spark, "t_life.wind")

    again = T.republish(spark, ["tide_v1_1"], database="t_life", scope="all_rows").collect()
    assert again[0]["ok"] and spark.table("t_life.tide_v1_1").count() == 50

    T.drop_tables(spark, None, database="t_life", dry_run=False)
    assert not T.table_exists(spark, "t_life.wind") and not T.table_exists(spark, "t_life.tide_v1_1")
    assert (tmp_path / "reports" / "wind" / "flat.csv.gz").exists()  # files stay


def test_create_conflict_returns_false(spark, tmp_path):
    store = build_store(tmp_path)
    folder = f"{store}/reports/wind"
    spark.sql("CREATE DATABASE IF NOT EXISTS t_conf")
    assert T.create_table(spark, "t_conf.x", folder)
    assert not T.create_table(spark, "t_conf.x", folder)


def landed(spark, lake, day, n, first=0):
    rows = spark.createDataFrame([(str(first + i), f"{i}.5") for i in range(n)], "key string, height string")
    return L.land(spark, rows.withColumn("src_file", F.lit(f"file:/{day}")).withColumn("report_date", F.lit(day).cast("date")), lake, "tide")


def test_tables_follow_later_loads_and_hide_crashed_ones(spark, tmp_path, monkeypatch):
    lake = str(tmp_path / "lake")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_follow")
    landed(spark, lake, "2020-01-31", 20)
    T.publish_missing(spark, lake, database="t_follow").collect()
    counted = lambda: spark.sql("SELECT count(*) FROM t_follow.tide").first()[0]
    assert counted() == 20
    landed(spark, lake, "2020-02-29", 7)
    T.publish_missing(spark, lake, database="t_follow").collect()
    assert counted() == 27
    with monkeypatch.context() as m:
        m.setattr(L, "append_log", lambda *a: (_ for _ in ()).throw(RuntimeError("crash")))
        with pytest.raises(RuntimeError):
            landed(spark, lake, "2020-03-31", 5)
    T.publish_missing(spark, lake, database="t_follow").collect()
    assert counted() == 27
    again = T.republish(spark, ["tide"], database="t_follow").collect()
    assert again[0]["ok"] and counted() == 27


def test_a_failed_republish_keeps_the_table(spark, tmp_path, monkeypatch):
    store = build_store(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS t_keep")
    assert T.create_table(spark, "t_keep.wind", f"{store}/reports/wind")
    monkeypatch.setattr(T, "typed_sql", lambda *a: "no_such_function(1)")
    assert not T.republish(spark, ["wind"], database="t_keep").first()["ok"]
    assert spark.table("t_keep.wind").count() == 15


def test_republish_turns_the_view_and_keeps_the_generation_before(spark, tmp_path):
    folder = f"{build_store(tmp_path)}/reports/wind"
    spark.sql("CREATE DATABASE IF NOT EXISTS t_gen")
    assert T.create_table(spark, "t_gen.wind", folder)
    reader = spark.table("t_gen.wind")
    for k in (1, 2, 3):
        done, looked, missed = threading.Event(), [], []

        def look():
            while not done.is_set():
                looked.append(1)
                try:
                    spark.table("t_gen.wind").columns
                except Exception as e:  # noqa: BLE001 - any failure is what the test is about
                    missed.append(e)

        thread = threading.Thread(target=look)
        thread.start()
        try:
            assert T.republish(spark, ["wind"], database="t_gen").first()["ok"]
        finally:
            done.set()
            thread.join()
        assert looked and not missed
        assert reader.count() == 15 == spark.table("t_gen.wind").count()
        assert T._raw_of(spark, "t_gen.wind") == f"t_gen.wind__raw_{k}"
        assert sorted(T._generations(spark, "t_gen.wind")) == [k - 1, k]
    assert [r["table_name"] for r in T.list_tables(spark, "t_gen").collect()] == ["wind"]
    T.drop_tables(spark, ["wind"], database="t_gen", dry_run=False)
    assert not spark.catalog.listTables("t_gen")


def test_collisions_are_reported_and_nothing_is_published_under_them(spark, tmp_path):
    for folder in ("a/tide_v1-1", "b/tide_v1-1", "c/Ebb-tide", "d/wind"):
        write_gz(tmp_path / folder / "x.csv.gz", "k,v\n" + "".join(f"{i},{i}\n" for i in range(12)))
    spark.sql("CREATE DATABASE IF NOT EXISTS t_coll")
    res = {r["folder"].rsplit("/", 2)[-2]: r for r in T.publish_missing(spark, str(tmp_path), database="t_coll").collect()}
    assert {k: r["ok"] for k, r in res.items()} == {"a": False, "b": False, "c": True, "d": True}
    assert "b/tide_v1-1" in res["a"]["error"] and "a/tide_v1-1" in res["b"]["error"]
    assert res["c"]["table_name"] == "ebb_tide" and spark.table("t_coll.ebb_tide").count() == 12
    write_gz(tmp_path / "e" / "wind" / "x.csv.gz", "k,v\n1,2\n")
    again = {r["folder"].rsplit("/", 2)[-2]: r for r in T.publish_missing(spark, str(tmp_path), database="t_coll").collect()}
    assert set(again) == {"a", "b", "e"}  # d has its table
    assert not again["e"]["ok"] and "d/wind" in again["e"]["error"]
    assert spark.table("t_coll.wind").count() == 12


def test_landed_files_of_one_bare_name_and_undated_rows_are_all_shown(spark, tmp_path):
    lake = str(tmp_path / "lake")
    rows = spark.createDataFrame([(str(i), f"/x/{p}/r.csv.gz", d) for p, n, d in (("a", 3, "2020-01-31"), ("b", 5, "2020-01-31"), ("c", 4, None)) for i in range(n)], "key string, src_file string, d string")
    L.land(spark, rows.withColumn("report_date", F.col("d").cast("date")).drop("d"), lake, "tide")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_same")
    assert T.create_table(spark, "t_same.tide", f"{lake}/tide")
    got = {(r["src_file"], r["report_date"] is None): r["n"] for r in spark.sql("SELECT src_file, report_date, count(*) AS n FROM t_same.tide GROUP BY 1, 2").collect()}
    assert got == {("/x/a/r.csv.gz", False): 3, ("/x/b/r.csv.gz", False): 5, ("/x/c/r.csv.gz", True): 4}


def test_a_table_that_can_not_be_refreshed_does_not_stop_the_others(spark, tmp_path):
    store = build_store(tmp_path)
    spark.sql("CREATE DATABASE IF NOT EXISTS t_stuck")
    assert T.create_table(spark, "t_stuck.wind", f"{store}/reports/wind")
    spark.sql("ALTER VIEW t_stuck.wind AS SELECT 1 AS k")  # reads no raw table any more
    res = {r["table_name"]: [] for r in T.publish_missing(spark, store, database="t_stuck").collect()}
    for r in T.publish_missing(spark, store, database="t_stuck").collect():
        res[r["table_name"]].append(r["ok"])
    assert res["wind"] == [False, False] and spark.table("t_stuck.tide_v1_1").count() == 50
