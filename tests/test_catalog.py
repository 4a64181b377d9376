"""File catalog over an invented harbour's files: selectors, name groups, overrides, diffs, reports."""

import calendar
import datetime as dt
import itertools

import pytest

from reportlake.operators import catalog as C
from reportlake.sources.specs import SourceSpec, specs_from_toml

SHAPE = r"(\d{8}|\d{6})\.(pier\w+)\.(\w+?)(?:_v\d+(?:-\d+)?)?\.csv"
GROUPS = ("file_date_key", "content_owner", "cargo")


def source(base, **options):
    known = dict(regex_pattern=SHAPE, regex_group_names=GROUPS, storage_folder_name=f"harbour/{base}", table_name=base)
    return SourceSpec(base, base, **{**known, **options})


def inventory(spark, paths):
    return spark.createDataFrame([(p, 100 + len(p), dt.datetime(2020, 5, 17)) for p in paths], C.LISTING_SCHEMA)


def catalog(spark, paths, specs, **options):
    return {r["file_path"]: r for r in C.build_catalog(inventory(spark, paths), specs, **options).collect()}


def test_selectors_take_and_leave(spark):
    families, ends, places = ["crane", "crane_night", "tug"], [".csv.gz", ".csv"], ["", "in/", "in/deep/er/"]
    paths = [f"{p}202005.pierA.{f}{e}" for p, f, e in itertools.product(places, families, ends)] + ["in/.~lock.202005.pierA.crane.csv.gz"]
    specs = [source("crane", exclude_file_name_base="crane_night"), source("tug", is_enabled=False)]
    assert set(catalog(spark, paths, specs)) == {p for p in paths if ".crane." in p and "lock" not in p}
    assert set(catalog(spark, paths, specs, extension=".csv.gz")) == {p for p in paths if p.endswith(".crane.csv.gz") and "lock" not in p}
    both = [source("crane", exclude_file_name_base=""), source("crane_night")]
    rows = C.build_catalog(inventory(spark, paths), both).groupBy("source_id").count().collect()
    assert {r[0]: r[1] for r in rows} == {"crane": 12, "crane_night": 6}


def test_listing_hides_marked_files_and_reads_no_content(spark, tmp_path):
    for name in ("berth/one.csv.gz", "berth/.~lock.one.csv.gz#", "quay/_draft.csv.gz", "quay/two.csv.gz"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    files = C.list_files(spark, str(tmp_path))
    assert sorted(r["path"].rsplit("/", 1)[-1] for r in files.collect()) == ["one.csv.gz", "two.csv.gz"]
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]


def test_no_files(spark):
    none = C.build_catalog(spark.createDataFrame([], C.LISTING_SCHEMA), [source("crane")])
    assert none.count() == 0
    assert C.compare_files(none, spark.createDataFrame([], "base_name string, file_count bigint")).count() == 0


def test_groups_become_columns(spark):
    made = {}
    for (year, month), day, pier, version in itertools.product([(2019, 2), (2020, 2), (2020, 12)], [None, 9], ["pierA", "pier_12"], ["", "v4", "v4-1"]):
        name = f"drop/{year}{month:02d}{'' if day is None else f'{day:02d}'}.{pier}.crane{version and '_' + version}.csv.gz"
        made[name] = (pier, dt.date(year, month, calendar.monthrange(year, month)[1]), version)
    rows = catalog(spark, list(made), [source("crane")])
    for path, (pier, end, version) in made.items():
        r = rows[path]
        assert (r["error"], r["content_owner"], r["file_version"], dict(r["attrs"])) == (None, pier, version, {"cargo": "crane"})
        assert (r["report_date"], r["report_date_str"], r["report_date_key"]) == (end, end.isoformat(), int(end.strftime("%Y%m%d")))
        assert r["storage_folder_name"] == "harbour/crane" + (version and f"_{version}")


def test_bad_names_are_rejected_with_a_reason(spark):
    good = ["20200517.pierA.crane.csv", "202005.pierB.crane.csv"]
    bad = {"crane-overview.csv": "name_mismatch", "20205.pierA.crane.csv": "name_mismatch", "202014.pierA.crane.csv": "date_key_invalid", "20200230.pierA.crane.csv": "date_key_invalid", "189912.pierA.crane.csv": "date_key_invalid"}
    cat = C.build_catalog(inventory(spark, [*good, *bad]), [source("crane")])
    assert {r["file_path"]: r["error"] for r in C.rejected(cat).collect()} == bad
    assert sorted(r["file_path"] for r in C.accepted(cat).collect()) == sorted(good)
    with pytest.raises(ValueError):
        C.assert_no_rejects(cat)
    assert C.assert_no_rejects(C.accepted(cat)).count() == 2


def test_captured_version_goes_before_the_tag(spark):
    spec = source("manifest", regex_pattern=r"manifest-(\w+)-rev(\w+)_v\d\.csv", regex_group_names=("content_owner", "file_version"), table_append_or_replace="replace")
    (row,) = catalog(spark, ["manifest-pierC-rev7_v1.csv.gz"], [spec]).values()
    assert (row["file_version"], row["storage_folder_name"], row["table_append_or_replace"], row["report_date"]) == ("7", "harbour/manifest_7", "replace", None)


def test_named_source_skips_the_selectors(spark):
    files = inventory(spark, ["202005.pierA.anything_v2.csv.gz"])
    row = C.catalog_for_source(files, [source("tug"), source("crane")], "crane", replace_override=True).first()
    assert (row["source_id"], row["table_append_or_replace"], row["storage_folder_name"], row["attrs"]["cargo"]) == ("crane", "replace", "harbour/crane_v2", "anything")
    assert C.catalog_for_source(files, [source("crane")], "ferry").count() == 0


def entries(spark, *rows):
    return spark.createDataFrame(rows, "base_name string, file_name string, file_version string, source_id string")


def test_both_sides_are_counted(spark):
    local = entries(spark, *[(b, f"{b}{i}", "", b) for b, n in (("tug", 3), ("crane", 2)) for i in range(n)])
    stored = spark.createDataFrame([("crane", 5), ("ferry", 1)], "base_name string, file_count bigint")
    assert [tuple(r) for r in C.compare_files(local, stored).collect()] == [("crane", 5, 2), ("ferry", 1, 0), ("tug", 0, 3)]


def test_new_files_are_those_not_stored(spark):
    names = ["n0", "n1", "n2", "n3"]
    local = entries(spark, *[("tug", n, "", "s") for n in names])
    for k in range(len(names) + 1):
        for have in itertools.combinations(names, k):
            if k in (0, 2, 4):
                stored = spark.createDataFrame([(n,) for n in have], "file_name string")
                assert {r["file_name"] for r in C.new_files(local, stored).collect()} == set(names) - set(have)


def test_duplicates_and_mixed_versions(spark):
    local = entries(spark, ("tug", "same", "v1", "here"), ("tug", "same", "v2", "there"), ("tug", "own", "v2", "here"), ("ferry", "x", "v5", "here"), ("ferry", "y", "v5", "here"))
    assert sorted(r["source_id"] for r in C.duplicate_files(local).collect()) == ["here", "there"]
    assert {(r["base_name"], r["file_version"]) for r in C.mixed_versions(local).collect()} == {("tug", "v1"), ("tug", "v2")}


def test_folder_summary(spark):
    dated = [f"harbour/tug_v2/report_date=2020-{m:02d}-28/{m}.csv.gz" for m in range(1, 8)]
    flat = ["harbour/old/crane/a.csv.gz", "harbour/old/crane/readme.md"]
    got = {r["storage_folder_name"]: r for r in C.folder_summary(spark.createDataFrame([(p,) for p in [*dated, *flat, "loose.csv.gz"]], "path string")).collect()}
    assert set(got) == {"harbour/tug_v2", "harbour/old/crane"}
    tug, crane = got["harbour/tug_v2"], got["harbour/old/crane"]
    assert (tug["file_count"], tug["has_partitioning"], tug["table_name"], tug["file_version"], tug["proposed_table_name"]) == (7, True, "tug", "v2", "tug_v2")
    assert tug["sample_files"].split(",") == dated[:3]
    assert (crane["file_count"], crane["has_partitioning"], crane["proposed_table_name"]) == (1, False, "crane")


def test_selected_tables(spark):
    tables = spark.createDataFrame([(t,) for t in ("tug", "crane", "ferry")], "table_name string")
    assert {r[0] for r in C.selected_tables(tables, " tug,ferry ,pilot").collect()} == {"tug", "ferry"}


def test_preview(spark):
    names = [f"f{i:03d}" for i in range(37)]
    rows = C.preview(spark.createDataFrame([(n,) for n in reversed(names)], "file_name string"), "file_name", 5).collect()
    assert [r["file_name"] for r in rows] == names[:5] and {r["more_count"] for r in rows} == {32}


def test_specs_from_toml():
    (spec,) = specs_from_toml(f'''
[file.tugboats]
is_enabled = true
storage_folder_name = "harbour/tug"
select_file_name_base = "tug"
exclude_file_name_base = "tug_test"
regex_pattern = '{SHAPE}'
regex_group_names = ["file_date_key", "content_owner", "cargo"]
table_append_or_replace = "append"
''')
    assert (spec.source_id, spec.select_file_name_base, spec.effective_table, tuple(spec.regex_group_names)) == ("tugboats", "tug", "tug", GROUPS)


@pytest.mark.parametrize("options", [{"regex_pattern": "(x)(y)", "regex_group_names": ("one",)}, {"table_append_or_replace": "upsert"}])
def test_specs_that_cannot_work(options):
    with pytest.raises(ValueError):
        SourceSpec("tug", "tug", **options)
