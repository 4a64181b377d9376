"""Property tests: Spark expressions against independent checks on generated inputs."""

import fnmatch

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from reportlake.functions import names as N
from reportlake.sources.specs import glob_condition
from test_names import size_text

SETTINGS = settings(max_examples=8, deadline=None)

alphabet = st.sampled_from(list("ab_.x-"))
names_st = st.lists(st.text(alphabet, min_size=0, max_size=9), min_size=20, max_size=60)
glob_st = st.lists(
    st.lists(st.one_of(st.just("*"), st.text(alphabet, min_size=1, max_size=3)), min_size=1, max_size=4).map("".join),
    min_size=1, max_size=6,
)


@SETTINGS
@given(names=names_st, globs=glob_st)
def test_glob_condition_matches_fnmatch(spark, names, globs):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select("n", *[glob_condition(F.col("n"), g).alias(f"g{i}") for i, g in enumerate(globs)]).collect()
    for row in got:
        for i, g in enumerate(globs):
            assert row[f"g{i}"] == fnmatch.fnmatchcase(row["n"], g), (row["n"], g)


@SETTINGS
@given(sizes=st.lists(st.one_of(st.integers(0, 2**20), st.integers(0, 2**53), st.integers(0, 2**62)), min_size=30, max_size=80))
def test_readable_size_is_exact(spark, sizes):
    got = [r[0] for r in spark.createDataFrame([(s,) for s in sizes], "s bigint").select(N.readable_size("s")).collect()]
    assert got == [size_text(s) for s in sizes]


@SETTINGS
@given(days=st.lists(st.dates(), min_size=30, max_size=80), junk=st.lists(st.text(st.sampled_from("0123456789x"), max_size=9), min_size=10, max_size=20))
def test_date_keys_round_trip(spark, days, junk):
    keys = [f"{d:%Y%m%d}".zfill(8) for d in days] + junk
    got = dict(zip(keys, [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(N.date_key_to_date("k")).collect()]))
    for d, k in zip(days, keys):
        assert got[k] == (d if 1900 <= d.year <= 2100 else None)
    assert all(got[k] is None or got[k].strftime("%Y%m%d").startswith(k) for k in junk)
