"""Path containment and object-name checks."""

import urllib.parse

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from frames import one_col
from reportlake.functions import paths as P


@pytest.mark.parametrize("path,ok", [
    ("/srv/box/one.csv", True), ("/srv/box/deep/../one.csv", True), ("/srv/box/../other/one.csv", False),
    ("/srv/box/./deep/./one.csv", True), ("/srv/box", True), ("/srv/boxes/one.csv", False), ("/root/one.csv", False),
])
def test_is_within(spark, path, ok):
    assert one_col(spark, [path]).select(P.is_within("v", "/srv/box")).first()[0] is ok


def violations(spark, names):
    return [r[0] for r in one_col(spark, names).select(F.array_join(P.object_name_violations("v"), ",")).collect()]


def encoded(text, rounds):
    for _ in range(rounds):
        text = "".join(f"%{b:02x}" if chr(b) in "./%\x07" else chr(b) for b in text.encode())
    return text


@pytest.mark.parametrize("rounds", [0, 1, 2, 5])
def test_every_depth_of_encoding_is_decoded(spark, rounds):
    names = [encoded(x, rounds) for x in ("q/r.csv", "q/../r", "/q/r", "q\x07r", "plain")]
    assert violations(spark, names) == ["", "path_traversal", "path_traversal", "control_chars", ""]


def test_bad_escapes_hide_nothing(spark):
    assert violations(spark, ["%2e%2e/%zz/x", "%zz%2E%2E", "100%", "a+b%", "z" * 1024, "z" * 1025]) == ["path_traversal", "path_traversal", "", "", "", "too_long"]


@settings(max_examples=6, deadline=None)
@given(names=st.lists(st.text(st.sampled_from(list("a.%2e25F+zé")), max_size=12), min_size=20, max_size=60))
def test_one_round_is_that_of_the_url_standard(spark, names):
    got = [r[0] for r in one_col(spark, names).select(P.percent_decoded(F.col("v"))).collect()]
    assert got == [urllib.parse.unquote(n, errors="replace") for n in names]
