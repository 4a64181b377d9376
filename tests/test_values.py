"""Value classes, null tokens, name normalisation and the vote, on inputs built from the rules."""

import datetime as dt
import random
import string

import pytest
from pyspark.sql import functions as F

from frames import one_col
from reportlake.functions import values as V
from reportlake.operators import infer


def classes(spark, values, leading_zero="decimal"):
    df = one_col(spark, values)
    return [r[0] for r in df.select(V.value_class(V.null_if_token("v"), leading_zero)).collect()]


def padded(rng, text):
    return " " * rng.randint(0, 2) + text + "\t" * rng.randint(0, 1)


def random_case(rng, word):
    return "".join(rng.choice((c.lower(), c.upper())) for c in word)


def generated(kind, n=60, seed=0):
    """``n`` texts of a class, each drawn by the class's own rule."""
    rng = random.Random(f"{kind}{seed}")
    day = lambda: dt.date(1950, 1, 1) + dt.timedelta(days=rng.randrange(40_000))
    stamp = lambda: dt.datetime.combine(day(), dt.time(rng.randrange(24), rng.randrange(60), rng.randrange(60)))
    make = {
        "INT64": lambda: str(rng.choice((1, -1)) * rng.randint(1, 9) * 10 ** rng.randint(0, 17) + rng.randint(0, 9)),
        "BOOL": lambda: random_case(rng, rng.choice(("true", "false", "yes", "no"))),
        "BIGNUMERIC": lambda: rng.choice((f"{rng.uniform(-1e4, 1e4):.3f}", f"{rng.uniform(1, 9):.2e}", f"0{rng.randint(1, 10**6)}", str(2**63 + rng.randint(0, 10**6)))),
        "DATE": lambda: day().strftime(rng.choice(("%Y-%m-%d", "%Y/%m/%d"))),
        "TIMESTAMP": lambda: stamp().strftime(rng.choice(("%Y-%m-%d %H:%M:%S", "%Y/%m/%d %H:%M:%S"))) + rng.choice(("", f".{rng.randint(0, 999):03d}")),
        "STRING": lambda: rng.choice(string.ascii_letters) + "".join(rng.choice(string.ascii_lowercase + " _") for _ in range(rng.randint(3, 9))) + rng.choice("#!x9"),
        None: lambda: random_case(rng, rng.choice(("", "null", "none"))),
    }[kind]
    return [padded(rng, make()) for _ in range(n)]


@pytest.mark.parametrize("kind", ["INT64", "BOOL", "BIGNUMERIC", "DATE", "TIMESTAMP", "STRING", None])
def test_generated_values_get_their_class(spark, kind):
    values = generated(kind)
    assert dict(zip(values, classes(spark, values))) == {v: kind for v in values}


def test_borders_between_classes(spark):
    edge = 2**63
    pairs = [(str(edge - 1), "INT64"), (str(-edge), "INT64"), (str(edge), "BIGNUMERIC"), (f"{edge // 7}.0", "BIGNUMERIC"),
             ("1", "INT64"), ("7e", "STRING"), ("4 4", "STRING"), ("..8", "STRING"), ("31-12-1999", "STRING"), ("1999-12-3", "STRING")]
    assert classes(spark, [v for v, _ in pairs]) == [k for _, k in pairs]
    assert classes(spark, ["0044", "0.44", "044.5"], leading_zero="string") == ["STRING", "BIGNUMERIC", "STRING"]
    assert classes(spark, [None]) == [None]


def test_names_are_cleaned_then_told_apart(spark):
    rng = random.Random(8)
    headers = [["".join(rng.choice("kK z.-(/)?:7") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 9))] for _ in range(40)]
    df = spark.createDataFrame([(h,) for h in headers], "h array<string>")
    for row in df.select("h", V.normalize_names("h").alias("out"), F.transform("h", V.normalize_name).alias("clean")).collect():
        assert len(set(row["out"])) == len(row["out"]) == len(row["h"])
        assert all(set(c) <= set("kz_7") for c in row["clean"])
        for i, (name, clean) in enumerate(zip(row["out"], row["clean"])):
            before = row["out"][:i]
            if clean not in before:
                assert name == clean
            else:  # the least number that is free
                number = int(name.removeprefix(clean + "_"))
                assert number >= 1 and all(f"{clean}_{k}" in before for k in range(1, number))


def vote(spark, columns):
    names = list(columns)
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"`{n}` string" for n in names))
    return {r["column_name"]: r["inferred_type"] for r in infer.decide(infer.profile(df, names)).collect()}


def test_each_class_wins_its_column(spark):
    kinds = ["INT64", "BOOL", "BIGNUMERIC", "DATE", "TIMESTAMP", "STRING"]
    assert vote(spark, {f"c_{k.lower()}": generated(k, 40, seed=3) for k in kinds}) == {f"c_{k.lower()}": k for k in kinds}


@pytest.mark.parametrize("odd,winner", [(1, "INT64"), (2, "INT64"), (3, "STRING"), (20, "STRING")])
def test_the_share_of_the_winner_must_reach_the_threshold(spark, odd, winner):
    values = generated("INT64", 40 - odd, seed=4) + generated("STRING", odd, seed=4)
    assert vote(spark, {"quantity": values}) == {"quantity": winner}


def test_null_tokens_neither_vote_nor_count(spark):
    few, many = generated("DATE", 9, seed=5), generated("DATE", 10, seed=5)
    assert vote(spark, {"few": few + generated(None, 41), "many": many + generated(None, 40)}) == {"few": "STRING", "many": "DATE"}


def test_revenue_columns_add_integers_and_decimals(spark):
    mixed = generated("INT64", 24, seed=6) + generated("BIGNUMERIC", 24, seed=6)
    assert vote(spark, {"share": mixed, "Net Revenue": mixed, "revenue_units": generated("INT64", 48, seed=7)}) == {
        "share": "STRING", "Net Revenue": "BIGNUMERIC", "revenue_units": "BIGNUMERIC"}


def test_type_distribution(spark):
    columns = {f"{k}{i}": generated(k, 15, seed=i) for k, n in (("DATE", 3), ("BOOL", 1), ("STRING", 2)) for i in range(n)}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{n} string" for n in columns))
    got = {r[0]: r[1] for r in infer.type_distribution(infer.decide(infer.profile(df, list(columns)))).collect()}
    assert got == {"DATE": 3, "BOOL": 1, "STRING": 2}


@pytest.mark.parametrize("t", ["INT64", "BOOL", "BIGNUMERIC", "TIMESTAMP", "DATE", "STRING"])
def test_view_sql_matches_dataframe_typing(spark, t):
    from reportlake.operators.tables import typed_sql
    from reportlake.sources.csvlake import typed_value

    kinds = ["INT64", "BOOL", "BIGNUMERIC", "DATE", "TIMESTAMP", "STRING", None]
    df = one_col(spark, [v for k in kinds for v in generated(k, 8, seed=9)] + [None, "\x0b5\x0c"])
    a = [r[0] for r in df.select(F.expr(typed_sql("v", t))).collect()]
    b = [r[0] for r in df.select(typed_value(F.col("v"), t, True)).collect()]
    assert a == b
