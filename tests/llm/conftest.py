"""Small document tables with the awkward cases every operator has to take."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
#: Extra columns with names that the operators use themselves.
CLASHING = ["id", "key", "label", "node", "row", "h", "kind", "spans", "body", "place", "doc"]


def sentence(rng, words=12):
    return " ".join(rng.choice(VOCABULARY) for _ in range(words)).capitalize() + "."


VOCABULARY = [a + b for a in ("ra", "to", "mi", "ge", "lu", "sen", "por", "dak") for b in ("ble", "no", "stin", "ver", "quo", "lem", "dir", "fas")]


def edge_texts(rng):
    long = "\n".join(sentence(rng, 15) for _ in range(700))
    base = [sentence(rng, 40) for _ in range(12)]
    near = " ".join(base[0].split()[:-2] + ["changed", "ending."])
    return [None, "", "   \n\t", "a", "one two three", "one two three", "ONE two THREE", "héllo wörld ñandú 日本語 😀 x", *base, base[0], near, long, long + " tail end here now.", "....", "12345 67890", "\x01 \x02   end"]


@pytest.fixture(scope="session")
def documents(spark):
    rng = random.Random(5)
    texts = edge_texts(rng)
    rows = [(i, t, [None, "xx", "yy"][i % 3], None if i % 4 else "src", None if i % 5 else 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[9]], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def widened(documents):
    from pyspark.sql import functions as F

    return documents.select("*", *[F.lit("clash").alias(c) for c in CLASHING])
