"""Schema inference by a vote over the values.

Each cleaned value gets one class (first hit of INT64, BOOL, BIGNUMERIC,
TIMESTAMP, DATE; else STRING). A column takes the first class, in that order,
that holds at least ``threshold`` of its non-null values; fewer than
``min_non_null`` values give STRING. Columns whose name contains "revenue"
become BIGNUMERIC when INT64 and BIGNUMERIC together reach the threshold.

The profile of a whole frame is one pass: each task counts the classes of its cells on Arrow batches
(``values.class_counts``, tested once for each distinct value of a batch) and sends one small row on.
That of groups is an aggregate with ``count_if`` per (column, class), or where they are many (the files of a
load) counted on batches too, a row a group. Only the per-column counts
(schema-sized) ever reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reportlake.functions import values as V
from reportlake.sources import csvlake

# Fixed values that must equal the reference's for equal results.
DEFAULT_SAMPLE_SIZE = 100
DEFAULT_THRESHOLD = 0.95
DEFAULT_MIN_NON_NULL = 10
REVENUE_MARK = "revenue"

COUNT_COLUMNS = ["n_int64", "n_bool", "n_bignumeric", "n_timestamp", "n_date"]
_CLASS_OF = dict(zip(COUNT_COLUMNS, ["INT64", "BOOL", "BIGNUMERIC", "TIMESTAMP", "DATE"]))


def classify(df: DataFrame, columns: list[str] | None = None, leading_zero: str = "decimal") -> DataFrame:
    """Class of every cell (I1), one ``<col>__class`` column per input column; NULL for null tokens."""
    cols = columns or df.columns
    # Clean first, in its own projection: the cleaned value is read by every
    # test below, and a separate projection keeps it computed once per cell.
    cleaned = df.select(*[V.null_if_token(F.col(c)).alias(f"{c}__v") for c in cols])
    return cleaned.select(*[V.value_class(F.col(f"{c}__v"), leading_zero).alias(f"{c}__class") for c in cols])


def profile(df: DataFrame, columns: list[str] | None = None, leading_zero: str = "decimal", by: list[str] = ()) -> DataFrame:
    """Per column (and group of ``by``): position, non-null count and count per class (I2). The counts of
    groups add up to those of all rows."""
    cols = columns if columns is not None else list(df.columns)
    if not by:
        return _column_rows(_counted(df.select(*[F.make_valid_utf8(F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(cols)]), leading_zero), cols)
    cleaned = df.select(*[V.null_if_token(F.col(c)).alias(f"{c}__v") for c in cols], *[F.col(c) for c in df.columns])
    # Small integer codes instead of class names: the counts compare ints, not strings.
    classes = cleaned.select(*[V.class_code(F.col(f"{c}__v"), leading_zero).alias(f"{c}__k") for c in cols], *[F.col(c) for c in df.columns])
    aggs = []
    for i, c in enumerate(cols):
        k = F.col(f"{c}__k")
        aggs.append(F.count(k).alias(f"{i}__n"))
        for code, cnt in enumerate(COUNT_COLUMNS, start=1):
            aggs.append(F.count_if(k == code).alias(f"{i}__{cnt}"))
    return _column_rows(classes.groupBy(*by).agg(*aggs), cols)


def _counted(cells: DataFrame, leading_zero: str) -> DataFrame:
    """One row with the counts of all columns. Tests written out for every column make Spark generate a method
    too large for its JIT."""
    width, names = len(cells.columns), ["n", *COUNT_COLUMNS]

    def run(batches):
        total = np.zeros((width, len(V.CLASS_NAMES)), np.int64)
        for batch in batches:
            for i in range(width):
                total[i] += V.class_counts(batch.column(i), leading_zero)
        total[:, 0] = total.sum(axis=1)  # non-null cells in the place of those of no class
        yield pa.RecordBatch.from_arrays([pa.array([int(v)]) for v in total.ravel()], names=[f"{i}__{n}" for i in range(width) for n in names])

    found = cells.mapInArrow(run, ", ".join(f"`{i}__{n}` long" for i in range(width) for n in names))
    return found.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in found.columns])


def profile_by(df: DataFrame, columns: list[str], by: list[str], sums: list[str] = (), leading_zero: str = "decimal") -> DataFrame:
    """``profile`` of many groups, with their number of ``rows`` and the exact sums of the long columns
    ``sums`` as decimals. Each task counts the groups of an Arrow batch and sends one row a group on."""
    width, names = len(columns), ["n", *COUNT_COLUMNS]
    cells = [F.make_valid_utf8(F.col(c).cast("string")).alias(f"c{i}") for i, c in enumerate(columns)]
    halves = [(F.shiftright(F.col(c).cast("bigint"), 32), F.col(c).cast("bigint").bitwiseAND(F.lit(_LOW_HALF))) for c in sums]
    given = df.select(*by, *cells, *[half.alias(f"s{i}_{k}") for i, pair in enumerate(halves) for k, half in enumerate(pair)])
    totals = ["rows", *[c for c in given.columns if c not in by and c.startswith("s")]]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            group = np.zeros(batch.num_rows, np.int64)
            for i in range(len(by)):
                codes = pc.dictionary_encode(batch.column(i), null_encoding="encode").indices.to_numpy()
                _, group = np.unique(group * (int(codes.max()) + 1) + codes, return_inverse=True)
            _, first, n = np.unique(group, return_index=True, return_counts=True)
            out = [batch.column(i).take(pa.array(first)) for i in range(len(by))]
            for i in range(width):
                counts = V.class_counts_of(batch.column(len(by) + i), group, len(first), leading_zero)
                out += [pa.array(v) for v in (counts.sum(axis=1), *counts.T[1:])]
            out.append(pa.array(n))
            for i in range(len(by) + width, batch.num_columns):
                total = np.zeros(len(first), np.int64)
                np.add.at(total, group, batch.column(i).to_numpy())
                out.append(pa.array(total))
            yield pa.RecordBatch.from_arrays(out, names=[*by, *counted, *totals])

    counted = [f"{i}__{n}" for i in range(width) for n in names]
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in by]
    found = given.mapInArrow(run, ", ".join([*kinds, *[f"`{c}` long" for c in [*counted, *totals]]]))
    found = found.groupBy(*by).agg(*[F.sum(c).alias(c) for c in [*counted, "rows"]], *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in totals[1:]])
    whole = [(F.col(f"s{i}_0").cast("decimal(25,0)") * F.lit(_LOW_HALF + 1) + F.col(f"s{i}_1")).cast("decimal(38,0)").alias(c) for i, c in enumerate(sums)]
    return _column_rows(found.select(*by, *counted, "rows", *whole), columns)


_LOW_HALF = (1 << 32) - 1


def _column_rows(wide: DataFrame, cols: list[str]) -> DataFrame:
    """One row a column (and group) from the counts in columns ``<position>__<count>``."""
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(i).cast("bigint").alias("position"),
                F.col(f"{i}__n").alias("n_non_null"),
                *[F.col(f"{i}__{cnt}").alias(cnt) for cnt in COUNT_COLUMNS],
            )
            for i, c in enumerate(cols)
        ]
    )
    kept = [c for c in wide.columns if "__" not in c or not c.split("__")[0].isdigit()]
    return wide.select(*kept, F.inline(rows))


def merged(profiles: DataFrame) -> DataFrame:
    """One profile from the profiles of files: counts add up, so no row is read again."""
    return profiles.groupBy("column_name").agg(F.min("position").alias("position"), *[F.sum(c).alias(c) for c in ["n_non_null", *COUNT_COLUMNS]]).select("column_name", "position", "n_non_null", *COUNT_COLUMNS)


def decide(prof: DataFrame, threshold: float = DEFAULT_THRESHOLD, min_non_null: int = DEFAULT_MIN_NON_NULL,
           revenue_rule: bool = True) -> DataFrame:
    """Add ``inferred_type`` to a profile."""
    n = F.col("n_non_null")
    ratio = lambda c: F.col(c) / n
    vote = F.lit("STRING")
    for cnt in reversed(COUNT_COLUMNS):
        vote = F.when(ratio(cnt) >= threshold, F.lit(_CLASS_OF[cnt])).otherwise(vote)
    if revenue_rule:
        revenue = F.lower("column_name").contains(REVENUE_MARK) & (
            (F.col("n_int64") + F.col("n_bignumeric")) / n >= threshold
        )
        vote = F.when(revenue, F.lit("BIGNUMERIC")).otherwise(vote)
    return prof.withColumn("inferred_type", F.when(n < min_non_null, F.lit("STRING")).otherwise(vote))


def type_distribution(decided: DataFrame) -> DataFrame:
    """Columns per inferred type."""
    return decided.groupBy("inferred_type").agg(F.count(F.lit(1)).alias("n_columns"))


@dataclass(frozen=True)
class InferredSchema:
    columns: list[str]
    types: list[str]
    has_title: bool
    head: csvlake.LakeHead

    @property
    def struct(self) -> T.StructType:
        return T.StructType(
            [T.StructField(c, csvlake.TYPE_TO_SPARK[t], True) for c, t in zip(self.columns, self.types)]
        )


def infer_lake_schema(
    spark: SparkSession,
    root: str,
    scope: str = "all_rows",
    sample_size: int = DEFAULT_SAMPLE_SIZE,
    threshold: float = DEFAULT_THRESHOLD,
    min_non_null: int = DEFAULT_MIN_NON_NULL,
    leading_zero: str = "decimal",
    fraction: float = 0.01,
    seed: int = 42,
) -> InferredSchema | None:
    """Folder to schema and title flag (I6). ``None`` when the folder has no file or the file is empty.

    ``scope='all_rows'`` votes over every row. Samples are taken only by name: ``'newest_file'`` votes
    over the first ``sample_size`` rows of the newest file, ``'sample'`` over a seeded ``fraction`` of the
    rows of every file; cells outside such a vote may not convert. All are one partial aggregate.
    """
    head = csvlake.lake_head(spark, root)
    if head is None or not head.columns:
        return None
    if scope == "newest_file":
        rows = csvlake.read_raw(spark, head.newest_path, head, with_source=False).limit(sample_size)
    elif scope == "all_rows":
        rows = csvlake.read_raw(spark, root, head, with_source=False)
    elif scope == "sample":
        rows = csvlake.read_raw(spark, root, head, with_source=False).sample(fraction=fraction, seed=seed)
    else:
        raise ValueError("scope must be 'newest_file', 'sample' or 'all_rows'")
    decided = decide(profile(rows, head.columns, leading_zero), threshold, min_non_null)
    got = {r["column_name"]: (r["inferred_type"], r["n_non_null"]) for r in decided.collect()}
    types = [got[c][0] for c in head.columns]
    return InferredSchema(head.columns, types, head.has_title, head)


def typed(raw: DataFrame, columns: list[str], on_error: str = "quarantine", **decide_kwargs) -> DataFrame:
    """An all-STRING frame with types voted over all its rows; cells that don't convert (a minority of
    their column) are named in ``_rejected`` unless ``on_error`` says otherwise (I2, I3, I8)."""
    got = {r["column_name"]: r["inferred_type"] for r in decide(profile(raw, columns), **decide_kwargs).collect()}
    return csvlake.apply_types(raw, columns, [got[c] for c in columns], on_error)


def read_typed(
    spark: SparkSession,
    root: str,
    schema: InferredSchema | None = None,
    on_error: str = "quarantine",
    autodetect_fallback: bool = True,
    **infer_kwargs,
) -> DataFrame:
    """A lake folder as a typed DataFrame (I8, I9): infer if no schema is given.

    Cells that don't convert are NULL and named in ``_rejected`` (``on_error='null'`` leaves that column
    out, ``'fail'`` raises). When inference finds nothing, ``autodetect_fallback`` falls back to
    Spark's own CSV inference over the folder; otherwise it raises.
    """
    schema = schema or infer_lake_schema(spark, root, **infer_kwargs)
    if schema is None:
        if not autodetect_fallback:
            raise ValueError(f"schema inference found no data in {root} and fallback is off")
        return spark.read.option("header", "true").option("inferSchema", "true").csv(root)
    raw = csvlake.read_raw(spark, root, schema.head)
    return csvlake.apply_types(raw, schema.columns, schema.types, on_error)
