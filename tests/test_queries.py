"""Every registered query against its DuckDB oracle on the sf0.01 driver tables (the correctness gate)."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracles import TABLES, canon  # noqa: E402

SF = "/root/testdata/sf0.01"
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["report_date", "n_rows"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(cols) > 0
        return
    cur = duck.execute(ORACLES[name])
    d_cols = [d[0] for d in cur.description]
    d_rows = cur.fetchall()
    assert sorted(cols) == sorted(d_cols)
    assert len(rows) == len(d_rows)
    assert canon(rows, cols) == canon(d_rows, d_cols)
