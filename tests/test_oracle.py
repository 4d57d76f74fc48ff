"""Every registered query against its SQL, value by value, on the given tables."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

# The training-data queries have their tests beside their subpackage's.
NAMES = sorted(n for n in contract.queries() if not n.startswith("op") and n != "pipeline")
KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for file in os.listdir(data):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data}/{file}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for c in frame.columns:
        if pd.api.types.is_datetime64_any_dtype(frame[c]):
            frame[c] = frame[c].astype("datetime64[us]").astype(str)
        elif pd.api.types.is_numeric_dtype(frame[c]):
            frame[c] = frame[c].astype("float64") + 0.0
        frame[c] = frame[c].astype(object).where(frame[c].notna(), None)
    return frame.sort_values(list(frame.columns), key=lambda s: s.map(repr), ignore_index=True)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, data, duck, name):
    result = contract.queries()[name](spark, data)
    got = result.toPandas()
    assert len(got) > 0
    sql = contract.oracle_sql()[name]
    want = duck.execute(sql).df()
    kinds = {column: kind for column, kind, *_ in duck.execute(f"DESCRIBE {sql}").fetchall()}
    assert {column: KINDS[kind] for column, kind in result.dtypes} == kinds
    pd.testing.assert_frame_equal(canonical(got), canonical(want), check_dtype=False, rtol=0, atol=0)


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
