"""Every query with SQL gives the rows that DuckDB gives."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from shelfspark.plans.catalogue import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM read_parquet('{f}')")
    return con


def _rows(df: pd.DataFrame) -> list[str]:
    def plain(v):
        if v is None or (not hasattr(v, "__len__") and pd.isna(v)):
            return None
        return round(float(v), 9) if isinstance(v, float) else str(v)

    return sorted(str([plain(v) for v in r]) for r in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows(spark, duck, name):
    assert _rows(QUERIES[name](spark, SF).toPandas()) == _rows(duck.execute(ORACLE_SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
