"""Every registered query of the core against its DuckDB SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd
import pytest

from loamline import plans

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, ORACLES = plans.queries(), plans.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    """A value as text that both engines' frames agree on."""
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, (float, np.floating)) and np.isnan(v)):
        return "-"
    if isinstance(v, (bool, np.bool_)):
        return str(bool(v))
    if isinstance(v, (int, float, np.integer, np.floating)):
        return f"{float(v):.9g}"
    return str(v).removesuffix(" 00:00:00")


def rows(df: pd.DataFrame) -> list[tuple]:
    return sorted(tuple(map(plain, r)) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_agrees_with_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_refresh_writes_every_mart(spark):
    log = QUERIES["s16_refresh_all"](spark, SF).collect()
    assert len(log) == 21 and all(r.in_order and r.row_count > 0 for r in log)
