"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from voxelweave.llm.oracle import ORACLE
from voxelweave.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def rows(frame):
    return sorted(str([None if pd.isna(v) else int(v) if isinstance(v, float) and v.is_integer() else v for v in r]) for r in frame[sorted(frame.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_names_follow_the_contract():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 13))
