import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_mod
from tidemark.plans import registry
from tests.conftest import SF001
from tidemark.sources.tables import TABLES

SLOW = {"stream_hourly_stats", "stream_dedup_latest", "stream_features", "stream_labeled", "stream_alerts"}


def test_every_query_has_an_oracle():
    q, o = registry.queries(), registry.oracle_sql()
    assert set(o) == set(q) <= set(entry_mod.queries())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["dex_protocol", "pool_id", "hour_ts"]
    assert dict(df.dtypes)["hour_ts"] == "timestamp_ntz"


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = pd.to_datetime(df[c]).astype("datetime64[us]").astype(str)
        df[c] = df[c].map(lambda v: None if v is None or (isinstance(v, float) and v != v) else str(v))
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(set(registry.oracle_sql()) - SLOW))
def test_oracle_pair_sf0001(spark, duck, name):
    got = entry_mod.queries()[name](spark, SF001).toPandas()
    exp = duck.execute(entry_mod.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert len(got) == len(exp)
    pd.testing.assert_frame_equal(_norm(got), _norm(exp))
