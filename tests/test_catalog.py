import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlens import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SAMPLE = ["q_gap", "q_episodes", "q_rt_daily", "q_recon_b", "q_displaced", "join_asof_both", "mv_backfill", "bm25", "kappa", "win_row_number", "dec_trade", "q_day_boundary"]


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def shown(value):
    if isinstance(value, float):
        return f"{value:.9g}"
    return [shown(v) for v in value] if isinstance(value, (list, tuple)) else str(value)


@pytest.mark.parametrize("name", SAMPLE)
def test_against_duckdb(spark, oracle, name):
    df = catalog.queries()[name](spark, DATA)
    got = oracle.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in got.description]
    assert sorted(df.columns) == sorted(columns)
    want = sorted(str([shown(r[columns.index(c)]) for c in df.columns]) for r in got.fetchall())
    assert sorted(str([shown(v) for v in r]) for r in df.collect()) == want


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_every_oracle_has_its_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
