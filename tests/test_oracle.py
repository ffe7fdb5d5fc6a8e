"""Every key with an oracle equals DuckDB on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from check_oracle import rows_of  # noqa: E402

import __spark_entry__ as E  # noqa: E402
from dockline.plans import oracle, registry  # noqa: E402
from dockline.sources.tables import TABLES  # noqa: E402

D = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{D}/{t}.parquet')")
    return c


def test_every_key_is_registered():
    keys = set(registry.queries())
    assert len(keys) == 56 and keys <= set(E.queries())
    assert set(SQL) <= keys and set(SQL) <= set(E.oracle_sql())
    assert keys - set(SQL) == {"model_comparison", "feature_importance", "prediction_vs_actual"}


@pytest.mark.parametrize("key", sorted(SQL))
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, D)
    srows, scols = df.collect(), df.columns
    res = con.execute(SQL[key])
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["station_name", "commune", "occupancy_pct"]
    assert 0 < df.count() <= 10
