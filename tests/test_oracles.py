"""The driver's gate at small scale: every query with an oracle matches DuckDB."""
import duckdb
import pytest

from tests.conftest import SF_SMALL

SLOW = {"self_training", "random_forest_scores", "gaussian_nb_scores"}


@pytest.fixture(scope="module")
def con():
    from opinio.sources.tables import TABLES
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_all_oracles(spark, con):
    import sys
    import os
    sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(__file__)), "tools"))
    from oracle_check import canon
    import __spark_entry__ as e
    qs, ors = e.queries(), e.oracle_sql()
    bad = []
    for name, sql in ors.items():
        df = qs[name](spark, SF_SMALL)
        sc, sv = canon(df.columns, [tuple(r) for r in df.collect()])
        res = con.execute(sql)
        oc, ov = canon([d[0] for d in res.description], res.fetchall())
        if sc != oc or sv != ov:
            bad.append(name)
    assert not bad
