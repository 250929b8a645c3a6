"""Every registered query against its SQL at the smallest scale."""

import duckdb
import pytest

from checks.catalogue import ORACLES, QUERIES
from checks.compare import KINDS, TABLES, rows_of

SF = "/root/testdata/sf0.001"
TRAINING = {"delay_model_metrics", "eta_model_metrics"}  # minutes of training; smoke-tested elsewhere
# as long: the same work is held against full builds and against the trained model in test_incremental.py and test_ml.py
TRAINING |= {"daily_two_runs", "stored_model_scores"}


@pytest.fixture(scope="module")
def con():
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return db


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in TRAINING])
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    ours = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert ours
        return
    cursor = con.execute(ORACLES[name])
    kinds = {c[0]: str(c[1]) for c in cursor.description}
    assert {c: KINDS[k] for c, k in df.dtypes} == kinds
    assert ours == rows_of(list(kinds), cursor.fetchall())


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
