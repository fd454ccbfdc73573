"""Every query with an SQL oracle equals DuckDB on the smallest fixture (the driver checks sf0.01)."""

import pytest
from harness import compare

from riskflow.plans.catalog import load_all

from conftest import SMALL

REG = load_all()
CHECKED = sorted(n for n, q in REG.items() if q.sql is not None)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_oracle(spark, duck_small, name):
    q = REG[name]
    compare(q.fn(spark, SMALL), q.sql, duck_small)


def test_entry(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.columns == ["DT_week", "n_samples", "fraud_rate"]
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
