"""Every registered core query runs; with SQL, it equals DuckDB's answer."""

import pytest
from conftest import DATA, same_rows

from kinseq.plans.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    if name in ORACLES:
        same_rows(df, duck, ORACLES[name])
    else:
        assert df.count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_plans_push_down_and_share_exchanges(spark):
    from kinseq.plans.queries import win1_interpolate

    plan = win1_interpolate(spark, DATA)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<event_id" in plan and "event_type" not in plan.split("ReadSchema")[1].split("\n")[0]
    physical = plan.split("== Physical Plan ==")[1]
    assert physical.count("Exchange hashpartitioning") <= 2
