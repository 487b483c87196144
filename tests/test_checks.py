"""Every ready-made query against its check SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as entry
from compare import compare, connect
from conftest import SF_SMALL
from sensorloom.plans import catalog

QUERIES = catalog()


@pytest.fixture(scope="module")
def con():
    return connect(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_check_sql(spark, con, name):
    assert compare(spark, con, QUERIES[name], SF_SMALL) is None


def test_entry_points(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_serving_query_reads_the_whole_topic(spark):
    whole, ward = (sorted(QUERIES[n].run(spark, SF_SMALL).collect()) for n in ("serving_query", "serving_ward"))
    assert whole == ward and len({r.window_start for r in whole if r.source_layer == "SPEED"}) > 30


def test_no_quadratic_joins(spark):
    for name, q in QUERIES.items():
        plan = q.run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan), name


def test_scans_read_only_what_they_need(spark, monkeypatch):
    from sensorloom.operators import cooldown

    staged, keep = [], cooldown.materialize
    monkeypatch.setattr(cooldown, "materialize", lambda df: staged.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    plan = QUERIES["breach_counts"].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"ReadSchema: struct<event_id:bigint,value:double>", plan)
    QUERIES["alert_cooldown"].run(spark, SF_SMALL)
    assert len(staged) == 1 and "GreaterThan(value,60.0)" in staged[0]  # the scan is in the plan of the staged candidates


def test_top_n_per_group_is_cut_before_its_shuffle(spark):
    plan = QUERIES["samples_per_group"].run(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
