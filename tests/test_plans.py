"""Plan properties the design relies on (static plans, AQE off)."""

import pytest

import __spark_entry__ as E
from newsarc.plans.queries import QUERIES as OWN

from conftest import SF_SMALL

RISKY = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


@pytest.fixture()
def static(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_cap_is_a_window_group_limit(static):
    assert "WindowGroupLimit" in _plan(E.queries()["q_cap5"](static, SF_SMALL))


def test_link_resolution_is_not_copied_into_filters(static):
    df = E.queries()["q_articles_base"](static, SF_SMALL)
    assert len(df._jdf.queryExecution().optimizedPlan().toString()) < 50_000


def test_no_cartesian_nested_loop_or_python(static):
    bad = {}
    for name in OWN:
        fn = E.queries()[name]
        plan = _plan(fn(static, SF_SMALL))
        hits = [k for k in RISKY if k in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad
