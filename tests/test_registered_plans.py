"""Every query of the catalog (non-IO) plans without Python evaluation, Cartesian products or nested-loop
joins, and every query has an oracle."""

import pytest

from courtline.plans.catalog import ORACLE, QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")
NAMES = sorted(n for n in QUERIES if not n.startswith(("io_", "ss_")))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_plan_hygiene(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in FORBIDDEN:
        assert bad not in plan, (name, bad)
