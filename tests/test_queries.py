"""Every query must give the rows of its SQL, without cross joins or Python in its plan."""

import io
from contextlib import redirect_stdout

import __spark_entry__ as entry_points
import compare
import pytest

from partload import plans

BANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_sql():
    assert set(plans.queries()) == set(plans.oracles())
    assert plans.queries().items() <= entry_points.queries().items()


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_query(spark, con, sf_dir, name):
    df = plans.queries()[name](spark, sf_dir)
    same, message = compare.compare(df, con, plans.oracles()[name])
    assert same, message
    plan = io.StringIO()
    with redirect_stdout(plan):
        df.explain("formatted")
    assert not [word for word in BANNED if word in plan.getvalue()]


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["order_month", "source_count", "target_count", "status"]
    assert df.count() > 0
