"""Every registered query against its SQL counterpart, over whole tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
from lettera.plans.catalog import BUILDERS, Workspace
from lettera.sources.testbed import CURRENT_YEAR
from oracle.sql import ORACLE
from tests.compare import connect, differences
from tests.conftest import FOLDER



@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(workspace, con, name):
    """The same rows, without a product of two sides or Python in the data path."""
    df = BUILDERS[name](workspace)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "PythonUDF"):
        assert unwanted not in plan
    assert differences(df, con, ORACLE[name]) == []


def test_every_query_has_sql():
    assert set(BUILDERS) == set(ORACLE)
    assert set(BUILDERS) <= set(entry_point.queries())


REPORTS = sorted(n for n in BUILDERS if n.startswith("q"))


@pytest.mark.parametrize("name", REPORTS)
def test_reports_read_the_stored_year(spark, workspace, name):
    """No report writes anything, and those of one year leave the other years unread."""
    folder = Path(workspace.layers.gold).parents[1]
    before = sorted(folder.iterdir())
    report = BUILDERS[name](workspace)
    assert sorted(folder.iterdir()) == before
    assert all(workspace.layers.gold in f for f in report.inputFiles())
    plan = report._jdf.queryExecution().executedPlan().toString()
    if name[1] in "123456":
        assert f"PartitionFilters: [isnotnull(ano" in plan and f"= {CURRENT_YEAR})]" in plan


def test_layers_are_built_once(spark, workspace):
    assert Workspace(spark, FOLDER).layers is workspace.layers


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns[0] == "sigla_uf"
    assert df.count() > 0
