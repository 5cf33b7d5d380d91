"""Region rows are laid out by region before they are multiplied, and stay in their
task: what the queries group and join by region is not shuffled, nor staged."""

import os

import pytest

from panelweft import scale
from panelweft.catalog import all_queries, world
from panelweft.plans import panel as whole
from panelweft.plans.config import REGION_TABLES, as_given, by_region
from panelweft.scale import shared_partitioning, staging_root

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="given tables not present")


def _folders(spark):
    root = staging_root(spark)
    return os.listdir(root) if os.path.isdir(root) else []


@pytest.mark.parametrize("name", ["population_rows", "income_rows", "cohort_rows"])
def test_rows_are_grouped_where_they_are_made(spark, name):
    df = all_queries()[name][0](spark, TABLES)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[scenario" in plan
    assert "Exchange hashpartitioning(scenario" not in plan


@pytest.mark.parametrize("name", ["panel_plain", "panel_reconciled", "panel_from_files", "panel_gates", "comparison_run"])
def test_panel_rows_are_not_staged(spark, name):
    before = set(_folders(spark))
    all_queries()[name][0](spark, TABLES).collect()
    new = {n.rsplit("-", 1)[0] for n in set(_folders(spark)) - before}
    assert new and not new & {"panel", "history", "baseline"}


@pytest.mark.parametrize("table", REGION_TABLES)
def test_regions_are_shuffled_before_their_years(spark, table):
    tables = by_region(world.sources(spark, TABLES))
    laid_out = getattr(tables, table)
    plan = laid_out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == plan.count("Exchange hashpartitioning(hierid") == 1
    assert "Generate" not in plan[plan.index("Exchange "):]
    given = getattr(as_given(tables), table)
    assert laid_out.exceptAll(given).isEmpty() and given.exceptAll(laid_out).isEmpty()


def test_weights_of_regions_need_no_hash_table(spark):
    # a task joins them in several branches, and each table stays until the task ends
    df = all_queries()["income_rows"][0](spark, TABLES)
    assert "ShuffledHashJoin" not in df._jdf.queryExecution().executedPlan().toString()


class Seen(Exception):
    pass


def _small_parts(monkeypatch):
    for module in (scale, world):
        monkeypatch.setattr(module, "ROWS_PER_TASK", 64)


@pytest.mark.parametrize(
    "name, module, sums",
    [("panel_from_files", world, "_national_sums"), ("panel_reconciled", world, "_national_sums"), ("panel_gates", whole, "country_sums")],
)
def test_country_sums_take_parts_of_regions_in_turn(spark, monkeypatch, name, module, sums):
    _small_parts(monkeypatch)
    plans = []

    def seen(panel, *args, **kwargs):
        plans.append(panel._jdf.queryExecution().executedPlan().toString())
        raise Seen

    monkeypatch.setattr(module, sums, seen)
    with pytest.raises(Seen):
        all_queries()[name][0](spark, TABLES)
    cores = spark.sparkContext.defaultParallelism
    assert scale.tasks_of(spark, 33 * 150, 64) > 2 * cores
    assert f"Coalesce {max(2 * cores, 5)}" in plans[0]
    # the tables of hash joins would stay in memory until the last of the parts
    assert "ShuffledHashJoin" not in plans[0]


def test_parts_in_turn_are_the_whole_panel(spark, monkeypatch):
    _small_parts(monkeypatch)
    with shared_partitioning(spark):
        each = whole.panel_layouts(world.sources(spark, TABLES), world.RECONCILED)
        by_part, in_turn = (sorted(map(tuple, world._national_sums(p).collect()), key=str) for p in each)
    assert len(by_part) == len(in_turn) > 20000
    assert [r[:7] for r in by_part] == [r[:7] for r in in_turn]
    assert all(a[7:] == pytest.approx(b[7:], abs=1e-6) for a, b in zip(by_part, in_turn))
