"""Physical-plan checks: no Python in the hot path, no nested-loop or cartesian joins,
filters and column pruning reach the bookings scan."""

from collections import Counter

import pytest

from ledgerline.registry import run
from ledgerline.sources.catalog import Catalog
from ledgerline.sources.fixtures import write_fixture_tables

BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF")
REPORTS = ("motor_leads", "health_fresh_leads", "health_renewal_leads", "life_leads", "sme_leads",
           "motor_summary", "health_persistency", "annual_clubs", "combined_leads", "partner_universe")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    write_fixture_tables(spark, "/root/testdata/sf0.001", root)
    return Catalog.from_parquet(spark, root)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", REPORTS)
def test_no_python_or_nested_loops(stored, name):
    plan = _plan(run(name, stored))
    for bad in BAD:
        assert bad not in plan, f"{name}: {bad} in plan"


def _formatted(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def test_bookings_scan_is_pushed_and_pruned(stored):
    text = _formatted(run("motor_leads", stored))
    blocks = [b for b in text.split("\n\n") if "Scan parquet" in b and "/bookings" in b]
    assert blocks
    s = blocks[0]
    assert "In(ProductId" in s
    assert "GreaterThanOrEqual(BookingDate" in s and "LessThan(BookingDate" in s
    read_schema = [l for l in s.splitlines() if l.startswith("ReadSchema")][0]
    assert "PolicyEndDate" not in read_schema  # pruned: the motor report does not read it


@pytest.mark.parametrize("name", ["sme_summary", "motor_summary", "health_fresh_summary", "health_renewal_summary", "life_summary"])
def test_summaries_weight_instead_of_copying(stored, name):
    assert "_copy" not in _plan(run(name, stored)).replace("_copies", "")


def test_renewal_stream_is_shuffled_by_lead_only(spark, stored):
    """Static plan without broadcasts, as in a plain session."""
    import re

    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        plan = _plan(run("health_renewal_leads", stored))
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert not re.search(r"hashpartitioning\(_ref_id#\d+L?, leadid", plan)
    assert len(re.findall(r"hashpartitioning\(leadid#", plan)) <= 2


@pytest.fixture(scope="module")
def stored_partitioned(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables_by_month"))
    write_fixture_tables(spark, "/root/testdata/sf0.001", root, partition_fact=True)
    return Catalog.from_parquet(spark, root)


@pytest.mark.parametrize("name", ["motor_leads", "health_renewal_leads", "sme_summary", "combined_leads"])
def test_month_partitioned_fact_gives_same_rows(stored, stored_partitioned, name):
    a = Counter(tuple(r) for r in run(name, stored).collect())
    b = Counter(tuple(r) for r in run(name, stored_partitioned).collect())
    assert a == b


def test_month_partitions_are_pruned(stored_partitioned):
    text = _formatted(run("motor_leads", stored_partitioned))
    blocks = [b for b in text.split("\n\n") if "Scan parquet" in b and "/bookings" in b]
    pf = [l for l in blocks[0].splitlines() if l.startswith("PartitionFilters")][0]
    assert "BookingMonth" in pf and "ProductId" in pf
