"""Physical plans of the fact jobs: what may not be above the expansion to days, and how raw rows are reduced."""

import os
import re

import pytest

from assetpulse.plans.bridge import Bridge
from assetpulse.plans.catalog import all_queries, fact_sources
from assetpulse.plans.daily_facts import daily_facts

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables absent")


def plan_lines(df):
    """(depth, operator) of the physical plan, root first."""
    text = df._jdf.queryExecution().sparkPlan().toString()
    lines = []
    for line in text.splitlines():
        body = re.match(r"^[\s:|+-]*(\*\(\d+\) )?", line)
        lines.append((body.end(), line[body.end() :].split("(")[0].split(" ")[0]))
    return lines


def above_expansion(df):
    names = [name for _, name in plan_lines(df)]
    assert "Generate" in names
    return names[: names.index("Generate")]


@pytest.mark.parametrize("name", ["daily_facts", "ml_prepared", "operational_age", "row_change", "daily_facts_valid", "ml_prepared_valid"])
def test_nothing_but_projections_after_the_expansion(spark, name):
    assert set(above_expansion(all_queries()[name](spark, SF_DIR))) <= {"Project", "Filter"}


def test_raw_rows_are_aggregated_by_hash(spark):
    """No source but the device table (a row per product) needs a sort to be reduced."""
    df = daily_facts(fact_sources(Bridge(spark, SF_DIR), "service_requests", "error_events", "firmware"), "2001-06-30")
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in text and text.count("HashAggregate") >= 8


def test_work_and_firmware_keep_their_order(spark):
    """Packed and struct orders pick the same rows."""
    bridge = Bridge(spark, SF_DIR)
    from assetpulse.operators import signals as sig

    sources = fact_sources(bridge, "firmware")
    for signal, table, order in ((sig.work_signal, sources.work, sources.work_tie_break), (sig.firmware_signal, sources.firmware, sources.firmware_tie_break)):
        packed, plain = signal(table, "2001-06-30", order), signal(table, "2001-06-30", [name for name, _ in order])
        assert packed.exceptAll(plain).count() == 0 and plain.exceptAll(packed).count() == 0
