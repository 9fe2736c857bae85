"""The test tables can tell right from wrong: a fault in a source, a multiplicity or a text rule shows in a query."""

from functools import cache

import pytest
from pyspark.sql import functions as F

from scrubline import MONTH_END, Tables, eligibility
from scrubline.checks import queries
from scrubline.sources.fixtures import AS_OF, FIXTURE_PERIOD, REPEATED, fixture_tables
from scrubline.sources.schemas import PERIOD, SNAPSHOTS, TABLE_NAMES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return fixture_tables(spark, SF)


def changed(tables, **others):
    return Tables(tables.spark, {name: others.get(name, tables.live(name)) for name in TABLE_NAMES})


def differ(a, b):
    return a.exceptAll(b).count() + b.exceptAll(a).count() > 0


@pytest.fixture(scope="module")
def month_end(tables):
    return eligibility(tables, AS_OF, MONTH_END, skew_limits=None).cache()


@pytest.mark.parametrize("name", SNAPSHOTS)
def test_reading_a_snapshot_live_shows(tables, month_end, name):
    live = tables.live(name).withColumn(PERIOD, F.lit(FIXTURE_PERIOD))
    assert differ(eligibility(changed(tables, **{f"{name}_me": live}), AS_OF, MONTH_END, skew_limits=None), month_end)


def test_reading_the_live_refinance_rows_from_the_snapshot_shows(tables, month_end):
    period = tables.live("loan_master_me").filter(F.col(PERIOD) == FIXTURE_PERIOD).drop(PERIOD)
    assert differ(eligibility(changed(tables, loan_master=period), AS_OF, MONTH_END, skew_limits=None), month_end)


@pytest.mark.parametrize("name", SNAPSHOTS)
def test_reading_all_periods_shows(tables, month_end, name):
    rows = tables.live(f"{name}_me").withColumn(PERIOD, F.lit(FIXTURE_PERIOD))
    assert differ(eligibility(changed(tables, **{f"{name}_me": rows}), AS_OF, MONTH_END, skew_limits=None), month_end)


OF_TABLE = {
    "modification_master": queries.join_modification,
    "foreclosure_master": queries.foreclosure_sale,
    "borrower_master": queries.deceased_borrower,
    "lossmitigation_step_transpose": queries.lossmit_steps,
    "portfolio_summary": queries.property_state,
    "property_master": queries.property_state,
}


@pytest.mark.parametrize("name", REPEATED)
def test_removing_repeated_rows_shows(tables, name):
    single = tables.live(name).dropDuplicates(["LoanId"])
    query = OF_TABLE[name]
    assert query(changed(tables, **{name: single})).count() < query(tables).count()


@cache
def codes():
    return {
        "InvestorId": {"45", "4000", "498 ", "025 "},
        "LoanStatusId": {"f", "2 "},
        "DelinquentStatusCodeId": {"f "},
        "PayoffStopCodeId": {"0 "},
        "ARMFlag": {"y "},
    }


@pytest.mark.parametrize("column", codes())
def test_text_edges_occur_among_the_loans(tables, column):
    found = {r[0] for r in tables.live("loan_master").select(column).distinct().collect()}
    assert codes()[column] <= found


@pytest.mark.parametrize("strict", ["case_sensitive"])
def test_comparing_text_strictly_shows(tables, month_end, strict):
    assert differ(eligibility(tables, AS_OF, MONTH_END, skew_limits=None, **{strict: True}), month_end)
