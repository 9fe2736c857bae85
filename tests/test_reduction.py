"""Semi-join reduction: every right side loses the rows of loans that are not screened, and the report loses none."""

import re

import pytest
from pyspark.sql import functions as F

from scrubline import CURRENT, MONTH_END, Tables, eligibility
from scrubline.operators import population, reduction
from scrubline.operators.reduction import Reduction
from scrubline.plans import pipeline
from scrubline.sources.fixtures import AS_OF, fixture_tables
from scrubline.sources.schemas import LOAN, TABLE_NAMES

ALWAYS = Reduction(most_share=1.0)
ONE_WORD = Reduction(most_share=1.0, bits_per_id=0)


@pytest.fixture(scope="module")
def few_screened(spark, tmp_path_factory):
    """Tables in which one loan in sixteen is delinquent."""
    directory = str(tmp_path_factory.mktemp("few"))
    tables = fixture_tables(spark, "/root/testdata/sf0.01")
    for name in TABLE_NAMES:
        rows = tables.live(name)
        if name.startswith("loan_master"):
            one = F.pmod(F.xxhash64(LOAN), F.lit(16)) == 0
            rows = rows.withColumns({c: F.when(one, F.col(c)).otherwise(F.lit(v)) for c, v in {"DelinquentStatusCodeId": "P", "InvestorId": "100"}.items()})
        rows.write.parquet(f"{directory}/{name}")
    return Tables.in_directory(spark, directory)


def test_a_filter_holds_all_its_ids_and_few_others(spark):
    ids = spark.range(0, 200_000, 10).withColumnRenamed("id", LOAN)
    words = reduction.words_for(20_000, Reduction())
    assert words == 4096
    keep = reduction.id_filter(ids.unionByName(spark.range(1).select(F.lit(None).cast("long").alias(LOAN))), words)
    assert 0 < keep.rows.count() <= words
    passed = reduction.reduced(spark.range(200_000).withColumnRenamed("id", LOAN), keep)
    assert passed.filter("LoanId % 10 = 0").count() == 20_000
    assert passed.filter("LoanId % 10 <> 0").count() < 0.05 * 180_000


def test_size_is_bounded():
    assert reduction.words_for(0, Reduction()) == 1
    assert reduction.words_for(10**6, Reduction()) == 1 << 18
    assert reduction.words_for(5 * 10**6, Reduction()) == 1 << 19
    # Four bits an id are the least: beyond that the filter passes nearly everything.
    assert reduction.words_for(9 * 10**6, Reduction()) is None


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
@pytest.mark.parametrize("limits", [ALWAYS, Reduction()], ids=["always", "default"])
def test_each_right_side_is_reduced_before_its_exchange(spark, few_screened, variant, limits):
    """One semi-join per row set, all below the exchanges by loan id."""
    # The filter is broadcast by its hint; the row sets are not.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = eligibility(few_screened, AS_OF, variant, skew_limits=None, filter_limits=limits)
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    depth = lambda line: len(re.match(r"[\s:+\-*()\d]*", line).group())
    under_exchange = 0
    for i, line in enumerate(lines):
        if "BroadcastHashJoin" in line and "LeftSemi" in line:
            above, at = [], depth(line)
            for other in reversed(lines[:i]):
                if depth(other) < at:
                    above.append(other)
                    at = depth(other)
            under_exchange += "Exchange hashpartitioning(LoanId" in next(x for x in above if "Exchange" in x or "SortMergeJoin" in x)
    assert under_exchange == (8 if variant.month_end else 7)
    plain = eligibility(few_screened, AS_OF, variant, skew_limits=None, filter_limits=None)
    assert df.count() == plain.count() > 0 and df.exceptAll(plain).count() == 0


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_rows_that_stay(few_screened, variant):
    """Counted per row set: all rows of screened loans, and few others."""
    run_date = F.lit(AS_OF)
    loans = pipeline.screened_loans(few_screened, run_date, variant)
    everything = pipeline.source(few_screened, variant, "loan_master", run_date)
    keep = reduction.screening_filter(everything, variant.population(population.Text()), loans, Reduction())
    assert keep is not None
    for name, rows in pipeline.enrichments(few_screened, run_date, variant).items():
        exact = rows.join(loans.select(LOAN).distinct(), LOAN, "left_semi").count()
        stays, all_rows = reduction.reduced(rows, keep).count(), rows.count()
        assert exact <= stays <= exact + 0.06 * all_rows and stays < 0.2 * all_rows + 5, name


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_a_filter_of_one_word_changes_nothing(few_screened, variant):
    """It passes nearly all rows; the joins stay exact, hot ids split or not."""
    plain = eligibility(few_screened, AS_OF, variant, skew_limits=None, filter_limits=None)
    for limits in (pipeline.Skew(), pipeline.Skew(piece_rows=3)):
        df = eligibility(few_screened, AS_OF, variant, skew_limits=limits, filter_limits=ONE_WORD)
        assert df.count() == plain.count() and df.exceptAll(plain).count() == 0


def test_no_filter_where_most_loans_are_screened(spark):
    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    run_date = F.lit(AS_OF)
    loans = pipeline.screened_loans(tables, run_date, CURRENT)
    whole = tables.live("loan_master")
    screened = CURRENT.population(population.Text())
    assert reduction.screening_filter(whole, screened, loans, Reduction()) is None
    assert reduction.screening_filter(whole, screened, loans, None) is None
    assert reduction.screening_filter(whole.limit(0), screened, loans.limit(0), Reduction()) is not None


def test_long_lists_reach_other_tables_by_a_filter(spark, monkeypatch):
    monkeypatch.setattr(population, "SENT_IDS", 1500)
    tables = fixture_tables(spark, "/root/testdata/sf0.01")
    long = spark.range(1, 4000).withColumnRenamed("id", LOAN)
    ids = population.listed_ids(spark, long.unionByName(long))
    assert isinstance(ids, population.LongList) and ids.ids.count() == 3999
    expected = eligibility(tables, AS_OF, loan_ids=None, skew_limits=None).filter("LoanId < 4000")
    for given in (long, range(1, 4000)):
        df = eligibility(tables, AS_OF, loan_ids=given)
        assert df.count() == expected.count() > 0 and df.exceptAll(expected).count() == 0


def test_lists_of_every_length(spark):
    rows = spark.range(0, 5000).withColumnRenamed("id", LOAN)
    for n, kind in ((0, list), (10, list), (1000, list), (1001, type(rows)), (4000, type(rows))):
        frame = spark.range(n).selectExpr("cast(id as int) as LoanId", "'x' as other")
        frame = frame.unionByName(frame).unionByName(spark.range(1).selectExpr("cast(null as int) as LoanId", "'y' as other"))
        for given in (frame, [*range(n), None, *range(n)]):
            ids = population.listed_ids(spark, given)
            assert isinstance(ids, kind), (n, type(ids))
            assert population.only_loans(rows, ids).count() == population.near_loans(rows, ids).count() == n
