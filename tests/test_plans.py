"""Physical plans: what reaches the scan, what is shuffled, what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from scrubline import CURRENT, MONTH_END, Tables, eligibility
from scrubline.operators import skew
from scrubline.sources.fixtures import AS_OF, fixture_tables
from scrubline.sources.schemas import TABLE_NAMES

BUCKETS = 8


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


def scans(text: str, table: str) -> list[str]:
    """The scan blocks of one table."""
    return [block for block in re.split(r"\n\n", text) if "Scan parquet" in block and re.search(rf"\b{table}\b", block)]


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    directory = str(tmp_path_factory.mktemp("plans"))
    tables = fixture_tables(spark, "/root/testdata/sf0.01")
    for name in TABLE_NAMES:
        writer = tables.live(name).write
        (writer.partitionBy("MEPeriod") if name.endswith("_me") else writer).parquet(f"{directory}/{name}")
    return Tables.in_directory(spark, directory)


@pytest.fixture
def large(spark):
    """Plans as for tables over the broadcast limit; the two lookups alone stay under it."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "6000")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def report(tables, variant):
    return eligibility(tables, AS_OF, variant, skew_limits=None)


def test_filters_and_columns_reach_the_scans(stored):
    text = plan(report(stored, CURRENT))
    loans = next(block for block in scans(text, "loan_master") if "TradeId" in block)
    pushed = re.search(r"PushedFilters: (.*)", loans).group(1)
    assert "GreaterThan(CurrentPrincipalBalanceAmt,0.01)" in pushed
    assert "GreaterThanOrEqual(InvestorId,400)" in pushed and "LessThan(InvestorId,499)" in pushed
    assert "StringStartsWith(DelinquentStatusCodeId,F)" in pushed
    assert "StringStartsWith(InvestorId,025)" in pushed
    schema = re.search(r"ReadSchema: (.*)", loans).group(1)
    assert "OriginalLoanToValueRatio" not in schema and "LoanPurposeCodeId" not in schema
    comments = scans(text, "collection_commentactivity")[0]
    assert "StringStartsWith(ReasonCode,001)" in comments
    refi = next(block for block in scans(text, "loan_master") if "TradeId" not in block)
    assert "GreaterThan(OriginalLoanToValueRatio,0.9" in refi
    assert len(re.search(r"ReadSchema: struct<(.*)>", refi).group(1).split(":")) == 5


def test_one_period_is_read(stored):
    text = plan(report(stored, MONTH_END))
    for table in ("loan_master_me", "modification_master_me", "foreclosure_master_me", "borrower_master_me"):
        (block,) = scans(text, table)
        assert "PartitionFilters" in block and "(MEPeriod" in block and "= 200107" in block


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_loans_are_shuffled_once(spark, stored, large, variant):
    text = plan(report(stored, variant))
    joins = len(re.findall(r"^\(\d+\) SortMergeJoin", text, re.M))
    by_loan = len(re.findall(r"hashpartitioning\(LoanId#\d+L, \d+\)", text))
    assert joins == (8 if variant.month_end else 7)
    # The loans and one exchange for each joined row set.
    assert by_loan == joins + 1
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "Pandas" not in text


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_ids_filter_every_table_before_its_shuffle(spark, stored, large, variant):
    """A DataFrame of ids, sent to all tasks: each table is semi-joined where it is scanned."""
    ids = spark.range(1, 4000).withColumnRenamed("id", "LoanId")
    df = eligibility(stored, AS_OF, variant, loan_ids=ids, skew_limits=None)
    text = plan(df)
    # The loans and every joined row set.
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin.*?\n(?:.*\n)*?Join type: LeftSemi", text, re.M)) >= 1
    semis = len(re.findall(r"Join type: LeftSemi", text))
    assert semis == (9 if variant.month_end else 8)
    assert df.count() == report(stored, variant).filter("LoanId < 4000").count() > 0


def test_refinance_rows_are_shuffled_by_loan_alone(stored, large):
    text = plan(report(stored, CURRENT))
    assert not re.findall(r"hashpartitioning\(LoanId#\d+L, [^\d\s]", text)


def test_lookups_are_broadcast_only_under_the_limit(spark, stored, large):
    text = plan(report(stored, CURRENT))
    assert len(re.findall(r"^\(\d+\) BroadcastHashJoin", text, re.M)) == 2
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert "Broadcast" not in plan(report(stored, CURRENT))


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_tables_bucketed_by_loan_need_no_shuffle(spark, stored, large, variant):
    """Only the purpose lookup, which is grouped, still has an exchange."""
    names = []
    for name in TABLE_NAMES:
        table = f"bucketed_{variant.name}_{name}"
        names.append(table)
        writer = stored.live(name).write.mode("overwrite")
        if name.endswith("_me"):
            writer = writer.partitionBy("MEPeriod")
        if not name.startswith("ref_"):
            writer = writer.bucketBy(BUCKETS, "LoanId").sortBy("LoanId")
        writer.saveAsTable(table)
    try:
        tables = Tables(spark, dict(zip(TABLE_NAMES, names, strict=True)))
        spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
        text = plan(report(tables, variant))
        assert len(re.findall(r"^\(\d+\) SortMergeJoin", text, re.M)) == (8 if variant.month_end else 7)
        assert not re.findall(r"hashpartitioning\(LoanId", text)
        bucketed, plain = report(tables, variant), report(stored, variant)
        assert bucketed.count() == plain.count()
        assert bucketed.exceptAll(plain).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        for table in names:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_generated_methods_stay_small(spark, stored, large, variant):
    """The JVM never compiles a method over 8000 bytes, and a stage with one runs many times slower."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = report(stored, variant)
        jvm = spark._jvm.org.apache.spark.sql.execution
        text = df._jdf.queryExecution().explainString(jvm.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert len(sizes) > 10
    assert max(sizes) < 8000


def test_only_candidates_are_counted_one_by_one(spark, stored, large):
    """The first exchange of the search carries cells; ids are shuffled only behind a semi-join with the cells that stay."""
    loans, rows = stored.live("loan_master"), stored.live("modification_master")
    joins, limits = [skew.Join(loans, {"rows": rows})], skew.Skew(piece_rows=1)
    tagged = skew._tagged(joins)
    heavy = skew.heavy_cells(joins, tagged, 0, limits)
    text = plan(heavy)
    assert re.findall(r"hashpartitioning\(_groupingexpression#|hashpartitioning\(_cell#", text) and not re.findall(r"hashpartitioning\(LoanId", text)
    counted = skew._counts(joins, skew.candidates(tagged, heavy, 0, limits), F.col("LoanId"))
    tree = counted._jdf.queryExecution().executedPlan().toString()
    shuffled, below = re.split(r"Exchange hashpartitioning\(LoanId#\d+L, ", tree, maxsplit=1)
    assert "LeftSemi" in below and "LeftSemi" not in shuffled
    # What is counted is a small part of all ids, and holds every hot one.
    found = {r["LoanId"]: (r["_0_loans"], r["_0_rows"]) for r in counted.collect()}
    assert 0 < len(found) < loans.select("LoanId").distinct().count() / 2
    hot = skew.find_hot_loans(loans, {"rows": rows}, limits)
    assert hot is not None and {r["LoanId"]: (r["loans"], r["rows"]) for r in hot.collect()}.items() <= found.items()


def in_buckets(spark, stored, name):
    """The stored tables in the catalog, those with a loan id bucketed by it."""
    names = []
    for table in TABLE_NAMES:
        names.append(f"{name}_{table}")
        writer = stored.live(table).write.mode("overwrite")
        if table.endswith("_me"):
            writer = writer.partitionBy("MEPeriod")
        if not table.startswith("ref_"):
            writer = writer.bucketBy(BUCKETS, "LoanId").sortBy("LoanId")
        writer.saveAsTable(names[-1])
    return Tables(spark, dict(zip(TABLE_NAMES, names, strict=True))), names


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_bucketed_tables_are_searched_without_a_shuffle(spark, stored, large, variant, monkeypatch):
    plans = []
    counted = skew.counts_in_buckets
    monkeypatch.setattr(skew, "counts_in_buckets", lambda joins: plans.append(plan(df := counted(joins))) or df)
    tables, names = in_buckets(spark, stored, f"searched_{variant.name}")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    try:
        df = eligibility(tables, AS_OF, variant)
        assert len(plans) == 1 and "Exchange" not in plans[0] and plans[0].count("Join type: LeftOuter") == 6
        text = plan(df)
        assert not re.findall(r"hashpartitioning\(LoanId", text)
        expected = report(stored, variant)
        assert df.count() == expected.count() and df.exceptAll(expected).count() == 0
        # Hot ids are found there, too.
        hot = eligibility(tables, AS_OF, variant, skew_limits=skew.Skew(piece_rows=2))
        assert hot.count() == expected.count() and hot.exceptAll(expected).count() == 0
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
        for table in names:
            spark.sql(f"DROP TABLE IF EXISTS {table}")


def test_other_tables_are_not_searched_in_buckets(stored):
    assert not stored.bucketed_by("LoanId", ["loan_master"])
