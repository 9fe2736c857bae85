"""Hot loan ids: they are found, and joining them apart gives the same rows as one chain of left joins."""

from functools import reduce

import pytest
from pyspark.sql import functions as F

from scrubline import CURRENT, MONTH_END, Tables, eligibility
from scrubline.operators.skew import Skew, find_hot_loans, left_join
from scrubline.sources.fixtures import AS_OF, fixture_tables
from scrubline.sources.schemas import TABLE_NAMES

HOT, HOT_RIGHT_ONLY, WARM = 31, 999_999, 32
EAGER = Skew(piece_rows=8)
# Extra rows of one loan per table; None is a missing id.
COPIES = {
    "loan_master": {HOT: 40, None: 30},
    "modification_master": {HOT: 25, HOT_RIGHT_ONLY: 50, WARM: 5, None: 20},
    "foreclosure_master": {HOT: 3, HOT_RIGHT_ONLY: 50},
    "borrower_master": {WARM: 20},
    "portfolio_summary": {HOT: 2},
    "collection_commentactivity": {HOT: 100},
}


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """The test tables with a third and more of some tables' rows under one loan id, written once."""
    directory = str(tmp_path_factory.mktemp("skewed"))
    tables = fixture_tables(spark, "/root/testdata/sf0.001")
    for name in TABLE_NAMES:
        rows = tables.live(name)
        for loan_id, copies in COPIES.get(name.removesuffix("_me"), {}).items():
            like = rows.filter(F.col("LoanId") == (31 if name.startswith("loan_master") else 32))
            extra = like.limit(1).withColumn("LoanId", F.lit(loan_id).cast("long"))
            rows = rows.unionByName(extra.withColumn("_", F.explode(F.sequence(F.lit(1), F.lit(copies)))).drop("_"))
        rows.write.parquet(f"{directory}/{name}")
    return Tables.in_directory(spark, directory)


def test_the_skewed_loan_is_reported(skewed):
    rows = eligibility(skewed, AS_OF, skew_limits=None).filter(F.col("LoanId") == HOT).count()
    assert rows > 1000


def rows_of(spark, sizes):
    """A row set with so many rows of each loan."""
    frames = [
        spark.range(n).select(F.lit(loan).cast("long").alias("LoanId"), F.col("id").alias("v")) for loan, n in sizes.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


def test_hot_loans_are_found(spark):
    loans = rows_of(spark, {1: 100, 2: 4, 3: 1, 5: 1, None: 50})
    row_sets = {"a": rows_of(spark, {2: 11, 4: 10, 5: 3, None: 99}), "b": rows_of(spark, {2: 1, 4: 5, 5: 3, 6: 60})}
    hot = lambda limit: {r["LoanId"]: tuple(r)[1:] for r in (find_hot_loans(loans, row_sets, Skew(limit)) or loans.limit(0)).collect()}
    # 2: 4 * 11 rows; 4 and 6 have no loan but many right rows; a missing id has its loans only.
    assert hot(43) == {1: (100, 0, 0), 2: (4, 11, 1), 4: (0, 10, 5), 6: (0, 0, 60), None: (50, 0, 0)}
    assert hot(50) == {1: (100, 0, 0), 6: (0, 0, 60)}
    assert hot(100) == {}


@pytest.mark.parametrize("limit", [2000, 50_000])
def test_a_loan_that_is_frequent_in_several_tables_is_split(spark, limit):
    """Ninety rows in each of three tables: no table is over the limit, but together they make 729,000 rows."""
    loans = rows_of(spark, {7: 90, 8: 2}).withColumnRenamed("v", "l")
    row_sets = {name: rows_of(spark, {7: 90, 9: 3}).withColumnRenamed("v", name) for name in ("x", "y")}
    assert [r["LoanId"] for r in find_hot_loans(loans, row_sets, Skew(limit)).collect()] == [7]
    for conf in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(conf, "false" if "coalesce" in conf else "-1")
    try:
        joined = left_join(loans, row_sets, Skew(limit))
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 90**3 + 2
    assert len(sizes) > 4 and max(sizes) < sum(sizes) / 2
    assert joined.distinct().count() == 90**3 + 2


def test_pieces_are_stored_before_they_are_used(skewed):
    """No task above a shuffle numbers rows: a rerun could number them differently."""
    text = eligibility(skewed, AS_OF, skew_limits=EAGER)._jdf.queryExecution().toString()
    assert "ExistingRDD" in text and "monotonically_increasing_id" not in text and "rand(" not in text


@pytest.mark.parametrize("piece_rows", [8, 2, 45])
@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_same_rows_as_plain_joins(skewed, variant, piece_rows):
    plain = eligibility(skewed, AS_OF, variant, skew_limits=None).cache()
    pieces = eligibility(skewed, AS_OF, variant, skew_limits=Skew(piece_rows)).cache()
    assert plain.count() == pieces.count()
    assert plain.exceptAll(pieces).count() == 0
    plain.unpersist()
    pieces.unpersist()


def test_same_rows_with_lists(spark, skewed):
    loans = spark.createDataFrame([(HOT,), (WARM,), (WARM,), (33,)], "LoanId long")
    options = {"loan_ids": loans, "exclusion_lists": {"collateral": loans}, "excluded_trades": ["200009"]}
    plain = eligibility(skewed, AS_OF, skew_limits=None, **options)
    pieces = eligibility(skewed, AS_OF, skew_limits=EAGER, **options)
    assert plain.count() == pieces.count() > 0
    assert plain.exceptAll(pieces).count() == 0


@pytest.mark.parametrize("kind", [list, iter, lambda ids: (i for i in ids)], ids=["list", "iterator", "generator"])
def test_ids_that_can_be_read_once_give_the_same_rows(skewed, kind):
    ids = [HOT, WARM, 33, 34, 35, None, 33]
    plain = eligibility(skewed, AS_OF, loan_ids=ids, skew_limits=None)
    pieces = eligibility(skewed, AS_OF, loan_ids=kind(ids), skew_limits=EAGER)
    assert plain.count() == pieces.count() > 1000
    assert plain.exceptAll(pieces).count() == 0
    assert plain.select("LoanId").distinct().count() > 2


def test_a_hot_loan_is_spread_over_tasks(spark, skewed):
    """No join task of the hot part may see all rows of the hot loan."""
    report = eligibility(skewed, AS_OF, skew_limits=EAGER).filter(F.col("LoanId") == HOT)
    # Keep the partitions as shuffled: adaptive execution would merge such small ones again.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = [r["count"] for r in report.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) > 4
    assert max(sizes) < sum(sizes) / 2
