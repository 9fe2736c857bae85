"""The registered queries, as lazy DataFrames over the input tables (or, for two date checks, over the orders)."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.functions import derive, periods
from scrubline.operators import enrich, population
from scrubline.operators.skew import Join, Skew, left_join, left_joins
from scrubline.plans.pipeline import derived, eligibility, screened_loans, source
from scrubline.plans.variants import CURRENT, MONTH_END, Variant
from scrubline.sources.fixtures import AS_OF, fixture_tables
from scrubline.sources.schemas import LOAN
from scrubline.sources.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
TableQuery = Callable[[Tables], DataFrame]

RUN_DATE = AS_OF
MODIFICATION_DATES = (
    "StatusCompleted",
    "StatusFinalDocumentsToBeReceived",
    "StatusFinalDocumentsReceivedInReview",
    "Verify4thTrialPaymentReceivedDt",
    "Verify3rdTrialPaymentReceivedDt",
    "Verify2ndTrialPaymentReceivedDt",
    "VerifyFirstTrialPaymentReceivedDt",
    "statusApprovedSendTrialPackage",
    "StatusTrialToBeAccepted",
)
STEP_DATES = ("G58_Date", "R33_Date", "L49_Date", "L50_Date", "G59_Date", "G60_Date")
# Comment codes whose loans stand in for the optional lists.
LIST_COMMENTS = {"collateral": "017", "unsaleable": "016", "active_repurchase": "015", "deceased": "014"}
LOAN_LIST_COMMENT = "013"
TRADES_LEFT_OUT = ("200007", "200013")


def _run_date() -> Column:
    return F.lit(RUN_DATE)


def _order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.to_date("o_orderdate").alias("run_date"))


def _commented(tables: Tables, code: str) -> DataFrame:
    comments = tables.live("collection_commentactivity")
    return comments.filter(F.col("ReasonCode") == code).select(LOAN).distinct()


def _loan_ids(tables: Tables, variant: Variant) -> DataFrame:
    return source(tables, variant, "loan_master", _run_date()).select(LOAN)


def _with_rows(tables: Tables, variant: Variant, rows: DataFrame) -> DataFrame:
    """The variant's loan ids left-joined with one row set."""
    return left_join(_loan_ids(tables, variant), {"rows": rows}, Skew())


def _both(tables: Tables, rows: Callable[[Variant], DataFrame]) -> DataFrame:
    """The same for both variants, told apart by a column, after one search for hot ids."""
    variants = (CURRENT, MONTH_END)
    current, month_end = left_joins([Join(_loan_ids(tables, v), {"rows": rows(v)}) for v in variants], Skew())
    named = lambda df, v: df.withColumn("Variant", F.lit(v.name))
    return named(current, CURRENT).unionByName(named(month_end, MONTH_END))


def period_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("run_date")
    return (
        _order_dates(spark, sf_dir)
        .distinct()
        .select(
            day,
            periods.me_period(day).alias("me_period"),
            periods.date_key(day).alias("date_key"),
            periods.month_start(day).alias("first_of_month"),
            periods.sale_cutoff_current(day).alias("sale_cutoff_current"),
            periods.sale_cutoff_month_end(day).alias("sale_cutoff_month_end"),
            periods.next_due_cutoff_pooled(day).alias("next_due_cutoff_pooled"),
            periods.next_due_cutoff_balance_sheet(day).alias("next_due_cutoff_balance_sheet"),
        )
    )


def loan_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order date as the run date of its own order, with a note date up to four years earlier."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    run, note = F.to_date("o_orderdate"), F.col("note_date")
    return (
        orders.select("o_orderkey", run.alias("run_date"))
        .withColumn("note_date", F.date_sub("run_date", (F.col("o_orderkey") % 1461).cast("int")))
        .select(
            F.col("o_orderkey").alias("order_key"),
            "run_date",
            "note_date",
            derive.loan_age(note, F.col("run_date")).alias("age_at_run_date"),
            derive.loan_age(note, _run_date()).alias("age_at_report"),
        )
    )


def population_current(tables: Tables) -> DataFrame:
    loans = screened_loans(tables, _run_date(), CURRENT)
    return loans.select(LOAN, "InvestorId", "DelinquentStatusCodeId", "CurrentPrincipalBalanceAmt", "LoTypeId")


def population_month_end(tables: Tables) -> DataFrame:
    loans = screened_loans(tables, _run_date(), MONTH_END)
    return loans.select(
        LOAN, "InvestorId", "DelinquentStatusCodeId", "LoanStatusId", "CurrentPrincipalBalanceAmt", "LoTypeId"
    )


def loan_list(tables: Tables) -> DataFrame:
    loans = screened_loans(tables, _run_date(), CURRENT)
    ids = population.listed_ids(tables.spark, _commented(tables, LOAN_LIST_COMMENT))
    return population.only_loans(loans, ids).select(LOAN, "InvestorId")


def loan_type(tables: Tables) -> DataFrame:
    code = F.col("LoTypeId")
    return tables.live("loan_master").select(LOAN, code, derive.loan_type(code).alias("LoanType"))


def source_label(tables: Tables) -> DataFrame:
    investor = F.col("InvestorId")
    return tables.live("loan_master").select(LOAN, investor, derive.source_label(investor).alias("Source"))


def ssdil_status(tables: Tables) -> DataFrame:
    reason = F.col("LossMitDenialReasonCodeid")
    return tables.live("loan_master").select(LOAN, reason, derive.short_sale_status(reason).alias("SSDILStatus"))


def loan_status(tables: Tables) -> DataFrame:
    return enrich.with_loan_status(tables.live("loan_master"), tables).select(LOAN, "LoanStatusId", "LoanStatus")


def property_state(tables: Tables) -> DataFrame:
    return _both(tables, lambda variant: tables.live(variant.property_table))


def _joined_source(name: str, *columns: str) -> TableQuery:
    def query(tables: Tables) -> DataFrame:
        def rows(variant: Variant) -> DataFrame:
            return source(tables, variant, name, _run_date()).select(LOAN, *columns)

        return _both(tables, rows)

    return query


join_modification = _joined_source("modification_master", "StatusCurrent", *MODIFICATION_DATES)
foreclosure_sale = _joined_source("foreclosure_master", "ScheduledSaleDt", "SaleDt")
deceased_borrower = _joined_source(
    "borrower_master", "BorrowerOneConsumerInfoCodeId", "BorrowerTwoConsumerInfoCodeId"
)


def lossmit_steps(tables: Tables) -> DataFrame:
    return _with_rows(tables, CURRENT, tables.live("lossmitigation_step_transpose"))


def deceased_comment(tables: Tables) -> DataFrame:
    return _with_rows(tables, CURRENT, enrich.deceased_comments(tables))


def na_housing_184(tables: Tables) -> DataFrame:
    return _with_rows(tables, MONTH_END, enrich.native_housing_escrow(tables))


def va_refi(tables: Tables) -> DataFrame:
    return enrich.va_refi(tables).select(
        LOAN, "LoTypeId", "LoanPurposeCodeId", "LoanPurposeCodeDesc", "OriginalLoanToValueRatio"
    )


def _buyout(loans: DataFrame) -> DataFrame:
    rate, fee = F.col("CurrentInterestRate"), F.col("FirstServiceFeeRt")
    return (
        loans.select(LOAN, rate, fee)
        .withColumn("PT at Buyout", derive.pass_through_rate(rate, fee))
        .withColumn("Svcg Fee at Buyout", derive.service_fee_at_buyout(rate, F.col("PT at Buyout"), loans.schema["CurrentInterestRate"].dataType))
    )


def buyout_rates(tables: Tables) -> DataFrame:
    return _buyout(tables.live("loan_master"))


def servicing_fee_check(tables: Tables) -> DataFrame:
    checked = derive.service_fee_check(F.col("CurrentInterestRate") - F.col("PT at Buyout"))
    return _buyout(tables.live("loan_master")).select(LOAN, "Svcg Fee at Buyout", checked.alias("Servicing Fee Check"))


def mod_stage(tables: Tables) -> DataFrame:
    rows = enrich.modifications(tables.live("modification_master"), _run_date())
    return derived(left_join(tables.live("loan_master"), {"modification": rows}, Skew())).select(
        LOAN, "LossMitStatusCodeid", "LossMitTemplateId", "StatusCurrent", "ModStage"
    )


def eligibility_current(tables: Tables) -> DataFrame:
    return eligibility(tables, RUN_DATE, CURRENT)


def eligibility_month_end(tables: Tables) -> DataFrame:
    return eligibility(tables, RUN_DATE, MONTH_END)


def scrub_current(tables: Tables) -> DataFrame:
    return eligibility_current(tables).select(LOAN, "ModStage", "SSDILStatus", "EligibilityScrub")


def scrub_month_end(tables: Tables) -> DataFrame:
    return eligibility_month_end(tables).select(LOAN, "ModStage", "SSDILStatus", "EligibilityScrub")


def _with_lists(variant: Variant) -> TableQuery:
    def query(tables: Tables) -> DataFrame:
        lists = {name: _commented(tables, code) for name, code in LIST_COMMENTS.items()}
        report = eligibility(tables, RUN_DATE, variant, exclusion_lists=lists, excluded_trades=TRADES_LEFT_OUT)
        return report.select(LOAN, "TradeCollateral", "EligibilityScrub")

    return query


exclusion_lists = _with_lists(CURRENT)
exclusion_lists_month_end = _with_lists(MONTH_END)

_TABLE_QUERIES = (
    population_current, population_month_end, loan_list, loan_type, source_label, loan_status, property_state,
    mod_stage, ssdil_status, lossmit_steps, deceased_comment, na_housing_184, va_refi, buyout_rates,
    servicing_fee_check, scrub_current, scrub_month_end, eligibility_current, eligibility_month_end,
)
TABLE_QUERIES: dict[str, TableQuery] = {query.__name__: query for query in _TABLE_QUERIES} | {
    "join_modification": join_modification,
    "foreclosure_sale": foreclosure_sale,
    "deceased_borrower": deceased_borrower,
    "exclusion_lists": exclusion_lists,
    "exclusion_lists_month_end": exclusion_lists_month_end,
}
DATE_QUERIES: dict[str, Query] = {"period_params": period_params, "loan_age": loan_age}


def _over_fixtures(query: TableQuery) -> Query:
    return lambda spark, sf_dir: query(fixture_tables(spark, sf_dir))


QUERIES = DATE_QUERIES | {name: _over_fixtures(query) for name, query in TABLE_QUERIES.items()}
