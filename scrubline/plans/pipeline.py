"""The eligibility report for either variant. Building it searches for hot loan ids; the report itself is lazy."""

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from scrubline.functions import derive, periods
from scrubline.functions.text import Text
from scrubline.operators import enrich, population, reduction, skew
from scrubline.operators.reduction import IdFilter, Reduction
from scrubline.operators.rules import LIST_REASONS, FixedLists, exclusion_rules, first_match, list_flag
from scrubline.operators.skew import Skew
from scrubline.plans.variants import CURRENT, Variant
from scrubline.sources.schemas import LOAN
from scrubline.sources.tables import Tables


def source(tables: Tables, variant: Variant, name: str, run_date: Column) -> DataFrame:
    """A table that has month-end snapshots: live, or the variant's period of it."""
    return tables.snapshot(name, periods.me_period(run_date)) if variant.month_end else tables.live(name)


def screened_loans(tables: Tables, run_date: Column, variant: Variant = CURRENT, text: Text = Text()) -> DataFrame:
    """The loans a variant reports on, filtered at the scan."""
    return source(tables, variant, "loan_master", run_date).filter(variant.population(text))


def enrichments(
    tables: Tables,
    run_date: Column,
    variant: Variant = CURRENT,
    exclusion_lists: Mapping[str, DataFrame] | None = None,
    text: Text = Text(),
    refinanced: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Everything left-joined to the loans on the loan id; ``refinanced`` are the refinance rows to use, all unless given."""
    refi = enrich.va_refi(tables, text, refinanced).select(
        LOAN, "OriginalLoanToValueRatio", F.col("LoanPurposeCodeId").alias("Loanpurposecodeid")
    )
    row_sets = {
        "modification": enrich.modifications(source(tables, variant, "modification_master", run_date), run_date, text),
        "property": tables.live(variant.property_table),
        "foreclosure": source(tables, variant, "foreclosure_master", run_date),
        "loss_mitigation": enrich.claim_steps(tables),
        "comment": enrich.deceased_comments(tables, text),
        "borrower": enrich.deceased_borrowers(source(tables, variant, "borrower_master", run_date), text),
        "va_refi": refi,
    }
    if variant.month_end:
        row_sets["escrow"] = enrich.native_housing_escrow(tables, text)
    for name, loans in (exclusion_lists or {}).items():
        if name not in LIST_REASONS:
            raise ValueError(f"unknown exclusion list {name!r}; known: {', '.join(LIST_REASONS)}")
        row_sets[f"list_{name}"] = enrich.listed(loans, list_flag(name))
    return row_sets


# Row sets that may hold many rows of one loan. The others are distinct, at most one row per loan.
_MANY_PER_LOAN = ("modification", "property", "foreclosure", "loss_mitigation", "borrower")
_SNAPSHOTS_COUNTED = ("loan_master", "modification_master", "foreclosure_master", "borrower_master")


def _limits(tables: Tables, variant: Variant, limits: Skew | None) -> Skew | None:
    """Tables that are all bucketed by loan id are searched inside their buckets."""
    names = [f"{name}_me" if variant.month_end else name for name in _SNAPSHOTS_COUNTED]
    counted = {*names, "loan_master", "lossmitigation_step_transpose", variant.property_table}
    return replace(limits, co_partitioned=True) if limits is not None and tables.bucketed_by(LOAN, sorted(counted)) else limits


def _joined(
    tables: Tables,
    loans: DataFrame,
    row_sets: Mapping[str, DataFrame],
    refinanced: DataFrame,
    ids: population.Ids,
    limits: Skew | None,
    keep: IdFilter | None,
    text: Text,
) -> DataFrame:
    """The wanted loans with all row sets. Rows of other loans leave every table before it is searched or shuffled."""
    only = lambda df: reduction.reduced(population.near_loans(df, ids), keep)
    # The refinance rows were restricted before they were gathered per loan.
    wanted = {name: df if name == "va_refi" else only(df) for name, df in row_sets.items()}
    searched = {name: wanted[name] for name in _MANY_PER_LOAN} | {"va_refi": refinanced}
    return skew.left_join(
        population.only_loans(loans, ids),
        wanted,
        limits,
        searched=searched,
        prepare=lambda part: enrich.with_loan_status(part, tables, text),
    )


def derived(joined: DataFrame, text: Text = Text()) -> DataFrame:
    """Adds what the rules and several columns build on, each computed once."""
    return joined.withColumns(
        {
            "ModStage": derive.modification_stage(text),
            "SSDILStatus": derive.short_sale_status(F.col("LossMitDenialReasonCodeid"), text),
            "PT at Buyout": derive.pass_through_rate(F.col("CurrentInterestRate"), F.col("FirstServiceFeeRt")),
        }
    )


def report_columns(run_date: Column, variant: Variant, scrub: Column, text: Text, rate_type: DataType) -> dict[str, Column]:
    """The report's columns that are not input columns of the same name."""
    col = F.col
    service_fee = derive.service_fee_at_buyout(col("CurrentInterestRate"), col("PT at Buyout"), rate_type)
    columns = {
        "TradeCollateral": col("TradeId"),
        "SFee": col("FirstServiceFeeRt"),
        "DebentureRate": col("FHA_DebentureRt"),
        "LoanType": derive.loan_type(col("LoTypeId"), text),
        "Age": derive.loan_age(col("NoteDt"), run_date),
        "EligibilityScrub": scrub,
        "MEPeriod": periods.me_period(run_date),
        "DateKey": periods.date_key(run_date),
        "Svcg Fee at Buyout": service_fee,
        "Source": derive.source_label(col("InvestorId"), text),
        "Servicing Fee Check": derive.service_fee_check(col("CurrentInterestRate") - col("PT at Buyout")),
    }
    if variant.month_end:
        columns["Next_Due_Date_Cutoff"] = periods.next_due_cutoff_pooled(run_date)
        columns["Cutoff_1stOfMonth_Prev3Months"] = variant.sale_cutoff(run_date)
    else:
        columns["Cutoff_1stOfMonth_Prev2Months"] = variant.sale_cutoff(run_date)
    return columns


def eligibility(
    tables: Tables,
    as_of: dt.date,
    variant: Variant = CURRENT,
    *,
    loan_ids: DataFrame | Iterable[int] | None = None,
    exclusion_lists: Mapping[str, DataFrame] | None = None,
    excluded_trades: Sequence[str] = (),
    fixed_lists: FixedLists = FixedLists(),
    case_sensitive: bool = False,
    skew_limits: Skew | None = Skew(),
    filter_limits: Reduction | None = Reduction(),
) -> DataFrame:
    """One row per screened loan (times its joined rows) with its reason in ``EligibilityScrub``; '' is eligible.

    ``loan_ids`` restricts the report; ``exclusion_lists`` maps a name in ``LIST_REASONS`` to loan ids that get that
    reason. ``skew_limits=None`` skips the search for hot loan ids, for tables known to have none; ``filter_limits``
    says when other tables are reduced to screened loans before their shuffle, never if None.
    """
    text = Text(case_sensitive)
    run_date = F.lit(as_of)
    # The loan's own ratio and purpose are not reported: those columns come from the refinance rows.
    loans = screened_loans(tables, run_date, variant, text).drop("OriginalLoanToValueRatio", "LoanPurposeCodeId")
    loans = population.without_trades(loans, excluded_trades, text)
    ids = None if loan_ids is None else population.listed_ids(tables.spark, loan_ids)
    # With a list of ids every table is restricted by that already.
    everything = source(tables, variant, "loan_master", run_date)
    keep = reduction.screening_filter(everything, variant.population(text), loans, filter_limits) if ids is None else None
    refinanced = reduction.reduced(population.near_loans(enrich.va_refi_rows(tables, text), ids), keep)
    row_sets = enrichments(tables, run_date, variant, exclusion_lists, text, refinanced)
    report = derived(_joined(tables, loans, row_sets, refinanced, ids, _limits(tables, variant, skew_limits), keep, text), text)
    rules = exclusion_rules(
        month_end=variant.month_end,
        sale_cutoff=variant.sale_cutoff(run_date),
        next_due_cutoff_pooled=periods.next_due_cutoff_pooled(run_date),
        next_due_cutoff_balance_sheet=periods.next_due_cutoff_balance_sheet(run_date),
        lists=tuple(exclusion_lists or ()),
        fixed_lists=fixed_lists,
        text=text,
    )
    made = report_columns(run_date, variant, first_match(rules), text, report.schema["CurrentInterestRate"].dataType)
    return report.select([made[name].alias(name) if name in made else F.col(name) for name in variant.columns])
