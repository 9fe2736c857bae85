"""What is joined to a loan. Each function returns one row set keyed by loan id.

A row set is cut down before its shuffle: whatever depends on its own columns alone is computed at its scan, and only the
result is joined, so neither the shuffle nor the joins after it carry a column that no rule or output needs.
Nothing here is deduplicated unless the report itself does so: two modification rows make two report rows.
"""

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.functions import derive
from scrubline.functions.text import Text
from scrubline.sources.schemas import LOAN
from scrubline.sources.tables import Tables

# Codes and thresholds.
DECEASED_COMMENT = "001"
DECEASED_CONSUMER = "X"
SHORT_SALE_STEPS = ("G58_Date", "R33_Date")
DEED_IN_LIEU_STEPS = ("L49_Date", "G59_Date", "L50_Date", "G60_Date")
NATIVE_HOUSING_SECTION = "184"
VA_TYPE = "2"
REFI_PURPOSES = ("5", "6", "7")
REFI_LTV = Decimal("0.90")


def with_loan_status(loans: DataFrame, tables: Tables, text: Text = Text()) -> DataFrame:
    """Adds the status text. No hint: Spark broadcasts the lookup while its size is under the broadcast threshold
    and otherwise sort-merges, where adaptive execution splits a status that holds many loans."""
    lookup = tables.live("ref_loanstatus").select(
        text.key(F.col("LoanStatusId")).alias("_status_key"), F.col("LoanStatusDesc").alias("LoanStatus")
    )
    return loans.join(lookup, text.key(F.col("LoanStatusId")) == F.col("_status_key"), "left").drop("_status_key")


def modifications(rows: DataFrame, run_date: Column, text: Text = Text()) -> DataFrame:
    return rows.select(
        LOAN,
        "StatusCurrent",
        derive.finished_lately(run_date).alias("FinishedLately"),
        derive.workflow_stage(text).alias("WorkflowStage"),
    )


def claim_steps(tables: Tables) -> DataFrame:
    """Whether a loan has any step date of a short-sale or a deed-in-lieu claim."""
    any_date = lambda names: F.coalesce(*names).isNotNull()
    return tables.live("lossmitigation_step_transpose").select(
        LOAN, any_date(SHORT_SALE_STEPS).alias("ShortSaleClaim"), any_date(DEED_IN_LIEU_STEPS).alias("DeedInLieuClaim")
    )


def deceased_borrowers(rows: DataFrame, text: Text = Text()) -> DataFrame:
    """Whether either borrower is marked as deceased. Rows stay one to one."""
    one, two = (text.equals(F.col(f"Borrower{n}ConsumerInfoCodeId"), DECEASED_CONSUMER) for n in ("One", "Two"))
    return rows.select(LOAN, (one | two).alias("BorrowerDeceased"))


def deceased_comments(tables: Tables, text: Text = Text()) -> DataFrame:
    """Loans with a deceased comment, once each, however many comments a loan has (counted down before the shuffle)."""
    return (
        tables.live("collection_commentactivity")
        .filter(text.at_scan(lambda t: t.isin(F.col("ReasonCode"), (DECEASED_COMMENT,))))
        .select(LOAN)
        .distinct()
        .withColumn("ReasonCode", F.lit(DECEASED_COMMENT))
    )


def native_housing_escrow(tables: Tables, text: Text = Text()) -> DataFrame:
    """Loans insured under the Native American housing section, once each."""
    code = "MortgageInsuranceFHASectionADPCode"
    return (
        tables.live("escrow_master")
        .filter(text.at_scan(lambda t: t.isin(F.col(code), (NATIVE_HOUSING_SECTION,))))
        .select(LOAN)
        .distinct()
        .withColumn(code, F.lit(NATIVE_HOUSING_SECTION))
    )


def _is_va_refi(text: Text) -> Column:
    return (
        text.isin(F.col("LoTypeId"), (VA_TYPE,))
        & (F.col("OriginalLoanToValueRatio") > F.lit(REFI_LTV))
        & text.isin(F.col("LoanPurposeCodeId"), REFI_PURPOSES)
    )


def va_refi_rows(tables: Tables, text: Text = Text()) -> DataFrame:
    """Live VA loans refinanced at a high loan-to-value ratio."""
    rows = tables.live("loan_master").filter(text.at_scan(_is_va_refi))
    return rows.select(LOAN, "LoTypeId", "LoanPurposeCodeId", "OriginalLoanToValueRatio")


def va_refi(tables: Tables, text: Text = Text(), rows: DataFrame | None = None) -> DataFrame:
    """Those rows (or fewer, if given) with the purpose text, distinct. Texts equal but for case or trailing blanks count as one, and the
    first of their spellings is kept.

    A loan's distinct rows are gathered by loan id first (map-side, and few per loan), so the rows are shuffled once, by
    the key that the report joins on.
    """
    purposes = (
        tables.live("ref_loanpurposecode")
        .groupBy(
            text.key(F.col("LoanPurposeCodeId")).alias("_purpose_key"),
            text.key(F.col("LoanPurposeCodeDesc")).alias("_desc_key"),
        )
        .agg(F.min("LoanPurposeCodeDesc").alias("LoanPurposeCodeDesc"))
        .drop("_desc_key")
    )
    row = F.struct("LoTypeId", "LoanPurposeCodeId", "OriginalLoanToValueRatio")
    rows = va_refi_rows(tables, text) if rows is None else rows
    per_loan = rows.groupBy(LOAN).agg(F.collect_set(row).alias("rows"))
    per_loan = per_loan.select(LOAN, F.explode("rows").alias("row"))
    keys = {"_type": text.key(F.col("row.LoTypeId")), "_purpose": text.key(F.col("row.LoanPurposeCodeId"))}
    distinct = (
        per_loan.withColumns(keys)
        .groupBy(LOAN, "_type", "_purpose", F.col("row.OriginalLoanToValueRatio").alias("OriginalLoanToValueRatio"))
        .agg(F.min("row.LoTypeId").alias("LoTypeId"), F.min("row.LoanPurposeCodeId").alias("LoanPurposeCodeId"))
    )
    return (
        distinct.join(purposes, F.col("_purpose") == F.col("_purpose_key"), "left")
        .select(LOAN, "LoTypeId", "LoanPurposeCodeId", "OriginalLoanToValueRatio", "LoanPurposeCodeDesc")
    )


def listed(loan_ids: DataFrame, flag: str) -> DataFrame:
    """A list of loans as one flagged row per loan."""
    return loan_ids.select(LOAN).distinct().withColumn(flag, F.lit(True))
