"""Derived columns of one loan row: labels, age, buyout rates, modification stage."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from scrubline.functions.periods import months_crossed
from scrubline.functions.text import Text

# Codes, labels and thresholds.
LOAN_TYPES = {"1": "FHA", "2": "VA", "9": "USDA"}
POOLED_INVESTORS = ("400", "498")
BALANCE_SHEET_INVESTORS = ("025", "027")
SHORT_SALE_DENIALS = ("DL", "LP", "SP", "MI")
SHORT_SALE_DONE = "Completed SS/DIL"
FINAL_MOD = "Final Mod Processing"
THIRD_TRIAL = "3rd Trial Payment Received"
SECOND_TRIAL = "2nd Trial Payment Received"
FIRST_TRIAL = "1st Trial Payment Received"
TRIAL_OFFERED = "Trial Offered"
FINAL_DOCUMENT_STATUSES = (
    "Approved - send final documents",
    "Final documents to be received",
    "Final documents received - in review",
    "Approved send final docs / File Prep",
    "Final Docs Received - BK Approval Pending",
    "Final Docs Received - Pending Corrections",
    "Final Documents Received - In Review",
)
FINAL_MOD_DAYS = 30
SERVICE_STRIP = Decimal("0.0025")
HIGH_SERVICE_FEE = Decimal("0.00625")
HIGH_FEE_WARNING = "Warning - High SFee"
RATE_TYPE = "decimal(9,6)"


def loan_type(code: Column, text: Text = Text()) -> Column:
    """Insurer name; null for any other code."""
    label = F.lit(None).cast("string")
    for value, name in LOAN_TYPES.items():
        label = F.when(text.equals(code, value), name).otherwise(label)
    return label


def is_pooled(investor: Column, text: Text = Text()) -> Column:
    return text.between(investor, *POOLED_INVESTORS)


def is_balance_sheet(investor: Column, text: Text = Text()) -> Column:
    return text.isin(investor, BALANCE_SHEET_INVESTORS)


def source_label(investor: Column, text: Text = Text()) -> Column:
    return (
        F.when(is_pooled(investor, text), "GNMA")
        .when(is_balance_sheet(investor, text), "Balance Sheet")
        .otherwise("UNKNOWN")
    )


def short_sale_status(denial_reason: Column, text: Text = Text()) -> Column:
    return F.when(text.isin(denial_reason, SHORT_SALE_DENIALS), SHORT_SALE_DONE).otherwise("")


def loan_age(note_date: Column, as_of: Column) -> Column:
    return months_crossed(note_date, as_of)


def pass_through_rate(rate: Column, fee: Column) -> Column:
    """Rate less half the fee (or less the minimum strip), rounded down to a half percent.

    Decimal arithmetic: in binary floating point a rate on the half-percent grid can fall one step too low.
    """
    strip = F.when(fee >= F.lit(SERVICE_STRIP), fee / 2).otherwise(F.lit(SERVICE_STRIP))
    return (F.floor((rate - strip) * 200) / 200).cast(RATE_TYPE)


def service_fee_at_buyout(rate: Column, pass_through: Column, rate_type: DataType | str = RATE_TYPE) -> Column:
    """What the pass-through rate leaves of the rate, with as many digits as the rate has."""
    return (rate - pass_through).cast(rate_type)


def service_fee_check(service_fee: Column) -> Column:
    return F.when(service_fee > F.lit(HIGH_SERVICE_FEE), HIGH_FEE_WARNING).otherwise("")


def workflow_stage(text: Text = Text()) -> Column:
    """How far a modification has come by its own dates and status; first match wins, null when nothing matches."""
    has = lambda name: F.col(name).isNotNull()
    at_final_documents = (
        has("StatusFinalDocumentsToBeReceived")
        | has("StatusFinalDocumentsReceivedInReview")
        | text.isin(F.col("StatusCurrent"), FINAL_DOCUMENT_STATUSES)
    )
    return (
        F.when(at_final_documents, FINAL_MOD)
        .when(has("Verify4thTrialPaymentReceivedDt") | has("Verify3rdTrialPaymentReceivedDt"), THIRD_TRIAL)
        .when(has("Verify2ndTrialPaymentReceivedDt"), SECOND_TRIAL)
        .when(has("VerifyFirstTrialPaymentReceivedDt"), FIRST_TRIAL)
        .when(has("statusApprovedSendTrialPackage") | has("StatusTrialToBeAccepted"), TRIAL_OFFERED)
    )


def finished_lately(as_of: Column) -> Column:
    return F.datediff(as_of, F.col("StatusCompleted")) < FINAL_MOD_DAYS


def modification_stage(text: Text = Text()) -> Column:
    """The loan's stage from its loss-mitigation codes and its modification's ``FinishedLately`` and ``WorkflowStage``.

    A null template matches neither of the template tests, so such a loan goes on to the workflow.
    """
    status = F.col("LossMitStatusCodeid")
    is_mod = text.contains(F.col("LossMitTemplateId"), "mod")
    no_open_mod = status.isNull() | (text.isin(status, ("R", "C")) & is_mod) | ~is_mod
    return (
        F.when(text.equals(status, "C") & is_mod & F.col("FinishedLately"), FINAL_MOD)
        .when(no_open_mod, "")
        .otherwise(F.col("WorkflowStage"))
    )
