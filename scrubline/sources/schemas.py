"""Declared columns of every input table, as (name, type) in Spark DDL.

Codes are strings (a leading zero counts), money and rates are decimals (binary doubles move rates off the half-percent
grid), dates are dates.
"""

from functools import cache

from pyspark.sql.types import StructType

LOAN = "LoanId"
PERIOD = "MEPeriod"

# Table and column names of the inputs.
_LOAN_MASTER = """
    LoanId bigint, TradeId string, LoTypeId string, RunDt date, NoteDt date, LoanStatusId string,
    CurrentPrincipalBalanceAmt decimal(18,2), CurrentInterestRate decimal(9,6), FirstServiceFeeRt decimal(9,6),
    FHA_DebentureRt decimal(9,6), ARMFlag string, LossMitStatusCodeid string, LossMitTemplateId string,
    LossMitDenialReasonCodeid string, InvestorId string, DelinquentStatusCodeId string, DelinquentPaymentCount int,
    InterestPaidToDt date, NextPaymentDueDt date, PayoffStopCodeId string, NativeAmericanLoanFlag string,
    LoanPurposeCodeId string, OriginalLoanToValueRatio decimal(9,4)
"""
_MODIFICATION = """
    LoanId bigint, StatusCurrent string, StatusCompleted date, StatusFinalDocumentsToBeReceived date,
    StatusFinalDocumentsReceivedInReview date, Verify4thTrialPaymentReceivedDt date,
    Verify3rdTrialPaymentReceivedDt date, Verify2ndTrialPaymentReceivedDt date, VerifyFirstTrialPaymentReceivedDt date,
    statusApprovedSendTrialPackage date, StatusTrialToBeAccepted date
"""
_FORECLOSURE = "LoanId bigint, ScheduledSaleDt date, SaleDt date"
_BORROWER = "LoanId bigint, BorrowerOneConsumerInfoCodeId string, BorrowerTwoConsumerInfoCodeId string"
_STATE = "LoanId bigint, PropertyState string"

_DDL = {
    "loan_master": _LOAN_MASTER,
    "modification_master": _MODIFICATION,
    "foreclosure_master": _FORECLOSURE,
    "borrower_master": _BORROWER,
    "lossmitigation_step_transpose": (
        "LoanId bigint, G58_Date date, R33_Date date, L49_Date date, L50_Date date, G59_Date date, G60_Date date"
    ),
    "portfolio_summary": _STATE,
    "property_master": _STATE,
    "collection_commentactivity": "LoanId bigint, ReasonCode string",
    "escrow_master": "LoanId bigint, MortgageInsuranceFHASectionADPCode string",
    "ref_loanstatus": "LoanStatusId string, LoanStatusDesc string",
    "ref_loanpurposecode": "LoanPurposeCodeId string, LoanPurposeCodeDesc string",
}
SNAPSHOTS = ("loan_master", "modification_master", "foreclosure_master", "borrower_master")

_DDL |= {f"{name}_me": f"{_DDL[name]}, {PERIOD} int" for name in SNAPSHOTS}
TABLE_NAMES = tuple(_DDL)


@cache
def schema(name: str) -> StructType:
    return StructType.fromDDL(_DDL[name])
