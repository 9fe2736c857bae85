"""What differs between the report on live tables and the one on a month-end snapshot."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column

from scrubline.functions import periods
from scrubline.functions.text import Text
from scrubline.operators.population import current_population, month_end_population

# Report columns, in order.
_HEAD = (
    "LoanId", "TradeCollateral", "LoTypeId", "LoanType", "RunDt", "LoanStatus", "CurrentPrincipalBalanceAmt",
    "CurrentInterestRate", "SFee", "DebentureRate", "ARMFlag", "LossMitStatusCodeid", "LossMitTemplateId",
    "LossMitDenialReasonCodeid", "StatusCurrent", "ModStage", "SSDILStatus", "ScheduledSaleDt", "SaleDt", "InvestorId",
    "DelinquentStatusCodeId", "DelinquentPaymentCount",
)
_TAIL = (
    "OriginalLoanToValueRatio", "Loanpurposecodeid", "PT at Buyout", "Svcg Fee at Buyout", "Source",
    "Servicing Fee Check",
)
_SCRUB = ("PropertyState", "Age", "EligibilityScrub", "MEPeriod", "DateKey")


@dataclass(frozen=True)
class Variant:
    name: str
    month_end: bool
    population: Callable[[Text], Column]
    property_table: str
    sale_cutoff: Callable[[Column], Column]
    columns: tuple[str, ...]


CURRENT = Variant(
    name="current",
    month_end=False,
    population=current_population,
    property_table="portfolio_summary",
    sale_cutoff=periods.sale_cutoff_current,
    columns=(
        *_HEAD, "InterestPaidToDt", "NextPaymentDueDt", "PayoffStopCodeId",
        *_SCRUB, "Cutoff_1stOfMonth_Prev2Months", *_TAIL,
    ),
)

MONTH_END = Variant(
    name="month_end",
    month_end=True,
    population=month_end_population,
    property_table="property_master",
    sale_cutoff=periods.sale_cutoff_month_end,
    columns=(
        *_HEAD, "PayoffStopCodeId", "NextPaymentDueDt",
        *_SCRUB, "Next_Due_Date_Cutoff", "Cutoff_1stOfMonth_Prev3Months", *_TAIL,
    ),
)
