"""The ordered exclusion rules: the first one that matches gives the loan its reason."""

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from scrubline.functions.derive import (
    FINAL_MOD,
    SECOND_TRIAL,
    SHORT_SALE_DONE,
    THIRD_TRIAL,
    is_balance_sheet,
    is_pooled,
)
from scrubline.functions.text import Text
from scrubline.operators.enrich import VA_TYPE
from scrubline.sources.schemas import LOAN

# Thresholds, codes and listed loans of the rules.
LOW_BALANCE = Decimal("30000")
LOW_RATE = Decimal("0.0275")
CURRENT_DELINQUENCY = ("P", "A", "B", "C", "D")
SHORT_SALE_TEMPLATES = ("HAFS", "SS")
DEED_IN_LIEU_TEMPLATES = ("HAFD", "DIL2")


@dataclass(frozen=True)
class FixedLists:
    """Loans excluded by id."""

    franklin_american: tuple[int, ...] = (1002013712, 1001898972)
    unsaleable: tuple[int, ...] = (8019110169,)


class Rule(NamedTuple):
    name: str
    matches: Column
    reason: Column | str


# Optional lists of loan ids -> the reason they give. A list's rule stands where exclusion_rules() names it.
LIST_REASONS = {
    "collateral": "Collateral",
    "unsaleable": "Unsaleable Loan",
    "active_repurchase": "Active Repurchase",
    "deceased": "Deceased Borrower",
}


def list_flag(name: str) -> str:
    return f"_listed_{name}"


def first_match(rules: Sequence[Rule], otherwise: str = "") -> Column:
    head, *tail = rules
    chain = F.when(head.matches, head.reason)
    for rule in tail:
        chain = chain.when(rule.matches, rule.reason)
    return chain.otherwise(otherwise)


def exclusion_rules(
    *,
    month_end: bool,
    sale_cutoff: Column,
    next_due_cutoff_pooled: Column | None = None,
    next_due_cutoff_balance_sheet: Column | None = None,
    lists: Sequence[str] = (),
    fixed_lists: FixedLists = FixedLists(),
    text: Text = Text(),
) -> list[Rule]:
    """The rules of a variant, in order. Tests on a null are unknown, and an unknown test is no match."""
    col = F.col

    def from_list(name: str) -> list[Rule]:
        return [Rule(f"list_{name}", col(list_flag(name)), LIST_REASONS[name])] if name in lists else []

    loss_mit_active = text.equals(col("LossMitStatusCodeid"), "A")
    template, stage = col("LossMitTemplateId"), col("ModStage")
    # The comment, escrow and refinance rows are filtered where they are read, so a row joined is a match.
    deceased = col("ReasonCode").isNotNull() | col("BorrowerDeceased")
    refi = text.equals(col("LoTypeId"), VA_TYPE) & col("Loanpurposecodeid").isNotNull()

    rules = [
        Rule("paid_in_full", text.differs(col("PayoffStopCodeId"), "0"), "PIF"),
        Rule("native_loan", text.equals(col("NativeAmericanLoanFlag"), "1"), "NAHousing"),
    ]
    if month_end:
        rules.append(Rule("native_section", col("MortgageInsuranceFHASectionADPCode").isNotNull(), "NAHousing"))
    rules += [
        Rule("va_refi", refi, "VA_Refi"),
        *from_list("collateral"),
        *from_list("unsaleable"),
        Rule("franklin_american", col(LOAN).isin(list(fixed_lists.franklin_american)), "Franklin American"),
        Rule("arm", text.equals(col("ARMFlag"), "Y"), "ARM"),
        Rule("unsaleable", col(LOAN).isin(list(fixed_lists.unsaleable)), "Unsaleable Loan"),
        *from_list("active_repurchase"),
    ]
    if not month_end:
        delinquency = col("DelinquentStatusCodeId")
        rules.append(Rule("not_delinquent", text.isin(delinquency, CURRENT_DELINQUENCY), "< 30 DAYS DQ"))
    rules += [
        Rule("low_balance", col("CurrentPrincipalBalanceAmt") < F.lit(LOW_BALANCE), "Low Balance"),
        Rule("low_rate", col("CurrentInterestRate") < F.lit(LOW_RATE), "Low Rate"),
        Rule("hardest_hit_fund", loss_mit_active & text.equals(template, "HHF"), "HHF"),
        Rule("deceased", deceased, "Deceased Borrower"),
        *from_list("deceased"),
        Rule("modification", stage.isin(FINAL_MOD, SECOND_TRIAL, THIRD_TRIAL), stage),
        Rule("short_sale_done", col("SSDILStatus") == SHORT_SALE_DONE, SHORT_SALE_DONE),
        Rule(
            "short_sale_claim",
            loss_mit_active & text.isin(template, SHORT_SALE_TEMPLATES) & col("ShortSaleClaim"),
            "Short Sale Claim Completed",
        ),
        Rule(
            "deed_in_lieu_claim",
            loss_mit_active & text.isin(template, DEED_IN_LIEU_TEMPLATES) & col("DeedInLieuClaim"),
            "DIL Claim Completed",
        ),
        Rule("foreclosed", col("SaleDt").isNotNull() | (col("ScheduledSaleDt") >= sale_cutoff), "FCSale"),
    ]
    if month_end:
        # Only loans due after the pooled cutoff get here; the balance-sheet cutoff is the later of the two.
        due, investor = col("NextPaymentDueDt"), col("InvestorId")
        late_pooled = (due > next_due_cutoff_pooled) & is_pooled(investor, text)
        late_balance_sheet = (due > next_due_cutoff_balance_sheet) & is_balance_sheet(investor, text)
        rules += [
            Rule("pooled_under_90", late_pooled, "<90 Days DQ - GNMA"),
            Rule("balance_sheet_under_30", late_balance_sheet, "<30 Days DQ - Balance Sheet"),
        ]
    return rules
