"""The ordered rules, one loan per rule, boundary values, nulls, and which rule wins."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scrubline import CURRENT, MONTH_END, eligibility
from scrubline.operators.rules import LIST_REASONS, FixedLists, exclusion_rules, first_match
from scrubline.sources.schemas import schema
from small import AS_OF, GOOD_LOAN, loan, small_tables

DAY = dt.date(2001, 5, 1)
VA = {"LoTypeId": "2", "OriginalLoanToValueRatio": Decimal("0.91"), "LoanPurposeCodeId": "6"}

# Each step makes a loan match one more rule; steps are in rule order. (table or list, changes, reason current, month-end)
LISTED, FIXED = "list", "fixed list"
FIRST_STEPS = [
    ("loan_master", {"PayoffStopCodeId": "1"}, "PIF", "PIF"),
    ("loan_master", {"NativeAmericanLoanFlag": "1"}, "NAHousing", "NAHousing"),
    ("escrow_master", {"MortgageInsuranceFHASectionADPCode": "184"}, None, "NAHousing"),
    ("loan_master", VA, "VA_Refi", "VA_Refi"),
    (LISTED, "collateral", "Collateral", "Collateral"),
    (LISTED, "unsaleable", "Unsaleable Loan", "Unsaleable Loan"),
    (FIXED, "franklin_american", "Franklin American", "Franklin American"),
    ("loan_master", {"ARMFlag": "y"}, "ARM", "ARM"),
    (FIXED, "unsaleable", "Unsaleable Loan", "Unsaleable Loan"),
    (LISTED, "active_repurchase", "Active Repurchase", "Active Repurchase"),
    ("loan_master", {"CurrentPrincipalBalanceAmt": Decimal("29999.99")}, "Low Balance", "Low Balance"),
    ("loan_master", {"CurrentInterestRate": Decimal("0.027499")}, "Low Rate", "Low Rate"),
]
LAST_STEPS = [
    ("foreclosure_master", {"SaleDt": DAY}, "FCSale", "FCSale"),
    ("loan_master", {"NextPaymentDueDt": dt.date(2001, 5, 2)}, "", "<90 Days DQ - GNMA"),
]
SALE_DONE = ("loan_master", {"LossMitDenialReasonCodeid": "LP"}, "Completed SS/DIL", "Completed SS/DIL")
STEPS_TABLE = "lossmitigation_step_transpose"
# Rules that exclude each other are in different chains: (what every loan of the chain has, steps).
CHAINS = {
    "modification": (
        {"LossMitStatusCodeid": "P", "LossMitTemplateId": "FHAMOD"},
        [
            *FIRST_STEPS,
            ("borrower_master", {"BorrowerTwoConsumerInfoCodeId": "X"}, "Deceased Borrower", "Deceased Borrower"),
            ("modification_master", {"Verify2ndTrialPaymentReceivedDt": DAY}, *["2nd Trial Payment Received"] * 2),
            SALE_DONE,
            *LAST_STEPS,
        ],
    ),
    "hardest hit fund": (
        {"LossMitStatusCodeid": "A", "LossMitTemplateId": "OTHER"},
        [
            *FIRST_STEPS,
            ("loan_master", {"LossMitTemplateId": "HHF"}, "HHF", "HHF"),
            ("collection_commentactivity", {"ReasonCode": "001"}, "Deceased Borrower", "Deceased Borrower"),
            SALE_DONE,
            *LAST_STEPS,
        ],
    ),
    "listed as deceased": (
        {},
        [*FIRST_STEPS, (LISTED, "deceased", "Deceased Borrower", "Deceased Borrower"), SALE_DONE, *LAST_STEPS],
    ),
    "short sale": (
        {"LossMitStatusCodeid": "A", "LossMitTemplateId": "SS"},
        [SALE_DONE, (STEPS_TABLE, {"G58_Date": DAY}, *["Short Sale Claim Completed"] * 2), *LAST_STEPS],
    ),
    "deed in lieu": (
        {"LossMitStatusCodeid": "A", "LossMitTemplateId": "DIL2"},
        [SALE_DONE, (STEPS_TABLE, {"G60_Date": DAY}, *["DIL Claim Completed"] * 2), *LAST_STEPS],
    ),
}


def scrubs(spark, rows, variant, **options):
    report = eligibility(small_tables(spark, rows), AS_OF, variant, **options)
    return {row["LoanId"]: row["EligibilityScrub"] for row in report.collect()}


@pytest.mark.parametrize("chain", CHAINS)
@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_earlier_rule_wins(spark, variant, chain):
    """Loan i matches rule i of the chain and every later one, so it must get the reason of rule i: swapping any two
    neighbours gives a loan another reason."""
    base, steps = CHAINS[chain]
    rows, expected, lists, fixed = {}, {}, {name: [] for name in LIST_REASONS}, {"franklin_american": (), "unsaleable": ()}
    for i in range(len(steps)):
        by_table = {"loan_master": loan(i, **base)}
        for table, changes, *_ in steps[i:]:
            if table == LISTED:
                lists[changes].append(i)
            elif table == FIXED:
                fixed[changes] += (i,)
            else:
                by_table[table] = by_table.get(table, {"LoanId": i}) | changes
        for table, row in by_table.items():
            rows.setdefault(table, []).append(row)
        reasons = [step[3] if variant.month_end else step[2] for step in steps[i:]]
        expected[i] = next(reason for reason in reasons if reason is not None)
    frames = {name: spark.createDataFrame([(i,) for i in ids], "LoanId long") for name, ids in lists.items()}
    assert scrubs(spark, rows, variant, exclusion_lists=frames, fixed_lists=FixedLists(**fixed)) == expected


EDGES = [
    ({}, {}, "", ""),
    ({"PayoffStopCodeId": None}, {}, "", ""),
    ({"PayoffStopCodeId": "0 "}, {}, "", ""),
    ({"CurrentPrincipalBalanceAmt": Decimal("30000")}, {}, "", ""),
    ({"CurrentInterestRate": Decimal("0.0275")}, {}, "", ""),
    ({"CurrentInterestRate": None}, {}, "", ""),
    (VA | {"OriginalLoanToValueRatio": Decimal("0.90")}, {}, "", ""),
    (VA | {"OriginalLoanToValueRatio": Decimal("0.9001"), "LoTypeId": "2 "}, {}, "VA_Refi", "VA_Refi"),
    (VA | {"LoanPurposeCodeId": "4"}, {}, "", ""),
    (VA | {"LoTypeId": "1"}, {}, "", ""),
    ({"LossMitStatusCodeid": "a", "LossMitTemplateId": "hhf"}, {}, "HHF", "HHF"),
    ({"LossMitStatusCodeid": "C", "LossMitTemplateId": "HHF"}, {}, "", ""),
    ({}, {"collection_commentactivity": {"ReasonCode": "001"}}, "Deceased Borrower", "Deceased Borrower"),
    ({}, {"collection_commentactivity": {"ReasonCode": "1"}}, "", ""),
    ({}, {"borrower_master": {"BorrowerOneConsumerInfoCodeId": "x"}}, "Deceased Borrower", "Deceased Borrower"),
    (
        {"LossMitStatusCodeid": "P", "LossMitTemplateId": "MOD"},
        {"modification_master": {"VerifyFirstTrialPaymentReceivedDt": DAY}},
        "",
        "",
    ),
    (
        {"LossMitStatusCodeid": "P", "LossMitTemplateId": "MOD"},
        {"modification_master": {"Verify4thTrialPaymentReceivedDt": DAY}},
        "3rd Trial Payment Received",
        "3rd Trial Payment Received",
    ),
    (
        {"LossMitStatusCodeid": "C", "LossMitTemplateId": None},
        {"modification_master": {"StatusFinalDocumentsToBeReceived": DAY}},
        "Final Mod Processing",
        "Final Mod Processing",
    ),
    (
        {"LossMitStatusCodeid": "A", "LossMitTemplateId": "ss"},
        {"lossmitigation_step_transpose": {"R33_Date": DAY}},
        "Short Sale Claim Completed",
        "Short Sale Claim Completed",
    ),
    (
        {"LossMitStatusCodeid": "A", "LossMitTemplateId": "HAFS"},
        {"lossmitigation_step_transpose": {"G59_Date": DAY}},
        "",
        "",
    ),
    *[
        (
            {"LossMitStatusCodeid": "A", "LossMitTemplateId": template},
            {"lossmitigation_step_transpose": {step: DAY}},
            "DIL Claim Completed",
            "DIL Claim Completed",
        )
        for template, step in (("HAFD", "L49_Date"), ("DIL2", "G59_Date"), ("HAFD", "L50_Date"), ("DIL2", "G60_Date"))
    ],
    # Scheduled sale on the cutoff day and the day before: the two variants differ by a month.
    ({}, {"foreclosure_master": {"ScheduledSaleDt": dt.date(2001, 6, 1)}}, "FCSale", "FCSale"),
    ({}, {"foreclosure_master": {"ScheduledSaleDt": dt.date(2001, 5, 31)}}, "", "FCSale"),
    ({}, {"foreclosure_master": {"ScheduledSaleDt": dt.date(2001, 5, 1)}}, "", "FCSale"),
    ({}, {"foreclosure_master": {"ScheduledSaleDt": dt.date(2001, 4, 30)}}, "", ""),
    # Next due date on and after each cutoff day.
    ({"NextPaymentDueDt": dt.date(2001, 5, 1)}, {}, "", ""),
    ({"NextPaymentDueDt": dt.date(2001, 5, 2)}, {}, "", "<90 Days DQ - GNMA"),
    ({"NextPaymentDueDt": None}, {}, "", ""),
    ({"InvestorId": "025", "NextPaymentDueDt": dt.date(2001, 7, 1)}, {}, "", ""),
    ({"InvestorId": "027", "NextPaymentDueDt": dt.date(2001, 7, 2)}, {}, "", "<30 Days DQ - Balance Sheet"),
]


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_edges(spark, variant):
    rows = {"loan_master": []}
    for i, (changes, others, *_) in enumerate(EDGES):
        rows["loan_master"].append(loan(i, **changes))
        for table, row in others.items():
            rows.setdefault(table, []).append({"LoanId": i} | row)
    expected = {i: case[3] if variant.month_end else case[2] for i, case in enumerate(EDGES)}
    assert scrubs(spark, rows, variant) == expected


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_listed_loans(spark, variant):
    rows = {
        "loan_master": [
            loan(1002013712),
            loan(1001898972, ARMFlag="Y"),
            loan(8019110169),
            loan(8019110168),
        ]
    }
    assert scrubs(spark, rows, variant) == {
        1002013712: "Franklin American",
        1001898972: "Franklin American",
        8019110169: "Unsaleable Loan",
        8019110168: "",
    }


@pytest.mark.parametrize("variant", [CURRENT, MONTH_END], ids=lambda v: v.name)
def test_optional_lists(spark, variant):
    rows = {
        "loan_master": [
            loan(1, **VA),
            loan(2, ARMFlag="Y"),
            loan(3, ARMFlag="Y"),
            loan(4, CurrentInterestRate=Decimal("0.02")),
            loan(5),
            loan(6, LossMitDenialReasonCodeid="DL"),
            loan(7, TradeId="t9 "),
            loan(8, TradeId=None),
        ]
    }
    lists = {
        "collateral": [1, 2, 2],
        "unsaleable": [3],
        "active_repurchase": [4, 3],
        "deceased": [6],
    }
    frames = {name: spark.createDataFrame([(i,) for i in ids], "LoanId long") for name, ids in lists.items()}
    assert scrubs(spark, rows, variant, exclusion_lists=frames, excluded_trades=["T9"]) == {
        1: "VA_Refi",
        2: "Collateral",
        3: "Unsaleable Loan",
        4: "Active Repurchase",
        5: "",
        6: "Deceased Borrower",
        8: "",
    }
    with pytest.raises(ValueError, match="unknown exclusion list"):
        scrubs(spark, rows, variant, exclusion_lists={"other": frames["deceased"]})


def test_loan_ids_as_list_or_frame(spark):
    rows = {"loan_master": [loan(i) for i in range(5)]}
    assert set(scrubs(spark, rows, CURRENT, loan_ids=[1, 3, 9])) == {1, 3}
    frame = spark.createDataFrame([(2,), (2,), (9,)], "LoanId long")
    report = eligibility(small_tables(spark, rows), AS_OF, loan_ids=frame)
    assert [row["LoanId"] for row in report.collect()] == [2]


def test_case_sensitive_switch(spark):
    rows = {"loan_master": [loan(1, LossMitStatusCodeid="A", LossMitTemplateId="hhf"), loan(2, ARMFlag="y")]}
    assert scrubs(spark, rows, CURRENT) == {1: "HHF", 2: "ARM"}
    assert scrubs(spark, rows, CURRENT, case_sensitive=True) == {1: "", 2: ""}


def test_loans_that_are_not_delinquent_have_a_rule(spark):
    """The population never lets such a loan through, so the rule is reached directly; the month-end list has none."""
    columns = {f.name: F.lit(GOOD_LOAN.get(f.name)).cast(f.dataType) for f in schema("loan_master") if f.name != "LoanPurposeCodeId"}
    flags = ("ReasonCode", "Loanpurposecodeid", "ModStage", "SSDILStatus", "MortgageInsuranceFHASectionADPCode")
    columns |= {"BorrowerDeceased": F.lit(False), "ShortSaleClaim": F.lit(False), "DeedInLieuClaim": F.lit(False), "SaleDt": F.lit(None).cast("date"), "ScheduledSaleDt": F.lit(None).cast("date")}
    columns |= {name: F.lit(None).cast("string") for name in flags}
    cutoff = F.lit(AS_OF)
    for code, current, month_end in (("P", "< 30 DAYS DQ", ""), ("D", "< 30 DAYS DQ", ""), ("3", "", "")):
        one = spark.range(1).select(*[c.alias(n) for n, c in (columns | {"DelinquentStatusCodeId": F.lit(code)}).items()])
        reason = lambda **given: one.select(first_match(exclusion_rules(sale_cutoff=cutoff, **given)).alias("reason")).first()["reason"]
        assert reason(month_end=False) == current
        assert reason(month_end=True, next_due_cutoff_pooled=cutoff, next_due_cutoff_balance_sheet=cutoff) == month_end
