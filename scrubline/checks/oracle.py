"""Check SQL for DuckDB, one statement per registered query.

Conditions are stated plainly. Two things are set up differently from the Spark code on purpose, so that they check it: an
ordered rule list becomes the smallest number among the rules that match, the population a table of allowed codes.
"""

from scrubline.checks.queries import (
    LIST_COMMENTS,
    LOAN_LIST_COMMENT,
    MODIFICATION_DATES,
    STEP_DATES,
    TRADES_LEFT_OUT,
)
from scrubline.sources.fixtures import FIXTURE_PERIOD, fixture_ctes

# The fixtures' run date and what follows from it.
RUN = "DATE '2001-08-31'"
DATE_KEY = 20010731
SALE_CUTOFF = {"current": "DATE '2001-06-01'", "month_end": "DATE '2001-05-01'"}
DUE_CUTOFF_POOLED, DUE_CUTOFF_BALANCE_SHEET = "DATE '2001-05-01'", "DATE '2001-07-01'"

# Codes, thresholds and texts, in lower case where text compares without regard to it.
POOLED_INVESTORS = "'400' AND '498'"
BALANCE_SHEET_INVESTORS = "'025', '027'"
POOLED_DELINQUENCY = "'2', '3', '4', 'f'"
BALANCE_SHEET_DELINQUENCY = "'1', '2', '3', '4', 'f'"
OPEN_STATUSES = "'2', '3', '4', 'f'"
CURRENT_DELINQUENCY = "'p', 'a', 'b', 'c', 'd'"
SHORT_SALE_DENIALS = "'dl', 'lp', 'sp', 'mi'"
REFI_PURPOSES = "'5', '6', '7'"
SHORT_SALE_TEMPLATES = "'hafs', 'ss'"
DEED_IN_LIEU_TEMPLATES = "'hafd', 'dil2'"
FINAL_DOCUMENT_STATUSES = (
    "'approved - send final documents', 'final documents to be received', 'final documents received - in review', "
    "'approved send final docs / file prep', 'final docs received - bk approval pending', "
    "'final docs received - pending corrections'"
)
NO_BALANCE, LOW_BALANCE, LOW_RATE, REFI_LTV = "0.01", "30000", "0.0275", "0.90"
SERVICE_STRIP, HIGH_SERVICE_FEE, FINAL_MOD_DAYS = "0.0025", "0.00625", "30"
FINAL_MOD, THIRD_TRIAL = "Final Mod Processing", "3rd Trial Payment Received"
SECOND_TRIAL, FIRST_TRIAL, TRIAL_OFFERED = "2nd Trial Payment Received", "1st Trial Payment Received", "Trial Offered"
SHORT_SALE_DONE = "Completed SS/DIL"
FRANKLIN_AMERICAN, UNSALEABLE = "1002013712, 1001898972", "8019110169"


def _k(column: str) -> str:
    """Text as it compares: without trailing blanks and letter case."""
    return f"lower(rtrim({column}))"


_SOURCE = (
    f"CASE WHEN {_k('InvestorId')} BETWEEN {POOLED_INVESTORS} THEN 'GNMA' "
    f"WHEN {_k('InvestorId')} IN ({BALANCE_SHEET_INVESTORS}) THEN 'Balance Sheet' ELSE 'UNKNOWN' END"
)
_SSDIL = (
    f"CASE WHEN {_k('LossMitDenialReasonCodeid')} IN ({SHORT_SALE_DENIALS}) THEN '{SHORT_SALE_DONE}' ELSE '' END"
)
_LOAN_TYPE = f"CASE {_k('LoTypeId')} WHEN '1' THEN 'FHA' WHEN '2' THEN 'VA' WHEN '9' THEN 'USDA' END"
_AGE = f"CAST(datediff('month', NoteDt, {RUN}) AS INTEGER)"
# Decimals throughout: DuckDB's division would turn them into doubles.
_PASS_THROUGH = (
    f"CAST(floor((CurrentInterestRate - CASE WHEN FirstServiceFeeRt >= {SERVICE_STRIP} THEN FirstServiceFeeRt * 0.5 "
    f"ELSE {SERVICE_STRIP} END) * 200) * 0.005 AS DECIMAL(9,6))"
)
_IS_REFI = (
    f"{_k('LoTypeId')} = '2' AND OriginalLoanToValueRatio > {REFI_LTV} AND {_k('l.LoanPurposeCodeId')} IN ({REFI_PURPOSES})"
)

_ALLOWED = {
    "current": f"""
        SELECT l.* FROM labelled l JOIN allowed a
            ON a.src = l.Source AND a.code = {_k("l.DelinquentStatusCodeId")}
        WHERE l.CurrentPrincipalBalanceAmt > {NO_BALANCE} AND l.LoanType IS NOT NULL""",
    "month_end": f"""
        SELECT l.* FROM labelled l LEFT JOIN allowed a
            ON a.src = l.Source AND a.code = {_k("l.DelinquentStatusCodeId")}
        WHERE CASE l.Source
            WHEN 'Balance Sheet' THEN l.CurrentPrincipalBalanceAmt > {NO_BALANCE} AND l.LoanType IS NOT NULL
            WHEN 'GNMA' THEN a.code IS NOT NULL AND {_k("l.LoanStatusId")} IN ({OPEN_STATUSES})
            ELSE false END""",
}


def _first_rank(conditions: list[str]) -> str:
    """Number of the first condition that holds, counting from one."""
    return "least(" + ", ".join(f"CASE WHEN {c} THEN {i} END" for i, c in enumerate(conditions, 1)) + ")"


def _name_table(names: list[str | None]) -> str:
    rows = ", ".join(f"({i}, {'NULL' if n is None else repr(n)})" for i, n in enumerate(names, 1))
    return f"SELECT * FROM (VALUES {rows}) AS t(rank, name)"


def _loans_cte(variant: str) -> str:
    """Period rows with their labels, and those of them that the report screens."""
    rows = "loan_master" if variant == "current" else f"loan_master_me WHERE MEPeriod = {FIXTURE_PERIOD}"
    return f"""
    allowed AS (
        SELECT 'GNMA' AS src, unnest([{POOLED_DELINQUENCY}]) AS code
        UNION ALL SELECT 'Balance Sheet', unnest([{BALANCE_SHEET_DELINQUENCY}])
    ),
    labelled AS (SELECT *, {_SOURCE} AS Source, {_LOAN_TYPE} AS LoanType FROM {rows}),
    loans AS ({_ALLOWED[variant]})"""


_STATUS = _k("LossMitStatusCodeid")
_MOD = "lower(LossMitTemplateId) LIKE '%mod%'"
_STAGES = [
    (f"{_STATUS} = 'c' AND {_MOD} AND datediff('day', StatusCompleted, {RUN}) < {FINAL_MOD_DAYS}", FINAL_MOD),
    ("LossMitStatusCodeid IS NULL", ""),
    (f"{_STATUS} IN ('r', 'c') AND {_MOD}", ""),
    (f"LossMitStatusCodeid IS NOT NULL AND NOT ({_MOD})", ""),
    ("StatusFinalDocumentsToBeReceived IS NOT NULL OR StatusFinalDocumentsReceivedInReview IS NOT NULL", FINAL_MOD),
    (f"{_k('StatusCurrent')} IN ({FINAL_DOCUMENT_STATUSES})", FINAL_MOD),
    ("Verify4thTrialPaymentReceivedDt IS NOT NULL OR Verify3rdTrialPaymentReceivedDt IS NOT NULL", THIRD_TRIAL),
    ("Verify2ndTrialPaymentReceivedDt IS NOT NULL", SECOND_TRIAL),
    ("VerifyFirstTrialPaymentReceivedDt IS NOT NULL", FIRST_TRIAL),
    ("statusApprovedSendTrialPackage IS NOT NULL", TRIAL_OFFERED),
    ("StatusTrialToBeAccepted IS NOT NULL", TRIAL_OFFERED),
]


def _stage_ctes(of: str) -> str:
    return f"""
    stage_names AS ({_name_table([name for _, name in _STAGES])}),
    staged AS (
        SELECT r.*, s.name AS ModStage, {_SSDIL} AS SSDILStatus
        FROM (SELECT *, {_first_rank([c for c, _ in _STAGES])} AS stage_rank FROM {of}) r
        LEFT JOIN stage_names s ON s.rank = r.stage_rank
    )"""


def _rules(variant: str, with_lists: bool) -> list[tuple[str, str | None]]:
    """Conditions and reasons in order; the reason None stands for the modification stage."""
    month_end = variant == "month_end"

    def in_list(name: str, reason: str) -> list[tuple[str, str]]:
        code = LIST_COMMENTS[name]
        found = f"LoanId IN (SELECT c.LoanId FROM collection_commentactivity c WHERE c.ReasonCode = '{code}')"
        return [(found, reason)] if with_lists else []

    active = f"{_STATUS} = 'a'"
    template = _k("LossMitTemplateId")
    rules = [(f"{_k('PayoffStopCodeId')} <> '0'", "PIF"), (f"{_k('NativeAmericanLoanFlag')} = '1'", "NAHousing")]
    if month_end:
        rules.append(("has_184", "NAHousing"))
    rules += [
        (f"{_k('LoTypeId')} = '2' AND refi_purpose IS NOT NULL", "VA_Refi"),
        *in_list("collateral", "Collateral"),
        *in_list("unsaleable", "Unsaleable Loan"),
        (f"LoanId IN ({FRANKLIN_AMERICAN})", "Franklin American"),
        (f"{_k('ARMFlag')} = 'y'", "ARM"),
        (f"LoanId IN ({UNSALEABLE})", "Unsaleable Loan"),
        *in_list("active_repurchase", "Active Repurchase"),
    ]
    if not month_end:
        rules.append((f"{_k('DelinquentStatusCodeId')} IN ({CURRENT_DELINQUENCY})", "< 30 DAYS DQ"))
    rules += [
        (f"CurrentPrincipalBalanceAmt < {LOW_BALANCE}", "Low Balance"),
        (f"CurrentInterestRate < {LOW_RATE}", "Low Rate"),
        (f"{active} AND {template} = 'hhf'", "HHF"),
        ("has_001", "Deceased Borrower"),
        (
            f"{_k('BorrowerOneConsumerInfoCodeId')} = 'x' OR {_k('BorrowerTwoConsumerInfoCodeId')} = 'x'",
            "Deceased Borrower",
        ),
        *in_list("deceased", "Deceased Borrower"),
        (f"ModStage = '{FINAL_MOD}'", None),
        (f"ModStage IN ('{SECOND_TRIAL}', '{THIRD_TRIAL}')", None),
        (f"SSDILStatus = '{SHORT_SALE_DONE}'", SHORT_SALE_DONE),
        (
            f"{active} AND {template} IN ({SHORT_SALE_TEMPLATES}) AND (G58_Date IS NOT NULL OR R33_Date IS NOT NULL)",
            "Short Sale Claim Completed",
        ),
        (
            f"{active} AND {template} IN ({DEED_IN_LIEU_TEMPLATES}) AND (L49_Date IS NOT NULL OR L50_Date IS NOT NULL "
            "OR G59_Date IS NOT NULL OR G60_Date IS NOT NULL)",
            "DIL Claim Completed",
        ),
        ("SaleDt IS NOT NULL", "FCSale"),
        (f"ScheduledSaleDt >= {SALE_CUTOFF[variant]}", "FCSale"),
    ]
    if month_end:
        late = f"NextPaymentDueDt > {DUE_CUTOFF_POOLED}"
        rules += [
            (f"{late} AND Source = 'GNMA'", "<90 Days DQ - GNMA"),
            (
                f"{late} AND Source = 'Balance Sheet' AND NextPaymentDueDt > {DUE_CUTOFF_BALANCE_SHEET}",
                "<30 Days DQ - Balance Sheet",
            ),
        ]
    return rules


def _report_ctes(variant: str, with_lists: bool = False) -> str:
    month_end = variant == "month_end"
    suffix, state = ("_me", "property_master") if month_end else ("", "portfolio_summary")
    of_period = f" AND {{}}.MEPeriod = {FIXTURE_PERIOD}" if month_end else ""
    tables = [
        "loan_master", "collection_commentactivity", "lossmitigation_step_transpose", "ref_loanstatus",
        "ref_loanpurposecode", state, "modification_master", "foreclosure_master", "borrower_master",
    ]
    if month_end:
        tables += ["loan_master_me", "modification_master_me", "foreclosure_master_me", "borrower_master_me"]
        tables.append("escrow_master")
    has_184 = "SELECT e.LoanId FROM escrow_master e WHERE rtrim(e.MortgageInsuranceFHASectionADPCode) = '184'"
    commented = "SELECT c.LoanId FROM collection_commentactivity c WHERE rtrim(c.ReasonCode) = '001'"
    flags = f"l.LoanId IN ({commented}) AS has_001"
    if month_end:
        flags += f", l.LoanId IN ({has_184}) AS has_184"
    rules = _rules(variant, with_lists)
    return (
        fixture_ctes(*tables)
        + f""",{_loans_cte(variant)},
    refi AS (
        SELECT LoanId, OriginalLoanToValueRatio AS refi_ltv, min(l.LoanPurposeCodeId) AS refi_purpose
        FROM loan_master l LEFT JOIN ref_loanpurposecode n ON {_k("n.LoanPurposeCodeId")} = {_k("l.LoanPurposeCodeId")}
        WHERE {_IS_REFI}
        GROUP BY LoanId, OriginalLoanToValueRatio, {_k("l.LoanPurposeCodeId")}, LoanPurposeCodeDesc
    ),
    joined AS (
        SELECT l.*, s.LoanStatusDesc, p.PropertyState, m.* EXCLUDE (LoanId{", MEPeriod" if month_end else ""}),
            f.ScheduledSaleDt, f.SaleDt, t.* EXCLUDE (LoanId), b.BorrowerOneConsumerInfoCodeId,
            b.BorrowerTwoConsumerInfoCodeId, v.refi_ltv, v.refi_purpose, {flags}
        FROM loans l
        LEFT JOIN ref_loanstatus s ON {_k("s.LoanStatusId")} = {_k("l.LoanStatusId")}
        LEFT JOIN modification_master{suffix} m ON m.LoanId = l.LoanId{of_period.format("m")}
        LEFT JOIN foreclosure_master{suffix} f ON f.LoanId = l.LoanId{of_period.format("f")}
        LEFT JOIN borrower_master{suffix} b ON b.LoanId = l.LoanId{of_period.format("b")}
        LEFT JOIN {state} p ON p.LoanId = l.LoanId
        LEFT JOIN lossmitigation_step_transpose t ON t.LoanId = l.LoanId
        LEFT JOIN refi v ON v.LoanId = l.LoanId
    ),{_stage_ctes("joined")},
    reasons AS ({_name_table([reason for _, reason in rules])}),
    scrubbed AS (
        SELECT q.*, CASE WHEN q.rule_rank IS NULL THEN '' ELSE coalesce(r.name, q.ModStage) END AS EligibilityScrub
        FROM (SELECT *, {_first_rank([c for c, _ in rules])} AS rule_rank, {_PASS_THROUGH} AS pass_through FROM staged) q
        LEFT JOIN reasons r ON r.rank = q.rule_rank
    )
    """
    )


def _eligibility(variant: str) -> str:
    only = (
        f"""{DUE_CUTOFF_POOLED} AS Next_Due_Date_Cutoff,
        {SALE_CUTOFF[variant]} AS Cutoff_1stOfMonth_Prev3Months"""
        if variant == "month_end"
        else f"InterestPaidToDt, {SALE_CUTOFF[variant]} AS Cutoff_1stOfMonth_Prev2Months"
    )
    return (
        _report_ctes(variant)
        + f"""SELECT LoanId, TradeId AS TradeCollateral, LoTypeId, LoanType, RunDt, LoanStatusDesc AS LoanStatus,
        CurrentPrincipalBalanceAmt, CurrentInterestRate, FirstServiceFeeRt AS SFee, FHA_DebentureRt AS DebentureRate,
        ARMFlag, LossMitStatusCodeid, LossMitTemplateId, LossMitDenialReasonCodeid, StatusCurrent, ModStage,
        SSDILStatus, ScheduledSaleDt, SaleDt, InvestorId, DelinquentStatusCodeId, DelinquentPaymentCount,
        NextPaymentDueDt, PayoffStopCodeId, PropertyState, {_AGE} AS Age, EligibilityScrub,
        CAST({FIXTURE_PERIOD} AS INTEGER) AS MEPeriod, CAST({DATE_KEY} AS INTEGER) AS DateKey, {only},
        refi_ltv AS OriginalLoanToValueRatio, refi_purpose AS Loanpurposecodeid, pass_through AS "PT at Buyout",
        CAST(CurrentInterestRate - pass_through AS DECIMAL(9,6)) AS "Svcg Fee at Buyout", Source,
        CASE WHEN CurrentInterestRate - pass_through > {HIGH_SERVICE_FEE} THEN 'Warning - High SFee' ELSE '' END
            AS "Servicing Fee Check"
    FROM scrubbed"""
    )


def _scrub(variant: str) -> str:
    return _report_ctes(variant) + "SELECT LoanId, ModStage, SSDILStatus, EligibilityScrub FROM scrubbed"


def _lists(variant: str) -> str:
    trades = ", ".join(f"'{t}'" for t in TRADES_LEFT_OUT)
    return (
        _report_ctes(variant, with_lists=True)
        + f"""SELECT LoanId, TradeId AS TradeCollateral, EligibilityScrub FROM scrubbed
    WHERE TradeId IS NULL OR TradeId NOT IN ({trades})"""
    )


def _from_loans(columns: str) -> str:
    return fixture_ctes("loan_master") + f"SELECT LoanId, {columns} FROM loan_master"


def _both(table: str, columns: str) -> str:
    """Live and month-end loans, each with its own snapshot of the table."""
    return (
        fixture_ctes("loan_master_me", f"{table}_me")
        + f"""SELECT 'current' AS Variant, l.LoanId, {columns}
    FROM loan_master l LEFT JOIN {table} r ON r.LoanId = l.LoanId
    UNION ALL
    SELECT 'month_end', l.LoanId, {columns}
    FROM loan_master_me l LEFT JOIN {table}_me r ON r.LoanId = l.LoanId AND r.MEPeriod = l.MEPeriod
    WHERE l.MEPeriod = {FIXTURE_PERIOD}"""
    )


def oracle_sql() -> dict[str, str]:
    month_back = "date_trunc('month', run_date) - INTERVAL {} MONTH"
    cutoff = lambda n, name: f"CAST({month_back.format(n)} AS DATE) AS {name}"
    return {
        "period_params": f"""SELECT run_date,
            CAST(strftime(run_date - INTERVAL 1 MONTH, '%Y%m') AS INTEGER) AS me_period,
            CAST(strftime(last_day(run_date - INTERVAL 1 MONTH), '%Y%m%d') AS INTEGER) AS date_key,
            {cutoff(0, "first_of_month")}, {cutoff(2, "sale_cutoff_current")}, {cutoff(3, "sale_cutoff_month_end")},
            {cutoff(3, "next_due_cutoff_pooled")}, {cutoff(1, "next_due_cutoff_balance_sheet")}
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date FROM orders)""",
        "loan_age": f"""SELECT order_key, run_date, note_date,
            CAST(datediff('month', note_date, run_date) AS INTEGER) AS age_at_run_date,
            CAST(datediff('month', note_date, {RUN}) AS INTEGER) AS age_at_report
        FROM (SELECT *, run_date - CAST(order_key % 1461 AS INTEGER) AS note_date
            FROM (SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS run_date FROM orders))""",
        "population_current": fixture_ctes("loan_master")
        + f""",{_loans_cte("current")}
        SELECT LoanId, InvestorId, DelinquentStatusCodeId, CurrentPrincipalBalanceAmt, LoTypeId FROM loans""",
        "population_month_end": fixture_ctes("loan_master_me")
        + f""",{_loans_cte("month_end")}
        SELECT LoanId, InvestorId, DelinquentStatusCodeId, LoanStatusId, CurrentPrincipalBalanceAmt, LoTypeId
        FROM loans""",
        "loan_list": fixture_ctes("loan_master", "collection_commentactivity")
        + f""",{_loans_cte("current")}
        SELECT LoanId, InvestorId FROM loans WHERE LoanId IN
            (SELECT LoanId FROM collection_commentactivity WHERE ReasonCode = '{LOAN_LIST_COMMENT}')""",
        "loan_type": _from_loans(f"LoTypeId, {_LOAN_TYPE} AS LoanType"),
        "source_label": _from_loans(f"InvestorId, {_SOURCE} AS Source"),
        "ssdil_status": _from_loans(f"LossMitDenialReasonCodeid, {_SSDIL} AS SSDILStatus"),
        "loan_status": fixture_ctes("loan_master", "ref_loanstatus")
        + f"""SELECT LoanId, l.LoanStatusId, LoanStatusDesc AS LoanStatus
        FROM loan_master l LEFT JOIN ref_loanstatus s ON {_k("s.LoanStatusId")} = {_k("l.LoanStatusId")}""",
        "property_state": fixture_ctes("loan_master_me", "portfolio_summary", "property_master")
        + f"""SELECT 'current' AS Variant, l.LoanId, PropertyState
        FROM loan_master l LEFT JOIN portfolio_summary p ON p.LoanId = l.LoanId
        UNION ALL
        SELECT 'month_end', l.LoanId, PropertyState
        FROM loan_master_me l LEFT JOIN property_master p ON p.LoanId = l.LoanId
        WHERE l.MEPeriod = {FIXTURE_PERIOD}""",
        "join_modification": _both("modification_master", ", ".join(("StatusCurrent", *MODIFICATION_DATES))),
        "foreclosure_sale": _both("foreclosure_master", "ScheduledSaleDt, SaleDt"),
        "deceased_borrower": _both("borrower_master", "BorrowerOneConsumerInfoCodeId, BorrowerTwoConsumerInfoCodeId"),
        "lossmit_steps": fixture_ctes("loan_master", "lossmitigation_step_transpose")
        + f"""SELECT l.LoanId, {", ".join(STEP_DATES)}
        FROM loan_master l LEFT JOIN lossmitigation_step_transpose s ON s.LoanId = l.LoanId""",
        "deceased_comment": fixture_ctes("loan_master", "collection_commentactivity")
        + """SELECT LoanId, CASE WHEN LoanId IN
            (SELECT LoanId FROM collection_commentactivity WHERE rtrim(ReasonCode) = '001') THEN '001' END AS ReasonCode
        FROM loan_master""",
        "na_housing_184": fixture_ctes("loan_master_me", "escrow_master")
        + f"""SELECT LoanId, CASE WHEN LoanId IN
            (SELECT LoanId FROM escrow_master WHERE rtrim(MortgageInsuranceFHASectionADPCode) = '184') THEN '184' END
            AS MortgageInsuranceFHASectionADPCode
        FROM loan_master_me WHERE MEPeriod = {FIXTURE_PERIOD}""",
        "va_refi": fixture_ctes("loan_master", "ref_loanpurposecode")
        + f"""SELECT LoanId, min(LoTypeId) AS LoTypeId, min(l.LoanPurposeCodeId) AS LoanPurposeCodeId,
            LoanPurposeCodeDesc, OriginalLoanToValueRatio
        FROM loan_master l LEFT JOIN ref_loanpurposecode p ON {_k("p.LoanPurposeCodeId")} = {_k("l.LoanPurposeCodeId")}
        WHERE {_IS_REFI}
        GROUP BY LoanId, {_k("l.LoanPurposeCodeId")}, LoanPurposeCodeDesc, OriginalLoanToValueRatio""",
        "buyout_rates": fixture_ctes("loan_master")
        + f"""SELECT *, CAST(CurrentInterestRate - "PT at Buyout" AS DECIMAL(9,6)) AS "Svcg Fee at Buyout" FROM
        (SELECT LoanId, CurrentInterestRate, FirstServiceFeeRt, {_PASS_THROUGH} AS "PT at Buyout" FROM loan_master)""",
        "servicing_fee_check": fixture_ctes("loan_master")
        + f"""SELECT LoanId, fee AS "Svcg Fee at Buyout",
            CASE WHEN fee > {HIGH_SERVICE_FEE} THEN 'Warning - High SFee' ELSE '' END AS "Servicing Fee Check"
        FROM (SELECT LoanId, CAST(CurrentInterestRate - {_PASS_THROUGH} AS DECIMAL(9,6)) AS fee FROM loan_master)""",
        "mod_stage": fixture_ctes("loan_master", "modification_master")
        + f""",
        joined AS (SELECT l.*, m.* EXCLUDE (LoanId)
            FROM loan_master l LEFT JOIN modification_master m ON m.LoanId = l.LoanId),{_stage_ctes("joined")}
        SELECT LoanId, LossMitStatusCodeid, LossMitTemplateId, StatusCurrent, ModStage FROM staged""",
        "scrub_current": _scrub("current"),
        "scrub_month_end": _scrub("month_end"),
        "exclusion_lists": _lists("current"),
        "exclusion_lists_month_end": _lists("month_end"),
        "eligibility_current": _eligibility("current"),
        "eligibility_month_end": _eligibility("month_end"),
    }
