"""Test tables for every input, derived from the orders, customer and lineitem test data.

Each column is one SQL expression that Spark and DuckDB read alike, so the same text feeds the Spark tables and the
check SQL. ``k`` is the order key, ``c`` the customer key, ``p`` the total price, ``d`` the order date, ``n`` the nation
key. The WHERE parts leave loans without a matching row, which the left joins need.
"""

import datetime as dt
from functools import cache, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.sources.schemas import PERIOD, SNAPSHOTS
from scrubline.sources.tables import Tables

AS_OF = dt.date(2001, 8, 31)
FIXTURE_PERIOD, EARLIER_PERIOD = 200107, 200106

# Order keys that stand for the listed loans.
LISTED_LOANS = {20: 1002013712, 60: 1001898972, 100: 8019110169}
_loan_id = "CASE {0} " + " ".join(f"WHEN {k} THEN {v}" for k, v in LISTED_LOANS.items()) + " ELSE {0} END"

_RUN = "DATE '2001-08-31'"
_STATE_WHERE = "k%101<>0"

# Table -> (source view, row filter, column -> expression).
TABLES = {
    "loan_master": (
        "base",
        "true",
        {
            "LoanId": "LoanId",
            "TradeId": "CASE WHEN k%17<>0 THEN CAST(200000+c%40 AS STRING) END",
            "LoTypeId": "CASE WHEN k%149=0 THEN '2 ' WHEN k%10<4 THEN '1' WHEN k%10<7 THEN '2' WHEN k%10<9 THEN '9' ELSE '3' END",
            "RunDt": _RUN,
            "NoteDt": "d",
            "LoanStatusId": "CASE WHEN k%127=0 THEN 'f' WHEN k%127=1 THEN '2 ' WHEN k%7<2 THEN '2' WHEN k%7<4 THEN '3' WHEN k%7=4 THEN '4' WHEN k%7=5 THEN 'F' "
            "ELSE 'A' END",
            "CurrentPrincipalBalanceAmt": "CASE WHEN k%499=0 THEN CAST(0 AS DECIMAL(18,2)) "
            "ELSE CAST(p AS DECIMAL(18,2)) END",
            "CurrentInterestRate": "CAST((200+(k*13)%45*10+5*(k%2))*CAST(0.0001 AS DECIMAL(9,4)) AS DECIMAL(9,6))",
            "FirstServiceFeeRt": "CASE WHEN k%41<>0 THEN "
            "CAST((19+(k*7)%60)*CAST(0.0001 AS DECIMAL(9,4)) AS DECIMAL(9,6)) END",
            "FHA_DebentureRt": "CAST((100+k%30*5)*CAST(0.0001 AS DECIMAL(9,4)) AS DECIMAL(9,6))",
            "ARMFlag": "CASE WHEN k%163=0 THEN 'y ' WHEN k%37=0 THEN 'Y' ELSE 'N' END",
            "LossMitStatusCodeid": "CASE WHEN k%167=0 THEN 'a ' WHEN k%4=1 THEN NULL WHEN k%12 IN (0,4,8) THEN 'A' "
            "WHEN k%12 IN (2,6) THEN 'C' WHEN k%12=10 THEN 'R' ELSE 'P' END",
            "LossMitTemplateId": "CASE WHEN c%11=0 THEN NULL WHEN c%11<5 THEN 'FHAMOD' WHEN c%11=5 THEN 'vamod2' "
            "WHEN c%11=6 THEN 'HHF' WHEN c%11=7 THEN 'HAFS' WHEN c%11=8 THEN 'SS' WHEN c%11=9 THEN 'HAFD' "
            "ELSE 'DIL2' END",
            "LossMitDenialReasonCodeid": "CASE WHEN k%43=0 THEN 'DL' WHEN k%43=1 THEN 'MI' WHEN k%43=2 THEN 'XX' "
            "WHEN k%43=3 THEN 'lp ' END",
            "InvestorId": "CASE WHEN k%211=0 THEN '45' WHEN k%211=1 THEN '4000' WHEN k%211=2 THEN '498 ' "
            "WHEN k%211=3 THEN '025 ' WHEN c%8=0 THEN '025' WHEN c%8=1 THEN '027' WHEN c%8=2 THEN '100' "
            "ELSE CAST(396+(c*3)%106 AS STRING) END",
            "DelinquentStatusCodeId": "CASE WHEN k%131=0 THEN 'f ' WHEN k%9=0 THEN '1' WHEN k%9<3 THEN '2' WHEN k%9<5 THEN '3' "
            "WHEN k%9<7 THEN '4' WHEN k%9=7 THEN 'F' ELSE 'P' END",
            "DelinquentPaymentCount": "CAST(k%12 AS INT)",
            "InterestPaidToDt": f"{_RUN} - CAST(30+k%240 AS INT)",
            "NextPaymentDueDt": f"CASE WHEN k%6<>0 THEN {_RUN} - CAST(k%240 AS INT) END",
            "PayoffStopCodeId": "CASE WHEN k%139=0 THEN '0 ' WHEN k%53=0 THEN '1' WHEN k%53=1 THEN NULL ELSE '0' END",
            "NativeAmericanLoanFlag": "CASE WHEN k%59=0 THEN '1' ELSE '0' END",
            "LoanPurposeCodeId": "CASE WHEN k%151=0 THEN '5 ' ELSE CAST(1+(k*5)%9 AS STRING) END",
            "OriginalLoanToValueRatio": "CAST((60+(k*11)%47)*CAST(0.01 AS DECIMAL(9,4)) AS DECIMAL(9,4))",
        },
    ),
    "modification_master": (
        "base",
        "k%10<>7",
        {
            "LoanId": "LoanId",
            "StatusCurrent": "CASE WHEN extra=1 THEN 'Open' WHEN k%5=0 THEN 'Final documents to be received' "
            "WHEN k%5=1 THEN 'FINAL DOCUMENTS RECEIVED - IN REVIEW' ELSE 'Open' END",
            "StatusCompleted": f"CASE WHEN extra=0 AND k%4=2 THEN {_RUN} - CAST(k%90 AS INT) END",
            "StatusFinalDocumentsToBeReceived": "CASE WHEN extra=0 AND k%23=0 THEN DATE '2001-06-01' END",
            "StatusFinalDocumentsReceivedInReview": "CASE WHEN extra=0 AND k%29=0 THEN DATE '2001-06-05' END",
            "Verify4thTrialPaymentReceivedDt": "CASE WHEN extra=0 AND k%19=0 THEN DATE '2001-05-01' END",
            "Verify3rdTrialPaymentReceivedDt": "CASE WHEN extra=0 AND k%19=1 THEN DATE '2001-04-01' END",
            "Verify2ndTrialPaymentReceivedDt": "CASE WHEN extra=0 AND k%13=0 THEN DATE '2001-03-01' END",
            "VerifyFirstTrialPaymentReceivedDt": "CASE WHEN extra=0 AND k%13=1 THEN DATE '2001-02-01' END",
            "statusApprovedSendTrialPackage": "CASE WHEN extra=0 AND k%2=0 THEN DATE '2001-01-15' END",
            "StatusTrialToBeAccepted": "CASE WHEN extra=0 AND k%3=0 THEN DATE '2001-01-10' END",
        },
    ),
    "foreclosure_master": (
        "base",
        "k%3<>1",
        {
            "LoanId": "LoanId",
            "ScheduledSaleDt": f"CASE WHEN k%5=0 THEN {_RUN} - CAST(k%400 AS INT) END",
            "SaleDt": f"CASE WHEN k%31=0 THEN {_RUN} - CAST(k%60 AS INT) END",
        },
    ),
    "borrower_master": (
        "base",
        "true",
        {
            "LoanId": "LoanId",
            "BorrowerOneConsumerInfoCodeId": "CASE WHEN k%67=0 THEN 'X' WHEN k%67=1 THEN 'x ' ELSE 'A' END",
            "BorrowerTwoConsumerInfoCodeId": "CASE WHEN k%71=0 THEN 'X' END",
        },
    ),
    "lossmitigation_step_transpose": (
        "base",
        "k%2=0",
        {
            "LoanId": "LoanId",
            "G58_Date": "CASE WHEN k%3=0 THEN DATE '2001-05-01' END",
            "R33_Date": "CASE WHEN k%8=0 THEN DATE '2001-05-02' END",
            "L49_Date": "CASE WHEN k%9=1 THEN DATE '2001-05-03' END",
            "L50_Date": "CASE WHEN k%9=4 THEN DATE '2001-05-04' END",
            "G59_Date": "CASE WHEN k%9=7 THEN DATE '2001-05-05' END",
            "G60_Date": "CASE WHEN k%5=2 THEN DATE '2001-05-06' END",
        },
    ),
    "portfolio_summary": (
        "located",
        _STATE_WHERE,
        {"LoanId": "LoanId", "PropertyState": "'S'||CAST(n AS STRING)"},
    ),
    "property_master": (
        "located",
        _STATE_WHERE,
        {"LoanId": "LoanId", "PropertyState": "'P'||CAST(n AS STRING)"},
    ),
    "collection_commentactivity": (
        "lines",
        "true",
        {
            "LoanId": "LoanId",
            "ReasonCode": "CASE WHEN l_returnflag='R' AND l_linenumber=7 AND l_quantity<8 THEN '001' "
            "WHEN l_returnflag='A' AND l_linenumber=7 AND l_quantity<4 THEN '001 ' ELSE '01'||CAST(l_linenumber AS STRING) END",
        },
    ),
    "escrow_master": (
        "lines",
        "true",
        {
            "LoanId": "LoanId",
            "MortgageInsuranceFHASectionADPCode": "CASE WHEN l_returnflag='A' AND l_linenumber=1 AND l_quantity<5 "
            "THEN '184' WHEN l_returnflag='R' AND l_linenumber=1 AND l_quantity<3 THEN '184 ' ELSE '203' END",
        },
    ),
}

# Table -> every so many-th order key has a second row, which the joins must multiply. ``extra`` is 1 there.
REPEATED = {
    "modification_master": 97,
    "foreclosure_master": 103,
    "borrower_master": 107,
    "lossmitigation_step_transpose": 109,
    "portfolio_summary": 113,
    "property_master": 113,
}

# What the report period's month-end rows have instead of the live values, and which live rows it lacks.
SNAPSHOT_WHERE = {
    "loan_master": "LoanId%89<>0",
    "modification_master": "LoanId%83<>0",
    "foreclosure_master": "LoanId%79<>0",
    "borrower_master": "LoanId%73<>0",
}
SNAPSHOT_CHANGES = {
    "loan_master": {
        "DelinquentStatusCodeId": "CASE WHEN LoanId%13=0 THEN '2' ELSE DelinquentStatusCodeId END",
        "CurrentPrincipalBalanceAmt": "CASE WHEN LoanId%13=1 THEN CAST(25000 AS DECIMAL(18,2)) "
        "ELSE CurrentPrincipalBalanceAmt END",
        "OriginalLoanToValueRatio": "CASE WHEN LoanId%5=0 THEN CAST(0.5 AS DECIMAL(9,4)) ELSE OriginalLoanToValueRatio END",
    },
    "modification_master": {
        "StatusCurrent": "CASE WHEN LoanId%11=0 THEN 'Approved send final docs / File Prep' ELSE StatusCurrent END",
        "Verify2ndTrialPaymentReceivedDt": "CASE WHEN LoanId%11=1 THEN DATE '2001-03-02' "
        "ELSE Verify2ndTrialPaymentReceivedDt END",
    },
    "foreclosure_master": {
        "ScheduledSaleDt": "CASE WHEN LoanId%7=0 THEN DATE '2001-05-15' ELSE ScheduledSaleDt END",
        "SaleDt": "CASE WHEN LoanId%17=0 THEN DATE '2001-07-15' ELSE SaleDt END",
    },
    "borrower_master": {
        "BorrowerTwoConsumerInfoCodeId": "CASE WHEN LoanId%19=0 THEN 'X' ELSE BorrowerTwoConsumerInfoCodeId END",
    },
}

# Lookup rows. Codes 'A' and '7' are left out, so that their text is null.
LOOKUPS = {
    "ref_loanstatus": (
        ("LoanStatusId", "LoanStatusDesc"),
        (("2", "60 days"), ("3", "90 days"), ("4", "120+ days"), ("F", "Foreclosure")),
    ),
    "ref_loanpurposecode": (
        ("LoanPurposeCodeId", "LoanPurposeCodeDesc"),
        (("5", "Refinance"), ("6", "Cash-out refinance")),
    ),
}

_BASE = {
    "k": "o_orderkey",
    "c": "o_custkey",
    "p": "o_totalprice",
    "d": "CAST(o_orderdate AS DATE)",
    "LoanId": _loan_id.format("o_orderkey"),
}


def _aliased(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def _snapshot(name: str) -> list[str]:
    """The columns of a table's month-end rows of the report period, from its live ones."""
    changes = SNAPSHOT_CHANGES[name]
    return [f"{changes[column]} AS {column}" if column in changes else column for column in TABLES[name][2]]


def _lookup_values(name: str) -> str:
    columns, rows = LOOKUPS[name]
    values = ", ".join("(" + ", ".join(f"'{cell}'" for cell in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {values}) AS t({', '.join(columns)})"


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The test tables as lazy DataFrames over one test-data directory."""

    @cache
    def view(name: str) -> DataFrame:
        read = lambda file: spark.read.parquet(f"{sf_dir}/{file}.parquet")
        match name:
            case "base":
                return read("orders").selectExpr(*_aliased(_BASE))
            case "located":
                # Every order has its customer, so only the two property tables need this join.
                return view("base").join(read("customer").selectExpr("c_custkey AS c", "c_nationkey AS n"), "c")
            case "lines":
                return read("lineitem").selectExpr("*", f"{_loan_id.format('l_orderkey')} AS LoanId")

    def live(name: str) -> DataFrame:
        if name in LOOKUPS:
            return spark.sql(_lookup_values(name))
        source, where, columns = TABLES[name]
        rows = view(source).where(where)
        if name in REPEATED:
            rows = rows.selectExpr("*", f"explode(IF(k%{REPEATED[name]}=0, array(0,1), array(0))) AS extra")
        return rows.selectExpr(*_aliased(columns))

    def month_end(name: str) -> DataFrame:
        rows = tables.live(name)
        now = rows.where(SNAPSHOT_WHERE[name]).selectExpr(*_snapshot(name))
        return now.withColumn(PERIOD, F.lit(FIXTURE_PERIOD)).unionByName(
            rows.filter("LoanId%3=0").withColumn(PERIOD, F.lit(EARLIER_PERIOD))
        )

    places = {name: partial(live, name) for name in (*TABLES, *LOOKUPS)}
    places |= {f"{name}_me": partial(month_end, name) for name in SNAPSHOTS}
    tables = Tables(spark, places)
    return tables


def fixture_ctes(*names: str) -> str:
    """The same tables as common table expressions for DuckDB: a WITH clause without its query."""
    wanted = dict.fromkeys(names)
    lives = dict.fromkeys(name.removesuffix("_me") for name in wanted)
    parts = {
        "base": f"SELECT {', '.join(_aliased(_BASE))}, c_nationkey AS n "
        "FROM orders JOIN customer ON o_custkey = c_custkey",
        "located": "SELECT * FROM base",
        "lines": f"SELECT lineitem.*, {_loan_id.format('l_orderkey')} AS LoanId FROM lineitem",
    }
    for name in lives:
        if name in LOOKUPS:
            parts[name] = _lookup_values(name)
        else:
            view, where, columns = TABLES[name]
            if name in REPEATED:
                second = f"SELECT *, 1 AS extra FROM {view} WHERE k%{REPEATED[name]}=0"
                view = f"(SELECT *, 0 AS extra FROM {view} UNION ALL {second})"
            parts[name] = f"SELECT {', '.join(_aliased(columns))} FROM {view} WHERE {where}"
    for name in wanted:
        if name.endswith("_me"):
            live = name.removesuffix("_me")
            parts[name] = (
                f"SELECT {', '.join(_snapshot(live))}, {FIXTURE_PERIOD} AS {PERIOD} FROM {live} "
                f"WHERE {SNAPSHOT_WHERE[live]} "
                f"UNION ALL SELECT *, {EARLIER_PERIOD} AS {PERIOD} FROM {live} WHERE LoanId%3=0"
            )
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts.items()) + "\n"
