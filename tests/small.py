"""A small set of input tables built from one complete, eligible loan and changes to it."""

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.sources.schemas import TABLE_NAMES, schema
from scrubline.sources.tables import Tables

AS_OF = dt.date(2001, 8, 31)
PERIOD = 200107

# Passes every rule in both variants.
GOOD_LOAN = {
    "TradeId": "T1",
    "LoTypeId": "1",
    "RunDt": AS_OF,
    "NoteDt": dt.date(2000, 1, 1),
    "LoanStatusId": "3",
    "CurrentPrincipalBalanceAmt": Decimal("30000.00"),
    "CurrentInterestRate": Decimal("0.0275"),
    "FirstServiceFeeRt": Decimal("0.0044"),
    "FHA_DebentureRt": Decimal("0.01"),
    "ARMFlag": "N",
    "InvestorId": "450",
    "DelinquentStatusCodeId": "3",
    "DelinquentPaymentCount": 3,
    "InterestPaidToDt": dt.date(2001, 4, 1),
    "NextPaymentDueDt": dt.date(2001, 5, 1),
    "PayoffStopCodeId": "0",
    "NativeAmericanLoanFlag": "0",
    "LoanPurposeCodeId": "1",
    "OriginalLoanToValueRatio": Decimal("0.80"),
}


def small_tables(spark, rows: dict[str, list[dict]]) -> Tables:
    """Tables from rows by table name; month-end tables not given hold the live rows under the period."""
    places = {}
    for name in TABLE_NAMES:
        given = rows.get(name)
        if given is None and name.endswith("_me"):
            given = [row | {"MEPeriod": PERIOD} for row in rows.get(name.removesuffix("_me"), [])]
        fields = schema(name)
        data = [{f.name: row.get(f.name) for f in fields} for row in given or []]
        places[name] = spark.createDataFrame(pa.Table.from_pylist(data, to_arrow_schema(fields)))
    return Tables(spark, places)


def loan(loan_id, **changes) -> dict:
    return GOOD_LOAN | {"LoanId": loan_id} | changes
