"""Column functions on hand-written rows: dates, text, rates, stages."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from scrubline.functions import derive, periods
from scrubline.functions.text import Text


def one(spark, column):
    return spark.range(1).select(column.alias("v")).collect()[0]["v"]


@pytest.mark.parametrize(
    ("as_of", "me_period", "date_key", "two_back", "three_back", "one_back"),
    [
        ("2001-08-31", 200107, 20010731, "2001-06-01", "2001-05-01", "2001-07-01"),
        ("2024-03-31", 202402, 20240229, "2024-01-01", "2023-12-01", "2024-02-01"),
        ("2024-02-29", 202401, 20240131, "2023-12-01", "2023-11-01", "2024-01-01"),
        ("2023-01-31", 202212, 20221231, "2022-11-01", "2022-10-01", "2022-12-01"),
        ("2023-01-01", 202212, 20221231, "2022-11-01", "2022-10-01", "2022-12-01"),
        ("2022-12-15", 202211, 20221130, "2022-10-01", "2022-09-01", "2022-11-01"),
    ],
)
def test_periods(spark, as_of, me_period, date_key, two_back, three_back, one_back):
    day = F.lit(dt.date.fromisoformat(as_of))
    iso = lambda column: one(spark, column).isoformat()
    assert one(spark, periods.me_period(day)) == me_period
    assert one(spark, periods.date_key(day)) == date_key
    assert iso(periods.month_start(day)) == as_of[:8] + "01"
    assert iso(periods.sale_cutoff_current(day)) == two_back
    assert iso(periods.sale_cutoff_month_end(day)) == three_back
    assert iso(periods.next_due_cutoff_pooled(day)) == three_back
    assert iso(periods.next_due_cutoff_balance_sheet(day)) == one_back


def test_periods_fold_to_literals(spark):
    folded = spark.range(1).select(periods.me_period(F.lit(dt.date(2001, 8, 31))).alias("v"))
    assert "[200107 AS v" in folded._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(
    ("note", "run", "months"),
    [
        ("2001-07-31", "2001-08-01", 1),
        ("2001-08-01", "2001-08-31", 0),
        ("2000-12-31", "2001-01-01", 1),
        ("1999-08-31", "2001-08-01", 24),
        ("2001-09-01", "2001-08-31", -1),
    ],
)
def test_age_counts_month_boundaries(spark, note, run, months):
    age = derive.loan_age(F.lit(dt.date.fromisoformat(note)), F.lit(dt.date.fromisoformat(run)))
    assert one(spark, age) == months


@pytest.mark.parametrize(
    ("investor", "pooled"),
    [
        ("400", True), ("498", True), ("45", True), ("4000", True), ("498  ", True), ("40z", True),
        ("499", False), ("4980", False), ("399", False), ("4", False), ("40", False), ("", False), (None, None),
    ],
)
def test_investor_text_range(spark, investor, pooled):
    value = F.lit(investor).cast("string")
    assert one(spark, derive.is_pooled(value)) is pooled
    # The wider test for the scan must not change the answer.
    assert one(spark, Text().at_scan(lambda text: derive.is_pooled(value, text))) is pooled


@pytest.mark.parametrize("case_sensitive", [False, True])
@pytest.mark.parametrize("value", ["F", "f", "F  ", "f ", " F", "FF", "2", "2 ", "22", "", None])
def test_isin_at_scan_equals_isin(spark, value, case_sensitive):
    text, codes = Text(case_sensitive), ("2", "F")
    column = F.lit(value).cast("string")
    plain = one(spark, text.isin(column, codes))
    assert one(spark, text.at_scan(lambda t: t.isin(column, codes))) is plain
    spelled = {None: None, "F": True, "F  ": True, "2": True, "2 ": True}
    if value in ("f", "f "):
        assert plain is not case_sensitive
    else:
        assert plain is spelled.get(value, False)


def test_text_spellings_cover_mixed_case(spark):
    for value in ("hafs", "HAFS", "HaFs "):
        assert one(spark, Text().wide_isin(F.lit(value), ("HAFS",))) is True


def test_text_template(spark):
    assert one(spark, Text().contains(F.lit("FHA MOD"), "mod")) is True
    assert one(spark, Text(case_sensitive=True).contains(F.lit("FHA MOD"), "mod")) is False
    assert one(spark, Text().differs(F.lit("0 "), "0")) is False


@pytest.mark.parametrize(
    ("rate", "fee", "pass_through", "service_fee"),
    [
        # On the half-percent grid binary arithmetic would give 0.030.
        ("0.0375", "0.0019", "0.035", "0.0025"),
        ("0.0375", None, "0.035", "0.0025"),
        ("0.0400", "0.0025", "0.035", "0.005"),
        ("0.0400", "0.0044", "0.035", "0.005"),
        ("0.0450", "0.0100", "0.040", "0.005"),
        ("0.0412", "0.0024", "0.035", "0.0062"),
        ("0.0010", "0.0044", "-0.005", "0.006"),
        (None, "0.0044", None, None),
    ],
)
def test_buyout_rates(spark, rate, fee, pass_through, service_fee):
    rate_column = F.lit(rate).cast("decimal(9,6)")
    found = derive.pass_through_rate(rate_column, F.lit(fee).cast("decimal(9,6)"))
    expect = lambda v: None if v is None else Decimal(v)
    assert one(spark, found) == expect(pass_through)
    assert one(spark, derive.service_fee_at_buyout(rate_column, found)) == expect(service_fee)


@pytest.mark.parametrize(("fee", "warned"), [("0.00625", False), ("0.006251", True), ("0", False), (None, False)])
def test_service_fee_check(spark, fee, warned):
    column = derive.service_fee_check(F.lit(fee).cast("decimal(9,6)"))
    assert one(spark, column) == ("Warning - High SFee" if warned else "")


@pytest.mark.parametrize(
    ("code", "label"), [("1", "FHA"), ("2", "VA"), ("9", "USDA"), ("9 ", "USDA"), ("3", None), ("01", None), (None, None)]
)
def test_loan_type(spark, code, label):
    assert one(spark, derive.loan_type(F.lit(code).cast("string"))) == label


@pytest.mark.parametrize(
    ("investor", "label"),
    [("450", "GNMA"), ("025", "Balance Sheet"), ("027 ", "Balance Sheet"), ("25", "UNKNOWN"), (None, "UNKNOWN")],
)
def test_source_label(spark, investor, label):
    assert one(spark, derive.source_label(F.lit(investor).cast("string"))) == label


STAGE_COLUMNS = {
    "LossMitStatusCodeid": "string",
    "LossMitTemplateId": "string",
    "StatusCurrent": "string",
    "StatusCompleted": "date",
    "StatusFinalDocumentsToBeReceived": "date",
    "StatusFinalDocumentsReceivedInReview": "date",
    "Verify4thTrialPaymentReceivedDt": "date",
    "Verify3rdTrialPaymentReceivedDt": "date",
    "Verify2ndTrialPaymentReceivedDt": "date",
    "VerifyFirstTrialPaymentReceivedDt": "date",
    "statusApprovedSendTrialPackage": "date",
    "StatusTrialToBeAccepted": "date",
}
DAY = dt.date(2001, 5, 1)
OPEN = {"LossMitStatusCodeid": "A", "LossMitTemplateId": "FHAMOD"}
FINAL, THIRD, SECOND, FIRST, OFFERED = (
    "Final Mod Processing",
    "3rd Trial Payment Received",
    "2nd Trial Payment Received",
    "1st Trial Payment Received",
    "Trial Offered",
)
STAGE_CASES = [
    ({"LossMitStatusCodeid": "C", "LossMitTemplateId": "fhaMod", "StatusCompleted": dt.date(2001, 8, 2)}, FINAL),  # 29
    ({"LossMitStatusCodeid": "C", "LossMitTemplateId": "fhaMod", "StatusCompleted": dt.date(2001, 8, 1)}, ""),  # 30
    ({"LossMitStatusCodeid": "c ", "LossMitTemplateId": "MOD", "StatusCompleted": dt.date(2001, 9, 9)}, FINAL),
    ({"LossMitStatusCodeid": "C", "LossMitTemplateId": "FHAMOD"}, ""),  # completion date missing
    ({"LossMitStatusCodeid": "R", "LossMitTemplateId": "FHAMOD", "StatusCompleted": dt.date(2001, 8, 30)}, ""),
    ({"StatusFinalDocumentsToBeReceived": DAY}, ""),  # no status at all
    ({"LossMitStatusCodeid": "A", "LossMitTemplateId": "HAFS", "StatusFinalDocumentsToBeReceived": DAY}, ""),
    ({"LossMitStatusCodeid": "C", "StatusFinalDocumentsToBeReceived": DAY}, FINAL),  # template missing: goes on
    ({"LossMitStatusCodeid": "R", "StatusTrialToBeAccepted": DAY}, OFFERED),
    (OPEN | {"StatusFinalDocumentsToBeReceived": DAY, "Verify3rdTrialPaymentReceivedDt": DAY}, FINAL),
    (OPEN | {"StatusFinalDocumentsReceivedInReview": DAY}, FINAL),
    (OPEN | {"StatusCurrent": "final docs received - pending corrections "}, FINAL),
    (OPEN | {"StatusCurrent": "Open", "Verify4thTrialPaymentReceivedDt": DAY}, THIRD),
    (OPEN | {"Verify3rdTrialPaymentReceivedDt": DAY, "Verify2ndTrialPaymentReceivedDt": DAY}, THIRD),
    (OPEN | {"Verify2ndTrialPaymentReceivedDt": DAY, "VerifyFirstTrialPaymentReceivedDt": DAY}, SECOND),
    (OPEN | {"VerifyFirstTrialPaymentReceivedDt": DAY, "statusApprovedSendTrialPackage": DAY}, FIRST),
    (OPEN | {"statusApprovedSendTrialPackage": DAY}, OFFERED),
    (OPEN | {"StatusTrialToBeAccepted": DAY}, OFFERED),
    (OPEN, None),  # nothing matches: null, not ''
]


def with_stage(df, as_of):
    own = {"FinishedLately": derive.finished_lately(F.lit(as_of)), "WorkflowStage": derive.workflow_stage()}
    return df.withColumns(own).withColumn("stage", derive.modification_stage())


def test_modification_stage(spark):
    schema = "i int, " + ", ".join(f"{c} {t}" for c, t in STAGE_COLUMNS.items())
    rows = [(i, *[case.get(c) for c in STAGE_COLUMNS]) for i, (case, _) in enumerate(STAGE_CASES)]
    staged = with_stage(spark.createDataFrame(rows, schema), dt.date(2001, 8, 31)).select("i", "stage")
    found = {row["i"]: row["stage"] for row in staged.collect()}
    assert found == {i: stage for i, (_, stage) in enumerate(STAGE_CASES)}


def test_final_document_texts(spark):
    texts = [
        *derive.FINAL_DOCUMENT_STATUSES,
        "FINAL DOCUMENTS RECEIVED - IN REVIEW",
    ]
    schema = ", ".join(f"{c} {t}" for c, t in STAGE_COLUMNS.items())
    rows = [tuple((OPEN | {"StatusCurrent": t}).get(c) for c in STAGE_COLUMNS) for t in texts]
    df = with_stage(spark.createDataFrame(rows, schema), DAY)
    assert [row["stage"] for row in df.collect()] == [FINAL] * len(texts)


def test_service_fee_keeps_the_rates_digits(spark):
    """A fee just under the limit is not rounded up to it, and agrees with the check beside it."""
    rows = spark.sql("SELECT CAST('0.03124996' AS DECIMAL(11,8)) AS rate, CAST(0.005 AS DECIMAL(9,6)) AS fee UNION ALL SELECT CAST('0.03125001' AS DECIMAL(11,8)), CAST(0.005 AS DECIMAL(9,6))")
    through = derive.pass_through_rate(F.col("rate"), F.col("fee"))
    fee = derive.service_fee_at_buyout(F.col("rate"), through, rows.schema["rate"].dataType)
    checked = rows.select(fee.alias("fee"), derive.service_fee_check(F.col("rate") - through).alias("warning")).orderBy("fee")
    assert dict(checked.dtypes)["fee"] == "decimal(11,8)"
    assert [tuple(r) for r in checked.collect()] == [(Decimal("0.00624996"), ""), (Decimal("0.00625001"), derive.HIGH_FEE_WARNING)]
