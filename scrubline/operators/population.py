"""Which loans a report screens."""

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.functions.derive import BALANCE_SHEET_INVESTORS, POOLED_INVESTORS
from scrubline.functions.text import Text
from scrubline.operators.reduction import IdFilter, Reduction, id_filter, reduced, words_for
from scrubline.shared import cut
from scrubline.sources.schemas import LOAN

# Codes and the smallest balance.
POOLED_DELINQUENCY = ("2", "3", "4", "F")
BALANCE_SHEET_DELINQUENCY = ("1", "2", "3", "4", "F")
OPEN_STATUSES = ("2", "3", "4", "F")
INSURED_TYPES = ("1", "2", "9")
NO_BALANCE = Decimal("0.01")


def _delinquent(text: Text, codes: Sequence[str]) -> Column:
    return text.isin(F.col("DelinquentStatusCodeId"), codes)


def _pooled(text: Text) -> Column:
    return text.between(F.col("InvestorId"), *POOLED_INVESTORS)


def _balance_sheet(text: Text) -> Column:
    return text.isin(F.col("InvestorId"), BALANCE_SHEET_INVESTORS)


def _insured_with_balance(text: Text) -> Column:
    return (F.col("CurrentPrincipalBalanceAmt") > F.lit(NO_BALANCE)) & text.isin(F.col("LoTypeId"), INSURED_TYPES)


def _current(text: Text) -> Column:
    pooled = _delinquent(text, POOLED_DELINQUENCY) & _pooled(text)
    balance_sheet = _delinquent(text, BALANCE_SHEET_DELINQUENCY) & _balance_sheet(text)
    return (pooled | balance_sheet) & _insured_with_balance(text)


def _month_end(text: Text) -> Column:
    status_open = text.isin(F.col("LoanStatusId"), OPEN_STATUSES)
    pooled = _delinquent(text, POOLED_DELINQUENCY) & _pooled(text) & status_open
    return pooled | (_balance_sheet(text) & _insured_with_balance(text))


def current_population(text: Text = Text()) -> Column:
    """Delinquent pooled or balance-sheet loans that are insured and carry a balance."""
    return text.at_scan(_current)


def month_end_population(text: Text = Text()) -> Column:
    """The month-end report's filter as AND-before-OR really binds it.

    Pooled loans are tested for delinquency and status but not for balance or type; balance-sheet loans the other way
    round. Kept as it is: the result has to match.
    """
    return text.at_scan(_month_end)


# Ids up to this number become a literal that reaches the scans; more become a DataFrame.
LITERAL_IDS = 1_000
# Distinct ids up to this number (8 MB) are sent to all tasks; more meet the loans by a shuffle that the joins reuse, and
# every other table through a filter of bounded size.
SENT_IDS = 1_000_000


@dataclass(frozen=True)
class LongList:
    """Distinct ids, stored, and the filter that stands for them at the scans of other tables than the loans."""

    ids: DataFrame
    keep: IdFilter | None


Ids = DataFrame | Sequence[int] | LongList | None


def listed_ids(spark: SparkSession, loan_ids: DataFrame | Iterable[int], reduction: Reduction = Reduction()) -> Ids:
    """The given ids once each: a short list as it is, a longer one as a DataFrame sent to all tasks, else a ``LongList``.

    A list is read here and nowhere else, so one that can be read only once serves every table. The rows of a DataFrame's own
    distinct aggregate say how long it is: no more than ``SENT_IDS`` and one of them leave the tasks.
    """
    if isinstance(loan_ids, DataFrame):
        distinct = loan_ids.select(F.col(LOAN).cast("bigint").alias(LOAN)).filter(F.col(LOAN).isNotNull()).distinct()
        some = distinct.limit(SENT_IDS + 1).toArrow()
        if some.num_rows > SENT_IDS:
            return _long_list(distinct, reduction)
        ids = some.column(LOAN).to_pylist() if some.num_rows <= LITERAL_IDS else some
    else:
        ids = sorted({i for i in loan_ids if i is not None})
    if len(ids) <= LITERAL_IDS:
        return ids
    given = ids if isinstance(ids, pa.Table) else pa.table({LOAN: pa.array(ids, pa.int64())})
    df = spark.createDataFrame(given)
    return F.broadcast(df) if len(ids) <= SENT_IDS else _long_list(df, reduction)


def _long_list(ids: DataFrame, reduction: Reduction) -> LongList:
    stored = cut(ids)
    words = words_for(stored.count(), reduction)
    return LongList(stored, None if words is None else id_filter(stored, words))


def only_loans(rows: DataFrame, ids: Ids) -> DataFrame:
    """Keeps the rows of the given loans, as ``listed_ids`` returns them."""
    if ids is None:
        return rows
    if isinstance(ids, LongList):
        return rows.join(ids.ids, LOAN, "left_semi")
    if isinstance(ids, DataFrame):
        return rows.join(ids, LOAN, "left_semi")
    return rows.filter(F.col(LOAN).isin(list(ids)))


def near_loans(rows: DataFrame, ids: Ids) -> DataFrame:
    """``only_loans`` for rows that an exact join with the loans follows: of a long list the filter is enough."""
    return reduced(rows, ids.keep) if isinstance(ids, LongList) else only_loans(rows, ids)


def without_trades(loans: DataFrame, trades: Sequence[str], text: Text = Text()) -> DataFrame:
    """Drops loans of the given trades; a loan without a trade stays."""
    if not trades:
        return loans
    return loans.filter(~text.isin(F.coalesce(F.col("TradeId"), F.lit("")), trades))
