"""Semi-join reduction: rows of loans that are not screened leave a table at its scan, before it is shuffled.

The ids of the screened loans become a Bloom filter whose blocks are single 64-bit words: an id sets four bits of one word, so a
probe is one hash join on the word's number and one mask. A filter passes some rows that it need not, never the
other way round, and the join that follows is exact. Its size is bounded whatever the number of ids; where that leaves too few
bits to tell ids apart, or where most loans are screened anyway, there is no filter.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scrubline.shared import cut
from scrubline.sources.schemas import LOAN

_WORD_BITS = 64
_PROBES = 4
# Fewer bits than this per id pass nearly everything.
_LEAST_BITS = 4


@dataclass(frozen=True)
class Reduction:
    """The share of the loans up to which a filter is worth its scan, its bits per id, and the most words (16 bytes each as
    rows) that are sent to all tasks, once for each of up to nine row sets."""

    most_share: float = 0.25
    bits_per_id: int = 12
    most_words: int = 1 << 19


@dataclass(frozen=True)
class IdFilter:
    """(word, bits) of a filter of so many words."""

    rows: DataFrame
    words: int


def _word(words: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), LOAN), F.lit(words))


def _mask() -> Column:
    hashed, one = F.xxhash64(F.lit(2), LOAN), F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(_PROBES)]
    return reduce(Column.bitwiseOR, bits)


def words_for(ids: int, reduction: Reduction) -> int | None:
    """Words of a filter for so many ids, a power of two; None if the most words are too few for them."""
    words = 1
    while words * _WORD_BITS < ids * reduction.bits_per_id and words < reduction.most_words:
        words *= 2
    return words if words * _WORD_BITS >= ids * _LEAST_BITS else None


def id_filter(loans: DataFrame, words: int) -> IdFilter:
    """The filter of the loans' ids, built map-side and stored, at most ``words`` rows."""
    bits = loans.filter(F.col(LOAN).isNotNull()).select(_word(words).alias("word"), _mask().alias("bit"))
    return IdFilter(cut(bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))), words)


def screening_filter(everything: DataFrame, screened: Column, loans: DataFrame, reduction: Reduction | None) -> IdFilter | None:
    """A filter of ``loans``, which are those of ``everything`` that pass ``screened`` or fewer; None where it would not pay."""
    if reduction is None:
        return None
    row = everything.agg(F.count("*").alias("all"), F.count_if(screened).alias("some")).first()
    words = words_for(row["some"], reduction) if row["some"] <= reduction.most_share * row["all"] else None
    return None if words is None else id_filter(loans, words)


def reduced(rows: DataFrame, keep: IdFilter | None) -> DataFrame:
    """``rows`` without (nearly all) those of loans that the filter does not hold."""
    if keep is None:
        return rows
    word = F.broadcast(keep.rows)
    passes = (_word(keep.words) == F.col("word")) & (F.col("bits").bitwiseAND(_mask()) == _mask())
    return rows.join(word, passes, "left_semi")
