"""Helpers shared by the operators: tables, names, and checkpoints in the shared folder."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scrubline.shared import bounded, cut, fresh_dir, remove, shared_dir

__all__ = ["BLANKS", "WORD", "arrow_map", "bounded", "cut", "exploded", "fresh_dir", "in_blocks", "remove", "shared_dir", "shielded", "table", "unsigned"]

# What separates words, and a word, as the contracts spell them. Both work in Java's and Python's regex.
BLANKS = r"\x20\x09-\x0D"
WORD = rf"[^{BLANKS}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The bytes of an Arrow batch. Counted in rows alone, a batch of long texts can pass Arrow's 2 GB and an executor's memory.
_BATCH_BYTES = 8 << 20


def arrow_map(df: DataFrame, function: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, unless the session sets a bound of its own."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(key, None) is None:
        conf.set(key, str(_BATCH_BYTES))
    return df.mapInArrow(function, schema)


# Rows that are made from one row in one array.
_ARRAY_ROWS = 10_000


def exploded(df: DataFrame, name: str, first: Column, count: Column) -> DataFrame:
    """Each row ``count`` times (1 or more) with the numbers from ``first`` on, in two steps: no array holds more than ten
    thousand of them, however many there are."""
    part, last = F.col("__part"), first + count
    parts = df.withColumn("__part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((count - 1) / _ARRAY_ROWS))))
    begin = first + part * _ARRAY_ROWS
    return parts.withColumn(name, F.explode(F.sequence(begin, F.least(begin + _ARRAY_ROWS, last) - 1))).drop("__part")


# Keys of large groups up to this number are sent to all tasks.
_SENT_KEYS = 500_000


def in_blocks(rows: DataFrame, key: str, member: str, most: int) -> DataFrame:
    """``rows`` (stored ones: they are read several times) with new keys, so that a key has about ``most`` rows at most and any
    two members of one old key still meet under a new one.

    Members of a larger group are dealt by hash into blocks of half that size, and every pair of blocks is a key, so a row
    is repeated once per block. Rows must be distinct; a group's size is counted map-side.
    """
    large = cut(rows.groupBy(key).agg(F.ceil(2 * F.count("*") / most).alias("__blocks")).filter(F.col("__blocks") > 2))
    if large.isEmpty():
        return rows
    large = bounded(large, _SENT_KEYS)
    own = F.pmod(F.xxhash64(member), F.col("__blocks"))
    dealt = rows.join(large, key).withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__blocks") - 1)))
    paired = F.xxhash64(key, F.least("__own", "__other"), F.greatest("__own", "__other"))
    return rows.join(large, key, "left_anti").unionByName(dealt.withColumn(key, paired).select(rows.columns))


def unsigned(value: Column) -> Column:
    """A 64-bit value as 16 lowercase hex digits."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def shielded(df: DataFrame, used: Sequence[str], made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Applies ``made`` while columns outside ``used`` carry names that clash with nothing; returns df's columns only."""
    hidden = {name: f"__kept_{i}" for i, name in enumerate(df.columns) if name not in used}
    back = [F.col(hidden.get(name, name)).alias(name) for name in df.columns]
    return made(df.withColumnsRenamed(hidden)).select(back)
