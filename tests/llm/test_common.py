"""Batches of long texts stay bounded in bytes; hidden columns come back."""

import pyarrow as pa
from pyspark.sql import functions as F

from scrubline.llm.common import arrow_map, in_blocks, shielded


def test_batches_are_bounded_in_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    texts = spark.range(0, 6000, 1, 1).select(F.repeat(F.lit("abcdefghij"), 1000).alias("text"))
    spark.conf.unset(key)
    rows = arrow_map(texts, sizes, "rows bigint, bytes bigint").collect()
    assert sum(r.rows for r in rows) == 6000 and max(r.bytes for r in rows) < 9 << 20
    # A bound of the session's own is kept.
    spark.conf.set(key, str(1 << 20))
    try:
        assert max(r.bytes for r in arrow_map(texts, sizes, "rows bigint, bytes bigint").collect()) < 2 << 20
        assert spark.conf.get(key) == str(1 << 20)
    finally:
        spark.conf.unset(key)


def test_shielded_columns_come_back(spark):
    df = spark.createDataFrame([(1, "a", 2, 3)], "doc_id int, text string, size int, times int")
    made = shielded(df, ("doc_id", "text"), lambda d: d.withColumns({"size": F.lit("mine"), "times": F.lit("mine")}))
    assert made.columns == df.columns and tuple(made.first()) == (1, "a", 2, 3)


def test_blocks_bound_groups_and_keep_all_meetings(spark):
    """A group of 2,000 under a limit of 100: no new key has many more, and every two members meet; small groups stay."""
    rows = spark.range(2000).selectExpr("7L as key", "id as member").unionByName(spark.range(60).selectExpr("id div 30 as key", "id as member"))
    dealt = in_blocks(rows, "key", "member", 100)
    assert dealt.columns == ["key", "member"]
    groups = [r.m for r in dealt.groupBy("key").agg(F.collect_list("member").alias("m")).collect()]
    assert max(map(len, groups)) <= 200 and all(len(g) == len(set(g)) for g in groups)
    met = {(a, b) for g in groups if len(g) > 30 for a in g for b in g if a < b}
    assert len(met) == 2000 * 1999 // 2
    assert sorted(sorted(g) for g in groups if len(g) == 30) == [list(range(30)), list(range(30, 60))]
    assert in_blocks(rows, "key", "member", 5000).exceptAll(rows).count() == 0
