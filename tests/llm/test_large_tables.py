"""What is sent to all tasks while small is joined by a shuffle when large: the same rows either way."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from scrubline.llm import kneser_ney, mixing, risk_rules, shard_tree
from scrubline.llm.common import cut
from scrubline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def rows(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize(
    ("module", "query"),
    [(mixing, "op6_mixing"), (kneser_ney, "op7_quality_classifier"), (shard_tree, "op9_sharding"), (risk_rules, "op10_quality_rules")],
    ids=lambda x: x if isinstance(x, str) else "",
)
def test_without_broadcasts(spark, monkeypatch, module, query):
    sent = rows(QUERIES[query](spark, SF))
    monkeypatch.setattr(module, "bounded", lambda df, _: cut(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(QUERIES[query](spark, SF)) == sent
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_filtered_tables_without_broadcasts(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source")))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    makers = [lambda: kneser_ney.accepted(docs, labels), lambda: mixing.mixed(docs)]
    sent = [rows(make()) for make in makers]
    for module in (kneser_ney, mixing):
        monkeypatch.setattr(module, "bounded", lambda df, _: cut(df))
    assert [rows(make()) for make in makers] == sent
