"""The hash tree against plain Python; balance, movement, slots."""

import math
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from scrubline.llm import shard_tree as st
from scrubline.llm.queries import QUERIES
from scrubline.llm.shard_tree import Leaf


def spark_hash(*values):
    """Spark's chained xxhash64 of longs and strings."""
    seed = 42
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True) if isinstance(v, int) else v.encode(), seed)
    return seed


def plain_shard(key, tree):
    leaves = [x for x in tree if x.weight > 0]
    for level, name in (("region", lambda x: x.region), ("rack", lambda x: f"{x.region}/{x.rack}"), ("shard", lambda x: str(x.shard))):
        groups = {}
        for x in leaves:
            groups.setdefault(name(x), []).append(x)
        draw = lambda c: math.log(((spark_hash(key, level, c) >> 11) + 1) / 2**53) / sum(x.weight for x in groups[c])
        leaves = groups[max(groups, key=draw)]
    return leaves[0].shard


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query(spark, scale):
    sf = f"/root/testdata/{scale}"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op9_sharding"](spark, sf).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(docs))
    tree = st.even_tree(16)
    for r in rows:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law) == (len(raw) + 1, zlib.crc32(raw), "key")
        assert r.shard == plain_shard(r.doc_id, tree)
        assert r.grown_shard == plain_shard(r.doc_id, st.grown(tree)) and r.grown_shard in (r.shard, 16)
    for shard in range(16):
        own = sorted(r.slot for r in rows if r.shard == shard)
        assert own == list(range(len(own)))


def test_weights_and_movement(spark):
    keys = spark.range(60_000).withColumnRenamed("id", "doc_id")
    tree = (Leaf("a", "r1", 0, 1), Leaf("a", "r1", 1, 2), Leaf("a", "r2", 2, 1), Leaf("b", "r1", 3, 4), Leaf("b", "r2", 4, 0))
    counts = {r["shard"]: r["count"] for r in st.with_shard(keys, tree).groupBy("shard").count().collect()}
    assert set(counts) == {0, 1, 2, 3}
    for shard, weight in ((0, 1), (1, 2), (2, 1), (3, 4)):
        assert counts[shard] == pytest.approx(60_000 * weight / 8, rel=0.05)
    # A weight changed inside region a moves rows only into its subtree, and nothing between others.
    heavier = tuple(Leaf(x.region, x.rack, x.shard, 2 if x.shard == 2 else x.weight) for x in tree)
    both = keys.select(st.shard_of(F.col("doc_id"), tree).alias("old"), st.shard_of(F.col("doc_id"), heavier).alias("new"))
    moved = {(r.old, r.new) for r in both.filter("old != new").distinct().collect()}
    assert (3, 2) in moved and not any(new == 3 for _, new in moved) and (0, 1) not in moved and (1, 0) not in moved
    new = keys.select(st.shard_of(F.col("doc_id"), tree).alias("old"), st.shard_of(F.col("doc_id"), st.grown(tree)).alias("new"))
    assert {r.new for r in new.filter("old != new").distinct().collect()} == {5}


def test_edges(spark, documents):
    rows = [(1, None), (2, ""), (3, "x"), (3, "x"), (3, "x"), (None, "y"), (None, "y"), (4, "é" * 100_000)]
    docs = documents(rows).withColumns({"shard": F.lit("mine"), "slot": F.lit(0), "law": F.lit(1)})
    found = st.report(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in found) == Counter((d, len((t or "").encode()) + 1) for d, t in rows)
    for shard in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert st.report(documents([])).collect() == []
    with pytest.raises(ValueError):
        st.shard_of(F.col("doc_id"), (Leaf("a", "b", 0, 0),))
    with pytest.raises(ValueError):
        st.shard_of(F.col("doc_id"), (Leaf("a", "b", 0), Leaf("a", "c", 0)))


def test_slots_over_many_cells(spark):
    rows = spark.range(5000).select((F.col("id") % 3).cast("int").alias("shard"), F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("doc_id"))
    found = st.with_slots(rows, cell_rows=100).collect()
    for shard in range(3):
        own = sorted(r.slot for r in found if r.shard == shard)
        assert own == list(range(len(own)))
    assert Counter((r.shard, r.doc_id) for r in found) == Counter((r.shard, r.doc_id) for r in rows.collect())
    again = st.with_slots(rows.repartition(5), cell_rows=100).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, found))


def test_written_shards(spark, documents, tmp_path):
    docs = documents(["a", "b", None, "d"])
    st.write(docs, st.even_tree(4), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text, r.shard) for r in back.collect()) == Counter((r.doc_id, r.text, r.shard) for r in st.with_shard(docs, st.even_tree(4)).collect())


def test_very_many_equal_rows_and_none(spark, documents):
    """A quarter of a million rows without id and text: gapless slots, made without one array of all."""
    rows = spark.range(250_000).selectExpr("cast(null as bigint) as doc_id", "cast(null as string) as text", "'x' as slot", "1 as shard")
    found = st.report(rows).agg(F.count("*"), F.countDistinct("slot"), F.min("slot"), F.max("slot"), F.countDistinct("shard")).first()
    assert tuple(found) == (250_000, 250_000, 0, 249_999, 1)
    assert st.report(documents([])).collect() == []
