"""The shared folder: found in the session, refused where executors could not see it, cleaned up."""

from types import SimpleNamespace

import pytest

from scrubline.shared import bounded, cut, fresh_dir, remove, shared_dir


def session(master, **settings):
    conf = SimpleNamespace(get=lambda key: settings.get(key.replace(".", "_")))
    context = SimpleNamespace(getConf=lambda: conf, getCheckpointDir=lambda: None, master=master)
    return SimpleNamespace(sparkContext=context)


def test_the_named_folder_is_used():
    assert shared_dir(session("yarn", spark_checkpoint_dir="hdfs://x/y")) == "hdfs://x/y"


def test_a_cluster_without_a_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("yarn"))


def test_stored_rows(spark):
    path = fresh_dir(spark, "rows")
    assert path != fresh_dir(spark, "rows") and path.startswith(shared_dir(spark))
    rows = spark.range(10).repartition(3)
    rows.write.parquet(path)
    assert spark.read.parquet(path).count() == 10
    remove(spark, path)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
    kept = cut(rows.filter("id > 4"))
    assert sorted(r[0] for r in kept.collect()) == [5, 6, 7, 8, 9]
    assert "Exchange" not in kept._jdf.queryExecution().toString()


def test_only_counted_tables_are_broadcast(spark):
    left = spark.range(100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [left.join(bounded(spark.range(10), n), "id")._jdf.queryExecution().toString() for n in (10, 9)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plans[0] and "Broadcast" not in plans[1]
