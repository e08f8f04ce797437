"""Plan properties the queries rely on at scale (read from the executed plans)."""

import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from tidepool.operators.sequence import running_total
from tidepool.operators.sequences import count_window
from tidepool.operators.windows import split_sessions

Q = entry.queries()


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_items_pushdown_pruning_and_partial_top_n(spark):
    plan = _plan(Q["hot_items"](spark, SF_SMALL))
    assert "EqualTo(event_type,view)" in plan                 # filter reaches the scan
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string,props:string>" in plan
    assert "WindowGroupLimit" in plan and "Partial" in plan     # top 5 before the exchange
    assert "partial_count" in plan                              # panes pre-aggregated


def test_word_count_partial_aggregation(spark):
    plan = _plan(Q["word_count"](spark, SF_SMALL))
    assert "partial_count" in plan
    assert "ReadSchema: struct<text:string>" in plan


def test_lookup_broadcasts_small_dimension(spark):
    plan = _plan(Q["broadcast_lookup"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan


@pytest.fixture
def no_coalesce(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def _hot(spark, n=20000):
    rnd = random.Random(1)
    rows = [(0 if rnd.random() < 0.4 else rnd.randint(1, 500), i, rnd.randint(1, 9)) for i in range(n)]
    return (spark.createDataFrame(rows, "k int, t long, v long")
            .withColumn("ts", F.timestamp_seconds(F.col("t") * 60))
            .withColumn("blk", F.expr("t div 500")))


def _tasks_for_hot_key(df, col):
    # keep the computed column so the operator is not pruned away
    rows = df.filter("k = 0").select(F.spark_partition_id().alias("p"), col).collect()
    return len({r.p for r in rows})


def test_hot_key_is_split_across_tasks(spark, no_coalesce):
    df = _hot(spark)
    split = running_total(df, ["k"], ["t"], [["blk"]], "v", "rt")
    plain = running_total(df, ["k"], ["t"], [], "v", "rt")
    assert _tasks_for_hot_key(plain, "rt") == 1
    assert _tasks_for_hot_key(split, "rt") > 4
    cw = count_window(df, ["k"], ["t"], 5, 3, "v", [["blk"]])
    assert _tasks_for_hot_key(cw, "window_sum") > 4
    ss = split_sessions(df, ["k"], "ts", "90 seconds", {"n": ("count", F.lit(1))},
                        block_unit="hour")
    assert ss.filter("k = 0").agg(F.sum("n")).first()[0] == df.filter("k = 0").count()
    assert _tasks_for_hot_key(ss, "n") > 4
