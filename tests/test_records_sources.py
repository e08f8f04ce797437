"""Sources, sinks, record parsing, punctuated watermark, processing time."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from tidepool.operators.aggregates import min_row
from tidepool.operators.records import attach_json, parse_key_number, project_json
from tidepool.operators.windows import processing_time, tumbling
from tidepool.sinks.files import as_tuple_lines, write_text
from tidepool.sinks.topics import topic_payload
from tidepool.sources.csv import read_behaviors
from tidepool.sources.jdbc import jdbc_options
from tidepool.sources.text import read_lines
from tidepool.sources.topics import topic_options
from tidepool.streaming.punctuated import parse_marked_lines, punctuated_windows
from tidepool.streaming.runner import drain, start


def test_punctuated_watermark_drops_late_and_closes_windows(spark):
    lines = ["1000,a,5", "1500,a,3", "punctuated_2500,a,9", "1200,a,1",   # 1200 is late
             "2100,a,4", "3000,b,7", "punctuated_4100,b,8", "3500,b,2", "4500,b,6"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "seq long, line string")
    parsed = parse_marked_lines(df, "line", [("key", "string"), ("v", "long")])
    parsed = parsed.withColumn("ts", F.timestamp_millis("t_ms")).withColumn("blk", F.expr("seq div 4"))
    out = punctuated_windows(parsed, "seq", "ts", "is_marker", ["key"], "2 seconds",
                             [min_row("v", ["ts", "seq"], ["t_ms", "v"]).alias("m")], "blk")
    got = sorted((r.key, r.window.start.second, r.m.t_ms, r.m.v) for r in out.collect())
    # window [0,2) s closes at marker 2500: min of 5 and 3 (1200 arrived after, late)
    # window [2,4) s closes at marker 4100: a has 2500(9), 2100(4); b has 3000(7),
    # and b's 3500(2) arrives after that marker, so it is late
    # window [4,6) s is never closed by a marker
    assert got == [("a", 0, 1500, 3), ("a", 2, 2100, 4), ("b", 2, 3000, 7)]
    opened = punctuated_windows(parsed, "seq", "ts", "is_marker", ["key"], "2 seconds",
                                [F.count(F.lit(1)).alias("n")], "blk", emit_open=True)
    assert opened.count() == 4


def test_behaviors_csv_and_rate_limit(spark):
    d = tempfile.mkdtemp(prefix="tp-csv-")
    for i in range(3):
        with open(os.path.join(d, f"part{i}.csv"), "w") as f:
            f.write(f"{i},10{i},7,pv,151177{i}000\n{i},20{i},7,buy,151177{i}001\n")
    b = read_behaviors(spark, d)
    assert b.count() == 6
    assert dict(b.dtypes)["ts"] == "timestamp"
    s = read_behaviors(spark, d, stream=True, max_files_per_trigger=1)
    name = "beh" + os.urandom(3).hex()
    q = drain(start(s.filter("behavior = 'pv'"), sink="memory", query_name=name,
                    checkpoint=tempfile.mkdtemp(prefix="tp-ck-")))
    assert spark.table(name).count() == 3
    assert sum(1 for p in q.recentProgress if p["numInputRows"] > 0) == 3


def test_tuple_text_sink_roundtrip(spark):
    df = spark.createDataFrame([("a", 1, 1), ("b", 1, 3)], "id string, t long, n long")
    assert sorted(r.value for r in as_tuple_lines(df).collect()) == ["(a,1,1)", "(b,1,3)"]
    d = os.path.join(tempfile.mkdtemp(prefix="tp-txt-"), "out")
    write_text(df, d)
    assert sorted(r.line for r in read_lines(spark, d).collect()) == ["(a,1,1)", "(b,1,3)"]


def test_json_projection_and_rejects(spark):
    rows = [(1, '{"transaction_time": "2021-01-02 10:00", "transaction_amount": 12.50}'),
            (2, "not json"), (3, None)]
    df = spark.createDataFrame(rows, "id long, raw string")
    sch = "transaction_time string, transaction_amount decimal(38,18)"
    ok = project_json(df, "raw", sch, keep=["id"]).filter("transaction_amount is not null")
    r = ok.first()
    assert r.id == 1 and str(r.transaction_amount).rstrip("0") == "12.5"
    bad = project_json(df, "raw", sch, keep=["id"], rejects=True)
    assert sorted(r.id for r in bad.collect()) == [2, 3]
    att = attach_json(df.filter("id = 1"), "raw", ["id"]).first()
    assert att.json == '{"transaction_amount":12.50,"transaction_time":"2021-01-02 10:00"}' or \
        "transaction_amount" in att.json


def test_key_number_lines(spark):
    df = spark.createDataFrame([("a,5",), ("b,x",)], "line string")
    got = sorted((r.key, r.t) for r in parse_key_number(df, "line").collect())
    assert got == [("a", 5), ("b", None)]


def test_processing_time_window_totals(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    out = tumbling(processing_time(df), "proc_time", "5 seconds", ["k"],
                   [F.count(F.lit(1)).alias("n")])
    assert out.agg(F.sum("n")).first()[0] == 100


def test_connector_options():
    o = topic_options("h:9092", pattern="topic-[0-5]", group_id="1")
    assert o["subscribePattern"] == "topic-[0-5]" and o["startingOffsets"] == "latest"
    assert topic_options("h:9092", topic="t")["subscribe"] == "t"
    with pytest.raises(ValueError):
        topic_options("h:9092")
    j = jdbc_options("jdbc:x", query="select a, b from t", partition_column="a",
                     lower_bound=0, upper_bound=100, num_partitions=4)
    assert j["dbtable"].startswith("(select a, b from t)") and j["numPartitions"] == "4"
    assert jdbc_options("jdbc:x", table="t")["dbtable"] == "t"


def test_topic_payload_columns(spark):
    df = spark.createDataFrame([(1, "x")], "k long, line string")
    assert topic_payload(df, "line", "k").columns == ["key", "value"]
