"""Cases worked by hand."""

from pyspark.sql import functions as F

from tidepool.operators.aggregates import first_value
from tidepool.operators.delta import delta_trigger_split
from tidepool.operators.lookup import broadcast_lookup, last_per_key
from tidepool.operators.records import counted, parse_tuples, tuple_text
from tidepool.operators.sequences import delta_trigger_max, every_n_average
from tidepool.operators.windows import sessions


def test_sessions_gap_3ms(spark):
    rows = [("a", 1, 1), ("b", 1, 1), ("b", 3, 1), ("b", 5, 1),
            ("c", 6, 1), ("a", 10, 1), ("c", 11, 1)]
    df = (spark.createDataFrame(rows, "id string, t_ms long, n int")
          .withColumn("ts", F.timestamp_millis("t_ms")))
    out = sessions(df, ["id"], "ts", 3,
                   [first_value("t_ms", ["t_ms"]).alias("t_ms"), F.sum("n").alias("n")])
    got = {(r.id, r.t_ms, r.n) for r in out.collect()}
    assert got == {("a", 1, 1), ("c", 6, 1), ("c", 11, 1), ("b", 1, 3), ("a", 10, 1)}
    text = {r[0] for r in out.select(tuple_text(["id", "t_ms", "n"])).collect()}
    assert text == {"(a,1,1)", "(c,6,1)", "(c,11,1)", "(b,1,3)", "(a,10,1)"}


def test_top_speeds_by_hand(spark):
    lines = ["(0,50,0.0,1000)", "(0,70,30.0,2000)", "(0,60,51.0,3000)", "(0,60,101.0,4000)", "(0,90,102.0,5000)",
             "(1,10,5.0,1000)", "(1,20,56.0,12000)", "(1,20,57.0,13000)", "(1,5,200.0,14000)"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(lines)], "line_no int, line string")
    cars = parse_tuples(df, "line", ["car", "speed", "distance", "t_ms"], ["int", "int", "double", "long"])
    cars = cars.withColumn("ts", F.timestamp_millis("t_ms"))
    # the mark is set at 0 and 5; 51 and 102 are the firings of car 0, 56 and 200 of car 1
    want = [(0, 3000, 70, 2000), (0, 5000, 90, 5000), (1, 12000, 20, 12000), (1, 14000, 20, 12000)]
    args = ("car", "ts", ["t_ms"], "distance", "speed", 50, "10 seconds", ["speed", "t_ms"])
    for out in (delta_trigger_max(cars, *args), *(delta_trigger_split(cars, *args, blocks=[], chunk_rows=n)
                                                  for n in (1, 2, 3, 100))):
        assert sorted((r.car, r.fire_t_ms, r.speed, r.t_ms) for r in out.collect()) == want


def test_every_n_average_pairs(spark):
    df = spark.createDataFrame([(1, 3, 1), (1, 5, 2), (1, 7, 3), (1, 4, 4), (1, 2, 5)],
                               "k long, v long, seq int")
    two = every_n_average(df, ["k"], ["seq"], "v", 2, [])
    assert sorted((r.k, r.average) for r in two.collect()) == [(1, 4), (1, 5)]
    three = every_n_average(df, ["k"], ["seq"], "v", 3, [])
    assert [(r.k, r.average) for r in three.collect()] == [(1, 5)]


def test_every_n_average_truncates_toward_zero(spark):
    df = spark.createDataFrame([(1, -3, 1), (1, -4, 2)], "k long, v long, seq int")
    assert every_n_average(df, ["k"], ["seq"], "v", 2, []).first().average == -3


def test_broadcast_lookup_text_and_missing_key(spark):
    dim = spark.createDataFrame([("pear", 1), ("plum", 2), ("fig", 3)], "name string, value int")
    data = spark.createDataFrame([("pear",), ("plum",), ("fig",), ("X",)], "name string")
    out = broadcast_lookup(data, dim, "name", "name", "value", out="v", text="line")
    assert {r.line for r in out.collect()} == {
        "pear ---> 1", "plum ---> 2", "fig ---> 3", "X ---> null"}
    out2 = broadcast_lookup(data, dim, "name", "name", "value", out="v", text="line", broadcast=True)
    assert {r.line for r in out2.collect()} == {r.line for r in out.collect()}


def test_lookup_last_wins(spark):
    dim = spark.createDataFrame([("a", 1, 1), ("a", 2, 2), ("b", 3, 1)], "k string, v int, o int")
    got = {(r.k, r.v) for r in last_per_key(dim, "k", "v", "o").collect()}
    assert got == {("a", 2), ("b", 3)}


def test_counter_observation(spark):
    df, obs = counted(spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "v string")
                      .repartition(8), "num_lines")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["num_lines"] == 4
