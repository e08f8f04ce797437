"""Split running totals equal the plain window, including a hot key and null keys."""

import random

import pandas as pd
from pyspark.sql import functions as F

from tidepool.operators.sequence import running_total, sequence_number
from tidepool.operators.sequences import count_window, full_batches


def _data(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        # key 0 holds about a third of the rows; some keys are null
        k = 0 if rnd.random() < 0.35 else (None if rnd.random() < 0.05 else rnd.randint(1, 20))
        rows.append((k, rnd.randint(0, 500), i, rnd.randint(-5, 50)))
    df = spark.createDataFrame(rows, "k int, t int, id int, v long")
    return df.withColumn("b0", F.expr("t div 100")).withColumn("b1", F.expr("t div 10")), rows


def _brute(rows, value=True):
    pdf = pd.DataFrame(rows, columns=["k", "t", "id", "v"])
    pdf["kk"] = pdf["k"].fillna(-1)
    pdf = pdf.sort_values(["kk", "t", "id"])
    pdf["rt"] = pdf.groupby("kk")["v" if value else "id"].transform(
        (lambda s: s.cumsum()) if value else (lambda s: pd.Series(range(1, len(s) + 1), index=s.index)))
    return {int(r.id): int(r.rt) for r in pdf.itertuples()}


def test_running_total_two_levels(spark):
    df, rows = _data(spark)
    out = running_total(df, ["k"], ["t", "id"], [["b0"], ["b1"]], "v", "rt")
    got = {r.id: r.rt for r in out.select("id", "rt").collect()}
    assert got == _brute(rows)


def test_sequence_number_one_level_and_plain(spark):
    df, rows = _data(spark, seed=11)
    want = _brute(rows, value=False)
    for blocks in ([["b0"]], [["b0", "b1"]], []):
        out = sequence_number(df, ["k"], ["t", "id"], blocks, "seq")
        assert {r.id: r.seq for r in out.select("id", "seq").collect()} == want


def test_count_window_matches_frame(spark):
    df, rows = _data(spark, n=800, seed=3)
    out = count_window(df, ["k"], ["t", "id"], 5, 3, "v", [["b0"]])
    pdf = pd.DataFrame(rows, columns=["k", "t", "id", "v"]).assign(kk=lambda d: d.k.fillna(-1))
    pdf = pdf.sort_values(["kk", "t", "id"])
    want = set()
    for kk, g in pdf.groupby("kk"):
        vs = g["v"].tolist()
        for f in range(3, len(vs) + 1, 3):
            want.add((kk, f, sum(vs[max(0, f - 5):f]), min(f, 5)))
    got = {(-1 if r.k is None else r.k, r.fire_seq, r.window_sum, r.n_rows) for r in out.collect()}
    assert got == want


def test_full_batches_and_remainder(spark):
    df, rows = _data(spark, n=500, seed=5)
    full = full_batches(df, ["k"], ["t", "id"], 10, [["b0"]])
    rest = full_batches(df, ["k"], ["t", "id"], 10, [["b0"]], remainder=True)
    assert full.count() + rest.count() == 500
    sizes = full.groupBy("k", "batch_no").count().select("count").distinct().collect()
    assert [r[0] for r in sizes] == [10]
    assert rest.groupBy("k").count().filter("count >= 10").count() == 0


def test_split_sessions_equal_session_window(spark):
    from tidepool.operators.windows import sessions, split_sessions
    rnd = random.Random(42)
    rows, eid = [], 0
    for k in [0] * 6 + [1, 2, None]:          # key 0 is hot
        t = rnd.randint(0, 3600)
        for _ in range(rnd.randint(50, 150)):
            # mostly short steps (sessions chain across many hour blocks),
            # some exactly the gap (touching windows merge), some long breaks
            t += rnd.choice([60, 300, 600, 600, 1800, 5000])
            eid += 1
            rows.append((k, t, eid, rnd.randint(1, 9)))
    df = (spark.createDataFrame(rows, "k int, t long, eid long, v long")
          .withColumn("ts", F.timestamp_seconds("t")))
    m = {"s": ("sum", "v"), "n": ("count", F.lit(1)), "hi": ("max", "v")}
    got = split_sessions(df, ["k"], "ts", "10 minutes", m, first={"fv": "v"},
                         order=["ts", "eid"], block_unit="hour")
    want = sessions(df, ["k"], "ts", "10 minutes",
                    [F.sum("v").alias("s"), F.count(F.lit(1)).alias("n"), F.max("v").alias("hi"),
                     F.min_by("v", F.struct("ts", "eid")).alias("fv")])
    cols = ["k", "session.start", "session.end", "s", "n", "hi", "fv"]
    def key(r):
        return (-1 if r[0] is None else r[0],) + tuple(r[1:])
    g = sorted((tuple(r) for r in got.select(*cols).collect()), key=key)
    w = sorted((tuple(r) for r in want.select(*cols).collect()), key=key)
    assert len(w) > 50 and g == w
