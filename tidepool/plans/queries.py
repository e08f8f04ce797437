"""Query definitions on the driver tables (see ``registry``).

Every query reads whole tables.  Keyed sequences are split by blocks that are cut
from counts (``sequence.sized_blocks``): a key stays whole until it has more than
``LARGE`` rows; above that its rows are split by

* events: key ``user_id``, order ``(ts, event_id)``, day then minute of ``ts``;
* conversations: order ``(conv_id, turn, pos)``, ``conv_id div 65536`` then ``div 256``;
* documents: order ``(doc_id, pos)``, ``doc_id div 65536`` then ``div 256``;
* arrival order over all events (punctuated watermark, no key): ``event_id div
  2^30`` then ``div 2^20``, always.
"""


from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.operators.aggregates import max_row, min_row
from tidepool.operators.delta import delta_trigger_split
from tidepool.operators.hot import hot_items
from tidepool.operators.lookup import broadcast_lookup, last_per_key
from tidepool.operators.records import attach_json, counted, parse_key_number, parse_tuples, project_json, tuple_text
from tidepool.operators.sequences import count_window, every_n_average, full_batches, position_from
from tidepool.operators.sequence import running_totals, sized_blocks
from tidepool.operators.text import running_count, split_words, tokenize, word_count
from tidepool.operators.topn import format_top_n
from tidepool.operators.user_aggregate import TrimmedMean, user_aggregate, whole_window
from tidepool.operators.windows import sliding, split_sessions, tumbling
from tidepool.plans.registry import register
from tidepool.sources.tables import events_with_item, table
from tidepool.streaming.punctuated import MARKER_PREFIX, parse_marked_lines, punctuated_windows

EVENT_ORDER = ["ts", "event_id"]
SPREAD = 32               # tasks for tokenizing a table that is one row group
ARRIVAL = {"_tp_far": 1 << 30, "_tp_near": 1 << 20}   # rows per block for the global running maximum


def _events_blocked(spark: SparkSession, sf_dir: str, *cols: str) -> tuple[DataFrame, list]:
    ev = table(spark, sf_dir, "events")
    if cols:
        ev = ev.select(*dict.fromkeys(["user_id", "ts", "event_id", *cols]))
    return sized_blocks(ev, ["user_id"], [(f"_tp_{u}", F.date_trunc(u, "ts")) for u in ("day", "minute")])


def _words_blocked(toks: DataFrame, text_id: str) -> tuple[DataFrame, list]:
    return sized_blocks(toks, ["word"], [(f"_tp_{n}", F.expr(f"{text_id} div {n}")) for n in (65536, 256)])


# --- hot items --------------------------------------------------------------

@register("hot_items")
def q_hot_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views per item (``props.k``), 60 min windows every 5 min, top 5 per window end."""
    ev = events_with_item(spark, sf_dir)
    return hot_items(ev, "ts", "item_id", size="60 minutes", slide="5 minutes", n=5,
                     behavior_col="event_type", behavior="view")


@register("hot_items_report")
def q_hot_items_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The top 5 per window end as the reference's printed text block."""
    top = q_hot_items(spark, sf_dir)
    return format_top_n(top, "window_end", "rank", "item_id", "view_count", 5)


# --- words ------------------------------------------------------------------

@register("word_count")
def q_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lower-cased ``\\W+`` tokens of every document, counted."""
    docs = table(spark, sf_dir, "documents", SPREAD)
    return word_count(tokenize(docs, "text"))


@register("word_count_text")
def q_word_count_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word counts written as tuple text ``(word,count)``."""
    return q_word_count(spark, sf_dir).select(tuple_text(["word", "count"]).alias("line"))


@register("ws_word_count")
def q_ws_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation texts split on single whitespace characters (Java rules), counted."""
    conv = table(spark, sf_dir, "conversations", SPREAD)
    return word_count(split_words(conv, "text"))


@register("running_count")
def q_running_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running count of each word over all conversation turns, one row per token."""
    conv = table(spark, sf_dir, "conversations", SPREAD)
    toks = tokenize(conv, "text", keep=["conv_id", "turn"], pos="pos")
    toks, blocks = _words_blocked(toks, "conv_id")
    out = running_count(toks, ["conv_id", "turn", "pos"], blocks)
    return out.select("conv_id", "turn", "pos", "word", "running_count")


@register("word_count_window")
def q_word_count_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count window per word over documents: every 3 occurrences, the last 5."""
    docs = table(spark, sf_dir, "documents", SPREAD)
    toks = tokenize(docs, "text", keep=["doc_id"], pos="pos").withColumn("one", F.lit(1))
    toks, blocks = _words_blocked(toks, "doc_id")
    return count_window(toks, ["word"], ["doc_id", "pos"], 5, 3, "one", blocks)


# --- time windows -----------------------------------------------------------

def _round_value_sum(df: DataFrame) -> DataFrame:
    return df.withColumn("value_sum", F.round("value_sum", 2))


@register("tumbling_sum")
def q_tumbling_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly tumbling sum and count of ``value`` per event type."""
    ev = table(spark, sf_dir, "events")
    out = tumbling(ev, "ts", "1 hour", ["event_type"],
                   [F.sum("value").alias("value_sum"), F.count(F.lit(1)).alias("n")])
    return _round_value_sum(out.select("event_type", F.col("window.start").alias("window_start"),
                                       F.col("window.end").alias("window_end"), "value_sum", "n"))


@register("sliding_sum")
def q_sliding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding sum per event type, 150 min every 30 min (the 2.5 / 0.5 shape), by panes."""
    ev = table(spark, sf_dir, "events")
    out = sliding(ev, "ts", "150 minutes", "30 minutes", ["event_type"],
                        {"value_sum": ("sum", "value"), "n": ("count", F.lit(1))})
    return _round_value_sum(out.select("event_type", "window_start", "window_end", "value_sum", "n"))


@register("sliding_count")
def q_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding count and sum per event type, 20 min every 10 min (the 2 / 1 shape)."""
    ev = table(spark, sf_dir, "events")
    out = sliding(ev, "ts", "20 minutes", "10 minutes", ["event_type"],
                  {"value_sum": ("sum", "value"), "n": ("count", F.lit(1))})
    return _round_value_sum(out.select("event_type", "window_start", "window_end", "value_sum", "n"))


@register("sliding_uneven")
def q_sliding_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sliding windows whose slide does not divide the size: 50 min every 20 min."""
    ev = table(spark, sf_dir, "events")
    out = sliding(ev, "ts", "50 minutes", "20 minutes", ["event_type"],
                  {"n": ("count", F.lit(1)), "low": ("min", "value"), "high": ("max", "value")})
    return out.select("event_type", "window_start", "window_end", "n", "low", "high")


@register("tumbling_min_row")
def q_tumbling_min_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and hour, the row with the smallest value (first in time on ties)."""
    ev = table(spark, sf_dir, "events")
    out = tumbling(ev, "ts", "1 hour", ["event_type"],
                   [min_row("value", EVENT_ORDER, ["event_id", "ts", "user_id", "value"]).alias("m")])
    return out.select("event_type", F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "m.event_id", "m.ts",
                      "m.user_id", "m.value")


@register("user_sessions")
def q_user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions per user with a 30 min gap: sum of value, first event type, size.

    Split by hour so one busy user's sessions are built in many tasks."""
    ev = table(spark, sf_dir, "events")
    out = split_sessions(ev, ["user_id"], "ts", "30 minutes",
                         {"value_sum": ("sum", "value"), "n": ("count", F.lit(1))},
                         first={"first_event_type": "event_type"}, order=EVENT_ORDER)
    return _round_value_sum(out.select(
        "user_id", F.col("session.start").alias("session_start"),
        F.col("session.end").alias("session_end"), "first_event_type", "value_sum", "n"))


# --- keyed sequences --------------------------------------------------------

@register("count_window_sum")
def q_count_window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user in time order: every 3 events, the sum of the last 5 values."""
    ev, blocks = _events_blocked(spark, sf_dir, "value")
    out = count_window(ev, ["user_id"], EVENT_ORDER, 5, 3, "value", blocks, fields=["ts"])
    return out.withColumn("window_sum", F.round("window_sum", 2))


@register("every_n_average")
def q_every_n_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per order, the truncated average quantity of every 2 line items."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("long").alias("qty"))
    # line numbers repeat within an order in this data: part and supplier break ties
    return every_n_average(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"],
                           "qty", 2, [])  # an order has a handful of lines


@register("every_n_average_events")
def q_every_n_average_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user in time order, the truncated average of every 3 values in cents."""
    ev, blocks = _events_blocked(spark, sf_dir, "value")
    ev = ev.withColumn("cents", position_from("value"))
    return every_n_average(ev, ["user_id"], EVENT_ORDER, "cents", 3, blocks)


@register("full_batches")
def q_full_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user in time order, events in complete groups of 10 (the buffering sink)."""
    ev, blocks = _events_blocked(spark, sf_dir, "value")
    out = full_batches(ev, ["user_id"], EVENT_ORDER, 10, blocks)
    return out.select("user_id", "batch_no", "slot", "event_id", "ts", "value")


@register("delta_trigger_max")
def q_delta_trigger_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: each time the running value total moves 500.00 past the last mark,
    the event with the top value among the last day's events."""
    ev, blocks = _events_blocked(spark, sf_dir, "value")
    ev = ev.withColumn("cents", position_from("value"))
    pos = running_totals(ev, ["user_id"], EVENT_ORDER, blocks, {"pos": "cents", "seq": None})
    return delta_trigger_split(pos, "user_id", "ts", ["event_id"], "pos", "value", delta=50_000, keep="1 day",
                               fields=["event_id", "ts", "value", "pos"], seq="seq")


# --- user functions ---------------------------------------------------------

@register("user_aggregate")
def q_user_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and day, a user aggregate: the mean of whole values without the lowest and highest tenth."""
    return user_aggregate(table(spark, sf_dir, "events"), ["event_type"], TrimmedMean(10), ["value"], "ts", "1 day")


def _median(rows: pa.Table) -> dict:
    v = rows.column(0).drop_null()
    return {"n": rows.num_rows, "median": v[(len(v) - 1) // 2].as_py() if len(v) else None}


@register("whole_window_median")
def q_whole_window_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and hour, a function over all rows of the window: their lower median value."""
    ev = table(spark, sf_dir, "events")
    return whole_window(ev, ["event_type"], "ts", "1 hour", ["value"], _median, "n long, median double", order=["value"])


# --- lookups, records -------------------------------------------------------

@register("broadcast_lookup")
def q_broadcast_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's nation name from the (size-checked, broadcast) nation table."""
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation")
    return broadcast_lookup(cust, nation, "c_nationkey", "n_nationkey", "n_name", text="line")


@register("lookup_last_wins")
def q_lookup_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer's status of their latest order (one value per key, last wins)."""
    cust = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders")
    dim = last_per_key(orders, "o_custkey", "o_orderstatus",
                       F.struct("o_orderdate", "o_orderkey"))
    return broadcast_lookup(cust, dim, "c_custkey", "o_custkey", "o_orderstatus")


@register("json_project")
def q_json_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``props`` JSON text to a typed column, keeping the event id."""
    ev = table(spark, sf_dir, "events")
    return project_json(ev, "props", "k bigint", keep=["event_id"])


@register("json_attach")
def q_json_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event id with its parsed ``props`` object, serialised compactly."""
    ev = table(spark, sf_dir, "events")
    return attach_json(ev, "props", ["event_id"], out="json")


@register("json_attach_broken")
def q_json_attach_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where every tenth text is cut short: null for those."""
    return attach_json(_with_bad_json(spark, sf_dir), "props", ["event_id"], out="json")


def _with_bad_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    broken = F.expr("substring(props, 1, length(props) - 1)")
    return ev.withColumn("props", F.when(F.col("event_id") % 10 == 0, broken).otherwise(F.col("props")))


@register("json_rejects")
def q_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts that do not parse (every tenth is cut short)."""
    return attach_json(_with_bad_json(spark, sf_dir), "props", ["event_id"], rejects=True)


@register("json_decimal")
def q_json_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON with a text and a decimal field, projected to typed columns without loss of digits."""
    text = F.to_json(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("transaction_time"),
                              F.col("o_totalprice").cast("decimal(12,2)").alias("transaction_amount")))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", text.alias("raw_data"))
    out = project_json(rows, "raw_data", "transaction_time string, transaction_amount decimal(38,18)", keep=["o_orderkey"])
    return out.withColumn("transaction_amount", F.col("transaction_amount").cast("string"))


@register("parse_tuples")
def q_parse_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ``(key,customer,price)`` text parsed back to typed columns; every seventh price is not a number."""
    o = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderkey") % 7 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string"))
    lines = o.select(tuple_text(["o_orderkey", "o_custkey", price]).alias("line"))
    return parse_tuples(lines, "line", ["o_orderkey", "o_custkey", "o_totalprice"], ["bigint", "bigint", "double"])


@register("key_number_lines")
def q_key_number_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as ``name,number`` lines parsed to typed pairs; every fifth number is missing."""
    c = table(spark, sf_dir, "customer")
    number = F.when(F.col("c_custkey") % 5 == 0, "").otherwise(F.col("c_custkey").cast("string"))
    return parse_key_number(c.select(F.concat_ws(",", "c_name", number).alias("line")), "line", "name", "number")


@register("marked_lines")
def q_marked_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ``[punctuated_]<ms>,<user>,<value>`` lines (errors are markers), parsed to typed columns."""
    ev = table(spark, sf_dir, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    mark = F.when(F.col("event_type") == "error", MARKER_PREFIX).otherwise("")
    lines = ev.select(F.concat(mark, F.concat_ws(",", ms, "user_id", "value")).alias("line"))
    return parse_marked_lines(lines, "line", [("user_id", "bigint"), ("value", "double")]).drop("line")


@register("tuple_text_nulls")
def q_tuple_text_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as tuple text; a status other than O is null."""
    o = table(spark, sf_dir, "orders").withColumn("s", F.when(F.col("o_orderstatus") == "O", F.col("o_orderstatus")))
    return o.select(tuple_text(["o_orderkey", "s", "o_custkey"]).alias("line"))


@register("counted_rows")
def q_counted_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders passed through an identity step that counts rows (an observation)."""
    df, _ = counted(table(spark, sf_dir, "orders"), "num_lines")
    return df


@register("counted_total")
def q_counted_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number an observation has counted after a job has used the rows."""
    df, seen = counted(table(spark, sf_dir, "orders"), "num_lines")
    df.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["num_lines"]).cast("long").alias("num_lines"))


@register("tumbling_max_row")
def q_tumbling_max_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type and hour, the row with the largest value (first in time on ties)."""
    ev = table(spark, sf_dir, "events")
    out = tumbling(ev, "ts", "1 hour", ["event_type"],
                   [max_row("value", [("ts", "time"), "event_id"], ["event_id", "ts", "user_id", "value"]).alias("m")])
    return out.select("event_type", F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "m.event_id", "m.ts",
                      "m.user_id", "m.value")


@register("punctuated_min_row")
def q_punctuated_min_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly min-value row per event type under a punctuated watermark: events in
    arrival (``event_id``) order, ``error`` events are the markers; late rows are
    dropped and only windows a marker closed are emitted."""
    ev = table(spark, sf_dir, "events").withColumns(
        {name: F.expr(f"event_id div {n}") for name, n in ARRIVAL.items()})
    out = punctuated_windows(
        ev, "event_id", "ts", F.col("event_type") == "error", ["event_type"], "1 hour",
        [min_row("value", EVENT_ORDER, ["event_id", "ts", "user_id", "value"]).alias("m")],
        list(ARRIVAL))
    return out.select("event_type", F.col("window.start").alias("window_start"),
                      F.col("window.end").alias("window_end"), "m.event_id", "m.ts",
                      "m.user_id", "m.value")
