"""Lookup: attach a value from a key-value set to every row.

The join type is left to Spark: known or, under adaptive execution, measured
sizes decide whether the set is broadcast.  A caller that knows its set to be
small may ask for the broadcast.  Nothing runs when the query is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_per_key(dim: DataFrame, key: str, value: str, order: str | Column) -> DataFrame:
    """One value per key: the one on the last row in ``order`` (``putAll``, last wins)."""
    o = F.col(order) if isinstance(order, str) else order
    return dim.groupBy(key).agg(F.max_by(F.col(value), o).alias(value))


def broadcast_lookup(df: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str,
                     out: str | None = None, text: str | None = None,
                     broadcast: bool = False) -> DataFrame:
    """Left-outer lookup of ``dim[value]`` by ``df[key] == dim[dim_key]``.

    A missing key gives null.  ``dim`` must have one row per key (see
    ``last_per_key``).  ``broadcast=True`` promises that it is small.  With
    ``text`` set, also add ``"<key> ---> <value>"``
    (``null`` for a missing value).
    """
    out = out or value
    d = dim.select(F.col(dim_key).alias("_tp_lk"), F.col(value).alias(out))
    if broadcast:
        d = F.broadcast(d)
    res = df.join(d, df[key] == d["_tp_lk"], "left").drop("_tp_lk")
    if text:
        res = res.withColumn(
            text, F.concat(F.col(key).cast("string"), F.lit(" ---> "),
                           F.coalesce(F.col(out).cast("string"), F.lit("null"))))
    return res
