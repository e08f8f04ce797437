"""Registered queries: each reads the driver tables under ``sf_dir``.

``QUERIES`` maps a name to ``fn(spark, sf_dir) -> DataFrame``.  The matching
DuckDB SQL lives in ``tidepool.plans.oracle``.  Column names and types are
kept equal on both sides (``timestamp_ntz`` <-> ``TIMESTAMP``, ``int`` <->
``INTEGER``, ``bigint`` <-> ``BIGINT``); double results are rounded to a
fixed scale on both sides, since the order of addition differs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco
