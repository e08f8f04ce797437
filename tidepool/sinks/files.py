"""File sinks: tuple text lines, and printing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tidepool.operators.records import tuple_text


def as_tuple_lines(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One ``value`` column ``(a,b,c)`` per row (the reference's text output)."""
    return df.select(tuple_text(list(cols or df.columns)).alias("value"))


def write_text(df: DataFrame, path: str, cols: Sequence[str] | None = None,
               mode: str = "overwrite") -> None:
    """Write rows as tuple text, one line per row, one file per partition."""
    as_tuple_lines(df, cols).write.mode(mode).text(path)
