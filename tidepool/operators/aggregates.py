"""Row-valued aggregates: the row with the maximum or minimum of a measure.

The reference's ``maxBy``/``minBy`` return the whole element with the extreme
field and keep the first one on ties.  Spark's ``max_by``/``min_by`` are
ordinary (partial + final) aggregates, so a hot key is combined map-side.
Ties are broken by an explicit order, never by arrival.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def falling(col: str, kind: str = "int") -> Column:
    """A long that falls as ``col`` rises: complement of an integer or of a time's microseconds."""
    c = F.unix_micros(F.col(col).cast("timestamp")) if kind == "time" else F.col(col).cast("long")
    return F.bitwise_not(c)


def max_row(measure: str, order: Sequence[str | tuple[str, str]], fields: Sequence[str]) -> Column:
    """Struct of ``fields`` from the row with the largest ``measure``.

    Ties go to the first row in ``order``; its columns are integers, or times
    given as ``(name, "time")``.  The measure may be of any orderable type (NaN
    is the largest number); rows with a null measure are skipped.
    """
    last = [falling(*((c, "int") if isinstance(c, str) else c)) for c in order]
    return F.max_by(F.struct(*_cols(fields)), F.when(F.col(measure).isNotNull(), F.struct(F.col(measure), *last)))


def min_row(measure: str, order: Sequence[str], fields: Sequence[str]) -> Column:
    """Struct of ``fields`` from the row with the smallest ``measure``, first on ties."""
    key = F.struct(F.col(measure), *_cols(order))
    return F.min_by(F.struct(*_cols(fields)), F.when(F.col(measure).isNotNull(), key))


def first_value(col: str, order: Sequence[str]) -> Column:
    """Value of ``col`` on the first row in ``order`` (the reference's untouched fields)."""
    return F.min_by(F.col(col), F.struct(*_cols(order)))
