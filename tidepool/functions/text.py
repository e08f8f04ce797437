"""Column expressions for splitting text the way the reference's Java code does."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (Java regex, same engine as Spark's split):
WORD_SEPARATOR = r"\W+"     # tokenizer: runs of non-word characters (ASCII word class)
ONE_WHITESPACE = r"\s"      # split on every single whitespace character
TRAILING_WHITESPACE = r"\s+\z"


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def word_tokens(col: str | Column) -> Column:
    """Array of lower-cased pieces between ``\\W+`` runs (empty pieces included)."""
    return F.split(F.lower(_c(col)), WORD_SEPARATOR)


def whitespace_split(col: str | Column) -> Column:
    """``String.split("\\s")``: inner and leading empties kept, trailing ones dropped.

    Spark's ``split`` keeps trailing empties, so trailing whitespace is cut
    first.  An empty line gives one empty word; a non-empty all-blank line
    gives none.
    """
    c = _c(col)
    cut = F.regexp_replace(c, TRAILING_WHITESPACE, "")
    return (F.when(c == "", F.array(F.lit("")))
            .when(cut == "", F.array().cast("array<string>"))
            .otherwise(F.split(cut, ONE_WHITESPACE)))
