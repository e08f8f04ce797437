"""Word operators: tokenize, whitespace split, word count, running word count.

Tokenizing is a generator (``explode``) inside one stage; counting is a
partial + final aggregate, so a word holding a third of all tokens is summed
map-side and only one row per task and word crosses the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions.text import whitespace_split, word_tokens
from tidepool.operators.sequence import Levels, sequence_number


def tokenize(df: DataFrame, col: str, keep: Sequence[str] = (), out: str = "word",
             pos: str | None = None) -> DataFrame:
    """One row per non-empty lower-cased ``\\W+`` token of ``col``.

    ``pos`` names an optional column with the token's index in the split
    (0-based, counting empty pieces), giving a total order within a text.
    """
    if pos:
        exploded = df.select(*keep, F.posexplode(word_tokens(col)).alias(pos, out))
    else:
        exploded = df.select(*keep, F.explode(word_tokens(col)).alias(out))
    return exploded.filter(F.length(out) > 0)


def split_words(df: DataFrame, col: str, keep: Sequence[str] = (), out: str = "word") -> DataFrame:
    """One row per piece of ``col`` split on single whitespace characters (Java rules)."""
    return df.select(*keep, F.explode(whitespace_split(col)).alias(out))


def word_count(words: DataFrame, word: str = "word", out: str = "count") -> DataFrame:
    """Final count per word."""
    return words.groupBy(word).agg(F.count(F.lit(1)).alias(out))


def running_count(words: DataFrame, order: Sequence[str], blocks: Levels,
                  word: str = "word", out: str = "running_count") -> DataFrame:
    """Count of the word so far, one output per token, in ``order``.

    ``order`` must be a total order of tokens (e.g. text id, turn, position);
    ``blocks`` split it (e.g. ``[["conv_block"], ["conv_id", "turn"]]``) so a
    frequent word is numbered in many tasks, see ``sequence_number``.
    """
    return sequence_number(words, [word], order, blocks, out)
