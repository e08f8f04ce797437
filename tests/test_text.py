"""Splitting rules: Java ``\\W+`` tokenizer and ``split("\\s")``."""

from tidepool.operators.text import split_words, tokenize, word_count


def _split(spark, s):
    df = spark.createDataFrame([(s,)], "t string")
    return [r.word for r in split_words(df, "t").collect()]


def test_whitespace_split_java_rules(spark):
    assert _split(spark, "a  b ") == ["a", "", "b"]
    assert _split(spark, " a b") == ["", "a", "b"]
    assert _split(spark, "") == [""]
    assert _split(spark, "   ") == []
    assert _split(spark, "a\tb\n") == ["a", "b"]


def test_tokenizer_drops_empties_and_lowercases(spark):
    df = spark.createDataFrame([("To be, or NOT to be?",), ("--",)], "t string")
    got = sorted((r.word, r["count"]) for r in word_count(tokenize(df, "t")).collect())
    assert got == [("be", 2), ("not", 1), ("or", 1), ("to", 2)]


def test_tokenizer_positions(spark):
    df = spark.createDataFrame([(",a b",)], "t string")
    got = [(r.pos, r.word) for r in tokenize(df, "t", pos="pos").orderBy("pos").collect()]
    assert got == [(1, "a"), (2, "b")]
