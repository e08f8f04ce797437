"""Corpus pipeline: toxicity filter, line dedup, near-dedup, source mixing, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read back as the next stage's ``docs``.  All but the last return the
columns of ``documents``.

* ``toxicity``: texts with a score of 0.7 or more go.
* ``line_dedup``: lines that repeat or resemble an earlier one go; ``n_chars``
  is the new length.
* ``near_dedup``: of each near-duplicate component the smallest id stays.
* ``mix``: a document appears as often as the mix takes it (none, once, twice).
* ``pack``: a row per piece with its bin.

Edge cases are those of the operators.  Rows with a null id pass the filters:
they are linked with nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import toxicity
from tidepool.llm.common import cut
from tidepool.llm.lines import clean_lines
from tidepool.llm.minhash import near_duplicates
from tidepool.llm.mixing import entropy_mix
from tidepool.llm.packing import pack
from tidepool.sources.tables import table

THRESHOLD = 0.7


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.fold(F.col("doc_id")) != 1)
    return toxicity.score(docs, model).filter(F.col("score") < THRESHOLD).select(
        *[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])


def stage_line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = clean_lines(docs)
    n = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length("text"))
    return out.select(*[F.col("text") if c == "text" else n.cast("long").alias(c) if c == "n_chars"
                        else F.col("row").getField(c).alias(c) for c in docs.columns])


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = near_duplicates(docs).filter("not kept").select("doc_id").distinct()
    return docs.join(cut(gone, "near-duplicates"), "doc_id", "left_anti").select(*docs.columns)


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed = entropy_mix(docs, keep=docs.columns).filter("copies > 0")
    return (mixed.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
            .select("row.*"))


def stage_pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [("toxicity", stage_toxicity), ("line_dedup", stage_line_dedup), ("near_dedup", stage_near_dedup),
          ("mix", stage_mix), ("pack", stage_pack)]

# model scores, MinHash links and Newton steps have no SQL form; tests compare
# every stage with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
