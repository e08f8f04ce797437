"""Queries of the training-data operators over the driver tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import ordinal, toxicity
from tidepool.llm.archive import convert_pages
from tidepool.llm.audit import filter_audit
from tidepool.llm.lines import clean_lines
from tidepool.llm.merkle import fingerprint_edits
from tidepool.llm.minhash import near_duplicates
from tidepool.llm.mixing import entropy_mix
from tidepool.llm.packing import pack
from tidepool.llm.permutation import permutation_search
from tidepool.llm.repair import damaged_repair
from tidepool.llm.repair_sql import repair_sql
from tidepool.llm.secrets import find_secrets
from tidepool.llm.suffix import remove_repeats
from tidepool.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn
    return deco


@register("op1_source_mix")
def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: sources weigh 5, 2, 1 and share 150 % of all words."""
    return entropy_mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@register("op2_minhash_join", """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
           FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(r.low, doc_id)) AS component_id,
       least(doc_id, coalesce(r.low, doc_id)) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) r USING (doc_id)
""")
def op2_minhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents (five-word shingles, Jaccard 0.75)."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


@register("op3_toxicity")
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents; labels of two thirds of the ids train the model."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), toxicity.fold(F.col("doc_id")) != 1)
    scored = toxicity.score(docs, model, keep=["doc_id"])
    return scored.select("row.doc_id", (toxicity.fold(F.col("row.doc_id")) == 1).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


@register("op4_conflict_packing")
def op4_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in bins of 2,048 words; no source and no copy or near copy twice in a bin."""
    return pack(table(spark, sf_dir, "documents"), near=True)


@register("op5_ordinal_quality")
def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade (0 poor, 1 good but toxic, 2 good) and tail probabilities of all documents."""
    docs = table(spark, sf_dir, "documents")
    rated = table(spark, sf_dir, "labels").select(
        "doc_id", ordinal.rating(F.col("quality"), F.col("toxic")).alias("grade"))
    scored = ordinal.grade(docs, ordinal.fit(docs, rated, top=2), keep=["doc_id"])
    return scored.select("row.doc_id", "expected_grade", F.col("tails")[0].alias("p_good"),
                         F.col("tails")[1].alias("p_clean"), (F.col("tails")[0] >= 0.5).alias("kept"))


@register("op6_fuzzy_lines")
def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the lines that repeat, exactly or nearly, an earlier line."""
    return clean_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_removed", "text")


@register("op7_repeated_bytes", """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
w AS (SELECT doc_id, i, md5(substr(hx, 2 * i + 1, 200)) AS h
      FROM (SELECT doc_id, hx, unnest(range(0, length(hx) // 2 - 99)) AS i FROM d)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
run AS (SELECT doc_id, i, sum(is_new) OVER (PARTITION BY doc_id ORDER BY i) AS r
        FROM (SELECT doc_id, i, CASE WHEN i <= 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS is_new FROM again)),
span AS (SELECT doc_id, r, min(i) AS a, max(i) + 100 AS b FROM run GROUP BY doc_id, r),
piece AS (SELECT doc_id, r, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY r), 0) AS done FROM span),
kept AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS tail,
                string_agg(substr(hx, 2 * done + 1, 2 * (a - done)), '' ORDER BY r) AS parts
         FROM piece JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(hx) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(parts, '') || substr(hx, 2 * coalesce(tail, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""")
def op7_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 100-byte strings, the first copy kept."""
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@register("op8_permutation_search")
def op8_permutation_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest vectors of every vector whose id is divisible by 100."""
    return permutation_search(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


@register("op9_arc_to_warc", """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p
  WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
""")
def op9_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as ARC files, converted to WARC files, read back."""
    return convert_pages(table(spark, sf_dir, "pages")).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op10_merkle_fingerprints")
def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle fingerprints of all documents and of their edited texts."""
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@register("op11_conversation_repair", repair_sql())
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged as stated and repaired at the least cost."""
    return damaged_repair(table(spark, sf_dir, "conversations"))


@register("op12_filter_audit", """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws,
             coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS fe FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, (CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END)
    + (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END) + (CASE WHEN fe THEN 16 ELSE 0 END) AS mask,
    count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM w LEFT JOIN l USING (doc_id) GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, unnest([1, 2, 3, 4, 5])::INTEGER AS step,
         unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, 31 - e.bit]) AS before,
         unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) AS bit
  FROM f a, f b, f c, f d, f e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
r AS (
  SELECT part, filter_order, step, bit,
    sum(n) FILTER (WHERE mask & (before | bit) = 0) AS kept,
    sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS removed,
    sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0) AS redundant,
    sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS good_lost,
    sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS toxic_lost
  FROM m, o GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r
""")
def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What filters A to E remove from all documents in every order, per language."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: fixed patterns and strings of unexplained bytes."""
    return find_secrets(table(spark, sf_dir, "documents"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)
