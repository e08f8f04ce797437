"""MinHash near-duplicates by an inverted join over signature coordinates.

1. *Sets.*  A text is its set of distinct five-word shingles (64-bit hashes).
   Texts with equal sets are one class; one representative goes on.
2. *Postings.*  Each representative is posted under its ``K`` coordinate-value
   pairs (a 64-bit token each).  Tokens that occur once are dropped: they
   cannot collide.  A representative with fewer than ``match`` tokens left has
   no partner.
3. *Prefix.*  Two signatures that agree in ``match`` coordinates share one of
   the ``n - match + 1`` rarest tokens of either, so only those are merged; the
   frequent tokens are skipped there and only looked up when a pair's
   collisions are counted.  Common lines and words therefore build no long lists.
4. *Merge.*  ``graph.linked_components`` walks the lists.  A pair stays when it
   collides in ``match`` of the ``K`` coordinates, and is a link when the exact
   Jaccard similarity of the full sets reaches the threshold; long lists of
   texts that are alike without being linked are compared in blocks.

With ``K = 48`` and ``match = 21`` a pair at similarity 0.75 has 36 expected
collisions; fewer than 21 happen about once in a million such pairs.

Edge cases: a null text and a text without words have an empty set and are
linked with nothing; with fewer than five words the whole sequence is one
shingle; rows that repeat an id and text are one document, and of different
texts under one id one stands for the id; null ids are documents that are
linked with nothing; ties are decided by the smallest id; an empty table gives
an empty result; other columns of the input are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import coordinates, counted_cut, cut, mix, shingle_set, shingle_sets, signatures, word_hashes
from tidepool.llm.graph import linked_components

K = 48
MATCH = 21
SHINGLE = 5
PERCENT = 75
GROUP = 1 << 15     # words whose sets are made and hashed at a time


def _texts(column: pa.Array) -> list[bytes]:
    return [(v or "").encode("utf-8") for v in column.to_pylist()]


def _sketch(batches: Iterator[pa.RecordBatch], k: int, seed: int) -> Iterator[pa.RecordBatch]:
    masks, muls = coordinates(seed, k)
    lane = mix(np.arange(1, k + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def sketch(words: list[np.ndarray]) -> list[np.ndarray]:
        """Set sizes, both halves of the set hashes, and tokens of non-empty word lists."""
        s, starts = shingle_sets(words, SHINGLE)
        halves = [np.add.reduceat(mix(s ^ masks[i]), starts) for i in (0, 1)]
        return [np.diff(np.append(starts, len(s))), *halves, mix(signatures(s, starts, masks, muls) ^ lane)]

    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            none, parts, held, size = [], [], [], 0
            for words in word_hashes(_texts(batch.column(1))):
                none.append(not len(words))
                if len(words):
                    held.append(words)
                    size += len(words)
                if size >= GROUP:
                    parts.append(sketch(held))
                    held, size = [], 0
            if held:
                parts.append(sketch(held))
            some = np.flatnonzero(~np.array(none, dtype=bool))
            n, h1, h2 = np.zeros((3, len(none)), dtype=np.int64)
            offsets = np.zeros(len(none) + 1, dtype=np.int32)
            sig = np.zeros(0, dtype=np.int64)
            if parts:
                n[some], h1[some], h2[some] = (np.concatenate([p[i] for p in parts]).view(np.int64) for i in range(3))
                offsets[some + 1] = k
                sig = np.concatenate([p[3] for p in parts]).view(np.int64).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum(offsets, dtype=np.int32)), pa.array(sig),
                                             mask=pa.array(none, pa.bool_()))
            mask = np.array(none, dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n), pa.array(h1, mask=mask), pa.array(h2, mask=mask), lists],
                names=["doc_id", "n_shingles", "h1", "h2", "sig"])


def sketches(docs: DataFrame, id_col: str, text_col: str, k: int = K, seed: int = 20) -> DataFrame:
    """``doc_id, n_shingles, h1, h2, sig``: set size, 128-bit set hash, coordinate tokens."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        lambda it: _sketch(it, k, seed),
        "doc_id long, n_shingles long, h1 long, h2 long, sig array<long>")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            batch = whole.slice(at, 1000)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()),
                 pa.array([pack.compress(t) for t in _texts(batch.column(1))], pa.binary())],
                names=["doc_id", "z"])


def packed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, z``: texts compressed before they are exchanged."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _pack, "doc_id long, z binary")


def text_set(z: bytes) -> np.ndarray:
    """Shingle set of a packed text."""
    return shingle_set(next(word_hashes([zstandard.ZstdDecompressor().decompress(z)])), SHINGLE)


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                    percent: int = PERCENT, k: int = K, match: int = MATCH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, class_id, n_links`` per row of ``docs``.

    ``class_id`` is the smallest id with the same set, ``component_id`` the
    smallest reachable over links, ``n_links`` the links that were confirmed at
    the class's representative on the way (not all of its links).
    """
    feats, n = counted_cut(sketches(docs, id_col, text_col, k), "sketches")
    some = feats.filter("n_shingles > 0 and doc_id is not null")
    classes = (some.groupBy("h1", "h2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
               .groupBy("rep").agg(F.min(F.struct("h1", "h2")).alias("h")))
    reps = (some.join(classes, (F.col("doc_id") == F.col("rep")) & (F.col("h1") == F.col("h.h1"))
                      & (F.col("h2") == F.col("h.h2")))
            .dropDuplicates(["rep"]).select("rep", "sig"))
    reps, n_reps = counted_cut(reps, "representatives", n * k)
    tokens = reps.select("rep", F.explode("sig").alias("token"))
    counts = cut(tokens.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1"), "token-counts",
                 n_reps * k // 2)
    ranked = (tokens.join(counts, "token").groupBy("rep")
              .agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("t"), F.sum("n").alias("weight"))
              .filter(F.size("t") >= match))
    cand, n_cand = counted_cut(ranked.select(
        "rep", "weight", F.col("t.token").alias("toks"),
        F.slice("t.token", F.lit(1), F.size("t") - (match - 1)).alias("prefix")), "candidates", n_reps * k)
    texts = cut(packed_texts(docs, id_col, text_col).join(cand.select("rep"), F.col("doc_id") == F.col("rep"))
                .dropDuplicates(["rep"]).select("rep", "z"), "candidate-texts")

    toks = cand.select("rep", "toks")

    def colliding(pairs: DataFrame) -> DataFrame:
        return (pairs.join(toks.toDF("b", "tb"), "b").join(toks.toDF("a", "ta"), "a")
                .filter(F.size(F.array_intersect("ta", "tb")) >= match).select("a", "b"))

    roots, links = linked_components(
        cand.select(F.explode("prefix").alias("token"), F.col("rep").alias("node"), "weight"),
        texts.select(F.col("rep").alias("node"), F.col("z").alias("item")), text_set, percent, colliding,
        rows=n_cand * (k - match + 1))
    ends = links.select(F.explode(F.array("a", "b")).alias("r")).groupBy("r").agg(F.count("*").alias("n_links"))
    label = cut(classes.select("rep", "h.h1", "h.h2").join(roots, F.col("rep") == F.col("node"), "left")
                .join(ends, F.col("rep") == F.col("r"), "left")
                .select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("rep").alias("class_id"),
                        F.coalesce("root", "rep").alias("root"),
                        F.coalesce("n_links", F.lit(0)).alias("n_links")), "labels", 2 * n)
    out = feats.drop("sig").join(label, (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
                                 & F.col("doc_id").isNotNull(), "left")
    comp = F.coalesce("root", "doc_id")
    return out.select("doc_id", "n_shingles", comp.alias("component_id"),
                      comp.eqNullSafe(F.col("doc_id")).alias("kept"),
                      F.coalesce("class_id", "doc_id").alias("class_id"),
                      F.coalesce("n_links", F.lit(0)).alias("n_links"))
