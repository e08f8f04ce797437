"""Best-fit packing of documents into fixed-size sequences under conflicts.

A document is cut into pieces of at most ``capacity`` words; full pieces are
bins of their own, the rest is packed.  Pieces go in falling size into the
compatible bin with the least room that suffices.  A bin carries two bitmaps,
of the sources and of the duplicate clusters it holds; a piece is compatible
when neither of its bits is set, so no bin holds a source or a cluster twice.
Bins are ordered by room: the search starts at the successor of the piece's
size and goes on until a bin is compatible; if none is, a bin is opened.

Documents are packed in shards of about ``SHARD`` documents by a hash of id and
text, so a shard is a bounded group, a hot source or a cluster of copies spreads
over all shards, and a lost task is packed again to the same bins.  The result
is the best fit within each shard.

Edge cases: a null or word-less text has one piece of size 0 and is placed like
any other; a null source is a source; the default cluster is the hash of the
text, and null texts are clusters of their own kind; with ``near`` a cluster is
a component of ``minhash.near_duplicates``, whose documents are the distinct
(id, text), so rows with a null id and several texts of one id take part, while
texts without words keep the hash of the text; repeated rows are separate
pieces (of one cluster, so never in one bin); ties go to the smaller id, then
text hash, and to the older bin; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import cut
from tidepool.llm.minhash import near_duplicates
from tidepool.llm.mixing import word_count

CAPACITY = 2048
SHARD = 2048


def best_fit(pieces: list[tuple[int, int, int]], capacity: int) -> list[int]:
    """Bin number of each piece ``(size, source number, cluster number)``, in the given order."""
    rooms: list[tuple[int, int]] = []           # (room, bin), ascending
    sources: list[int] = []                     # bitmaps by bin
    clusters: list[int] = []
    out = []
    for size, source, cluster in pieces:
        s, c = 1 << source, 1 << cluster
        at = bisect_left(rooms, (size, -1))
        while at < len(rooms) and (sources[rooms[at][1]] & s or clusters[rooms[at][1]] & c):
            at += 1
        if at < len(rooms):
            room, b = rooms.pop(at)
        else:
            room, b = capacity, len(sources)
            sources.append(0), clusters.append(0)
        sources[b] |= s
        clusters[b] |= c
        insort(rooms, (room - size, b))
        out.append(b)
    return out


def _numbers(values: list) -> list[int]:
    """Small numbers for the distinct values, by first appearance."""
    seen: dict = {}
    return [seen.setdefault(v, len(seen)) for v in values]


def _pack_shard(t: pa.Table, capacity: int) -> pa.Table:
    rows = sorted(zip(t["doc_id"].to_pylist(), t["text_hash"].to_pylist(), t["size"].to_pylist(),
                      t["source"].to_pylist(), t["cluster"].to_pylist(), strict=True),
                  key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2]))
    source, cluster = _numbers([r[3] for r in rows]), _numbers([r[4] for r in rows])
    full, rest = [], []
    for k, r in enumerate(rows):
        n = r[2] // capacity
        full += [(k, p, capacity) for p in range(n)]
        if r[2] % capacity or not n:
            rest.append((k, n, r[2] % capacity))
    rest.sort(key=lambda x: -x[2])
    bins = best_fit([(size, source[k], cluster[k]) for k, _, size in rest], capacity)
    first = max(bins, default=-1) + 1
    placed = [(b, *p) for b, p in zip(bins, rest, strict=True)] + [(first + i, *p) for i, p in enumerate(full)]
    fill = np.zeros(first + len(full), dtype=np.int64)
    for b, _, _, size in placed:
        fill[b] += size
    shard = t["shard"][0].as_py()
    cols = [[(shard << 32) | b for b, *_ in placed], [rows[k][0] for _, k, _, _ in placed],
            [p for _, _, p, _ in placed], [p * capacity for _, _, p, _ in placed],
            [size for *_, size in placed], [capacity - int(fill[b]) for b, *_ in placed],
            [rows[k][3] for _, k, _, _ in placed], [rows[k][4] for _, k, _, _ in placed]]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = ["bin_id", "doc_id", "piece", "start_word", "n_words", "bin_room", "source", "cluster"]
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def pack(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         cluster: Column | None = None, near: bool = False, capacity: int = CAPACITY,
         shard: int = SHARD) -> DataFrame:
    """``bin_id, doc_id, piece, start_word, n_words, bin_room, source, cluster``, a row per piece.

    ``cluster`` is a long that names a document's duplicate cluster; by default
    the hash of its text, with ``near`` its component of near-duplicates.
    """
    text_hash = F.xxhash64(F.col(text_col).isNull(), F.col(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash.alias("text_hash"),
                       word_count(F.col(text_col)).alias("size"), F.col(source_col).cast("string").alias("source"),
                       (text_hash if cluster is None else cluster).cast("long").alias("cluster"))
    base = cut(base, "pack-sizes")
    if near:
        keyed = docs.select(F.xxhash64(F.col(id_col).cast("long"), text_hash).alias("key"),
                            F.col(text_col).alias("text"))
        found = cut(near_duplicates(keyed, id_col="key").filter("n_shingles > 0")
                    .groupBy(F.col("doc_id").alias("key")).agg(F.min("component_id").alias("component")), "clusters")
        base = cut(base.withColumn("key", F.xxhash64("doc_id", "text_hash")).join(found, "key", "left")
                   .withColumn("cluster", F.coalesce("component", "cluster")).drop("key", "component"), "pack-input")
    n = max(1, -(-base.count() // shard))
    base = base.withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(n)).cast("long"))
    return base.groupBy("shard").applyInArrow(
        lambda t: _pack_shard(t, capacity),
        "bin_id long, doc_id long, piece int, start_word long, n_words long, bin_room long, source string, cluster long")


def utilisation(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Bins, words and the share of the bins' room that is filled."""
    bins = packed.groupBy("bin_id").agg(F.sum("n_words").alias("words"))
    return bins.agg(F.count("*").alias("bins"), F.sum("words").alias("words"),
                    (F.sum("words") / (F.count("*") * capacity)).alias("filled"))


