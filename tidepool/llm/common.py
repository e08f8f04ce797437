"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder that ``spark.checkpoint.dir`` names."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


TASK_ROWS = 1 << 16  # rows of two or three longs that are worth a task and a file of their own
LEAST_TASKS = 8


def tasks(rows: int) -> int:
    """Tasks worth starting for ``rows`` rows of two or three longs."""
    return max(LEAST_TASKS, -(-rows // TASK_ROWS))


def cut(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as a parquet table in the shared folder and read it back.

    The table replaces the lineage: every executor and the driver see the same
    files, so a lost executor costs only the tasks it was running.  With ``rows``, at
    most so many rows of two or three longs, no more tasks write than those need:
    a small table is then not hundreds of files.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    schema = df.schema
    if rows is not None:
        df = df.coalesce(tasks(rows))
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def counted_cut(df: DataFrame, name: str, rows: int | None = None) -> tuple[DataFrame, int]:
    """``cut`` and the number of rows written, which is taken while they are written."""
    seen = Observation()
    out = cut(df.observe(seen, F.count(F.lit(1)).alias("n")), name, rows)
    return out, seen.get["n"]


LISTED = 2_000_000  # rows of a list of ids that may be broadcast (16 bytes each)


def listed(ids: DataFrame) -> DataFrame:
    """A written list of ids, to be broadcast if it has at most ``LISTED`` rows, else joined by shuffle."""
    return F.broadcast(ids) if ids.count() <= LISTED else ids


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps: it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_groups(texts: list[bytes], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges ``[a, b)`` of consecutive texts of about ``limit`` bytes (a longer text stands alone)."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield a, i
            a, size = i, 0
        size += len(t) + 1
    if a < len(texts):
        yield a, len(texts)


# --- 64-bit hashing of byte strings, vectorised ------------------------------

_MUL = np.uint64(0x9E3779B97F4A7C15)   # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(0x7E1D).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _power_table(which: str, n: int) -> np.ndarray:
    have = _POWERS.get(which)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        step = np.full(size, _MUL if which == "mul" else _INV, dtype=np.uint64)
        step[0] = 1
        have = _POWERS[which] = np.multiply.accumulate(step)
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising 64-bit mixer (every input bit reaches every output bit)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``range_hash`` gives the hash of any byte range of ``buf``."""
    out = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[buf] * _power_table("mul", len(buf))[:len(buf)], out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the bytes ``[start, end)``; depends on the bytes alone, not on where they stand."""
    inv = _power_table("inv", len(prefix))
    raw = (prefix[end] - prefix[start]) * inv[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


# --- words -------------------------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
PIECE = 1 << 20


def _pieces(data: bytes) -> Iterator[bytes]:
    """Cut a long text at white space into pieces of about ``PIECE`` bytes."""
    a = 0
    while len(data) - a > 2 * PIECE:
        b = a + PIECE
        while b < len(data) and not _SPACE[data[b]]:
            b += 1
        yield data[a:b]
        a = b
    yield data[a:] if a else data


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and 64-bit hash of every word (``[^\\x20\\x09-\\x0D]+``) of ``data``."""
    buf = np.frombuffer(data, dtype=np.uint8)
    gap = np.ones(len(buf) + 2, dtype=bool)
    gap[1:-1] = _SPACE[buf]
    edge = np.flatnonzero(gap[1:] != gap[:-1])
    start, end = edge[::2], edge[1::2]
    return start, range_hash(prefix_hash(buf), start, end)


def word_hashes(texts: list[bytes]) -> Iterator[np.ndarray]:
    """For each text the hashes of its words, in order; A-Z are lower-cased first.

    Texts are hashed in groups of about a megabyte; a long text is hashed in
    pieces cut at white space, so memory does not grow with its length except
    for the eight bytes kept per word.
    """
    for a, b in text_groups(texts):
        if b == a + 1:
            parts = [_word_hashes(p)[1] for p in _pieces(texts[a].lower())]
            yield np.concatenate(parts)
            continue
        start, hashes = _word_hashes(b"\n".join(texts[a:b]).lower())
        bounds = np.cumsum([0] + [len(t) + 1 for t in texts[a:b]])
        at = np.searchsorted(start, bounds)
        for i in range(b - a):
            yield hashes[at[i]:at[i + 1]]


_LANE = np.array([0x9DDFEA08EB382D69, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                  0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63, 0xA0761D6478BD642F,
                  0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles.

    With fewer than ``k`` words the whole sequence is one shingle; without
    words the set is empty.
    """
    n = len(words)
    if n == 0:
        return words
    w = min(n, k)
    acc = np.full(n - w + 1, w, dtype=np.uint64)
    for j in range(w):
        acc += words[j:n - w + 1 + j] * _LANE[j % 8] + np.uint64(j)
    return np.unique(mix(acc))


def shingle_sets(words: list[np.ndarray], k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_set`` of several non-empty word lists, one after another, and where each starts."""
    lens = np.array([max(len(w), k) for w in words])    # shorter lists are filled up, their one shingle is put in below
    at = np.concatenate([[0], np.cumsum(lens)])
    flat = np.concatenate([w if len(w) >= k else np.append(w, np.zeros(k - len(w), dtype=np.uint64)) for w in words])
    n = len(flat) - k + 1
    acc = np.full(n, k, dtype=np.uint64)
    for j in range(k):
        acc += flat[j:n + j] * _LANE[j % 8] + np.uint64(j)
    acc = mix(acc)
    keep = np.append(True, np.zeros(n - 1, dtype=bool))
    for i, a in enumerate(at[:-1].tolist()):
        own = acc[a:a + lens[i] - k + 1]
        if len(words[i]) < k:
            own[:] = shingle_set(words[i], k)
        own.sort()
        keep[a] = True
        np.not_equal(own[1:], own[:-1], out=keep[a + 1:a + len(own)])
    starts = np.concatenate([[0], np.cumsum(np.add.reduceat(keep, at[:-1], dtype=np.int64))[:-1]])
    return acc[keep], starts


def coordinates(seed: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Xor masks and odd multipliers of ``k`` MinHash coordinates."""
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 63, k, dtype=np.uint64),
            rng.integers(0, 1 << 63, k, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


def signatures(hashes: np.ndarray, starts: np.ndarray, masks: np.ndarray, muls: np.ndarray) -> np.ndarray:
    """MinHash signatures (sets x coordinates) of non-empty sets of 64-bit hashes that stand one after another."""
    out = np.empty((len(starts), len(masks)), dtype=np.uint64)
    buf = np.empty_like(hashes)
    for j in range(len(masks)):
        np.bitwise_xor(hashes, masks[j], out=buf)
        np.multiply(buf, muls[j], out=buf)
        out[:, j] = np.minimum.reduceat(buf, starts)
    return out
