"""Removal of repeated byte strings by longest-previous-factor arrays.

A byte goes when a string of ``WIDTH`` (100) bytes that covers it also starts
earlier: in a smaller id, or earlier in the same text.  In the suffix order of
all texts that is ``LPF[i] >= WIDTH``, where ``LPF[i]`` is the longest match of
suffix ``i`` with an earlier position; it is reached at the previous or the next
suffix (in suffix order) that has a smaller position.  The order is never built
whole; it is cut where longer common prefixes than ``WIDTH`` cannot exist:

1. *Anchors.*  Each ``WIDTH``-byte window is named by the smallest hash of its
   ``GRAM``-byte strings; equal windows have equal names.  A *block* is a run of
   windows with one name, about 35 of them: ``(name, block hash, id, start, n)``.
2. *Names that occur once* have no repeat anywhere and drop out, unless the
   naming string itself occurs twice in the block (a periodic text).
3. *Equal blocks* (same name and hash): all but the first repeat it whole, so
   their windows have earlier matches, and the first stands for them.  Groups of
   copies collapse here, in map-side combined aggregates.
4. *Suffix order.*  First blocks whose name has several blocks, or occurs twice
   in one, may share single windows.  Their bytes are sent to tasks by name; a task sorts the window
   suffixes of its names, computes neighbour prefixes and previous and next
   smaller positions, and from them the LPF array (``longest_previous``).
   A name with more than ``HOT`` first blocks is dealt out once more, by window:
   an aggregate over window hashes finds the first of each, in map-side combined
   form, so no name is one task.
5. The byte ranges found are gathered by document and cut out.

Anchors are selected by content only, so every repeat of ``WIDTH`` bytes is
found, whatever its length, place or frequency.

Edge cases: a null text is empty; texts of fewer than ``WIDTH`` bytes lose
nothing; a long text is read in segments of a megabyte (the segment border only
makes a block differ, which step 4 resolves); overlapping repeats within a text
count; ids are expected to be unique, rows that repeat an id and text are one
document; a null id orders first; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import cut, prefix_hash, range_hash, text_groups
from tidepool.llm.minhash import packed_texts

WIDTH = 100
GRAM = 32
HOT = 4096
SEGMENT = 1 << 20


# --- blocks ------------------------------------------------------------------

def _window_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` consecutive values."""
    m, have = x, 1
    while have * 2 <= w:
        m = np.minimum(m[:len(m) - have], m[have:])
        have *= 2
    if have < w:
        m = np.minimum(m[:len(m) - (w - have)], m[w - have:])
    return m


def blocks(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Blocks of consecutive texts: text number, start, windows, name, block hash, and
    whether the naming string occurs more than once (equal windows inside a block need that)."""
    data = b"".join(texts)
    span = WIDTH - GRAM + 1
    empty = np.zeros(0, dtype=np.int64)
    if len(data) < WIDTH:
        return empty, empty, empty, empty, empty, empty.astype(bool)
    buf = np.frombuffer(data, dtype=np.uint8)
    p = prefix_hash(buf)
    at = np.arange(len(buf) - GRAM + 1)
    gram = range_hash(p, at, at + GRAM)
    name = _window_min(gram, span)
    offset = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    valid = np.ones(len(buf) + WIDTH, dtype=bool)
    for b in offset[1:]:
        valid[max(0, b - WIDTH + 1):b] = False
    start = np.flatnonzero(valid[:len(name)])
    if not len(start):
        return empty, empty, empty, empty, empty, empty.astype(bool)
    name = name[start]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (name[1:] != name[:-1]) | (start[1:] != start[:-1] + 1)
    head = np.flatnonzero(new)
    size = np.diff(np.append(head, len(start)))
    parts = -(-size // span)                      # long runs are cut every ``span`` windows
    which = np.repeat(np.arange(len(head)), parts)
    k = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    s = start[head[which]] + k * span
    n = np.minimum(span, size[which] - k * span)
    doc = np.searchsorted(offset, s, side="right") - 1
    name = name[head[which]]
    reach = np.lib.stride_tricks.sliding_window_view(np.append(gram, np.zeros(2 * span, np.uint64)), 2 * span - 1)
    hits = (reach[s] == name[:, None]) & (np.arange(2 * span - 1) < (n + span - 1)[:, None])
    return (doc, s - offset[doc], n, name.view(np.int64), range_hash(p, s, s + n + WIDTH - 1).view(np.int64),
            hits.sum(axis=1) > 1)


def _block_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            part = whole.slice(at, 1000)
            ids = part.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            texts = [(v or "").encode("utf-8") for v in part.column(1).to_pylist()]
            for a, b in text_groups(texts, SEGMENT):
                if b == a + 1 and len(texts[a]) > 2 * SEGMENT:
                    pieces = ((x, [texts[a][x:x + SEGMENT + WIDTH - 1]]) for x in range(0, len(texts[a]), SEGMENT))
                else:
                    pieces = iter([(0, texts[a:b])])
                for shift, group in pieces:
                    doc, s, n, name, h, twice = blocks(group)
                    cols = [ids[a + doc], s + shift, n, name, h, twice]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                                                     names=["doc_id", "s", "n", "name", "block", "twice"])


# --- suffix order ------------------------------------------------------------

def _smaller(pos: np.ndarray, lcp: np.ndarray, floor: int) -> np.ndarray:
    """Match length with the nearest earlier entry that has a smaller position.

    ``lcp[i]`` is the common prefix of entries ``i - 1`` and ``i``.  Pointers
    jump over entries with larger positions; a pointer whose match has fallen
    below ``floor`` stops (its result is 0).
    """
    n = len(pos)
    to, match = np.arange(n) - 1, lcp.copy()
    open_ = np.flatnonzero((to >= 0) & (match >= floor))
    open_ = open_[pos[to[open_]] > pos[open_]]
    while len(open_):
        via = to[open_]
        match[open_] = np.minimum(match[open_], match[via])
        to[open_] = to[via]
        open_ = open_[(to[open_] >= 0) & (match[open_] >= floor)]
        open_ = open_[pos[to[open_]] > pos[open_]]
    return np.where((to >= 0) & (match >= floor), match, 0)


def longest_previous(pos: np.ndarray, lcp: np.ndarray, floor: int = 1) -> np.ndarray:
    """Longest-previous-factor lengths in suffix order (0 where below ``floor``).

    ``pos`` holds the positions in suffix order, ``lcp[i]`` the common prefix of
    entries ``i - 1`` and ``i`` (``lcp[0]`` is ignored).
    """
    if not len(pos):
        return np.zeros(0, dtype=np.int64)
    lcp = lcp.copy()
    lcp[0] = 0
    back = np.append(0, lcp[1:][::-1])
    return np.maximum(_smaller(pos, lcp, floor), _smaller(pos[::-1], back, floor)[::-1])


def repeated_windows(contexts: list[bytes], sizes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Which windows of the contexts (in position order) have an equal earlier one.

    Context ``i`` holds ``sizes[i]`` windows, at its first ``sizes[i]`` bytes.
    """
    buf = np.frombuffer(b"".join(contexts), dtype=np.uint8)
    offset = np.cumsum([0] + [len(c) for c in contexts])[:-1]
    which = np.repeat(np.arange(len(sizes)), sizes)
    start = offset[which] + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    rows = np.lib.stride_tricks.sliding_window_view(buf, width)[start]
    order = np.argsort(np.ascontiguousarray(rows).view(f"S{width}").ravel(), kind="stable")
    rows = rows[order]
    lcp = np.zeros(len(order), dtype=np.int64)
    if len(order) > 1:
        differ = rows[1:] != rows[:-1]
        lcp[1:] = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    out = np.empty(len(order), dtype=bool)
    out[order] = longest_previous(order, lcp, width) >= width
    return out


def _runs(flag: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, ...]:
    """Ranges of flagged windows: id, first byte, byte after the last."""
    at = np.flatnonzero(flag)
    if not len(at):
        return at, at, at
    new = np.ones(len(at), dtype=bool)
    new[1:] = (doc[at[1:]] != doc[at[:-1]]) | (start[at[1:]] != start[at[:-1]] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    return doc[at[head]], start[at[head]], start[at[tail]] + WIDTH


def _order_batches(batches: Iterator[pa.RecordBatch], chunk: int = 3000) -> Iterator[pa.RecordBatch]:
    """Rows arrive sorted by name, id, start; whole names are ordered together."""
    def solve(t: pa.Table) -> pa.RecordBatch:
        key = np.stack([t[c].to_numpy().astype(np.int64) for c in ("name", "doc_id", "s")])
        fresh = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0))   # a row may be repeated
        t = t.filter(pa.array(fresh))
        n = t["n"].to_numpy()
        doc, s = np.repeat(t["doc_id"].to_numpy(), n), t["s"].to_numpy()
        start = np.repeat(s, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        cols = _runs(repeated_windows(t["bytes"].to_pylist(), n), doc, start)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["doc_id", "a", "b"])

    held: pa.Table | None = None
    for batch in batches:
        for at in range(0, batch.num_rows, chunk):
            new = pa.Table.from_batches([batch.slice(at, chunk)])
            held = new if held is None else pa.concat_tables([held, new])
            names = held["name"].to_numpy()
            last = int(np.flatnonzero(names != names[-1])[-1]) + 1 if (names != names[-1]).any() else 0
            if last >= chunk:
                yield solve(held.slice(0, last))
                held = held.slice(last)
    if held is not None and held.num_rows:
        yield solve(held)


def _context_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for i in range(batch.num_rows):
            doc, wanted = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
            data = unpack.decompress(batch.column(1)[i].as_py())
            wanted = [w for w in wanted if w["s"] + w["n"] + WIDTH - 1 <= len(data)]  # another text under the id
            yield pa.RecordBatch.from_arrays([
                pa.array([w["name"] for w in wanted], pa.int64()), pa.array([doc] * len(wanted), pa.int64()),
                pa.array([w["s"] for w in wanted], pa.int32()), pa.array([w["n"] for w in wanted], pa.int32()),
                pa.array([data[w["s"]:w["s"] + w["n"] + WIDTH - 1] for w in wanted], pa.binary())],
                names=["name", "doc_id", "s", "n", "bytes"])


def _window_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            n, data = batch.column("n")[i].as_py(), batch.column("bytes")[i].as_py()
            p = prefix_hash(np.frombuffer(data, dtype=np.uint8))
            at = np.arange(n)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, batch.column("name")[i].as_py()), pa.int64()),
                pa.array(range_hash(p, at, at + WIDTH).view(np.int64), pa.int64()),
                pa.array(np.full(n, batch.column("doc_id")[i].as_py()), pa.int64()),
                pa.array(batch.column("s")[i].as_py() + at, pa.int64())], names=["name", "window", "doc_id", "a"])


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            batch = whole.slice(at, 500)
            rows = []
            for doc, z, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(),
                                     strict=True):
                data = unpack.decompress(z.as_py())
                kept, removed, n, end = [], 0, 0, 0
                for a, b in sorted((x["a"], x["b"]) for x in spans or ()):
                    if n == 0 or a > end:       # touching ranges are one maximal run
                        kept.append(data[end:a])
                        n, removed, end = n + 1, removed + b - a, b
                    elif b > end:
                        removed, end = removed + b - end, b
                kept.append(data[end:])
                text = b"".join(kept)
                rows.append((doc, len(data), removed, n, hashlib.sha256(text).hexdigest(), text))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds, strict=True)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def repeated_ranges(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """``doc_id, a, b``: byte ranges (they may overlap) that have earlier matches.

    ``docs`` has ``doc_id`` (no nulls) and ``text``.
    """
    found = docs.select("doc_id", "text").mapInArrow(
        _block_batches, "doc_id long, s int, n int, name long, block long, twice boolean")
    names = cut(found.groupBy("name").agg(F.count("*").alias("c"), F.max("twice").alias("twice"))
                .filter("c > 1 or twice").select("name"), "names")
    some = cut(found.join(names, "name"), "blocks")
    first = cut(some.groupBy("name", "block").agg(
        F.min(F.struct("doc_id", "s")).alias("f"), F.max("n").alias("n"),
        F.max("twice").alias("twice"))
        .select("name", "block", F.col("f.doc_id").alias("f_doc"), F.col("f.s").alias("f_s"), "n", "twice"),
        "first-blocks")
    copies = (some.join(first.drop("n", "twice"), ["name", "block"]).filter("doc_id <> f_doc or s <> f_s")
              .select("doc_id", F.col("s").cast("long").alias("a"), (F.col("s") + F.col("n") + (WIDTH - 1)).cast("long").alias("b")))
    several = cut(first.groupBy("name").agg(F.count("*").alias("c"), F.max("twice").alias("twice"))
                  .filter("c > 1 or twice"), "ambiguous-names")
    wanted = (first.join(several.select("name"), "name").groupBy("f_doc")
              .agg(F.collect_list(F.struct("name", F.col("f_s").alias("s"), "n")).alias("wanted")))
    context = (packed_texts(docs, "doc_id", "text")
               .join(cut(wanted, "wanted"), F.col("doc_id") == F.col("f_doc")).select("doc_id", "z", "wanted")
               .mapInArrow(_context_batches, "name long, doc_id long, s int, n int, bytes binary"))
    context = cut(context, "contexts")
    plain = several.filter(F.col("c") <= hot).select("name")
    single = (context.join(plain, "name", "left_semi").repartition("name")
              .sortWithinPartitions("name", "doc_id", "s").mapInArrow(_order_batches, "doc_id long, a long, b long"))
    often = context.join(several.filter(F.col("c") > hot).select("name"), "name", "left_semi")
    windows = often.mapInArrow(_window_batches, "name long, window long, doc_id long, a long")
    lead = cut(windows.groupBy("name", "window").agg(F.min(F.struct("doc_id", "a")).alias("f"), F.count("*").alias("c"))
               .filter("c > 1"), "first-windows")
    again = (windows.join(lead, ["name", "window"]).filter("doc_id <> f.doc_id or a <> f.a")
             .select("doc_id", "a", (F.col("a") + WIDTH).alias("b")))
    return copies.unionByName(single).unionByName(again)


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept`` (the remaining bytes) per document."""
    low = F.lit(-(1 << 63))
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), low).alias("doc_id"), F.col(text_col).alias("text"))
    spans = cut(repeated_ranges(base, hot).groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
                .withColumnRenamed("doc_id", "span_id"), "ranges")
    out = (packed_texts(base, "doc_id", "text").join(spans, F.col("doc_id") == F.col("span_id"), "left")
           .select("doc_id", "z", "spans").mapInArrow(
               _cut_batches, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"))
    return out.withColumn("doc_id", F.nullif("doc_id", low))
