"""Line deduplication by MinHash over character shingles.

A line's *form* is its text in lower case with white space runs as one blank; a
line without a form (blank) is left alone.  Lines with equal forms are one node,
whatever their length.

1. *Signatures.*  Every node with a shingle (5 characters) gets ``BANDS * ROWS``
   MinHash coordinates of 16 bits; a band of four is a 64-bit token.  A task
   posts a form once, however often it meets it.
2. *Banding.*  Nodes that share a token meet in a posting list; tokens of one node
   are dropped.  At a similarity of 0.8 a pair shares no band three times in a
   hundred thousand ((1 - 0.8**4)**20), at 0.9 once in a hundred million.  Tokens
   travel in packed buckets with 2 bits of 64 coordinates (``sketches``); a bucket's
   task takes each list apart where neither sizes nor sketches allow 0.8 (``NEAR`` of
   64 agree; fewer do about twice in a million pairs at 0.8), as most members of lists
   of a large corpus met by chance.  Longer lists than ``LIST`` go on whole.
3. *Verification.*  ``graph.linked_components`` (distributed union-find) walks the
   lists.  A pair goes on if its set sizes allow 0.8 (they are kept in the node
   number, so this needs no join) and ``AGREE`` of its 80 coordinates agree (64 are
   expected at 0.8; fewer than ``AGREE`` happen about once in a million such pairs;
   four bits of each are compared, so chance adds one in sixteen of the others);
   then the exact Jaccard similarity of the shingle sets decides.  Only for
   such pairs are the forms fetched from the texts.

Of each component the line that comes first by (id, text hash, line number) stays.

The node of a form is a 52-bit hash of it and its set size (12 bits, the largest
value meaning as many or more).

Edge cases: a null text has no lines and stays null; blank lines stay; forms
shorter than a shingle are compared as a whole; a text that loses every line becomes
empty, its row stays; equal lines within a text count like any others; rows that
repeat an id and text are one document; different texts under one id are documents
of their own; rows with a null id keep all their lines and stand for nothing; other
columns pass in a struct, so no name can clash; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import LISTED, coordinates, counted_cut, cut, listed, mix, release
from tidepool.llm.graph import linked_components

GRAM = 5
BANDS = 20
ROWS = 4
PERCENT = 80
AGREE = 45
SIZE_BITS = 12
SIGS = BANDS // 4
MOST = (1 << SIZE_BITS) - 1        # set sizes of this many and more are not told apart
STEP = 5                           # bands that are exchanged at a time
NEAR = 39                          # sketched coordinates that agree
LIST = 4096                        # members of a list that is taken apart
BUCKET = 1 << 17                   # tokens of a bucket
PACKED = 1 << 16                   # nodes whose tokens a task packs at a time
SEEN = 1 << 18                     # nodes a task remembers as posted
PICKED = 1 << 20                   # characters of forms that a task hands over at a time
_SIGS = [f"g{i}" for i in range(SIGS)]
_BANDS = [f"b{i}" for i in range(BANDS // STEP)]
_GRAM_LANES = (np.random.default_rng(5).integers(0, 1 << 63, GRAM, dtype=np.uint64)
               * np.uint64(2) + np.uint64(1))
_CODES = mix(np.arange(1, (1 << 16) + 1, dtype=np.uint64))      # of the code points below 65,536


def form(line: str) -> str:
    """The text by which lines are compared."""
    return " ".join(line.lower().split())


def _hash_of(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8"), digest_size=8).digest(), "little", signed=True)


def _numbered(h: int, size: int) -> int:
    return (h >> SIZE_BITS << SIZE_BITS) | min(size, MOST)


def node_of(text: str, size: int) -> int:
    """Node of a form with ``size`` distinct shingles."""
    return _numbered(_hash_of(text), size)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """Hashes of all ``GRAM``-character shingles of an array of code points."""
    c = np.take(_CODES, codes, mode="clip")
    far = np.flatnonzero(codes >= len(_CODES))
    if len(far):
        c[far] = mix(codes[far].astype(np.uint64) + np.uint64(1))
    n = len(c) - GRAM + 1
    acc, buf = c[:n] * _GRAM_LANES[0], np.empty(n, dtype=np.uint64)
    for j in range(1, GRAM):
        acc += np.multiply(c[j:n + j], _GRAM_LANES[j], out=buf)
    return mix(acc)


def _join(forms: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of forms of at least ``GRAM`` characters, one after another, and where each form's start."""
    lens = np.array([len(f) for f in forms])
    codes = np.frombuffer("".join(forms).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    grams = gram_hashes(codes)
    at = np.cumsum(lens)
    inside = np.ones(len(codes), dtype=bool)
    for j in range(1, GRAM):
        inside[at - j] = False           # shingles that would run into the next line
    return grams[inside[:len(grams)]], np.concatenate([[0], np.cumsum(lens - GRAM + 1)[:-1]])


def set_sizes(grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of distinct shingles of each form."""
    keys = grams.copy()
    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
        keys[a:b].sort()
    new = np.append(True, keys[1:] != keys[:-1])
    new[starts] = True
    return np.add.reduceat(new, starts, dtype=np.int64)


def band_tokens(grams: np.ndarray, starts: np.ndarray, masks: np.ndarray, muls: np.ndarray) -> np.ndarray:
    """Tokens (forms x BANDS): four coordinates of 16 bits each."""
    low = (grams >> np.uint64(32)).astype(np.uint32)
    buf = np.empty_like(low)
    half = BANDS * ROWS // 2
    found = np.empty((2 * half, len(starts)), dtype=np.uint32)
    for i in range(half):              # the least and the largest of an order are two coordinates, of different bands
        np.bitwise_xor(low, masks[i], out=buf)
        np.multiply(buf, muls[i], out=buf)
        np.minimum.reduceat(buf, starts, out=found[i])
        np.maximum.reduceat(buf, starts, out=found[half + i])
    parts = (mix(found) >> np.uint64(48)).reshape(BANDS, ROWS, -1)
    parts <<= np.arange(0, 16 * ROWS, 16, dtype=np.uint64)[:, None]
    return np.ascontiguousarray(np.bitwise_or.reduce(parts, axis=1).T).view(np.int64)


def sketches(tokens: np.ndarray) -> np.ndarray:
    """Two bits of each coordinate of the first 16 bands (forms x 2: the first bits, the second bits)."""
    t, low = tokens.view(np.uint64), np.uint64(0x0001000100010001)
    out = np.zeros((len(t), 2), dtype=np.uint64)
    for j in range(16):
        out[:, 0] |= (t[:, j] & low) << np.uint64(j)
        out[:, 1] |= (t[:, j] >> np.uint64(1) & low) << np.uint64(j)
    return out.view(np.int64)


def nibble_words(tokens: np.ndarray) -> np.ndarray:
    """Four bits of each coordinate (forms x SIGS), as ``nibbles`` has them."""
    low = tokens.view(np.uint64) & np.uint64(0x000F000F000F000F)
    low <<= np.tile(np.arange(0, 16, 4, dtype=np.uint64), SIGS)
    return np.bitwise_or.reduce(low.reshape(len(tokens), SIGS, -1), axis=2).view(np.int64)


def _join_labels(lab: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels (least member of a component) after the links ``a, b``."""
    while True:
        x, y = lab[a], lab[b]
        if not (x != y).any():
            return lab
        up = np.arange(len(lab))
        np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
        while (up[up] != up).any():
            up = up[up]
        lab = up[lab]


def near_lists(rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Lists (token, node) of the nodes that share a token and may be similar, from rows ``token, node`` and sketches.

    A list of at most ``LIST`` members is parted into the components of such pairs;
    members are in the order of their set sizes, so only pairs whose sizes allow
    it are looked at.  A longer one stays as it is.
    """
    def parts(*cols: np.ndarray) -> np.ndarray:
        new = np.ones(len(cols[0]), dtype=bool)
        new[1:] = np.any([c[1:] != c[:-1] for c in cols], axis=0)
        return new

    rows = rows[np.argsort(rows[:, 0])]
    first = parts(rows[:, 0])
    rows = rows[~(first & np.append(first[1:], True))]
    rows = rows[np.lexsort((rows[:, 1], rows[:, 1] & MOST, rows[:, 0]))]
    rows = rows[parts(rows[:, 0], rows[:, 1])]
    token, node, size, s0, s1 = rows[:, 0], rows[:, 1], rows[:, 1] & MOST, rows[:, 2], rows[:, 3]
    n, at = len(rows), np.flatnonzero(parts(token))
    long = np.diff(np.append(at, n))
    start, long = np.repeat(at, long), np.repeat(long, long)
    lab = np.where(long > LIST, start, np.arange(n))
    left, k, found, waiting = np.flatnonzero(long <= LIST), 0, [], 0
    while len(left):
        k += 1
        left = left[left + k < n]
        left = left[(start[left] == start[left + k]) & (100 * size[left] >= percent * size[left + k])]
        a = left[lab[left] != lab[left + k]]
        a = a[np.bitwise_count((s0[a] ^ s0[a + k] | s1[a] ^ s1[a + k]).view(np.uint64)) <= 64 - NEAR]
        if len(a):
            found.append((a, a + k))
            waiting += len(a)
        if found and (waiting > 1 << 16 or not len(left)):
            lab, found, waiting = _join_labels(lab, *map(np.concatenate, zip(*found))), [], 0
    kept = np.bincount(lab, minlength=n)[lab] > 1
    own = mix(token.view(np.uint64) + node[lab].view(np.uint64)).view(np.int64)
    return own[kept], node[kept]


def _pack_tokens(batches: Iterator[pa.RecordBatch], at: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Rows ``token, node`` and sketches of some bands from band ``at`` on, packed by bucket."""
    lanes = mix(np.arange(at, at + STEP, dtype=np.uint64) + np.uint64(1))
    waiting: list[np.ndarray] = []

    def flush() -> pa.RecordBatch:
        rows = np.concatenate(waiting)
        waiting.clear()
        bucket = (rows[:, 0].view(np.uint64) % np.uint64(buckets)).astype(np.uint16)
        rows = rows[np.argsort(bucket, kind="stable")]
        n = np.bincount(bucket, minlength=buckets)
        ends = np.concatenate([[0], np.cumsum(n[n > 0])]) * (8 * rows.shape[1])
        data = pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(rows)])
        return pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n), pa.int32()), data], names=["bucket", "data"])

    for batch in batches:
        node, s0, s1 = (batch.column(i).to_numpy() for i in range(3))
        some = batch.column(3)                # of 8 * STEP bytes each, none is null
        first = np.frombuffer(some.buffers()[1], dtype=np.int32)[some.offset] if len(some) else 0
        tokens = np.frombuffer(some.buffers()[2] or b"", dtype=np.uint64, offset=first, count=len(some) * STEP).reshape(-1, STEP)
        rows = np.empty((len(node), STEP, 4), dtype=np.int64)
        rows[:, :, 0] = mix(tokens + lanes).view(np.int64)
        for i, x in enumerate((node, s0, s1), 1):
            rows[:, :, i] = x[:, None]
        waiting.append(rows.reshape(-1, 4))
        if sum(map(len, waiting)) > PACKED * STEP:
            yield flush()
    if sum(map(len, waiting)):
        yield flush()


def _line_batches(batches: Iterator[pa.RecordBatch], seed: int) -> Iterator[pa.RecordBatch]:
    masks, muls = (x.astype(np.uint32) for x in coordinates(seed, BANDS * ROWS))
    muls |= np.uint32(1)
    met: dict[int, int] = {}           # node of each form that the task has posted, by the form's hash
    ids, hs, nos, forms, chars = [], [], [], [], 0

    def flush() -> pa.RecordBatch:
        if len(met) > SEEN:
            met.clear()
        hashes = [_hash_of(f) for f in forms]
        new: dict[int, int] = {}
        for i, (h, f) in enumerate(zip(hashes, forms)):
            if h not in met and len(f) >= GRAM:
                new.setdefault(h, i)
        at = list(new.values())
        sketch, sig = np.zeros((len(forms), 2), dtype=np.int64), np.zeros((len(forms), SIGS), dtype=np.int64)
        bands: list[list[bytes | None]] = [[None] * len(forms) for _ in range(BANDS // STEP)]
        if at:
            grams, starts = _join([forms[i] for i in at])
            tokens = band_tokens(grams, starts, masks, muls)
            met.update(zip(new, map(_numbered, new, set_sizes(grams, starts).tolist())))
            sketch[at], sig[at] = sketches(tokens), nibble_words(tokens)
            for k, some in enumerate(bands):
                data = tokens[:, k * STEP:(k + 1) * STEP].tobytes()
                for j, i in enumerate(at):
                    some[i] = data[8 * STEP * j:8 * STEP * (j + 1)]
        nodes = [met[h] if len(f) >= GRAM else _numbered(h, 0) for h, f in zip(hashes, forms)]
        out = pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(hs, pa.int64()), pa.array(nos, pa.int32()), pa.array(nodes, pa.int64()),
             *map(pa.array, [*sketch.T, *sig.T]), *(pa.array(x, pa.binary()) for x in bands)],
            names=["doc_id", "h", "line_no", "node", "s0", "s1", *_SIGS, *_BANDS])
        for x in (ids, hs, nos, forms):
            x.clear()
        return out

    for batch in batches:
        for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            for no, line in enumerate(text.as_py().split("\n")):
                f = form(line)
                if f:
                    ids.append(doc_id), hs.append(h), nos.append(no), forms.append(f)
                    chars += len(f)
                    if chars > 1 << 18:
                        yield flush()
                        chars = 0
    if forms:
        yield flush()


def _pick_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    nodes, items, chars = [], [], 0

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(items, pa.string())], names=["node", "item"])
        nodes.clear(), items.clear()
        return out

    for batch in batches:
        for text, nos, own in zip(batch.column(0), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            lines = text.as_py().split("\n")
            nodes += own
            items += [form(lines[no]) for no in nos]
            chars += sum(map(len, items[-len(nos):]))
            if chars > PICKED:
                yield flush()
                chars = 0
    if nodes:
        yield flush()


def form_set(text: str) -> np.ndarray:
    """Distinct shingle hashes of a form."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.unique(gram_hashes(codes)) if len(codes) >= GRAM else np.zeros(0, dtype=np.uint64)


def form_sets(texts: list[str]) -> list[np.ndarray]:
    """``form_set`` of several forms."""
    out = [np.zeros(0, dtype=np.uint64)] * len(texts)
    long = [i for i, f in enumerate(texts) if len(f) >= GRAM]
    if long:
        grams, starts = _join([texts[i] for i in long])
        bounds = [*starts.tolist(), len(grams)]
        for a, b in zip(bounds, bounds[1:]):
            grams[a:b].sort()
        new = np.append(True, grams[1:] != grams[:-1])
        new[starts] = True
        ends = np.append(0, np.cumsum(np.add.reduceat(new, starts, dtype=np.int64))).tolist()
        grams = grams[new]
        for i, a, b in zip(long, ends, ends[1:]):
            out[i] = grams[a:b]
    return out


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    x, y = (F.col(c).bitwiseAND(F.lit(MOST)) for c in (a, b))
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)      # a size of MOST or more counts as MOST


def nibbles(bands: str) -> Column:
    """Four bits of each coordinate of a node's tokens, in a struct of ``SIGS`` longs."""
    low = [F.col(bands)[i].bitwiseAND(F.lit(0x000F000F000F000F)) for i in range(BANDS)]
    return F.struct(*[reduce(Column.bitwiseOR, [F.shiftleft(x, 4 * j) for j, x in enumerate(low[i:i + 4])]).alias(f"s{i // 4}")
                      for i in range(0, BANDS, 4)])


def _agreeing(a: str, b: str) -> Column:
    """Coordinates in which two nodes' ``nibbles`` agree: at least those in which their tokens do."""
    other = []
    for i in range(SIGS):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        x = x.bitwiseOR(F.shiftright(x, 2))
        x = x.bitwiseOR(F.shiftright(x, 1))
        other.append(F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111))))
    return F.lit(BANDS * ROWS) - reduce(Column.__add__, other)


def repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                   percent: int = PERCENT, seed: int = 6) -> DataFrame:
    """``doc_id, h, drop`` (sorted line numbers) for the texts that lose lines; ``h`` is the text's ``xxhash64``."""
    text = F.col(f"`{text_col}`")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text")).filter(
        "doc_id is not null and text is not null")
    lines, n_lines = counted_cut(
        base.mapInArrow(lambda it: _line_batches(it, seed),
                        "doc_id long, h long, line_no int, node long, s0 long, s1 long, "
                        + ", ".join([*(f"{c} long" for c in _SIGS), *(f"{c} binary" for c in _BANDS)])), "lines")
    first_met = lines.filter("b0 is not null")
    buckets = min(1 << 16, max(64, -(-n_lines * STEP // BUCKET)))
    posted, n_posted = [], 0

    def meet(t: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(x.as_buffer(), dtype=np.int64) for x in t["data"]]).reshape(-1, 4)
        token, node = near_lists(rows, percent)
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        first = np.flatnonzero(np.append(True, token[1:] != token[:-1])[:len(token)])
        m = np.diff(np.append(first, len(token)))
        return pa.table({"token": token, "node": node, "head": np.repeat(node[first], m), "m": np.repeat(m, m)})

    for at in range(0, BANDS, STEP):          # what the exchange of some bands needs on disk is free again for the next
        packed = first_met.select("node", "s0", "s1", _BANDS[at // STEP]).mapInArrow(
            lambda it, at=at: _pack_tokens(it, at, buckets), "bucket int, data binary")
        some, n = counted_cut(packed.groupBy("bucket").applyInArrow(meet, "token long, node long, head long, m long"), "postings")
        posted.append(some)
        n_posted += n
        release(docs.sparkSession)
    posted = reduce(DataFrame.unionByName, posted)

    def likely(pairs: DataFrame) -> DataFrame:
        release(docs.sparkSession)
        pairs = cut(pairs.filter(_sizes_allow("a", "b", percent)), "sized-pairs")
        nodes, n_nodes = counted_cut(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "sized-nodes")
        nodes = F.broadcast(nodes) if n_nodes <= LISTED else nodes
        sig = cut(first_met.select("node", F.struct(*[F.col(c).alias(f"s{i}") for i, c in enumerate(_SIGS)]).alias("sig")).join(nodes, "node").groupBy("node").agg(F.first("sig").alias("sig")),
                  "signatures", 2 * n_nodes)
        full = pairs.join(sig.toDF("a", "sig_a"), "a").join(sig.toDF("b", "sig_b"), "b")
        return full.filter(_agreeing("sig_a", "sig_b") >= AGREE).select("a", "b")

    def forms(nodes: DataFrame) -> DataFrame:
        release(docs.sparkSession)
        nodes = cut(nodes, "form-nodes")
        at = (lines.select("node", "doc_id", "h", "line_no").join(listed(nodes), "node")
              .groupBy("node").agg(F.min(F.struct("doc_id", "h", "line_no")).alias("at")))
        where = cut(at.groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.h").alias("h"))
                    .agg(F.collect_list(F.struct("at.line_no", "node")).alias("nos")), "form-places")
        # a list of at most LISTED nodes has no more places
        where = F.broadcast(where) if nodes.count() <= LISTED else where
        picked = base.join(where, ["doc_id", "h"]).select("text", "nos.line_no", "nos.node").mapInArrow(_pick_lines, "node long, item string")
        return cut(picked.groupBy("node").agg(F.first("item").alias("item")), "line-forms")

    roots, _ = linked_components(posted, forms, form_set, percent, likely, alone=True, rows=n_posted, met=True,
                                 to_sets=form_sets)
    keyed = (lines.select("doc_id", "h", "line_no", "node").join(roots, "node", "left")
             .select("doc_id", "h", "line_no", F.coalesce("root", "node").alias("comp")))
    place = F.struct("doc_id", "h", "line_no")
    first = cut(keyed.groupBy("comp").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .filter("first <> last").select("comp", "first"), "first-lines")
    # by node, so lines are exchanged once
    first = first.select(F.col("comp").alias("node"), "first").unionByName(
        roots.join(first, F.col("root") == F.col("comp")).select("node", "first"))
    return (lines.select("doc_id", "h", "line_no", "node").join(first, "node").filter(place != F.col("first"))
            .groupBy("doc_id", "h").agg(F.sort_array(F.collect_set("line_no")).alias("drop")))


def _rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            total, gone, out = [], [], []
            for text, drop in zip(part.column("text"), part.column("drop").to_pylist()):
                lines, bad = text.as_py().split("\n"), set(drop)
                total.append(len(lines)), gone.append(len(bad))
                out.append("\n".join(ln for k, ln in enumerate(lines) if k not in bad))
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(out, pa.string())], names=["row", "n_lines", "n_removed", "text"])


def clean_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                percent: int = PERCENT) -> DataFrame:
    """Rows of ``docs`` as ``row`` (a struct of the other columns), ``n_lines, n_removed, text``."""
    drop = cut(repeated_lines(docs, id_col=id_col, text_col=text_col, percent=percent)
               .toDF("drop_id", "drop_h", "drop"), "dropped-lines")
    n = drop.agg(F.count("*"), F.sum(F.size("drop"))).first()
    drop = F.broadcast(drop) if n[0] + (n[1] or 0) <= LISTED else drop
    release(docs.sparkSession)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    shape = docs.select(row).schema["row"].dataType.simpleString()
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), row, text.alias("text"))
    rows = rows.join(drop, (F.col("doc_id") == F.col("drop_id")) & (F.col("h") == F.col("drop_h")) & F.col("text").isNotNull(),
                     "left")
    whole = rows.filter("drop is null").select(
        "row", F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"),
        F.lit(0).cast("long").alias("n_removed"), "text")
    less = rows.filter("drop is not null").select("row", "text", "drop").mapInArrow(
        _rebuild, f"row {shape}, n_lines long, n_removed long, text string")
    return whole.unionByName(less)
