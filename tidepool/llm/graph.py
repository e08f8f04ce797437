"""Components of a link graph, and links of posting lists without all pairs.

``components`` alternates large-star and small-star steps (each node hands its
larger, then its smaller neighbours to the smallest one it knows) until nothing
is left but stars: a distributed union-find with a logarithmic number of rounds
for which no node, link or component goes to the driver.

``linked_components`` turns posting lists of sets into components under an exact
Jaccard threshold.  Testing every pair of a list as rows is quadratic in its
length, and mostly unnecessary, as connected nodes need no test:

1. *Star*: every member of a list is tested against its foremost member.
2. *Short lists* (up to ``SHORT`` members) whose members are not all connected by
   then: every pair from different components is tested.
3. *Long lists* that are not all connected: lists that share members are joined
   to groups, a group is cut into blocks of about ``BLOCK`` nodes, and pairs of
   blocks are compared inside a task, by products of their incidence matrices.
   No pair is emitted unless it connects two components, a large component has
   blocks of its own, and blocks of one component are not compared.

Every pair of a list is thus tested or connected, so no link between different
components is lost; a task holds two blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import counted_cut, cut, release, tasks

SHORT = 64
BLOCK = 256
COLUMNS = 8192      # elements whose incidence is held at a time
PAIR_WORK = 64      # rows whose writing is the work of comparing a pair
BULK = 1 << 19      # size of the items of pairs that are compared at a time
ToSet = Callable[[bytes], np.ndarray]
ToSets = Callable[[list], list[np.ndarray]]


def _is_stars(e: DataFrame, n: int) -> bool:
    """Whether every node has one edge to a root that has none (one pass over the ``n`` edges)."""
    ends = e.select("u", "v", F.explode(F.array(F.lit(0), F.lit(1))).alias("end"))
    ends = ends.select(F.when(F.col("end") == 0, F.col("u")).otherwise(F.col("v")).alias("x"), "end")
    return (ends.groupBy("x").agg(F.count(F.when(F.col("end") == 0, 1)).alias("up"), F.max("end").alias("root"))
            .filter("up > 1 or (up = 1 and root = 1)").coalesce(tasks(2 * n)).isEmpty())


def components(links: DataFrame, a: str = "a", b: str = "b", rows: int | None = None) -> DataFrame:
    """``node, root`` for every linked node that is not the smallest of its component.

    Null ends and self-links are ignored; repeated links count once.  ``links`` has
    at most ``rows`` rows, if that is given.
    """
    e = (links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"),
                      F.col(a).isNull().alias("na"), F.col(b).isNull().alias("nb"))
         .filter("u > v and not na and not nb").select("u", "v").distinct())
    e, n = counted_cut(e, "edges", rows)
    while n and not _is_stars(e, n):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "large-star", 2 * n)
        e = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .distinct())
        e, n = counted_cut(e, "edges", n)
        low = cut(e.groupBy("u").agg(F.min("v").alias("m")), "small-star", n)
        e = (e.join(low, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        e, n = counted_cut(e, "edges", n)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))


def common_sizes(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets ``a`` and ``b`` (positions, pair by pair)."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    ends = np.cumsum(sizes[a] + sizes[b]).tolist()
    both = np.concatenate([sets[i] for pair in zip(a.tolist(), b.tolist()) for i in pair])
    for x, y in zip([0, *ends], ends):
        both[x:y].sort()
    same = np.append(0, np.cumsum(both[1:] == both[:-1]))
    out = np.zeros(len(a), dtype=np.int64)
    for i, (x, y) in enumerate(zip([0, *ends], ends)):
        out[i] = same[y - 1] - same[x] if y > x else 0      # not across the border of two pairs
    return out


def _pair_batches(batches: Iterator[pa.RecordBatch], to_sets: ToSets, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows ``a, b, item_a, item_b`` to the pairs whose sets are similar."""
    def similar(a: list[int], b: list[int], items: dict[int, object]) -> pa.RecordBatch:
        at = {node: i for i, node in enumerate(items)}
        sets = to_sets(list(items.values()))
        x, y = (np.array([at[n] for n in nodes]) for nodes in (a, b))
        size, both = np.array([len(s) for s in sets], dtype=np.int64), common_sizes(sets, x, y)
        keep = 100 * both >= percent * (size[x] + size[y] - both)
        return pa.RecordBatch.from_arrays([pa.array(np.array(a, dtype=np.int64)[keep]), pa.array(np.array(b, dtype=np.int64)[keep])],
                                          names=["a", "b"])

    for batch in batches:
        a, b, items, bulk, start = batch.column(0).to_pylist(), batch.column(1).to_pylist(), {}, 0, 0
        for i in range(len(a)):
            for node, column in ((a[i], 2), (b[i], 3)):
                if node not in items:
                    items[node] = batch.column(column)[i].as_py()
                bulk += len(items[node])          # a pair's sets are laid out once more to be compared
            if bulk > BULK:
                yield similar(a[start:i + 1], b[start:i + 1], items)
                items, bulk, start = {}, 0, i + 1
        if items:
            yield similar(a[start:], b[start:], items)


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    which = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1                       # an element of one set only adds nothing
    which, column = which[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    which, column = which[order], column[order]
    total = np.zeros((n, n), dtype=np.float64)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        part = slice(*np.searchsorted(column, (a, a + COLUMNS)))
        m = np.zeros((n, min(COLUMNS, int(column[-1]) + 1 - a)), dtype=np.float32)
        m[which[part], column[part] - a] = 1
        total += m @ m.T
    return total.astype(np.int64)


def connecting_links(nodes: list[int], comps: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Similar pairs that connect different components, none twice."""
    size = np.array([len(s) for s in sets])
    both = common_counts(sets)
    near = np.triu(100 * both >= percent * (size[:, None] + size[None] - both), 1)
    up = {c: c for c in comps}

    def find(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(near)):
        a, b = find(comps[i]), find(comps[j])
        if a != b:
            up[max(a, b)] = min(a, b)
            out.append((min(nodes[i], nodes[j]), max(nodes[i], nodes[j])))
    return out


def _block_links(lists: DataFrame, items: DataFrame, to_sets: ToSets, percent: int, alone: bool,
                 rows: int) -> DataFrame:
    """Links between members of long lists (``token, node, comp``, at most ``rows``), compared block by block.

    A list is a group of its own (``alone``), or lists that share members are one.
    """
    if alone:
        nodes = cut(lists.select("node", "comp", F.col("token").alias("grp")), "group-nodes", rows)
    else:
        first = cut(lists.groupBy("token").agg(F.min("node").alias("b")), "list-firsts", rows)
        group = components(lists.join(first, "token").filter("node <> b").select(F.col("node").alias("a"), "b").distinct(),
                           rows=rows)
        nodes = (lists.select("node", "comp").distinct().join(group, "node", "left")
                 .select("node", "comp", F.coalesce("root", "node").alias("grp")))
        nodes = cut(nodes, "group-nodes", rows)
    sizes = nodes.groupBy("grp", "comp").agg(F.count("*").alias("n"))
    small = sizes.filter(F.col("n") <= BLOCK).groupBy("grp").agg(F.sum("n").alias("rest"))
    sizes = cut(sizes.join(small, "grp", "left").withColumnRenamed("grp", "g").withColumnRenamed("comp", "c"), "group-sizes", rows)
    large = F.col("n") > BLOCK
    parts = F.ceil(F.when(large, F.col("n")).otherwise(F.col("rest")) / BLOCK)
    part = F.pmod(F.xxhash64(F.when(large, F.col("node")).otherwise(F.col("comp"))), parts)
    placed = (nodes.join(sizes, (F.col("grp") == F.col("g")) & (F.col("comp") == F.col("c")))
              .select("grp", "node", "comp", F.when(large, F.col("comp")).alias("pure"), part.alias("part")))
    placed = cut(placed.withColumn("blk", F.xxhash64("grp", "pure", "part")), "blocks", 2 * rows)
    blocks = placed.select("grp", "pure", "blk").distinct()
    x, y = blocks.toDF("grp", "pure1", "blk1"), blocks.toDF("grp", "pure2", "blk2")
    pairs = (x.join(y, "grp").filter((F.col("blk1") <= F.col("blk2"))
                                     & F.coalesce(F.col("pure1") != F.col("pure2"), F.lit(True)))
             .select(F.xxhash64("blk1", "blk2").alias("pair"), F.explode(F.array_distinct(F.array("blk1", "blk2"))).alias("blk")))
    rows = placed.select("blk", "node", "comp").join(cut(pairs, "block-pairs"), "blk").join(items, "node")

    def compare(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        found = connecting_links(t["node"].to_pylist(), t["comp"].to_pylist(),
                                 to_sets(t["item"].to_pylist()), percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    return rows.select("pair", "node", "comp", "item").groupBy("pair").applyInArrow(compare, "a long, b long")


def linked_components(postings: DataFrame, items: DataFrame | Callable[[DataFrame], DataFrame], to_set: ToSet, percent: int,
                      likely: Callable[[DataFrame], DataFrame] = lambda pairs: pairs,
                      alone: bool = False, rows: int | None = None,
                      met: bool = False, to_sets: ToSets | None = None) -> tuple[DataFrame, DataFrame]:
    """Components (``node, root``) and confirmed links (``a, b``) of posting lists.

    ``postings`` has ``token, node, weight`` (the member of a list with the
    largest weight is its foremost), ``items`` has ``node, item`` (or gives that for
    a table of the nodes in question); ``to_set`` turns an item into its sorted distinct 64-bit elements.  ``likely`` may drop
    candidate pairs (``a < b``) that cannot reach ``percent``.  ``alone`` compares
    each long list for itself: better where lists share members by chance, as joined
    lists are compared across, and worse where many lists have the same members.
    ``rows``, if known, is the number of postings at most.  ``met``: the postings are
    written, ``rows`` of them, no list has a single member, and ``head`` and ``m`` (a list's
    foremost member and number of members) stand in place of ``weight``.  ``to_sets`` is
    ``to_set`` for many items at a time.
    """
    to_sets = to_sets or (lambda many: [to_set(x) for x in many])

    def items_of(rows: DataFrame, *cols: str) -> DataFrame:
        if isinstance(items, DataFrame):
            return items
        return items(rows.select(F.explode(F.array(*cols)).alias("node")).distinct())

    def confirm(pairs: DataFrame, rows: int | None) -> tuple[DataFrame, int]:
        pairs, n = counted_cut(likely(pairs), "pairs", rows)
        release(pairs.sparkSession)
        own = items_of(pairs, "a", "b")
        full = (pairs.join(own.toDF("b", "item_b"), "b").join(own.toDF("a", "item_a"), "a")
                .select("a", "b", "item_a", "item_b"))
        return counted_cut(full.mapInArrow(lambda it: _pair_batches(it, to_sets, percent), "a long, b long"), "links",
                           n * PAIR_WORK)

    def ordered(x: str, y: str) -> list:
        return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]

    def open_lists(roots: DataFrame, rows: int) -> tuple[DataFrame, int]:
        """Members of the lists that are not one component and have pairs besides those of their foremost member."""
        known = (many.join(roots, "node", "left")
                 .select("token", "node", "head", F.coalesce("root", "node").alias("comp")))
        left = cut(known.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"))
                   .filter("lo <> hi").select("token", "m"), "open-lists", rows)
        return counted_cut(known.join(left, "token"), "open-members", 2 * rows)

    if met:
        n = rows
    else:
        postings, n = counted_cut(
            postings.join(cut(postings.groupBy("token").agg(F.count("*").alias("m")).filter("m > 1").select("token"),
                              "lists", rows), "token"), "postings", rows)
        # the foremost member, map-side combined: a long list is one row per task
        head = cut(postings.groupBy("token").agg(F.max(F.struct("weight", F.bitwise_not("node").alias("n"))).alias("h"),
                                                 F.count("*").alias("m"))
                   .select("token", F.bitwise_not("h.n").alias("head"), "m"), "heads", n)
        postings = postings.join(head, "token")
    many = postings.filter("m > 2").select("token", "node", "head")      # the one pair of a list of two is tested by its star
    links, n_star = confirm(postings.filter("node <> head").select(*ordered("node", "head")).distinct(), n)
    roots = cut(components(links, rows=n_star), "components", n_star)
    members, n = open_lists(roots, n)
    # the stars have tested the pairs of the foremost member
    short = members.filter((F.col("m") <= SHORT) & (F.col("node") != F.col("head"))).select("token", "node", "comp")
    pairs = (short.join(short.toDF("token", "node2", "comp2"), "token").filter("node < node2 and comp <> comp2")
             .select(*ordered("node", "node2")).distinct())
    more, n_more = confirm(pairs, SHORT * n)
    found_later, found = more, n_star + n_more
    long = members.filter(F.col("m") > SHORT).select("token", "node", "comp")
    if not long.isEmpty():
        more, n_more = counted_cut(_block_links(long, items_of(long, "node"), to_sets, percent, alone, n), "block-links")
        found_later, found = found_later.unionByName(more), found + n_more
    # what was connected by the stars stays so
    joined = roots.toDF("a", "b").unionByName(found_later)
    return cut(components(joined, rows=found), "components", found), links.unionByName(found_later)
