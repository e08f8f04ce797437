"""Filter interaction audit over sorted posting lists.

Which filter removes what depends on the order in which filters run.  For every
part of a corpus this module counts, for all orders of a few filters, what each
step removes, what an earlier step had removed already, and what the loss is
worth.

Method: ``posting_lists`` cuts each part into id ranges of at most one Arrow
batch.  The documents of a range are numbered in id order, and for each filter
the ascending numbers of its failing documents are kept (a posting list, as in an
inverted file), with one more list per flag.  ``interactions`` takes one range at
a time: the union of the lists of every set of filters by a k-way merge, the
difference of each other filter's list to that union by galloping search, and its
intersections with the flags' lists.  Ranges are disjoint, so sizes add up over
them; ``orders`` reads every step of every order from these sums.

With k filters a range gives ``k * 2**(k - 1)`` sums (80 for five) and the result
has ``k! * k`` rows a part, so ``k`` is meant to stay at six or less.  A task
holds one range; a part of any size spreads over as many tasks as it needs.

Edge cases: a null part is the empty string; a null text is the empty text.
Repeated ids count as documents of their own.  A row without id cannot come after
a smaller id, so it never fails the filter of equal texts, and has no label; a
document is good (toxic) if any of its labels says 1.  An empty table has no part
and gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import cut

BLANKS = " \t\n\u000b\f\r"
SPAN = 1024          # document numbers per range of a k-way merge
NONE = np.zeros(0, dtype=np.int64)


# --- merges of ascending lists ------------------------------------------------

def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Entries of ``a`` that ``b`` lacks; the shorter list gallops through the longer."""
    if not len(a) or not len(b):
        return a
    if len(a) <= len(b):
        at = np.searchsorted(b, a)
        return a[b[np.minimum(at, len(b) - 1)] != a]
    at = np.searchsorted(a, b)
    return np.delete(a, at[a[np.minimum(at, len(a) - 1)] == b])


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection; the shorter list gallops through the longer."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    return int((b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a).sum())


def union(lists: Sequence[np.ndarray], n: int) -> np.ndarray:
    """Union of ascending lists of numbers below ``n``: a k-way merge over number ranges.

    Every list gallops to the start of each range; a range that one list has to
    itself is copied, the runs of the others are merged.
    """
    lists = [x for x in lists if len(x)]
    if len(lists) < 2:
        return lists[0] if lists else NONE
    edges = np.arange(0, n + SPAN, SPAN)
    cuts = [np.searchsorted(x, edges) for x in lists]
    out = []
    for r in range(len(edges) - 1):
        runs = [x[c[r]:c[r + 1]] for x, c in zip(lists, cuts) if c[r] < c[r + 1]]
        if len(runs) == 1:
            out.append(runs[0])
        elif runs:
            merged = np.sort(np.concatenate(runs), kind="stable")   # merges sorted runs
            out.append(merged[np.append(True, merged[1:] != merged[:-1])])
    return np.concatenate(out)


# --- posting lists -------------------------------------------------------------

def posting_lists(rows: DataFrame, lists: Sequence[str], part: str = "part", id: str = "doc_id") -> DataFrame:
    """``part, lo, hi, n, lists``: per id range of a part the ascending numbers of its marked rows.

    ``rows`` has ``part``, ``id`` and a boolean column for each name of ``lists``
    (null: not marked).  ``lo`` and ``hi`` are the range's ids, ``n`` its rows, and
    ``lists[i]`` the row numbers (from 0, in id order) that ``lists[i]`` marks.
    """
    kind = dict(rows.dtypes)
    rows = rows.select(part, id, *[F.coalesce(c, F.lit(False)).alias(c) for c in lists])
    rows = rows.repartitionByRange(part, id).sortWithinPartitions(part, id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            parts = batch.column(0).to_pylist()
            starts = [0] + [i for i in range(1, len(parts)) if parts[i] != parts[i - 1]] + [len(parts)]
            marks = [batch.column(2 + i).to_numpy(zero_copy_only=False) for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([
                pa.array([parts[a] for a in starts[:-1]], batch.schema.field(0).type),
                batch.column(1).take(pa.array(starts[:-1])),
                batch.column(1).take(pa.array([b - 1 for b in starts[1:]])),
                pa.array([b - a for a, b in zip(starts, starts[1:])], pa.int64()),
                pa.array([[np.flatnonzero(m[a:b]) for m in marks] for a, b in zip(starts, starts[1:])],
                         pa.list_(pa.list_(pa.int64()))),
            ], names=[part, "lo", "hi", "n", "lists"])

    schema = f"{part} {kind[part]}, lo {kind[id]}, hi {kind[id]}, n long, lists array<array<long>>"
    return rows.mapInArrow(run, schema)


def interactions(postings: DataFrame, k: int, flags: Sequence[str], part: str = "part") -> DataFrame:
    """``part, before, filter, covered, removed, flags...``, summed over the part's ranges.

    ``before`` is a set of filters as a bit mask, ``covered`` what they fail
    together, ``removed`` what ``filter`` (not in the set) fails besides, and each
    flag's column how many of those the flag marks.
    """
    names = ["before", "filter", "covered", "removed", *flags]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out_part, out = [], [[] for _ in names]
            for name, n, lists in zip(*(batch.column(c).to_pylist() for c in (part, "n", "lists"))):
                lists = [np.asarray(x, dtype=np.int64) for x in lists]
                for before in range((1 << k) - 1):
                    gone = union([lists[i] for i in range(k) if before >> i & 1], n)
                    for f in (f for f in range(k) if not before >> f & 1):
                        removed = difference(lists[f], gone)
                        out_part.append(name)
                        for col, v in zip(out, [before, f, len(gone), len(removed),
                                                *(common(removed, x) for x in lists[k:])]):
                            col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(out_part, batch.schema.field(part).type),
                                              *[pa.array(c, pa.int64()) for c in out]], names=[part, *names])

    schema = f"{part} {dict(postings.dtypes)[part]}, " + ", ".join(f"{c} long" for c in names)
    sums = postings.select(part, "n", "lists").mapInArrow(run, schema)
    return sums.groupBy(part, "before", "filter").agg(*[F.sum(c).alias(c) for c in names[2:]])


def orders(postings: DataFrame, filters: Sequence[str], flags: Sequence[str], part: str = "part") -> DataFrame:
    """One row per part, order of the filters and step.

    ``kept`` (after the step), ``removed`` (by the step), ``redundant`` (failing
    the step's filter, removed earlier), ``unique_fails`` (failing that filter
    only), each flag's column (removed rows it marks) and ``shapley`` (the
    filter's removed rows, summed over all orders).  All counts are long.
    """
    spark, k = postings.sparkSession, len(filters)
    found = cut(interactions(postings, k, flags, part), "interactions")
    weight = [factorial(s) * factorial(k - 1 - s) for s in range(k)]
    whole = (1 << k) - 1
    size = F.bit_count("before")
    alone = F.sum(F.expr(f"CASE WHEN before = {whole} - shiftleft(1, cast(filter AS int)) THEN removed END"))
    per_filter = found.groupBy(part, "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("fails"), alone.alias("unique_fails"),
        F.sum(F.col("removed") * F.element_at(F.array(*map(F.lit, weight)), size + 1)).cast("long").alias("shapley"))
    total = postings.groupBy(part).agg(F.sum("n").alias("n"))
    steps = [("".join(filters[i] for i in order), s + 1, sum(1 << i for i in order[:s]), f)
             for order in permutations(range(k)) for s, f in enumerate(order)]
    # k! * k rows, fixed by the number of filters
    plan = F.broadcast(spark.createDataFrame(steps, "filter_order string, step int, before long, filter long"))
    # two rows of one part at most a filter: these joins are on the small sums
    rows = found.join(per_filter, [part, "filter"]).join(total, part).join(plan, ["before", "filter"])
    return rows.select(part, "filter_order", "step", (F.col("n") - F.col("covered") - F.col("removed")).alias("kept"),
                       "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails",
                       *flags, "shapley")


# --- the filters of the documents ----------------------------------------------

def text_filters(text: Column) -> dict[str, Column]:
    """Filters A to D as conditions under which a text fails (nulls are the empty text).

    A: under 200 words.  B: fewer than half of the words distinct.  C: more than 3 %
    of the code points in A-Z.  D: holds one of ``#$%&*|``.
    """
    text = F.coalesce(text, F.lit(""))
    body = F.btrim(text, F.lit(BLANKS))
    words = F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, r"[\x20\x09-\x0D]+"))
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": n < 200, "B": 100 * distinct < 50 * n, "C": 100 * capitals > 3 * F.length(text),
            "D": text.rlike("[#$%&*|]")}


def failing_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, doc_id, A, B, C, D, E, good_lost, toxic_lost``: a row per document with its failed filters.

    E is the filter of texts that a smaller id has as well.  The smallest id of
    every text is found by an aggregation (combined before the shuffle) and joined
    back on (id, text hash), a key that no group of copies makes frequent.
    """
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("part"), "doc_id",
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("h"),
                       *[c.alias(k) for k, c in text_filters(F.col("text")).items()])
    rows = cut(rows, "filter-fails")
    first = rows.groupBy("h").agg(F.min("doc_id").alias("doc_id")).select("h", "doc_id", F.lit(True).alias("is_first"))
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good_lost"),
                                         F.max(F.col("toxic") == 1).alias("toxic_lost"))
    again = F.col("doc_id").isNotNull() & F.col("is_first").isNull()
    return (rows.join(first, ["h", "doc_id"], "left").withColumn("E", again).drop("h", "is_first")
            .join(marks, "doc_id", "left"))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of filters A to E over all documents, per language (see ``orders``)."""
    names, flags = ["A", "B", "C", "D", "E"], ["good_lost", "toxic_lost"]
    rows = cut(failing_rows(docs, labels), "filter-rows")
    return orders(cut(posting_lists(rows, names + flags), "postings"), names, flags)
