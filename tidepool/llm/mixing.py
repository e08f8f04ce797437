"""Mixing sources to target token counts by entropy balancing.

``targets`` shares a token budget over the sources by weight; a source takes at
most ``max_epochs`` times its size, and what it cannot take is shared again over
the rest by weight until no source is above its bound (the water level of the
weights).  ``entropy_mix`` then finds document rates.

*Dual.*  Among all rates the chosen ones are closest in relative entropy to
"each document once", subject to the token total of every source and to rates
of at most ``max_epochs``.  The optimum is an exponential tilt,
``rate = min(max_epochs, exp(lambda_s * size / mean_size_s))``, with one
multiplier per source: the maximiser of a concave dual (equivalently the root
of a monotone function), found by Newton steps kept inside a bracket.  A rate
depends on source and size alone, so the iterations run on the table of
``(source, size, documents)`` cells; every step is one aggregate by source.

*Rounding.*  The totals of ``documents * rate`` up to each size of a source are
rounded, and a cell gets the difference of two neighbouring ones: what rounding
leaves goes on to the next size, so a source is off by at most one document of
its largest size, however thin its cells are.  The totals run within spans of
sizes (six leading bits) after the totals of whole spans, so no source is one
task.  Then copies of one size are added or taken where they bring a source
nearest its target, until no single copy helps.  Inside a cell the copies go to its
documents as evenly as possible, in the order of a hash of the id; ranks are
split over hash buckets of a few hundred documents, so a cell that holds a
third of all rows is not one task.  Everything is a function of the rows:
reruns agree.

Only DataFrame functions are used.  Tables by source are as small as the number
of sources, cells as the number of distinct sizes; both are written to the
shared folder between steps and their size on disk decides whether Spark
broadcasts them.

Edge cases: a null or word-less text has size 0, is kept at rate 1 and adds no
tokens; a null source is a source of its own, ordered last; a null id hashes
like any value; repeated rows are separate documents; a source without words
has target 0; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import cut

WORD = r"[^\x20\x09-\x0D]+"
BUCKET_DOCS = 256
FRACTION = 20  # bits of a copy that the running totals keep


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[float], share: float,
            max_epochs: float) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` (one row per source).

    Weights repeat along the sources in code-point order, null last.  The level
    ``t`` with ``sum(min(w * t, cap)) = budget`` is found in closed form: with
    sources ordered by ``cap / w``, the first ones are capped.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    t = (sizes.withColumn("w", w).withColumn("cap", F.col("source_size") * float(max_epochs))
         .withColumn("ratio", F.col("cap") / F.col("w")))
    t = (t.withColumn("budget", F.sum("source_size").over(whole) * float(share))
         .withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
         .withColumn("open_w", F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))))
    t = t.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("open_w"))
    # the first source whose ratio reaches the level ends the capped ones
    reached = t.filter(F.col("ratio") >= F.col("level")).agg(
        F.min_by("level", F.struct("ratio", F.col("source").isNull(), "source")).alias("t"))
    return (t.crossJoin(F.broadcast(reached))  # one row
            .select("source", "source_size",
                    F.coalesce(F.least("cap", F.col("w") * F.col("t")), F.col("cap")).alias("target")))


def _rate(max_epochs: float) -> Column:
    z = F.col("size") / F.col("mean")
    return F.when(F.col("lam").isNull(), F.lit(float(max_epochs))).otherwise(
        F.least(F.lit(float(max_epochs)), F.exp(F.least(F.col("lam") * z, F.lit(50.0)))))


def multipliers(cells: DataFrame, goals: DataFrame, max_epochs: float, *,
                tolerance: float = 1e-7, max_steps: int = 60) -> DataFrame:
    """One multiplier per source (null: every document at the bound).

    A Newton step on the logarithm of a source's tokens, replaced by bisection
    when it leaves the bracket.  ``max_steps`` is far above what bisection alone
    needs for double precision.
    """
    state = cut(goals.select(
        "source", "source_size", "target", F.lit(0.0).alias("lam"), F.lit(-1e3).alias("lo"),
        F.lit(1e3).alias("hi"),
        (F.col("source_size") == 0).alias("done"),
        (F.col("target") >= F.col("source_size") * float(max_epochs)).alias("full")), "dual")
    rate = _rate(max_epochs)
    inside = F.col("lam") * F.col("size") / F.col("mean") < F.log(F.lit(float(max_epochs)))
    for _ in range(max_steps):
        open_ = state.filter("not done and not full")
        live = cells.join(open_.select(F.col("source").alias("s2"), "lam"),
                          F.col("source").eqNullSafe(F.col("s2")))
        mass = F.col("docs") * F.col("size") * rate
        got = live.groupBy("s2").agg(
            F.sum(mass).alias("f"),
            F.sum(F.when(inside, mass * F.col("size") / F.col("mean")).otherwise(0.0)).alias("df"))
        new = state.join(got, F.col("source").eqNullSafe(F.col("s2")), "left")
        above = F.col("f") > F.col("target")
        lo = F.when(F.col("f").isNull() | above, F.col("lo")).otherwise(F.col("lam"))
        hi = F.when(F.col("f").isNull() | ~above, F.col("hi")).otherwise(F.col("lam"))
        new = new.withColumn("lo2", lo).withColumn("hi2", hi)
        step = F.col("lam") + F.log(F.col("target") / F.col("f")) * F.col("f") / F.nullif(F.col("df"), F.lit(0.0))
        ok = step.isNotNull() & (step > F.col("lo2")) & (step < F.col("hi2"))
        near = F.abs(F.col("f") - F.col("target")) <= F.col("target") * tolerance
        settled = F.col("done") | F.coalesce(near, F.lit(False))
        state = cut(new.select(
            "source", "source_size", "target",
            F.when(settled | F.col("f").isNull(), F.col("lam")).when(ok, step)
            .otherwise((F.col("lo2") + F.col("hi2")) / 2).alias("lam"),
            F.col("lo2").alias("lo"), F.col("hi2").alias("hi"), settled.alias("done"), "full"), "dual")
        if state.filter("not done and not full").isEmpty():
            break
    return state.select("source", "source_size", "target",
                        F.when(~F.col("full"), F.col("lam")).alias("lam"))


def _copies(cells: DataFrame, max_copies: int) -> DataFrame:
    """Whole copies per cell (column ``copies``), each source's tokens nearest its target.

    Totals of ``docs * rate`` are whole numbers of ``2**-FRACTION`` copies, so
    they do not depend on the order of addition.
    """
    shift = F.greatest(F.length(F.bin("size")) - 6, F.lit(0))
    cells = (cells.withColumn("part", F.round(F.col("docs") * F.col("rate") * (1 << FRACTION)).cast("long"))
             .withColumn("span", shift * 64 + F.floor(F.col("size") / F.pow(F.lit(2.0), shift))))
    spans = cells.groupBy("source", "span").agg(F.sum("part").alias("total"))
    before = Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    start = spans.select(F.col("source").alias("s2"), F.col("span").alias("span2"),
                         F.coalesce(F.sum("total").over(before), F.lit(0)).alias("start"))
    upto = F.col("start") + F.sum("part").over(
        Window.partitionBy("source", "span").orderBy("size").rowsBetween(Window.unboundedPreceding, 0))
    whole = lambda x: F.shiftright(x + (1 << FRACTION - 1), FRACTION)
    cells = cut(cells.join(start, F.col("source").eqNullSafe(F.col("s2")) & (F.col("span") == F.col("span2")))
                .withColumn("upto", upto)
                .withColumn("copies", whole(F.col("upto")) - whole(F.col("upto") - F.col("part")))
                .drop("s2", "span", "span2", "start", "upto", "part"), "cells")
    while True:
        gap = (cells.groupBy("source").agg(
            (F.max("target") - F.sum(F.col("copies") * F.col("size"))).alias("gap"))
            .withColumnRenamed("source", "s2"))
        j = cells.join(gap, F.col("source").eqNullSafe(F.col("s2")))
        free = F.when(F.col("gap") > 0, F.col("docs") * max_copies - F.col("copies")).otherwise(F.col("copies"))
        n = F.least(free, F.greatest(F.floor(F.abs("gap") / F.nullif(F.col("size"), F.lit(0))), F.lit(1)))
        left = F.abs(F.abs(F.col("gap")) - F.col("n") * F.col("size"))
        best = (j.filter((F.col("size") > 0) & (free > 0)).withColumn("n", n)
                .filter(left < F.abs(F.col("gap")))
                .groupBy("s2").agg(F.min(F.struct(left.alias("left"), "size", "n")).alias("m"),
                                   F.first(F.signum("gap")).cast("long").alias("sign"))
                .select("s2", F.col("m.size").alias("size2"), (F.col("m.n") * F.col("sign")).alias("move")))
        best = cut(best, "moves")
        if best.isEmpty():
            return cells
        cells = cut(cells.join(best, F.col("source").eqNullSafe(F.col("s2"))
                               & (F.col("size") == F.col("size2")), "left")
                    .withColumn("copies", F.col("copies") + F.coalesce("move", F.lit(0)))
                    .drop("s2", "size2", "move"), "cells")


def entropy_mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                source_col: str = "source", weights: Sequence[float] = (5, 2, 1),
                share: float = 1.5, max_epochs: int = 2, keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, source, size, source_size, target, rate, copies, taken`` per document.

    ``keep`` names further columns of ``docs`` to carry along; they come back in
    a struct ``row``, so no name can clash.
    """
    extra = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row")] if keep else []
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                       word_count(F.col(text_col)).alias("size"), *extra)
    if not keep:
        base = cut(base, "sizes")
    else:
        base = cut(base, "mix-input")
    cells = cut(base.groupBy("source", "size").agg(F.count("*").alias("docs")), "cells")
    by_source = cells.groupBy("source").agg(
        F.sum(F.col("docs") * F.col("size")).alias("source_size"), F.sum("docs").alias("n"))
    goals = cut(targets(by_source.select("source", "source_size"), weights, share, max_epochs), "goals")
    means = by_source.select(F.col("source").alias("s3"),
                             F.greatest(F.col("source_size") / F.col("n"), F.lit(1.0)).alias("mean"))
    cells = cut(cells.join(means, F.col("source").eqNullSafe(F.col("s3"))).drop("s3"), "cells")
    lam = multipliers(cells, goals, max_epochs).withColumnRenamed("source", "s4")
    cells = (cells.join(lam, F.col("source").eqNullSafe(F.col("s4"))).drop("s4")
             .withColumn("rate", F.when(F.col("size") == 0, F.lit(1.0)).otherwise(_rate(max_epochs))))
    cells = _copies(cells, max_epochs)

    # ranks inside a cell: offsets of hash buckets, then a window per bucket
    h = F.xxhash64("doc_id", F.lit(17))
    cell = cells.select(F.col("source").alias("s5"), F.col("size").alias("z5"), "docs",
                        "copies", "rate", "source_size", "target")
    placed = (base.join(cell, F.col("source").eqNullSafe(F.col("s5")) & (F.col("size") == F.col("z5")))
              .drop("s5", "z5").withColumn("h", h)
              .withColumn("buckets", F.ceil(F.col("docs") / BUCKET_DOCS))
              .withColumn("bucket", F.pmod(F.shiftright("h", 8), F.col("buckets"))))
    many = placed.filter("buckets > 1").groupBy("source", "size", "bucket").agg(F.count("*").alias("b"))
    upto = (Window.partitionBy("source", "size").orderBy("bucket")
            .rowsBetween(Window.unboundedPreceding, -1))
    offset = cut(many.select(F.col("source").alias("s6"), F.col("size").alias("z6"),
                             F.col("bucket").alias("b6"),
                             F.coalesce(F.sum("b").over(upto), F.lit(0)).alias("offset")), "offsets")
    placed = placed.join(offset, F.col("source").eqNullSafe(F.col("s6")) & (F.col("size") == F.col("z6"))
                         & (F.col("bucket") == F.col("b6")), "left").drop("s6", "z6", "b6")
    rank = (F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id"))
            - 1 + F.coalesce("offset", F.lit(0)))
    spare = F.pmod(F.col("copies"), F.col("docs"))
    one = F.floor(F.col("copies") / F.col("docs")) + (rank < spare).cast("long")
    return placed.withColumn("one", one.cast("long")).select(
        "doc_id", "source", "size", "source_size", "target", "rate", F.col("one").alias("copies"),
        (F.col("one") * F.col("size")).alias("taken"), *(["row"] if keep else []))
