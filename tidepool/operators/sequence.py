"""Running totals along a keyed order, split so that no key is one window partition.

A plain ``sum(...).over(Window.partitionBy(key).orderBy(...))`` sends every
row of a key to one task.  With a key that holds a third of all rows that task
is a third of the job.  ``running_total`` splits the order into *blocks*
(columns that grow with the order, e.g. day and hour of ``ts``, or document
id ranges) and makes two passes over the input:

1. block totals: a partial + final aggregate per ``(key, blocks)``; folded level
   by level, windows over the blocks of one parent give each block's exclusive
   offset within its key;
2. the rows plus one offset marker row per block go through one window per
   ``(key, block)``; the marker sorts first, so the running sum starts at the
   block's offset.  Its partitions are bounded by the block size, not by the
   key size.  Null keys behave as in ``groupBy`` (no join is involved).

Sizing: the final window holds one ``(key, finest block)``; the offset windows
hold the blocks of one parent.  ``sized_blocks`` cuts blocks by counts: keys of
ordinary size stay whole and only large ones are split, so the block table stays
a small part of the rows whatever their distribution over keys and time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.session import checkpoint_dir

_V = "_tp_v"      # value being summed
_KIND = "_tp_kind"  # 0 = offset marker row, 1 = data row
_S = "_tp_s"      # block total
_OFF = "_tp_off"  # what a block carries in from the blocks before it

LARGE = 1 << 18   # rows of a key that one window partition may hold
SMALL_LIST = 100_000  # keys of a list that may be broadcast

Levels = Sequence[str | Sequence[str]]


def _levels(blocks: Levels) -> list[list[str]]:
    return [[b] if isinstance(b, str) else list(b) for b in blocks]


def sized_blocks(df: DataFrame, keys: Sequence[str], units: Sequence[tuple[str, Column]],
                 limit: int = LARGE) -> tuple[DataFrame, list[list[str]]]:
    """Add block columns that split only keys of more than ``limit`` rows.

    ``units`` lists ``(column name, expression)`` from coarse to fine; each must
    grow with the order.  The rows are counted per key first; keys above the limit
    get the coarsest unit, their blocks above the limit the next one, and so on;
    other keys stay whole (null in the column).  With no large key there is no
    column and no further pass.  The block table thus has a row per key, and about
    one more per ``limit`` rows.  Runs one aggregation per level that is needed;
    the lists of large blocks are broadcast only while they are short.
    """
    keys, names = list(keys), []
    checkpoint_dir(df.sparkSession)
    for name, unit in units:
        at = F.struct(*keys, *names)  # structs compare nulls as equal
        large = (df.groupBy(*keys, *names).agg(F.count(F.lit(1)).alias(_S)).filter(F.col(_S) > limit)
                 .select(at.alias("_tp_large"))).checkpoint()
        n = large.count()
        if not n:
            break
        large = F.broadcast(large) if n <= SMALL_LIST else large
        df = (df.join(large, at == F.col("_tp_large"), "left")
              .withColumn(name, F.when(F.col("_tp_large").isNotNull(), unit)).drop("_tp_large"))
        names.append(name)
    return df, [[n] for n in names]


def block_offsets(totals: DataFrame, keys: list[str], levels: list[list[str]],
                  sums: Sequence[str] = (_S,), how: str = "sum") -> DataFrame:
    """What each finest block carries in: ``<total>_off`` per column of ``sums`` (null: nothing).

    ``totals`` has one row per ``keys + all level columns`` with the block totals
    (sums, or maxima with ``how="max"``).  Level by level: the totals are folded
    to the parent blocks, whose offsets are found first; a window over the blocks
    of *one parent* gives the offset inside it, and the two are put together.  No
    window holds more than the blocks of one parent, however many a key has.
    """
    fold = F.sum if how == "sum" else F.max
    parent, last = [c for lvl in levels[:-1] for c in lvl], levels[-1]
    before = (Window.partitionBy(*keys, *parent).orderBy(*last)
              .rowsBetween(Window.unboundedPreceding, -1))
    own = totals.withColumns({f"{s}_off": fold(s).over(before) for s in sums})
    if parent:
        above = block_offsets(totals.groupBy(*keys, *parent).agg(*[fold(s).alias(s) for s in sums]),
                              keys, levels[:-1], sums, how)
        up = F.struct(*keys, *parent)  # structs compare nulls as equal
        both = (lambda a, b: F.coalesce(a + b, a, b)) if how == "sum" else F.greatest   # both skip nulls
        own = (own.withColumn("_tp_up", up)
               .join(above.select(up.alias("_tp_up"), *[F.col(f"{s}_off").alias(f"{s}_up") for s in sums]), "_tp_up")
               .withColumns({f"{s}_off": both(F.col(f"{s}_off"), F.col(f"{s}_up")) for s in sums}))
    return own.select(*keys, *parent, *last, *[f"{s}_off" for s in sums])


def running_totals(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], blocks: Levels,
                   totals: Mapping[str, str | Column | None]) -> DataFrame:
    """Inclusive running sums per key, several in one pass: ``{output: value}`` (``None`` counts rows).

    ``order`` must be a total order within a key (add a unique tie-break).
    ``blocks`` lists block columns of ``df`` from coarse to fine; together they
    must sort like ``order`` does.  With ``blocks=[]`` this is the plain window.
    """
    keys, outs = list(keys), list(totals)
    levels = _levels(blocks)
    fine = [c for lvl in levels for c in lvl]
    vals = [f"{_V}{i}" for i in range(len(outs))]
    value = [F.lit(1).cast("long") if v is None else (F.col(v) if isinstance(v, str) else v) for v in totals.values()]
    base = df.withColumns({**dict(zip(vals, value)), _KIND: F.lit(1)})
    if levels:
        total = base.groupBy(*keys, *fine).agg(*[F.sum(v).alias(v) for v in vals])
        offs = block_offsets(total, keys, levels, vals)
        markers = offs.select(*keys, *fine, *[F.col(f"{v}_off").alias(v) for v in vals], F.lit(0).alias(_KIND))
        base = base.unionByName(markers, allowMissingColumns=True)
    w = (Window.partitionBy(*keys, *fine)
         .orderBy(_KIND, *order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (base.withColumns({out: F.sum(v).over(w) for out, v in zip(outs, vals)})
            .filter(F.col(_KIND) == 1)
            .drop(*vals, _KIND))


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                  blocks: Levels, value: str | Column | None = None,
                  out: str = "running_total") -> DataFrame:
    """Inclusive running sum of ``value`` (1 per row when ``None``) per key, see ``running_totals``."""
    return running_totals(df, keys, order, blocks, {out: value})


def sequence_number(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                    blocks: Levels, out: str = "seq") -> DataFrame:
    """1-based position of each row within its key along ``order`` (a split ``row_number``)."""
    return running_total(df, keys, order, blocks, None, out)


def time_blocks(df: DataFrame, ts: str, units: Sequence[str] = ("day", "hour"),
                prefix: str = "_tp_blk_") -> tuple[DataFrame, list[str]]:
    """Add block columns ``date_trunc(unit, ts)`` for ``running_total``."""
    names = []
    for u in units:
        name = f"{prefix}{u}"
        df = df.withColumn(name, F.date_trunc(u, F.col(ts)))
        names.append(name)
    return df, names


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                blocks: str | Levels, value: str | Column, out: str = "running_max",
                inclusive: bool = True) -> DataFrame:
    """Running maximum of ``value`` per key (or over all rows with ``keys=[]``).

    Same two-pass plan as ``running_total``: the block maxima are carried level by
    level (``blocks`` from coarse to fine), and enter each block's window as a
    marker row; without keys only the coarsest level is one window.  With
    ``inclusive=False`` the current row is left out (the state *before* it).
    """
    keys, levels = list(keys), _levels([blocks] if isinstance(blocks, str) else blocks)
    fine = [c for lvl in levels for c in lvl]
    v = F.col(value) if isinstance(value, str) else value
    base = df.withColumn(_V, v).withColumn(_KIND, F.lit(1))
    bmax = base.groupBy(*keys, *fine).agg(F.max(_V).alias(_S))
    markers = (block_offsets(bmax, keys, levels, (_S,), "max")
               .select(*keys, *fine, F.col(f"{_S}_off").alias(_V), F.lit(0).alias(_KIND)))
    end = Window.currentRow if inclusive else -1
    w = (Window.partitionBy(*keys, *fine).orderBy(_KIND, *order)
         .rowsBetween(Window.unboundedPreceding, end))
    return (base.unionByName(markers, allowMissingColumns=True)
            .withColumn(out, F.max(_V).over(w))
            .filter(F.col(_KIND) == 1)
            .drop(_V, _KIND))
