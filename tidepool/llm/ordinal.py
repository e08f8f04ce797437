"""Quality classifier: ordinal cumulative-link regression on hashed texts.

``P(grade <= k) = logistic(theta_k - s)`` with one score ``s`` per text and
ordered thresholds ``theta_1 < theta_2 < ...``.  The score is a sum of hashed
weights shared by all thresholds: the distinct words of the text (scaled by the
square root of their number) and shape tokens, i.e. binned properties of the
whole text (length, distinct words, repeated lines, upper case, digits,
symbols, word length).  The thresholds stay ordered because their gaps are
exponentials.  Outputs are the probability of each grade's tail
``P(grade >= k)`` and the expected grade, the sum of the tails.

The model is fitted on at most ``TRAIN_ROWS`` labelled texts (those with the
smallest id hashes), read whole; its size is ``DIM`` weights.  Every text is
scored whole.

Edge cases: null and empty texts have only shape tokens; several labels of one
id: the lowest grade counts; a null label or id is not used for fitting; with
fewer than two grades among the labels every text gets the tails of the labels'
shares; columns of ``docs`` pass in a struct; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import cut, word_hashes

DIM = 1 << 16
SHAPES = 16           # bins of each shape property
TRAIN_ROWS = 8_000
_UPPER = re.compile(rb"[A-Z]")
_DIGIT = re.compile(rb"[0-9]")
_SYMBOL = re.compile(rb"[^\sA-Za-z0-9\x80-\xff]")


def shape_tokens(data: bytes, words: np.ndarray, distinct: int) -> list[int]:
    """Feature numbers (beyond ``DIM``) of the binned properties of a text."""
    n, size = len(words), max(1, len(data))
    lines = data.split(b"\n")
    share = [
        min(1.0, math.log1p(n) / 12), distinct / max(1, n), 1 - len(set(lines)) / len(lines),
        len(_UPPER.findall(data)) / size, min(1.0, 4 * len(_DIGIT.findall(data)) / size),
        min(1.0, 4 * len(_SYMBOL.findall(data)) / size), min(1.0, size / max(1, n) / 24),
        min(1.0, math.log1p(size / len(lines)) / 9)]
    return [DIM + SHAPES * i + min(SHAPES - 1, int(v * SHAPES)) for i, v in enumerate(share)]


SIZE = DIM + SHAPES * 8


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature numbers and values of each text."""
    for data, words in zip(texts, word_hashes(texts), strict=True):
        distinct = np.unique(words)
        at = np.unique((distinct >> np.uint64(20)) % np.uint64(DIM)).astype(np.int64)
        shape = shape_tokens(data, words, len(distinct))
        yield (np.concatenate([at, shape]),
               np.concatenate([np.full(len(at), 1 / math.sqrt(max(1, len(at)))), np.ones(len(shape))]))


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending; grade k is reached with probability logistic(s - theta_k)

    def tails(self, s: np.ndarray) -> np.ndarray:
        z = np.clip(s[:, None] - self.thresholds[None], -50, 50)
        return 1 / (1 + np.exp(-z))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, top: int, *, ridge: float = 1e-3,
                steps: int = 300, rate: float = 0.05) -> OrdinalModel:
    """Full-gradient Adam on the negative log likelihood."""
    at = np.concatenate([r[0] for r in rows])
    val = np.concatenate([r[1] for r in rows])
    which = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    share = [(grades >= k).mean() for k in range(1, top + 1)]
    theta = np.array([-math.log((p + 1e-3) / (1 - p + 1e-3)) for p in share])
    gap = np.log(np.maximum(np.diff(theta), 1e-2))
    par = np.concatenate([np.zeros(SIZE), theta[:1], gap])
    m, v = np.zeros_like(par), np.zeros_like(par)
    for step in range(1, steps + 1):
        w, first, g = par[:SIZE], par[SIZE], par[SIZE + 1:]
        theta = first + np.concatenate([[0.0], np.cumsum(np.exp(g))])
        s = np.bincount(which, weights=w[at] * val, minlength=len(rows))
        tail = 1 / (1 + np.exp(-np.clip(s[:, None] - theta[None], -50, 50)))
        full = np.concatenate([np.ones((len(rows), 1)), tail, np.zeros((len(rows), 1))], axis=1)
        slope = full * (1 - full)
        i = np.arange(len(rows))
        p = np.maximum(full[i, grades] - full[i, grades + 1], 1e-12)
        d_low, d_high = slope[i, grades] / p, slope[i, grades + 1] / p
        ds = -(d_low - d_high) / len(rows)
        dt = np.zeros(top)
        np.add.at(dt, grades[grades > 0] - 1, (d_low / len(rows))[grades > 0])
        np.add.at(dt, grades[grades < top], -(d_high / len(rows))[grades < top])
        gw = np.bincount(at, weights=ds[which] * val, minlength=SIZE) + ridge * w / 10
        grad = np.concatenate([gw, [dt.sum()], np.cumsum(dt[::-1])[::-1][1:] * np.exp(g)])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par = par - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    theta = par[SIZE] + np.concatenate([[0.0], np.cumsum(np.exp(par[SIZE + 1:]))])
    return OrdinalModel(par[:SIZE], theta)


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            part = whole.slice(at, 500)
            rows = list(features([(v or "").encode("utf-8") for v in part.column("text").to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("grade"), pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.float32()))], names=["doc_id", "grade", "at", "val"])


def fit(docs: DataFrame, grades: DataFrame, *, top: int, id_col: str = "doc_id", text_col: str = "text",
        rows: int = TRAIN_ROWS) -> OrdinalModel:
    """Fit on rated texts; ``grades`` has ``doc_id, grade`` with grades ``0 .. top``."""
    known = (grades.select(F.col("doc_id").cast("long"), F.col("grade").cast("int")).dropna()
             .groupBy("doc_id").agg(F.min("grade").alias("grade"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    known = cut(known, "rated-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = (texts.join(known, "doc_id").select("doc_id", "grade", "text").mapInArrow(
        _feature_batches, "doc_id long, grade int, at array<int>, val array<float>").toArrow())
    table = table.sort_by("doc_id")
    y = table["grade"].to_numpy().astype(np.int64)
    if len(set(y.tolist())) < 2:
        share = [(float((y >= k).mean()) if len(y) else 0.0) for k in range(1, top + 1)]
        return OrdinalModel(np.zeros(SIZE), np.array([-math.log((p + 1e-6) / (1 - p + 1e-6)) for p in share]))
    x = [(np.asarray(a.values), np.asarray(v.values)) for a, v in zip(table["at"], table["val"], strict=True)]
    return fit_ordinal(x, y, top)


def _score_batches(batches: Iterator[pa.RecordBatch], model: OrdinalModel) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            part = whole.slice(at, 500)
            texts = [(v or "").encode("utf-8") for v in part.column("text").to_pylist()]
            s = np.array([float((model.weights[i] * v).sum()) for i, v in features(texts)])
            tails = model.tails(s)
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), pa.array(tails.sum(axis=1), pa.float64()),
                 pa.array(list(tails), pa.list_(pa.float64()))], names=["row", "expected_grade", "tails"])


def grade(docs: DataFrame, model: OrdinalModel, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (struct of the columns ``keep``), ``expected_grade`` and ``tails`` (``P(grade >= k)``, k from 1)."""
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or docs.columns)]).alias("row")
    shape = docs.select(row).schema["row"].dataType.simpleString()
    return docs.select(row, F.col(text_col).alias("text")).mapInArrow(
        lambda it: _score_batches(it, model), f"row {shape}, expected_grade double, tails array<double>")


def rating(quality: Column, toxic: Column) -> Column:
    """Graded rating of the labels: 0 poor, 1 good but toxic, 2 good and clean."""
    return F.when(quality == 0, 0).when(toxic == 1, 1).when((quality == 1) & (toxic == 0), 2)
