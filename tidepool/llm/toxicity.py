"""Toxicity scores of texts whose toxic words may be disguised.

*Noisy channel.*  A suspicious stretch (a token with digits or symbols between
letters, with separators inside, with a letter twice in a row, or single characters
set apart by white space) becomes a character lattice: a look-alike may
stand for its letters, a separator or a repeated letter for nothing.  Viterbi
decoding under a character trigram model (``language_model``: trigram counts
of all texts) picks the likeliest original; the ``BEST`` best readings count.

*Score.*  Words (as written and as restored) and their beginnings of 4 to 6
characters are the features.  A feature's weight is the lower confidence bound
of its log odds ratio between toxic and clean training texts.  A text is judged
by its three strongest distinct words and its number of words, as written, in a
logistic model.  Weights and logistic model are fitted on disjoint halves in turn
(weights of one half, scores of the other), then the weights on both.

*Skeletons.*  A word only matters if one of its features has a weight.  With
look-alikes put in one class, repeats and separators taken out, the skeleton of a
restored word is that of a stretch of the token it came from, so when scoring only
tokens go through the lattice from one of whose possible word starts the skeleton
of a weighted feature follows.  Scores are the same as without this.

Bounds, all independent of the input: at most ``TRAIN_ROWS`` labelled texts
(those with the smallest id hashes), whose features are all that a model can
hold, and 28**3 trigrams.  The trigram counts cover every text whole, and every
text is scored whole.

Edge cases: null and empty texts have no features and get the score of a text
without evidence; several labels of one id count as toxic if one is; without
training rows of both classes every score is 0; a null id scores like any and
is never held out; ties between readings go to the first in code-point order;
an empty table gives an empty result; columns of ``docs`` pass in a struct, so
no name can clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import cut

TRAIN_ROWS = 12_000
BEST = 2
LETTERS = 28  # word border, a-z, any other letter
LOOKALIKES = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i"}
SEPARATORS = " .-_*'`~/\\,:;"
EDGE = " \t\r\n.,;:!?\"'()[]{}<>*_-~`/\\|#%&"
_INSIDE = re.compile(r"[^\W\d_].*[\d@$!|+(<€£¡.\-_*'`~/\\:].*[^\W\d_]|[\d@$!|+(<€£¡].*[^\W\d_]|[^\W\d_].*[\d@$!|+(<€£¡]")
_DOUBLE = re.compile(r"([^\W\d_])\1")
_SPACED = re.compile(r"(?<!\S)\S(?: \S){2,}(?!\S)")


# --- language model ----------------------------------------------------------

_CODE = np.zeros(256, dtype=np.int64)
_CODE[97:123] = _CODE[65:91] = np.arange(1, 27)
_CODE[0xC3:] = 27


def _trigram_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LETTERS ** 3, dtype=np.int64)
    for batch in batches:
        for v in batch.column(0):
            data = np.frombuffer(((v.as_py() or "")).encode("utf-8"), dtype=np.uint8)
            for a in range(0, len(data), 1 << 20):
                part = data[max(0, a - 2):a + (1 << 20)]
                part = part[(part < 0x80) | (part >= 0xC0)]  # a letter outside ASCII counts once
                c = _CODE[part]
                total += np.bincount(c[:-2] * LETTERS * LETTERS + c[1:-1] * LETTERS + c[2:], minlength=LETTERS ** 3)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["code", "n"])


def language_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Log probabilities of a character after two others, from all texts (28**3 numbers)."""
    counts = (docs.select(F.col(text_col).alias("text")).mapInArrow(_trigram_batches, "code long, n long")
              .groupBy("code").agg(F.sum("n").alias("n")))
    n = np.full(LETTERS ** 3, 0.5)
    for r in counts.collect():  # at most 28**3 rows
        n[r["code"]] += r["n"]
    n = n.reshape(LETTERS, LETTERS, LETTERS)
    return np.log(n / n.sum(axis=2, keepdims=True))


def _letter(ch: str) -> int:
    if "a" <= ch <= "z":
        return ord(ch) - 96
    return 27 if ch.isalpha() else 0


def _readings(chars: str, i: int) -> list[tuple[str, float]]:
    """What the character at ``i`` may stand for, with its channel cost (blank: a word border)."""
    ch = chars[i]
    out: list[tuple[str, float]] = []
    if ch.isalpha():
        out.append((ch, 0.0))
        if i and chars[i - 1] == ch:
            out.append(("", 0.5))
    if ch in LOOKALIKES:
        out += [(x, 0.7) for x in LOOKALIKES[ch]]
        if i and chars[i - 1] == ch:
            out.append(("", 0.5))
    if ch in SEPARATORS:
        out += [("", 0.3), (" ", 3.0)]
    return out or [(" ", 1.0)]


def decode(stretch: str, lm: np.ndarray, best: int = BEST) -> list[str]:
    """The ``best`` likeliest originals of a disguised stretch (lower case), by Viterbi search.

    A state is the last two characters; each state keeps its ``best`` paths.
    """
    paths: dict[tuple[int, int], list[tuple[float, str]]] = {(0, 0): [(0.0, "")]}
    for i in range(len(stretch)):
        new: dict[tuple[int, int], list[tuple[float, str]]] = {}
        for (p, q), kept in paths.items():
            for ch, cost in _readings(stretch, i):
                state = (p, q) if ch == "" else (q, _letter(ch))
                gain = -cost if ch == "" else -cost + float(lm[p, q, state[1]])
                new.setdefault(state, []).extend((s + gain, text + ch) for s, text in kept)
        paths = {state: sorted(set(options), key=lambda o: (-o[0], o[1]))[:best] for state, options in new.items()}
    ends = [(s + float(lm[p, q, 0]), text) for (p, q), kept in paths.items() for s, text in kept]
    out: list[str] = []
    for _, text in sorted(ends, key=lambda o: (-o[0], o[1])):
        if text not in out:
            out.append(text)
        if len(out) == best:
            break
    return out


def suspicious(token: str) -> bool:
    if token.isalpha():     # no digit or symbol inside
        return _DOUBLE.search(token) is not None
    return bool(_INSIDE.search(token) or _DOUBLE.search(token))


PIECE = 256     # characters of a stretch that are decoded together
_RUN = re.compile(r"(.)\1{2,}", re.DOTALL)


def restore(stretch: str, lm: np.ndarray) -> set[str]:
    """Words of the likeliest originals.

    Runs are cut to two characters first, so a stretched word stays short; what is
    longer than ``PIECE`` then is decoded in pieces that overlap by half.
    """
    stretch = _RUN.sub(r"\1\1", stretch)
    out: set[str] = set()
    for a in range(0, max(1, len(stretch) - PIECE // 2), PIECE // 2):
        for text in decode(stretch[a:a + PIECE], lm):
            out.update(w for w in text.split(" ") if len(w) > 2)
    return out


# --- skeletons ---------------------------------------------------------------

_SOFT, _HARD = "\x01", "\x02"      # a separator, a character that can only part words


def _class_of(ch: str) -> str:
    ch = LOOKALIKES.get(ch, ch)[0]
    return "i" if ch == "l" else ch        # 1 and | may be either


class _Classes(dict):
    def __missing__(self, code: int) -> str:
        ch = chr(code)
        self[code] = out = (_class_of(ch) if ch in LOOKALIKES or ch.isalpha() else _SOFT if ch in SEPARATORS else _HARD)
        return out


_CLASSES = _Classes()


def skeletons(stretch: str) -> Iterator[tuple[str, list[int]]]:
    """Skeletons of the parts of a stretch, with the places at which a word may begin."""
    for part in stretch.translate(_CLASSES).split(_HARD):
        runs, starts, fresh = [], [], True
        for ch in part:
            if ch == _SOFT:
                fresh = True
                continue
            if not runs or ch != runs[-1]:
                runs.append(ch)
            if fresh:
                starts.append(len(runs) - 1)
                fresh = False
        if runs:
            yield "".join(runs), starts


class Skeletons:
    """The skeletons of the features that have a weight."""

    def __init__(self, weights: dict[str, float]):
        self.known = {"".join(s for s, _ in skeletons(f[1:])) for f in weights} - {""}
        self.sizes = sorted({len(s) for s in self.known})

    def may_hold(self, stretch: str) -> bool:
        """Whether a restored word of the stretch could have a weighted feature."""
        return any(s[a:a + n] in self.known for s, starts in skeletons(stretch) for a in starts for n in self.sizes)


def written_tokens(text: str) -> tuple[set[str], set[str]]:
    """Distinct tokens of a text in lower case, and its stretches of characters set apart."""
    low = text.lower()
    tokens = low.split()
    apart: set[str] = set()
    if list(map(len, tokens)).count(1) > 2:
        even = " ".join(tokens)  # wider blanks part the letters in ``even``, words in ``low``
        apart = {m.group() for t in {even, low} for m in _SPACED.finditer(t)}
    return set(tokens), apart


def token_words(token: str, lm: np.ndarray, may_hold=None) -> set[str]:
    """The word that a token is and those that it may hide."""
    word = token.strip(EDGE)
    found = {word} if word else set()
    if suspicious(token):
        hidden = token.strip(".,;:?\"[]{}")
        if may_hold is None or may_hold(hidden):
            found |= restore(hidden, lm)
    return found


def text_words(text: str, lm: np.ndarray, cache: dict[str, frozenset[str]]) -> tuple[set[str], int]:
    """Distinct words of a text as written and as restored, and the number of distinct tokens."""
    tokens, apart = written_tokens(text)
    out: set[str] = set()
    for token in tokens:
        words = cache.get(token)
        if words is None:
            words = frozenset(token_words(token, lm))
            if len(cache) < 1 << 16:
                cache[token] = words
        out |= words
    for stretch in apart:
        out |= restore(stretch, lm)
    return out, len(tokens)


def word_features(word: str) -> list[str]:
    return ["=" + word] + ["^" + word[:n] for n in (4, 5, 6) if len(word) >= n]


# --- model -------------------------------------------------------------------

@dataclass
class ToxicityModel:
    """Trigram model, feature weights and the logistic model of the three strongest words."""

    lm: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    logistic: np.ndarray | None = None

    def __post_init__(self):
        self.skeletons = Skeletons(self.weights)
        self.heads = {f[1:5] for f in self.weights}     # beginnings of the words that can have a weight

    def weight(self, word: str) -> float:
        if word[:4] not in self.heads:
            return 0.0
        return max((self.weights.get(f, 0.0) for f in word_features(word)), default=0.0)

    def _weighted(self, words: set[str]) -> tuple[tuple[str, float], ...]:
        return tuple((w, x) for w in words if (x := self.weight(w)) > 0)

    def score(self, text: str, cache: dict[str, tuple], sift: bool = True) -> float:
        """Score of a text; ``sift=False`` decodes every suspicious stretch, to the same result."""
        if self.logistic is None:
            return 0.0
        may_hold = self.skeletons.may_hold if sift else None
        tokens, apart = written_tokens(text)
        strong: dict[str, float] = {}
        for token in tokens:
            if token.isalpha():
                if token[:4] not in self.heads and _DOUBLE.search(token) is None:
                    continue        # most tokens: plain, and without weight
            elif token.strip(EDGE)[:4] not in self.heads and not suspicious(token):
                continue
            found = cache.get(token)
            if found is None:
                found = self._weighted(token_words(token, self.lm, may_hold))
                if len(cache) < 1 << 16:
                    cache[token] = found
            if found:
                strong.update(found)
        for stretch in apart:
            if not sift or may_hold(stretch):
                strong.update(self._weighted(restore(stretch, self.lm)))
        z = float(self.logistic @ evidence(strong.values(), len(tokens)))
        return 1.0 / (1.0 + math.exp(-max(-50.0, min(50.0, z))))


def evidence(weights: Iterable[float], n_tokens: int) -> np.ndarray:
    """Weights of the three strongest words, size of the text, constant."""
    top = sorted(weights, reverse=True)[:3]
    return np.array([*top, *[0.0] * (3 - len(top)), math.log1p(n_tokens), 1.0])


def lower_log_odds(toxic: int, clean: int, n_toxic: int, n_clean: int) -> float:
    """Log odds ratio less 1.5 standard errors."""
    a, b = toxic + 0.5, clean + 0.5
    odds = math.log(a / (n_toxic - toxic + 0.5)) - math.log(b / (n_clean - clean + 0.5))
    return odds - 1.5 * math.sqrt(1 / a + 1 / b)


def _word_batches(batches: Iterator[pa.RecordBatch], lm: np.ndarray) -> Iterator[pa.RecordBatch]:
    cache: dict[str, frozenset[str]] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, 200):
            part = whole.slice(at, 200)
            found = [text_words(v or "", lm, cache) for v in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("half"), part.column("toxic"),
                 pa.array([sorted(w) for w, _ in found], pa.list_(pa.string())), pa.array([n for _, n in found], pa.int64())],
                names=["doc_id", "half", "toxic", "words", "n_tokens"])


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of features by half and label, added up within a batch."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1000):
            part = whole.slice(at, 1000)
            counts: dict[str, list[int]] = {}
            for half, toxic, words in zip(part.column("half").to_pylist(), part.column("toxic").to_pylist(),
                                          part.column("words").to_pylist(), strict=True):
                for f in {f for w in words for f in word_features(w)}:
                    counts.setdefault(f, [0, 0, 0, 0])[2 * half + toxic] += 1
            cols = list(zip(*counts.values())) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                              *[pa.array(c, pa.int64()) for c in cols]],
                                             names=["f", "c0", "t0", "c1", "t1"])


def _evidence_batches(batches: Iterator[pa.RecordBatch], weights: list[dict[str, float]]) -> Iterator[pa.RecordBatch]:
    models = [ToxicityModel(np.zeros(0), w) for w in weights]
    for part in batches:
        rows = []
        for half, words, n in zip(part.column("half").to_pylist(), part.column("words").to_pylist(),
                                  part.column("n_tokens").to_pylist(), strict=True):
            model = models[1 - half]
            rows.append(evidence([x for w in words if (x := model.weight(w)) > 0], n).tolist())
        yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(rows, pa.list_(pa.float64()))],
                                         names=["toxic", "x"])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps; the constant is not penalised."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, train: Column, *, id_col: str = "doc_id", text_col: str = "text",
        rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit on the labelled rows where ``train`` (a condition on ``doc_id``) holds.

    ``labels`` has ``doc_id, toxic``.
    """
    model = ToxicityModel(language_model(docs, text_col))
    known = (labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("toxic"))
             .filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(train)
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    known = cut(known.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(2)).cast("int")), "train-ids")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    lm = model.lm
    sample = cut(texts.join(known, "doc_id").select("doc_id", "half", "toxic", "text").mapInArrow(
        lambda it: _word_batches(it, lm), "doc_id long, half int, toxic int, words array<string>, n_tokens long"), "train-words")
    size = {(r["half"], r["toxic"]): r["n"] for r in
            sample.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    n = lambda h, t: size.get((h, t), 0)
    if not (n(0, 1) + n(1, 1)) or not (n(0, 0) + n(1, 0)):
        return model
    t, c = F.col("t0") + F.col("t1"), F.col("c0") + F.col("c1")
    share = (n(0, 1) + n(1, 1)) / sum(size.values())
    counts = (sample.select("half", "toxic", "words").mapInArrow(
        _feature_batches, "f string, c0 long, t0 long, c1 long, t1 long")
        .groupBy("f").agg(*[F.sum(x).alias(x) for x in ("c0", "t0", "c1", "t1")])
        .filter((t >= 2) & (t > 3 * share * (t + c))).collect())   # features of at most ``rows`` texts

    def table(halves: tuple[int, ...]) -> dict[str, float]:
        nt, nc = sum(n(h, 1) for h in halves), sum(n(h, 0) for h in halves)
        out = {}
        for r in counts:
            w = lower_log_odds(sum(r[f"t{h}"] for h in halves), sum(r[f"c{h}"] for h in halves), nt, nc)
            if w > 0.5:
                out[r["f"]] = w
        return out

    parts = [table((0,)), table((1,))]
    got = sample.select("half", "toxic", "words", "n_tokens").mapInArrow(
        lambda it: _evidence_batches(it, parts), "toxic int, x array<double>").collect()
    x, y = np.array([r["x"] for r in got]), np.array([r["toxic"] for r in got], dtype=float)
    order = np.lexsort((*x.T, y))  # the sums do not depend on the order of arrival
    return ToxicityModel(model.lm, table((0, 1)), fit_logistic(x[order], y[order]))


def _score_batches(batches: Iterator[pa.RecordBatch], model: ToxicityModel, with_text: bool) -> Iterator[pa.RecordBatch]:
    cache: dict[str, tuple] = {}
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            part = whole.slice(at, 500)
            text = part.column("text")
            scores = pa.array([model.score(v.as_py() or "", cache) for v in text], pa.float64())
            cols = {"row": part.column("row"), **({"text": text} if with_text else {}), "score": scores}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def score(docs: DataFrame, model: ToxicityModel, *, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (a struct of the columns ``keep``) and ``score`` per document.

    Without ``keep`` the struct holds all columns but the text, which follows as ``text``.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in (keep or [c for c in docs.columns if c != text_col])]).alias("row")
    shape = docs.select(row).schema["row"].dataType.simpleString()
    text = "" if keep else "text string, "
    return docs.select(row, F.col(text_col).alias("text")).mapInArrow(
        lambda it: _score_batches(it, model, not keep), f"row {shape}, {text}score double")


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 3
