"""The skeleton filter changes no score; stretched words are restored; the score against its formula."""

import math
import random

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_ORACLE
from tidepool.llm import toxicity


def _model(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet")
    labels = spark.read.parquet(f"{SF_ORACLE}/labels.parquet")
    return docs, toxicity.fit(docs, labels, toxicity.fold(F.col("doc_id")) != 1)


def test_scores_are_the_same_without_the_filter(spark):
    docs, model = _model(spark)
    texts = [r["text"] or "" for r in docs.select("text").collect()]
    strong = [f[1:] for f in sorted(model.weights, key=model.weights.get, reverse=True) if f[0] == "="][:40]
    rng = random.Random(4)
    for word in strong:         # weighted words in many disguises
        loud = "".join(rng.choice([c, c.upper(), {"o": "0", "i": "1", "e": "3", "a": "@", "s": "$", "l": "|"}.get(c, c)]) for c in word)
        texts += [f"so {loud} it is", "-".join(word), " ".join(word), "  ".join(loud), "".join(c * rng.randint(1, 30) for c in word),
                  f"x.{loud}", f"{loud}&more", "*".join(loud) + "!!", f"{word[:3]}.{word[3:]}"]
    cache, plain = {}, {}
    got = [model.score(t, cache) for t in texts]
    want = [model.score(t, plain, sift=False) for t in texts]
    assert got == want and len(strong) > 5
    # what the filter is for: far fewer stretches reach the lattice
    tokens = {t for text in texts[:docs.count()] for t in toxicity.written_tokens(text)[0] if toxicity.suspicious(t)}
    assert sum(model.skeletons.may_hold(t) for t in tokens) < 0.3 * len(tokens)


def test_score_is_the_logistic_of_the_three_strongest_words(spark):
    docs, model = _model(spark)
    for r in docs.limit(60).collect():
        words, n = toxicity.text_words(r["text"] or "", model.lm, {})
        top = sorted((max([model.weights.get(f, 0.0) for f in toxicity.word_features(w)] + [0.0]) for w in words), reverse=True)
        x = np.array([*(top + [0.0] * 3)[:3], math.log1p(n), 1.0])
        assert abs(model.score(r["text"] or "", {}) - 1 / (1 + math.exp(-float(model.logistic @ x)))) < 1e-12


def test_long_runs_are_restored(spark):
    docs, model = _model(spark)
    word = max((f[1:] for f in model.weights if f[0] == "="), key=lambda w: (model.weights["=" + w], w))
    for n in (3, 20, 400):
        stretched = "".join(c * n for c in word)
        assert word in toxicity.restore(stretched, model.lm) or len(set(word)) < len(word) - 1
        assert abs(model.score(f"you {stretched} you", {}) - model.score(f"you {word} you", {})) < 0.2


def test_skeletons():
    def may(weights, stretch):
        return toxicity.Skeletons(dict.fromkeys(weights, 1.0)).may_hold(stretch)
    assert may(["=idiot"], "1d10t") and may(["=idiot"], "iiiddd--ioott") and may(["^idio"], "x.|d!0") and may(["=hello"], "he11o")
    assert not may(["=idiot"], "adiot") and not may(["=idiot"], "xidiot") and may(["=idiot"], "x&idiot") and not may([], "idiot")
