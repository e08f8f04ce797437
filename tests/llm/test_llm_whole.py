"""Whole jobs: source targets with thin cells, disguises by blanks and doubled letters, conflicts of near copies."""

from collections import Counter

import numpy as np
import pytest

from helpers import duck
from tidepool.llm import mixing, toxicity
from tidepool.llm.queries import QUERIES, op4_conflict_packing

LARGE = "/root/testdata/sf0.1"


@pytest.mark.parametrize("rate", [0.3, 0.7, 1.4])
def test_copies_of_thin_cells(spark, rate):
    rows = [("a", 40 + 7 * k, 1, rate, rate * sum(40 + 7 * i for i in range(2000))) for k in range(2000)] + \
        [(None, 5, 3, 2.0, 30.0), (None, 0, 4, 1.0, 30.0)]
    cells = spark.createDataFrame(rows, "source string, size long, docs long, rate double, target double")
    got = mixing._copies(cells, 2).collect()
    taken = sum(r["copies"] * r["size"] for r in got if r["source"] == "a")
    assert all(0 <= r["copies"] <= 2 * r["docs"] for r in got) and len(got) == len(rows)
    assert abs(taken - rows[0][4]) <= 20, (taken, rows[0][4])
    assert {r["size"]: r["copies"] for r in got if r["source"] is None} == {5: 6, 0: 4}


def test_mix_meets_targets_with_many_sizes(spark):
    rows = QUERIES["op1_source_mix"](spark, LARGE).collect()
    docs = duck(LARGE).execute("select doc_id, source from documents").fetchall()
    source = dict(docs)
    target, taken = {}, Counter()
    for r in rows:
        assert 0 <= r["copies"] <= 2
        target[source[r["doc_id"]]] = r["target"]
        taken[source[r["doc_id"]]] += r["taken"]
    off = {s: taken[s] / t - 1 for s, t in target.items()}
    print("MIX", max(off.values()), min(off.values()))
    assert len(rows) == len(docs) and all(abs(x) < 0.001 for x in off.values()), off


def test_disguises_by_blanks_and_doubled_letters():
    n = np.full(28 ** 3, 0.01)
    for word in ["idiot", "stupid", "trash"] * 50:
        c = [0, 0, *[ord(x) - 96 for x in word], 0]
        for a, b, d in zip(c, c[1:], c[2:]):
            n[(a * 28 + b) * 28 + d] += 1
    n = n.reshape(28, 28, 28)
    lm = np.log(n / n.sum(axis=2, keepdims=True))
    missed = [s for s, word in (
        ("iddiioott", "idiot"), ("stuupid", "stupid"), ("i  d  i  o  t", "idiot"), ("i\td\ti\to\tt", "idiot"),
        ("t \tr a   s h", "trash"), ("i d\ni o t", "idiot"), ("a b c   i d i o t", "idiot"))
        if word not in toxicity.text_words(f"so {s} it is", lm, {})[0]]
    assert not missed


def test_near_copies_conflict(spark, tmp_path):
    rows, group = [], {}
    for g in range(3):
        words = [f"w{g}x{k}" for k in range(80)]
        for m in range(5):
            own = [*words[:70 + m], "other", *words[71 + m:]] if m else words
            rows.append((100 * g + m, " ".join(own).upper() if m == 3 else " ".join(own), f"s{g}{m}"))
            group[f"s{g}{m}"] = g
    rows.append((None, rows[1][1] + " end", "s-null"))
    rows.append((100, rows[0][1] + " last", "s-same-id"))       # another text under an id of group 1
    group.update({"s-null": 0, "s-same-id": 0})
    for k, text in enumerate(["", "", None, None]):
        rows.append((900 + k, text, f"e{k}"))
        group[f"e{k}"] = 10 + k // 2
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(
        f"{tmp_path}/documents.parquet")
    in_bin, cluster = {}, {}
    for r in op4_conflict_packing(spark, str(tmp_path)).collect():
        in_bin.setdefault(r["bin_id"], []).append(group[r["source"]])
        cluster.setdefault(group[r["source"]], set()).add(r["cluster"])
    assert sum(len(b) for b in in_bin.values()) == len(rows)
    assert all(len(b) == len(set(b)) for b in in_bin.values()), in_bin
    assert all(len(c) == 1 for c in cluster.values()) and len(set.union(*cluster.values())) == len(cluster)
