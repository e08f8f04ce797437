"""Filter audit against counting every order by hand; merges against Python sets."""

import random
import re
from itertools import permutations

import numpy as np

from conftest import SF_SMALL
from helpers import compare_with_sql, duck
from tidepool.llm import audit, queries

COLUMNS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def fails(text, earlier):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    capitals = sum("A" <= c <= "Z" for c in text)
    marks = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * capitals > 3 * len(text),
             bool(re.search("[#$%&*|]", text)), earlier]
    return {f for f, bad in zip("ABCDE", marks) if bad}


def plain(docs, labels):
    """{(part, order, step): counts} by applying every order to the rows (doc_id, text, lang)."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        parts.setdefault(lang or "", []).append((i, fails(text, i is not None and first[text] < i)))
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[1] for r in rows) - len(gone), sum(r[1] == {f} for r in rows),
                    sum(r[0] in good for r in gone), sum(r[0] in toxic for r in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return out


def as_dict(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in COLUMNS] for r in rows}
    assert len(out) == len(rows)
    return out


def test_merges():
    rng = np.random.default_rng(4)
    for _ in range(60):
        n = int(rng.integers(1, 5000))
        lists = [np.flatnonzero(rng.random(n) < p) for p in rng.choice([0, 0.001, 0.1, 0.7, 1], 5)]
        sets = [set(x.tolist()) for x in lists]
        assert audit.union(lists, n).tolist() == sorted(set().union(*sets))
        for a, x in zip(lists, sets):
            for b, y in zip(lists, sets):
                assert audit.difference(a, b).tolist() == sorted(x - y)
                assert audit.common(a, b) == len(x & y)
    assert audit.union([], 5).tolist() == []


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang").collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    df = queries.op12_filter_audit(spark, SF_SMALL)
    assert as_dict(df) == plain(docs, labels)
    compare_with_sql(df, duck(SF_SMALL), queries.ORACLE["op12_filter_audit"])


def test_odd_rows(spark):
    rng = random.Random(6)
    texts = [None, "", " \t\n", "ABC DEF", "a # b", "word " * 300, "x" * 300_000, " ".join(f"w{i}" for i in range(250)),
             "Ä" * 40, " one word"]
    docs = [(i, texts[i % len(texts)], rng.choice([None, "", "en", "de"])) for i in range(60)]
    docs += [docs[3], docs[3], (3, "another text under one id", "en"), (None, "ABC DEF", "en"), (None, "ABC DEF", None)]
    labels = [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 2)] + [(4, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 1)]
    schema = "doc_id long, text string, lang string, part string, A int, h string, n long, lists long, before long"
    df = spark.createDataFrame([(*d, "p", 1, "h", 2, 3, 4) for d in docs], schema).repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert as_dict(audit.filter_audit(df, lab)) == plain(docs, labels)
    assert audit.filter_audit(df.limit(0), lab).count() == 0


def test_posting_lists_cover_a_part_in_ranges(spark):
    """A part spreads over ranges of ids; the lists name every marked row once."""
    rows = spark.range(30_000).selectExpr("'en' AS part", "id AS doc_id", "id % 3 = 0 AS A", "id % 5 = 0 AS B")
    got = audit.posting_lists(rows, ["A", "B"]).collect()
    assert len(got) > 2 and sum(r["n"] for r in got) == 30_000
    found = {}
    for r in got:
        assert r["hi"] - r["lo"] + 1 == r["n"]
        for name, numbers in zip("AB", r["lists"]):
            found.setdefault(name, []).extend(r["lo"] + x for x in numbers)
    assert sorted(found["A"]) == list(range(0, 30_000, 3)) and sorted(found["B"]) == list(range(0, 30_000, 5))
