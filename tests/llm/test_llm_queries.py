"""Queries over the driver tables against brute-force versions, SQL or invariants."""

import hashlib
from collections import Counter, defaultdict

import brute
import pytest

import corpus_pipeline
from helpers import compare_with_sql, duck
from tidepool.llm import packing
from tidepool.llm.queries import ORACLE, QUERIES

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs():
    return duck(SMALL).execute("select doc_id, text, source from documents order by doc_id").fetchall()


def _texts(docs):
    return [(i, t) for i, t, _ in docs]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, name):
    compare_with_sql(QUERIES[name](spark, SMALL), duck(SMALL), ORACLE[name])


def test_mix_meets_targets(spark, docs):
    rows = QUERIES["op1_source_mix"](spark, SMALL).collect()
    again = QUERIES["op1_source_mix"](spark, SMALL).collect()
    assert sorted(rows) == sorted(again)
    size = {i: len((t or "").encode().split()) for i, t, _ in docs}
    source = {i: s for i, _, s in docs}
    total = Counter()
    for i, n in size.items():
        total[source[i]] += n
    names = sorted(total)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, budget = {}, 1.5 * sum(total.values())
    while True:  # share, cap, share the excess again
        open_ = [s for s in names if s not in target]
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        over = [s for s in open_ if weight[s] * level > 2 * total[s]]
        if not over:
            target.update({s: weight[s] * level for s in open_})
            break
        target.update({s: 2.0 * total[s] for s in over})
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == total[source[r["doc_id"]]]
        assert abs(r["target"] - target[source[r["doc_id"]]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    for s in names:
        assert abs(taken[s] - target[s]) <= max(n for i, n in size.items() if source[i] == s) / 2
    assert len(rows) == len(docs)


def test_minhash_equals_brute_force(spark, docs):
    want = brute.near_duplicates(_texts(docs))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in QUERIES["op2_minhash_join"](spark, SMALL).collect()}
    assert got == want


def test_toxicity_on_held_out_rows(spark):
    rows = QUERIES["op3_toxicity"](spark, MIDDLE).collect()
    label = dict(duck(MIDDLE).execute("select doc_id, toxic from labels").fetchall())
    held = [(label[r["doc_id"]], r["score"], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in label]
    toxic, clean = [s for y, s, _ in held if y], [s for y, s, _ in held if not y]
    auc = sum((a > b) + (a == b) / 2 for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert auc > 0.95
    assert sum(p for y, _, p in held if not y) <= 0.02 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_packing_invariants(spark, docs):
    rows = QUERIES["op4_conflict_packing"](spark, SMALL).collect()
    size = {i: len((t or "").encode().split()) for i, t, _ in docs}
    words, used, sources, clusters, pieces = Counter(), Counter(), defaultdict(list), defaultdict(list), Counter()
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
        pieces[r["doc_id"], r["piece"]] += 1
        used[r["bin_id"]] += r["n_words"]
        sources[r["bin_id"]].append(r["source"])
        clusters[r["bin_id"]].append(r["cluster"])
    assert {i: words[i] for i in size} == size and set(pieces.values()) == {1}
    assert max(used.values()) <= packing.CAPACITY
    assert all(len(v) == len(set(v)) for v in [*sources.values(), *clusters.values()])
    assert all(r["bin_room"] == packing.CAPACITY - used[r["bin_id"]] for r in rows)


def test_quality_grades(spark):
    rows = QUERIES["op5_ordinal_quality"](spark, MIDDLE).collect()
    label = dict(duck(MIDDLE).execute("select doc_id, quality from labels").fetchall())
    seen = [(label[r["doc_id"]], r["kept"]) for r in rows if r["doc_id"] in label]
    assert sum(k for q, k in seen if q) >= 0.98 * sum(1 for q, _ in seen if q)
    assert sum(k for q, k in seen if not q) <= 0.2 * sum(1 for q, _ in seen if not q)
    assert all(0 <= r["p_clean"] <= r["p_good"] <= 1 for r in rows)
    assert all(abs(r["expected_grade"] - r["p_good"] - r["p_clean"]) < 1e-9 for r in rows)


def test_lines_equal_brute_force(spark, docs):
    want = brute.clean_lines(_texts(docs))
    assert {r["doc_id"]: r["text"] for r in QUERIES["op6_fuzzy_lines"](spark, SMALL).collect()} == want


def test_repeats_equal_brute_force(spark, docs):
    want = brute.remove_repeats(_texts(docs))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in QUERIES["op7_repeated_bytes"](spark, SMALL).collect()}
    assert got == want


def test_search_recall(spark):
    vecs = duck(MIDDLE).execute("select vec_id, embedding from embeddings").fetchall()
    want = brute.nearest(vecs, [i for i, _ in vecs if i % 100 == 0])
    rows = QUERIES["op8_permutation_search"](spark, MIDDLE).collect()
    true = {(q, i) for (q, _), (i, _) in want.items()}
    got = {(r["query_id"], r["vec_id"]) for r in rows}
    assert len(true & got) >= 0.9 * len(true) and len(rows) == len(want)
    score = {(q, i): d for (q, _), (i, d) in want.items()}
    assert all(abs(r["score"] - score[r["query_id"], r["vec_id"]]) < 1e-12
               for r in rows if (r["query_id"], r["vec_id"]) in score)


def test_fingerprints(spark, docs):
    rows = sorted(QUERIES["op10_merkle_fingerprints"](spark, SMALL).collect())
    texts = [t or "" for _, t, _ in docs]
    for k, r in enumerate(rows):
        a, b = texts[k], texts[(k + 1) % len(texts)]
        cut = len(a) // 4
        edited = a[:len(a) - cut] + b[:cut]
        assert r["n_chars"] == len(a)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (r["fingerprint"] == r["edited_fingerprint"]) == (a == edited)
    assert len({r["fingerprint"] for r in rows}) == len(set(texts))
    assert sum(r["near_edited"] for r in rows) / len(rows) > 0.6
    assert sum(r["near_next"] for r in rows) / len(rows) < 0.2


def test_pipeline_stages_against_brute_force(spark):
    """Each stage is compared on its own input."""
    df = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = df.columns
    tox = corpus_pipeline.stage_toxicity(spark, df, SMALL).cache()
    label = dict(duck(SMALL).execute("select doc_id, toxic from labels").fetchall())
    kept = {r["doc_id"] for r in tox.collect()}
    assert tox.columns == columns
    assert all(i in kept for i, y in label.items() if not y)
    lines = corpus_pipeline.stage_line_dedup(spark, tox, SMALL).cache()
    before = [(r["doc_id"], r["text"]) for r in tox.collect()]
    after = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}
    want = brute.clean_lines(before)
    assert lines.columns == columns and {i: t for i, (t, _) in after.items()} == want
    assert all(n == len(t) for t, n in after.values())
    near = corpus_pipeline.stage_near_dedup(spark, lines, SMALL).cache()
    comp = brute.near_duplicates([(i, t) for i, (t, _) in after.items()])
    assert near.columns == columns
    assert {r["doc_id"] for r in near.collect()} == {i for i, (_, c) in comp.items() if c == i}
    mix = corpus_pipeline.stage_mix(spark, near, SMALL).cache()
    source = {r["doc_id"]: (r["source"], len(r["text"].split())) for r in near.collect()}
    times = Counter(r["doc_id"] for r in mix.collect())
    assert mix.columns == columns and max(times.values()) <= 2 and set(times) <= set(source)
    total = sum(n for _, n in source.values())
    taken = sum(source[i][1] * k for i, k in times.items())
    assert abs(taken - 1.5 * total) < 0.05 * total
    packed = corpus_pipeline.stage_pack(spark, mix, SMALL).collect()
    words = Counter()
    for r in packed:
        words[r["doc_id"]] += r["n_words"]
    assert words == Counter({i: source[i][1] * k for i, k in times.items()})
