"""Pieces of the operators on small inputs worked by hand or by brute force."""

import random
from pathlib import Path

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidepool.llm import archive, common, graph, lines, ordinal, packing, permutation, suffix, toxicity
from tidepool.llm.common import shingle_set, word_hashes
from tidepool.llm.graph import components
from tidepool.llm.merkle import edits, likeness, with_fingerprints
from tidepool.session import checkpoint_dir


def _lpf(text, floor):
    n = len(text)
    order = np.array(sorted(range(n), key=lambda i: text[i:]), dtype=int)

    def common(a, b):
        k = 0
        while max(a, b) + k < n and text[a + k] == text[b + k]:
            k += 1
        return k

    lcp = np.array([0] + [common(order[i - 1], order[i]) for i in range(1, n)], dtype=int)
    got = np.zeros(n, dtype=int)
    got[order] = suffix.longest_previous(order, lcp, floor)
    want = [max([common(i, j) for j in range(i)], default=0) for i in range(n)]
    return got.tolist(), [x if x >= floor else 0 for x in want]


@settings(max_examples=200, deadline=None)
@given(st.text("ab", max_size=40), st.integers(1, 4))
def test_longest_previous_factor(text, floor):
    got, want = _lpf(text, floor)
    assert got == want


def test_blocks_cover_every_window_once():
    rng = random.Random(1)
    texts = [bytes(rng.choices(b"abc ", k=n)) for n in (0, 99, 100, 101, 500, 3000)] + [b"x" * 1000]
    doc, s, n, name, _, twice = suffix.blocks(texts)
    seen = sorted((int(d), int(a) + k) for d, a, m in zip(doc, s, n) for k in range(int(m)))
    assert seen == [(d, a) for d, t in enumerate(texts) for a in range(max(0, len(t) - 99))]
    assert twice[doc == 6].all() and len(set(name[doc == 6].tolist())) == 1


def test_words_and_shingles_match_plain_python():
    texts = ["", " \t\n", "a b", "A b c D e f", "x\x0by\x0cz   É é", "w " * 3000, "long" * 70_000 + " b c d e"]
    for t, h in zip(texts, word_hashes([t.encode() for t in texts]), strict=True):
        assert len(h) == len(brute.words(t))
        assert len(shingle_set(h)) == len(brute.shingles(t))


def test_sets_and_signatures_of_many_texts_are_those_of_each():
    rng = random.Random(5)
    texts = ["a", "a b c d", "a b c d e", "x " * 50, "a b c d e " * 7, "Ä ö ü", " ".join(rng.choices("abc", k=900))]
    words = list(word_hashes([t.encode() for t in texts]))
    sets = [shingle_set(w) for w in words]
    flat, starts = common.shingle_sets(words)
    assert [x.tolist() for x in np.split(flat, starts[1:])] == [s.tolist() for s in sets]
    masks, muls = common.coordinates(20, 48)
    want = [((s[:, None] ^ masks) * muls).min(axis=0).tolist() for s in sets]
    assert common.signatures(flat, starts, masks, muls).tolist() == want


def test_components_and_links(spark):
    rng = random.Random(3)
    pairs = [(i, i + 1) for i in range(60)] + [(100, 90 + i) for i in range(10)] + \
        [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)] + [(7, 7)]
    union = brute.Union()
    for a, b in pairs:
        union.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: union.find(x) for x in union.up if union.find(x) != x}


@pytest.mark.parametrize("sizes", [(64, 256), (4, 256), (2, 6)])
def test_links_of_lists(spark, monkeypatch, sizes):
    """Short lists, long lists in blocks, components larger than a block: no link is lost."""
    monkeypatch.setattr(graph, "SHORT", sizes[0])
    monkeypatch.setattr(graph, "BLOCK", sizes[1])
    rng = random.Random(9)
    to_set = lambda data: np.frombuffer(data, dtype=np.uint64)  # noqa: E731  (workers cannot import this file)
    sets, base = {}, [list(range(1000 * f, 1000 * f + 40)) for f in range(3)]
    for n in range(90):  # families of texts that are alike; only some pairs are links
        s = set(base[n % 3])
        for x in rng.sample(base[n % 3], rng.choice([0, 2, 6, 9])):
            s = s - {x} | {10_000 + 100 * n + x % 100}
        sets[n] = s
    posts = [(t, n, len(s)) for n, s in sets.items() for t in (n % 3, 7 + n % 3, 50 + n % 2)]
    union = brute.Union()
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                union.join(a, b)
    items = [(n, bytearray(np.array(sorted(s), dtype=np.uint64).tobytes())) for n, s in sets.items()]
    roots, links = graph.linked_components(
        spark.createDataFrame(posts, "token long, node long, weight long"),
        spark.createDataFrame(items, "node long, item binary"), to_set, 75)
    got = {r["node"]: r["root"] for r in roots.collect()}
    assert {n: got.get(n, n) for n in sets} == {n: union.find(n) for n in sets}
    assert all(r["a"] < r["b"] for r in links.collect())


def test_decoding_restores_disguised_words():
    n = np.full(28 ** 3, 0.01)
    for word in ["idiot", "stupid", "trash"] * 50:
        c = [0, 0, *[ord(x) - 96 for x in word], 0]
        for a, b, d in zip(c, c[1:], c[2:]):
            n[(a * 28 + b) * 28 + d] += 1
    n = n.reshape(28, 28, 28)
    lm = np.log(n / n.sum(axis=2, keepdims=True))
    for disguised, word in (("1d10t", "idiot"), ("i d i o t", "idiot"), ("s.t.u.p.i.d", "stupid"), ("tr@$h", "trash"),
                            ("stuuuupid", "stupid"), ("1d1000t", "idiot")):
        assert word in toxicity.restore(disguised, lm), disguised
        assert word in toxicity.text_words(f"so {disguised} it is", lm, {})[0]
    assert toxicity.text_words("plain words here", lm, {}) == ({"plain", "words", "here"}, 3)


def test_best_fit_under_conflicts():
    rng = random.Random(5)
    pieces = sorted(((rng.randint(0, 50), rng.randrange(4), rng.randrange(12)) for _ in range(300)), key=lambda p: -p[0])
    bins, want = [], []
    for size, s, c in pieces:
        fits = [(room, k) for k, (room, ss, cc) in enumerate(bins) if room >= size and s not in ss and c not in cc]
        if fits:
            k = min(fits)[1]
        else:
            k = len(bins)
            bins.append((100, set(), set()))
        room, ss, cc = bins[k]
        bins[k] = (room - size, ss | {s}, cc | {c})
        want.append(k)
    assert packing.best_fit(pieces, 100) == want


def test_ordinal_thresholds_and_order():
    rng = np.random.default_rng(2)
    rows, grades = [], []
    for _ in range(400):
        g = int(rng.integers(0, 3))
        rows.append((np.array([g * 10 + int(rng.integers(0, 5)), 99]), np.ones(2)))
        grades.append(g)
    m = ordinal.fit_ordinal(rows, np.array(grades), 2)
    assert m.thresholds[0] < m.thresholds[1]
    s = np.array([m.weights[r[0]].sum() for r in rows])
    assert (np.rint(m.tails(s).sum(axis=1)) == grades).mean() > 0.95


def test_arc_versions_and_lengths():
    body = b"HTTP/1.1 200 OK\r\n\r\nhttp://x/ 1.2.3.4 20200101000000 text/html 5\nWARC/1.0\r\n"
    v1 = b"filedesc://a 0.0.0.0 20200101000000 text/plain 9\n1 0 org\nU\n" + \
        b"http://a/ 1.2.3.4 20200102030405 text/html %d\n" % len(body) + body + b"\n"
    v2 = b"filedesc://a 0.0.0.0 20200101000000 text/plain 200 - - 0 f 9\n2 0 org\nU\n" + \
        b"http://b/ 1.2.3.4 20200102030405 text/html 404 - - 0 f 0\n\n"
    got = list(archive.parse_arc(v1 + v2))
    assert [(r["url"], r["version"], r["status"], r["content"]) for r in got] == \
        [("http://a/", 1, None, body), ("http://b/", 2, 404, b"")]


def test_line_forms():
    assert lines.form("  A\tb  C ") == "a b c"


def test_merkle_locates_edits(spark):
    a = "First line, with a clause.\nSecond line.\n\nA section of its own.\nLast."
    b = "First line, with a clause.\nSecond lime.\n\nA section of its own.\nLast."
    df = spark.createDataFrame([(a, b, "", None)], "a string, b string, c string, d string")
    r = with_fingerprints(df, {"fa": "a", "fb": "b", "fc": "c", "fd": "d"}).withColumns({
        "at": edits(F.col("fb"), F.col("fa")), "near": likeness(F.col("fa"), F.col("fb")),
        "same": likeness(F.col("fa"), F.col("fa")), "none": likeness(F.col("fa"), F.col("fc")),
        "empty": likeness(F.col("fc"), F.col("fd"))}).first()
    assert len(r["at"]) == 1 and r["at"][0] in r["fb"] and r["fa"] != r["fb"]
    assert 0.5 < r["near"] < 1 and r["same"] == 1.0 and r["none"] == 0.0 and r["empty"] == 1.0


def _written(spark, name):
    """Data files of each table ``name`` that was written to the shared folder."""
    return [len(list(p.glob("part-*"))) for p in Path(checkpoint_dir(spark).removeprefix("file:")).glob(f"{name}-*")]


def test_small_tables_are_few_files_whatever_the_number_of_partitions(spark):
    was = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        before = sorted(_written(spark, "large-star"))
        pairs = spark.createDataFrame([(i, i + 1) for i in range(300) if i % 10 != 9], "a long, b long")
        got = {r["node"]: r["root"] for r in components(pairs).collect()}
        assert got == {i: i // 10 * 10 for i in range(300) if i % 10}
        after = _written(spark, "large-star")
        assert len(after) > len(before) and max(after) <= common.LEAST_TASKS
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


def test_counted_cut_of_some_and_no_rows(spark):
    for n in (0, 5):
        df, seen = common.counted_cut(spark.range(n).filter("id >= 0"), "counted", 10)
        assert seen == n and df.count() == n


def test_nibbles_agree_wherever_tokens_do(spark):
    rng = np.random.default_rng(1)
    rows, least = [], []
    for k in range(40):
        a = rng.integers(0, 1 << 16, (lines.BANDS, lines.ROWS), dtype=np.uint64)
        b = a.copy()
        new = rng.random(a.shape) < k / 40
        b[new] = rng.integers(0, 1 << 16, int(new.sum()), dtype=np.uint64)
        least.append(int(((a & np.uint64(15)) == (b & np.uint64(15))).sum()))
        rows.append((k, *[(x << np.array([0, 16, 32, 48], dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64).tolist()
                          for x in (a, b)]))
    df = spark.createDataFrame(rows, "k int, a array<long>, b array<long>")
    df = df.select("k", lines.nibbles("a").alias("a"), lines.nibbles("b").alias("b"))
    assert [r["n"] for r in df.select("k", lines._agreeing("a", "b").alias("n")).orderBy("k").collect()] == least


def test_bands_of_lines_are_exchanged_in_steps(spark, monkeypatch):
    posted = []
    real = lines.counted_cut

    def seen(df, name, rows=None):
        out, n = real(df, name, rows)
        if name == "postings":
            posted.append(out)
        return out, n

    monkeypatch.setattr(lines, "counted_cut", seen)
    text = "one line that stands in both of the texts, nearly{}\nanother {}"
    docs = spark.createDataFrame([(1, text.format("", "x" * 30)), (2, text.format(".", "y" * 30))], "doc_id long, text string")
    got = {r["doc_id"]: r["drop"] for r in lines.repeated_lines(docs).collect()}
    assert got == {2: [0]}
    assert len(posted) == lines.BANDS // lines.STEP > 1
    tokens = [{r["token"] for r in p.collect()} for p in posted]
    assert sum(map(len, tokens)) == len(set().union(*tokens)) and any(tokens)


def test_lists_are_taken_apart_where_no_pair_may_be_similar(monkeypatch):
    rng = np.random.default_rng(2)
    kinds = rng.integers(0, 1 << 63, (3, 2))
    # one list: two kinds of three nodes, of 100 shingles; a kind of its own; one that is near by its sketch, but much larger
    nodes = [(i << lines.SIZE_BITS) + 100 for i in range(7)] + [(7 << lines.SIZE_BITS) + 200]
    kind = [0, 0, 0, 1, 1, 1, 2, 0]
    rows = np.array([[5, n, *kinds[k]] for n, k in zip(nodes, kind)] * 2 + [[6, nodes[0], *kinds[0]]], dtype=np.int64)
    token, node = lines.near_lists(rows, 80)
    lists = sorted(sorted(node[token == t].tolist()) for t in set(token.tolist()))
    assert lists == [nodes[:3], nodes[3:6]]
    monkeypatch.setattr(lines, "LIST", 3)
    token, node = lines.near_lists(rows, 80)
    assert len(set(token.tolist())) == 1 and sorted(node.tolist()) == nodes
    assert [len(x) for x in lines.near_lists(rows[-1:], 80)] == [0, 0]


def _plain_search(vecs, n_chunks, chunk_of, pivots, near, share, k, queries):
    """The search by its definition, one pair of vectors at a time."""
    def order(x):
        return [int(p) for p in permutation.nearest_pivots(np.array([x]), pivots, near)[0]]

    def apart(a, b):
        place = lambda o, p: o.index(p) if p in o else near
        return sum(abs(place(a, p) - place(b, p)) for p in {*a, *b})

    orders = {i: order(x) for i, x in vecs.items()}
    out = []
    for q in queries:
        found = []
        for c in range(n_chunks):
            own = sorted(i for i in vecs if chunk_of[i] == c)
            take = max(4 * (k + 1), int(share * len(own)) + 1)
            own = [i for _, i in sorted((apart(orders[q], orders[i]), i) for i in own)[:take] if i != q]
            found += [(float(np.sqrt(((np.array(vecs[i]) - np.array(vecs[q])) ** 2).sum())), i) for i in own]
        out += [(q, rank, i, d) for rank, (d, i) in enumerate(sorted(found)[:k], 1)]
    return out


@pytest.mark.parametrize("single", [True, False])
def test_search_sends_queries_and_not_chunks(spark, monkeypatch, single):
    monkeypatch.setattr(permutation, "SENT", 2)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 6)).astype(np.float32).astype(float)
    x[50:60] = x[40]
    vecs = {10 * i: x[i].tolist() for i in range(600)}
    df = spark.createDataFrame(list(vecs.items()), f"vec_id long, embedding array<{'float' if single else 'double'}>")
    got = permutation.permutation_search(df, F.col("id") % 40 == 0, k=3, pivots=40, near=12, share=0.2, chunk=100, block=32)
    # a chunk that is dealt out with each block of queries is shuffled once for every block
    assert "mapinarrow" in str(got._jdf.queryExecution().executedPlan()).lower()
    assert "block" not in got._jdf.queryExecution().toString()
    ids = df.select("vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(6)).alias("c"), F.xxhash64("vec_id").alias("h")).collect()
    pivots = permutation.choose_pivots([vecs[r["vec_id"]] for r in sorted(ids, key=lambda r: r["h"])], 40)
    want = _plain_search(vecs, 6, {r["vec_id"]: r["c"] for r in ids}, pivots, 12, 0.2, 3, [i for i in vecs if i % 40 == 0])
    assert [(r[0], r[1], r[2]) for r in sorted(got.collect())] == [w[:3] for w in want]
    assert np.allclose([r[3] for r in sorted(got.collect())], [w[3] for w in want])


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.integers(1, 9), st.integers(0, 9))
def test_footrule_of_an_inverted_file(near, n, seed):
    import pyarrow as pa

    rng = np.random.default_rng(seed)
    orders = np.array([rng.permutation(near + 20)[:near] for _ in range(n)], dtype=np.int16)
    t = pa.table({"chunk": [0] * n, "id": list(range(n)), "vec": [[1.0]] * n, "near": [bytes(o) for o in orders]})
    packed = permutation._pack_chunk(t, near + 20)
    held = np.frombuffer(packed["lists"][0].as_py(), dtype=np.min_scalar_type(near)).reshape(-1, n)
    place = np.full((n, near + 20), near)
    place[np.arange(n)[:, None], orders] = np.arange(near)
    for o, own in zip(orders, place):
        assert permutation.footrule(o, held).tolist() == np.abs(place - own).sum(axis=1).tolist()


@given(st.lists(st.integers(0, 6), min_size=1, max_size=30), st.integers(1, 31))
def test_nearest_share(same, take):
    want = sorted(sorted(range(len(same)), key=lambda i: (-same[i], i))[:take])
    assert permutation.nearest_share(np.array(same, dtype=np.uint16), take).tolist() == want


def test_no_pair_is_tested_twice(spark, monkeypatch):
    """What the stars have tested is not tested again: lists of two, and the foremost member of short lists."""
    monkeypatch.setattr(graph, "SHORT", 8)
    sets = {n: {*range(100 * n, 100 * n + 40)} for n in range(7)}       # no two are alike, but
    sets[5] = sets[6] = {*range(1000, 1040)}
    to_set = lambda data: np.frombuffer(data, dtype=np.uint64)
    items = spark.createDataFrame([(n, bytearray(np.array(sorted(x), dtype=np.uint64).tobytes())) for n, x in sets.items()],
                                  "node long, item binary")
    lists = {1: [0, 1], 2: [0, 1, 2], 3: [3, 4], 4: [2, 4, 5, 6]}
    asked = []

    def likely(pairs):
        asked.append(sorted((r["a"], r["b"]) for r in pairs.collect()))
        return pairs

    posts = spark.createDataFrame([(t, n, 1) for t, nodes in lists.items() for n in nodes], "token long, node long, weight long")
    roots, links = graph.linked_components(posts, items, to_set, 75, likely)
    assert [(r["node"], r["root"]) for r in roots.collect()] == [(6, 5)]
    assert [(r["a"], r["b"]) for r in links.collect()] == [(5, 6)]
    assert asked == [[(0, 1), (0, 2), (2, 4), (2, 5), (2, 6), (3, 4)], [(1, 2), (4, 5), (4, 6), (5, 6)]]
    met = spark.createDataFrame([(t, n, min(x), len(x)) for t, x in lists.items() for n in x], "token long, node long, head long, m long")
    asked.clear()
    roots, _ = graph.linked_components(met, items, to_set, 75, likely, rows=met.count(), met=True)
    assert [(r["node"], r["root"]) for r in roots.collect()] == [(6, 5)]
    assert asked == [[(0, 1), (0, 2), (2, 4), (2, 5), (2, 6), (3, 4)], [(1, 2), (4, 5), (4, 6), (5, 6)]]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \U0001f600\uffff", max_size=30), max_size=8), st.data())
def test_sets_of_many_forms(forms, data):
    sets = lines.form_sets(forms)
    assert [x.tolist() for x in sets] == [lines.form_set(f).tolist() for f in forms]
    for f, x in zip(forms, sets):
        grams = {f[i:i + lines.GRAM] for i in range(len(f) - lines.GRAM + 1)}
        plain = [sum(int(common.mix(np.array([ord(c) + 1], dtype=np.uint64))[0]) * int(w) for c, w in zip(g, lines._GRAM_LANES))
                 for g in grams]
        assert x.tolist() == sorted(common.mix(np.array([v % (1 << 64) for v in plain], dtype=np.uint64)).tolist())
    if forms:
        at = st.lists(st.integers(0, len(forms) - 1), min_size=1, max_size=9)
        a, b = np.array(data.draw(at)), np.array(data.draw(at))
        a, b = a[:len(b)], b[:len(a)]
        assert graph.common_sizes(sets, a, b).tolist() == [len({*sets[i].tolist()} & {*sets[j].tolist()}) for i, j in zip(a, b)]


def test_nibbles_of_many_forms(spark):
    tokens = np.random.default_rng(2).integers(-1 << 63, 1 << 63, (9, lines.BANDS), dtype=np.int64)
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens.tolist())], "k int, t array<long>")
    want = [list(r["n"]) for r in df.select("k", lines.nibbles("t").alias("n")).orderBy("k").collect()]
    assert lines.nibble_words(tokens).tolist() == want


def test_forms_met_again_are_posted_once():
    import pyarrow as pa

    text = ["one line of text\nOne  line of text\nabc\nanother line here", "another line here\nabc", "x" * 300_000 + "\none line of text"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([4, 5, 6]), pa.array(text)], names=["doc_id", "h", "text"])
    rows = [r for b in lines._line_batches(iter([batch]), 6) for r in b.to_pylist()]
    forms = [lines.form(x) for t in text for x in t.split("\n")]
    assert [r["node"] for r in rows] == [lines.node_of(f, len(lines.form_set(f))) for f in forms]
    assert [r["b0"] is not None for r in rows] == [True, False, False, True, False, False, True, False]
    assert all((r["b0"] is None) == (r["b3"] is None) and len(r["b3"] or b"x" * 40) == 8 * lines.STEP for r in rows)
