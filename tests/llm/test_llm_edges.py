"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing names."""

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import ordinal, toxicity
from tidepool.llm.archive import convert_pages
from tidepool.llm.lines import clean_lines
from tidepool.llm.merkle import fingerprint_edits
from tidepool.llm.minhash import near_duplicates
from tidepool.llm.mixing import entropy_mix
from tidepool.llm.packing import pack
from tidepool.llm.permutation import permutation_search
from tidepool.llm.suffix import remove_repeats

LONG = " ".join(f"word{i % 977}x{i % 13}" for i in range(150_000))
LINE = "The same boilerplate line stands in many of these documents."
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, size long, token long, "
          "node long, z string, copies long, h1 long, bucket long")


def _rows():
    texts = {0: "alpha beta gamma delta epsilon zeta", 1: "alpha beta gamma delta epsilon zeta", 2: "", 3: None,
             4: " \n\t ", 5: LONG, 6: LONG + " end", 7: "one", 8: "one", 9: LINE + "\nown words of nine stand here now",
             10: LINE + "\nother words of ten stand over there", 11: "x" * 400, 12: "äöü " * 60}
    rows = [(i, t, None if i % 4 == 0 else "en", None if i % 5 == 0 else f"s{i % 3}", None if t is None else len(t))
            for i, t in texts.items()]
    rows.append(rows[9])                        # a repeated row
    rows.append((None, LINE + "\nno id", "en", "s1", 3))
    return [(*r, "r", 1, 2, 3, "z", 9, 4, 5) for r in rows]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 3 == 0)) for i in range(13)] + [(None, 1, 1), (5, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


TEXTS = [(r[0], r[1]) for r in _rows() if r[0] is not None]


def test_near_duplicates(odd, none):
    want = brute.near_duplicates(dict(TEXTS).items())
    got = near_duplicates(odd).collect()
    assert len(got) == len(_rows()) and near_duplicates(none).count() == 0
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None} == \
        {(i, n, c) for i, (n, c) in want.items()}


def test_lines(odd, none):
    want = brute.clean_lines(list(dict(TEXTS).items()))
    got = clean_lines(odd).collect()
    assert len(got) == len(_rows()) and clean_lines(none).count() == 0
    assert all(r["text"] == want[r["row"]["doc_id"]] for r in got if r["row"]["doc_id"] is not None)


def test_lines_of_several_texts_under_one_id(spark):
    """Texts are told apart by id and hash: a line of one is not removed because of its number in another."""
    long = "A line that stands in many of these texts, word for word."
    texts = [(1, long + "\nonly here, with words of its own"), (1, "nothing of that\nbut other things\nand more"),
             (2, long + "\nanother end"), (2, "Share this post\nlast"), (3, "share  this POST\nx"), (3, "Share this post"),
             (None, long), (4, "x")]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    got = sorted((r["row"]["doc_id"], r["text"], r["n_lines"], r["n_removed"]) for r in clean_lines(df).collect()
                 if r["row"]["doc_id"] is not None)
    for doc_id, text, n, removed in got:
        before = next(t for i, t in texts if i == doc_id and n == t.count("\n") + 1
                      and set(text.split("\n")) <= set(t.split("\n")) | {""})
        assert removed == n - len(text.split("\n")) if text else removed == n
        assert before
    kept = [line for _, t, _, _ in got for line in t.split("\n")]
    assert kept.count(long) == 1 and sum(line.lower().split() == ["share", "this", "post"] for line in kept) == 1
    assert kept.count("x") == 1
    for own in ("only here, with words of its own", "nothing of that", "but other things", "and more", "another end", "last"):
        assert kept.count(own) == 1


def test_line_sizes_and_tokens():
    from tidepool.llm import lines
    forms = ["aaaaaaaaaa", "abcdefgh", "ab ab ab ab ab ab", "x" * 5, "héllo wörld " * 500]
    grams, starts = lines._join(forms)
    assert lines.set_sizes(grams, starts).tolist() == [len(lines.form_set(f)) for f in forms]
    assert lines.node_of("abc", 0) & lines.MOST == 0 and lines.node_of("abc", 10 ** 6) & lines.MOST == lines.MOST


@pytest.mark.parametrize("hot", [1, 4096])
def test_repeats(odd, none, hot):
    want = brute.remove_repeats([(-1, _rows()[-1][1]), *dict(TEXTS).items()])
    got = remove_repeats(odd, hot=hot).collect()
    assert len(got) == len(_rows()) and remove_repeats(none).count() == 0
    for r in got:
        i = -1 if r["doc_id"] is None else r["doc_id"]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[i]


def test_mix(odd, none):
    got = entropy_mix(odd, keep=odd.columns).collect()
    assert len(got) == len(_rows()) and entropy_mix(none).count() == 0
    by = {}
    for r in got:
        assert r["row"]["copies"] == 9 and 0 <= r["taken"] <= 2 * r["size"]
        by.setdefault(r["source"], []).append(r)
    assert None in by
    for rows in by.values():
        assert sum(r["size"] for r in rows) == rows[0]["source_size"]


def test_toxicity(spark, odd, none, labels):
    model = toxicity.fit(odd, labels, toxicity.fold(F.col("doc_id")) != 1)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(_rows()) and all(0 <= r["score"] <= 1 for r in got)
    assert len({r["score"] for r in got if not (r["text"] or "").split()}) == 1
    empty = toxicity.fit(none, labels.limit(0), F.lit(True))
    assert toxicity.score(none, empty).count() == 0
    assert {r["score"] for r in toxicity.score(odd, empty).collect()} == {0.0}


def test_ordinal(spark, odd, none, labels):
    rated = labels.select("doc_id", ordinal.rating(F.col("quality"), F.col("toxic")).alias("grade"))
    got = ordinal.grade(odd, ordinal.fit(odd, rated, top=2)).collect()
    assert len(got) == len(_rows()) and all(r["tails"][1] <= r["tails"][0] for r in got)
    assert ordinal.grade(none, ordinal.fit(none, rated.limit(0), top=2)).count() == 0


def test_pack(odd, none):
    got = pack(odd, capacity=1000, shard=5).collect()
    assert pack(none).count() == 0
    assert sum(r["n_words"] for r in got) == sum(len(brute.words(r[1])) for r in _rows())
    in_bin = {}
    for r in got:
        in_bin.setdefault(r["bin_id"], []).append(r)
    assert all(len({r["source"] for r in b}) == len(b) == len({r["cluster"] for r in b}) for b in in_bin.values())


def test_search(spark):
    good = [(i, [float(i % 5), 1.0, float(i % 3), 0.5], 0, "x") for i in range(1, 40)]
    bad = [(100, None, 0, "x"), (200, [0.0] * 4, 0, "x"), (300, [1.0, None, 0.0, 0.0], 0, "x"),
           (400, [float("nan"), 1.0, 0.0, 0.0], 0, "x"), (500, [1.0], 0, "x"), (None, [1.0, 1.0, 1.0, 1.0], 0, "x"),
           (600, [float("inf"), 1.0, 0.0, 0.0], 0, "x")]
    rows = good + bad + [(700, [1.0, 1.0, 1.0, 0.5], 0, "x")] * 2 + [(800, [1.0, 1.0, 1.0, 0.5], 0, "x")]
    schema = "vec_id long, embedding array<double>, id int, vec string"
    df = spark.createDataFrame(rows, schema)
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"])
           for r in permutation_search(df, F.col("id") % 100 == 0, share=1.0).collect()}
    usable = {r[0]: r[1] for r in good + rows[-3:]}
    assert got == brute.nearest(list(usable.items()), [700, 800])
    assert permutation_search(df.limit(0), F.col("id") % 100 == 0).count() == 0
    few = permutation_search(df.filter("vec_id in (700, 800)"), F.col("id") % 100 == 0).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in sorted(few)] == [(700, 1, 800, 0.0), (800, 1, 700, 0.0)]


def test_archive(spark):
    big = "p" * 300_000
    rows = [(1, "http://a/", "x" * 100, 0), (2, None, "x" * 100, 0), (3, " a b\n", "x" * 99, 0), (4, "http://d/", "x" * 99, 0),
            (5, "http://e/", None, 0), (6, "http://f/", "", 0), (7, "u", "WARC/1.1\r\n\r\n\r\nfiledesc://\n", 0),
            (8, "u", big, 0), (9, "u", big, 0), (None, "u", big, 0), (10, "u", "é" * 50, 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload int")
    for version in (1, 2):
        got = {r["key"]: r for r in convert_pages(df, version=version).collect()}
        assert len(got) == len(rows)
        assert {k: r["refers_to"] for k, r in got.items() if r["record_type"] == "revisit"} == {2: 1, 9: 8, None: 8}
        assert got[9]["payload_bytes"] == len(big) and got[10]["payload_bytes"] == 100 and got[5]["payload_bytes"] == 0
        assert got[7]["payload"] == rows[6][2].encode()
    assert convert_pages(df.limit(0)).count() == 0


def test_fingerprints(odd, none):
    got = fingerprint_edits(odd).collect()
    assert len(got) == len(_rows()) and fingerprint_edits(none).count() == 0
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], set()).add(r["fingerprint"])
    assert by[0] == by[1] and by[2] == by[3] and by[7] == by[8] and by[5] != by[6]


def test_pipeline_stages(spark, odd, none, tmp_path):
    for docs in (odd, none):
        at = str(tmp_path / f"in{docs is none}")
        spark.createDataFrame([(i, 1, int(i == 7)) for i in range(13)], "doc_id long, quality int, toxic int").write.parquet(
            f"{at}/labels.parquet")
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, at)
            if name != "pack":
                assert docs.columns == odd.columns
        docs.collect()


def test_archive_of_other_encodings(spark, tmp_path):
    """Bytes that are not UTF-8 pass through both formats as they are; digests are of the bytes."""
    import gzip
    import hashlib

    from tidepool.llm import archive
    body = "naïve café".encode("latin-1") * 20
    head = b"HTTP/1.0 200 OK\r\nServer: caf\xe9\r\n\r\n"
    block = b"1 0 Old\nURL IP-address Archive-date Content-type Archive-length\n"
    data = b"filedesc://x 0.0.0.0 19990101000000 text/plain %d\n%s\n" % (len(block), block)
    for url in (b"http://a/caf\xe9", b"http://b/"):
        data += b"%s 1.2.3.4 19990102030405 text/html %d\n%s\n" % (url, len(head + body), head + body)
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "old.arc.gz").write_bytes(gzip.compress(data))
    arc = archive.read_arc(spark, str(tmp_path / "arc"))
    rows = arc.collect()
    assert [(r["url"], bytes(r["payload"]), bytes(r["http_head"])) for r in rows] == [
        ("http://a/caf%E9", body, head), ("http://b/", body, head)]
    archive.write_warc(archive.to_warc(arc), str(tmp_path / "warc"))
    back = archive.read_warc(spark, str(tmp_path / "warc")).collect()
    assert {r["payload_digest"] for r in back} == {hashlib.sha256(body).hexdigest()}
    assert sorted(r["record_type"] for r in back) == ["response", "revisit"]
    assert [bytes(r["payload"]) for r in back if r["record_type"] == "response"] == [body]
