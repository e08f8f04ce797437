"""Secret scan: fixed patterns, and strings that nothing around them explains.

Patterns find the secrets whose form is known (``base_spans``).  Others are found
by novelty: a string of ``MIN_CHARS`` or more beside a word like *password* or
*bearer* is a candidate, and its marginal size is measured with zstandard, primed
with a dictionary of

* the surrounding text (``NEAR`` characters on each side, the candidate's own
  occurrences taken out, else a secret written twice would explain itself), and
* the corpus' identifiers that occur in the candidate.  Words (and the parts of
  camel-case and snake-case names) are counted over all texts outside of
  candidates and pattern matches, so that a secret in many copies is no identifier;
  those found in ``min_texts`` texts or more are joined to the candidates.  The
  dictionary thus stands for one of all identifiers, of any number, of which a
  candidate can only use the ones it holds.

A candidate of which more than ``share`` of the bytes remain is reported; names,
paths and words shrink to a few bytes.

Work: one pass in Python over the texts gives spans, candidates and word counts;
everything else is joins and aggregations of those.  Findings depend on the text
alone, so candidates of equal texts are measured once.  A task holds one Arrow
batch of texts and a batch of candidates.

Edge cases: a null text is the empty text.  Repeated rows and ids give a row each.
Offsets are code points.  Very long texts are scanned whole.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.common import cut

# fixed values: the patterns with a known form
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")     # a maximal run of 18 or more
HEX = re.compile(r"[0-9a-f]{16,}")            # likewise of 16 or more
KINDS = ("assign", "access", "hex", "novel")

# words beside which a string is sensitive
CUE_WORDS = ("pass", "pwd", "secret", "token", "key", "auth", "bearer", "credential", "private", "signature", "cookie")
CUE = re.compile(r"(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|signing|encryption)[\x20_-]?key"
                 r"|auth(?:orization)?|bearer|credentials?|signature|cookie)(?![A-Za-z])", re.IGNORECASE | re.ASCII)
ASSIGNED = re.compile(r"""["')\]]?\x20*(?::|=>?|:=)\x20*["']?""")
VALUE = re.compile(r"[A-Za-z0-9][A-Za-z0-9+/_.=~-]{9,}")
MIN_CHARS = 10
REACH = 32           # a string that begins so many characters after the cue, on its line
NEAR = 1024
WORD = re.compile(r"[^\W\d_]{3,}")
PART = re.compile(r"[^\W\d_A-Z]{3,}|[A-Z][^\W\d_A-Z]{2,}|[A-Z]{3,}")
PIECE = 1 << 20
SHARE = 0.6
LEVEL = 19


def base_spans(text: str, lower: str | None = None) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the pattern matches, in order (kind: place in ``KINDS``).

    Matches are leftmost and do not overlap within a kind; those whose value is too
    short are dropped after they have taken their characters.
    """
    lower = text.lower() if lower is None else lower
    out = []
    if any(w in lower for w in ASSIGN_WORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def candidates(text: str, base: list[tuple[int, int, int]], lower: str | None = None) -> list[tuple[int, int]]:
    """Spans of strings in sensitive context that touch no pattern match.

    A string that is assigned to the cue may be of any kind, one that only stands
    near it must hold both letters and digits.
    """
    lower = text.lower() if lower is None else lower
    if not any(w in lower for w in CUE_WORDS):
        return []
    found, assigned_at = {}, set()
    for cue in CUE.finditer(text):
        at = cue.end()
        assigned = ASSIGNED.match(text, at)
        stop = text.find("\n", at, at + REACH)
        stop = min(len(text), at + REACH) if stop < 0 else stop
        first = True
        while at < stop:
            m = VALUE.search(text, at, stop + MIN_CHARS)
            if not m or m.start() >= stop:
                break
            m = VALUE.match(text, m.start())        # to its end
            value = m.group()
            mixed = any(c.isdigit() for c in value) and any(c.isalpha() for c in value)
            own = bool(first and assigned and assigned.end() == m.start())
            if mixed or own:
                found.setdefault(m.start(), m.end())
                if own:
                    assigned_at.add(m.start())
            at, first = m.end(), False
    taken: list[list[int]] = []                      # the matches' characters as disjoint ranges
    for a, _, b in base:
        if taken and a <= taken[-1][1]:
            taken[-1][1] = max(taken[-1][1], b)
        else:
            taken.append([a, b])
    sure = sorted(assigned_at)                       # `name=value` is told by its value alone
    out, done, i = [], 0, 0
    for a, b in sorted(found.items()):
        k = bisect_right(sure, a)
        if a not in assigned_at and k < len(sure) and sure[k] < b:
            continue
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if a >= done and not (i < len(taken) and taken[i][0] < b):
            out.append((a, b))
            done = b
    return out


def _without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with the spans (in any order, they may overlap) blanked out."""
    out, at = [], 0
    for a, b in sorted(spans):
        if b > at:
            out.append(text[at:max(a, at)])
            at = b
    return " ".join([*out, text[at:]]) if out else text


def words(text: str) -> set[str]:
    """Distinct words and name parts of three letters or more, lower-cased; read in pieces cut between words."""
    seen: set[str] = set()
    a = 0
    while a < len(text):
        b = min(len(text), a + PIECE)
        while b < len(text) and text[b].isalpha():
            b += 1
        seen.update(WORD.findall(text[a:b]))
        a = b
    # an inner capital marks a name with parts
    parts = [p for w in seen if not (w.islower() or w.isupper() or w[1:].islower()) for p in PART.findall(w)]
    return {w.lower() for w in seen} | {p.lower() for p in parts}


def value_parts(value: str) -> list[str]:
    """Words and name parts of a candidate, as written."""
    whole = WORD.findall(value)
    return list(dict.fromkeys([*whole, *(p for w in whole for p in PART.findall(w))]))


def marginal_bytes(value: str, near: str, known: list[str]) -> int:
    """Bytes that ``value`` adds to a zstandard frame primed with ``known`` identifiers and the text ``near`` it."""
    primer = " ".join([*sorted(known), near.replace(value, " ")]).encode().ljust(64)
    data = value.encode()
    how = zstandard.ZstdCompressionParameters.from_level(
        LEVEL, source_size=len(data), dict_size=len(primer), format=zstandard.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    dictionary = zstandard.ZstdCompressionDict(primer, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    frame = zstandard.ZstdCompressor(dict_data=dictionary, compression_params=how).compress(data)
    blocks = 1 + (len(data) - 1 >> 17)
    return max(0, len(frame) - 2 - 3 * blocks)      # less the frame's and its blocks' headers


_SCAN = ("what string, doc_id {id}, k binary, n_assign long, n_access long, n_hex long, base_sha256 string, "
         "base array<struct<start:long,kind:int,end:long>>, n_found long, start long, kind int, end long, value string, "
         "near string, parts array<string>, word string, texts long")


def _scan(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows of three kinds: ``doc`` (spans of a document), ``found`` (span to measure) and ``word`` (text count)."""
    def flush(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema)

    for batch in batches:
        rows, count = [], Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = text.as_py() or ""
            lower = text.lower()
            base = base_spans(text, lower)
            new = candidates(text, base, lower)
            key = hashlib.sha256(text.encode()).digest()
            named = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base)
            n = Counter(k for _, k, _ in base)
            rows.append({"what": "doc", "doc_id": doc_id, "k": key, "n_assign": n[0], "n_access": n[1], "n_hex": n[2],
                         "base_sha256": hashlib.sha256(named.encode()).hexdigest(),
                         "base": [{"start": a, "kind": k, "end": b} for a, k, b in base], "n_found": len(new)})
            for a, k, b in [*base, *((a, 3, b) for a, b in new)]:
                value = text[a:b]
                rows.append({"what": "found", "k": key, "start": a, "kind": k, "end": b, "value": value,
                             "near": f"{text[max(0, a - NEAR):a]} {text[b:b + NEAR]}", "parts": value_parts(value)})
                if len(rows) >= 1000:
                    yield flush(rows)
                    rows = []
            count.update(words(_without(text, [(a, b) for a, _, b in base] + new)))
        yield flush(rows)
        rows = []
        for w, c in count.items():
            rows.append({"what": "word", "word": w, "texts": c})
            if len(rows) >= 10_000:
                yield flush(rows)
                rows = []
        yield flush(rows)


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
    n = pa.int64()
    return pa.schema([("what", pa.string()), ("doc_id", id_type), ("k", pa.binary()), ("n_assign", n), ("n_access", n),
                      ("n_hex", n), ("base_sha256", pa.string()), ("base", pa.list_(span)), ("n_found", n), ("start", n),
                      ("kind", pa.int32()), ("end", n), ("value", pa.string()), ("near", pa.string()),
                      ("parts", pa.list_(pa.string())), ("word", pa.string()), ("texts", n)])


def scan(docs: DataFrame) -> DataFrame:
    """One pass over all texts (``doc_id``, ``text``): document rows, spans to measure, word counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            schema = schema or _arrow_schema(batch.schema.field(0).type)
            yield from _scan(iter([batch]), schema)

    return docs.select("doc_id", "text").mapInArrow(run, _SCAN.format(id=dict(docs.dtypes)["doc_id"]))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = {c: batch.column(c) for c in ("value", "near", "known")}
        size = [marginal_bytes(*(cols[c][i].as_py() for c in ("value", "near")), cols["known"][i].as_py() or [])
                for i in range(batch.num_rows)]
        keep = [batch.column(c) for c in ("k", "start", "kind", "end", "value")]
        yield pa.RecordBatch.from_arrays([*keep, pa.array(size, pa.int64())],
                                         names=["k", "start", "kind", "end", "value", "bytes"])


def novelty(scanned: DataFrame, min_texts: int = 3) -> DataFrame:
    """``k, start, kind, end, value, bytes``: marginal bytes of every span of every distinct text.

    ``k`` is the SHA-256 of the text.  Pattern matches are measured as well.
    """
    found = (scanned.filter("what = 'found'").select("k", "start", "kind", "end", "value", "near", "parts")
             .dropDuplicates(["k", "start", "kind"]))
    found = cut(found, "secret-candidates")
    part = found.select("k", "start", "kind", F.explode("parts").alias("part")).withColumn("word", F.lower("part"))
    known = (scanned.filter("what = 'word'").groupBy("word").agg(F.sum("texts").alias("texts"))
             .filter(F.col("texts") >= min_texts).select("word"))
    held = part.join(known, "word").groupBy("k", "start", "kind").agg(F.collect_set("part").alias("known"))
    rows = found.drop("parts").join(held, ["k", "start", "kind"], "left")
    return rows.mapInArrow(_measure, "k binary, start long, kind int, end long, value string, bytes long")


def find_secrets(docs: DataFrame, share: float = SHARE, min_texts: int = 3) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, one row per row of ``docs``.

    ``spans`` names all spans as ``kind:start:end``, comma-joined, by start and
    then kind; a novel span is a candidate that keeps over ``share`` of its bytes.
    """
    scanned = cut(scan(docs), "secret-scan")
    novel = novelty(scanned, min_texts).filter((F.col("kind") == 3) & (F.col("bytes") > share * F.octet_length("value")))
    per_text = cut(novel.groupBy("k").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more")), "novel-spans")
    rows = scanned.filter("what = 'doc'").select("doc_id", "k", "n_assign", "n_access", "n_hex", "base_sha256", "base", "n_found")
    some = rows.filter("n_found > 0").join(per_text, "k", "left")
    none = rows.filter("n_found = 0").withColumn("more", F.lit(None).cast(dict(per_text.dtypes)["more"]))
    kind = F.array(*map(F.lit, KINDS))
    spans = F.array_sort(F.concat("base", F.coalesce("more", F.array().cast(dict(per_text.dtypes)["more"]))))
    named = F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"], s["end"]))
    return none.unionByName(some.select(*none.columns)).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(named, ",").alias("spans"))
