"""Legacy web archives (ARC version 1 and 2) to WARC.

An ARC file is a *version block* (a record whose URL starts with
``filedesc://``; its body names the version and the field list) followed by
records: one header line of space-separated fields, the last of which is the
declared length, then that many bytes, then a line break.  Version 1 lines
have 5 fields, version 2 lines have 10.  ``read_arc`` follows the declared
lengths, so bodies may hold anything that looks like a header.

``to_warc`` synthesises the WARC side of every record: a name-based record id,
the ISO timestamp, the record type and the digests.  Of records with equal
payloads of at least ``min_revisit`` bytes the one with the smallest key is
the ``response``, the others are ``revisit`` records that refer to it.

Files are written by Spark's text writer with the record separator as line
separator: an archive of UTF-8 records is exactly that, here gzip-compressed as a
whole.  They are read back as binary files (``max_records`` bounds a file) and
parsed by length.  Payloads and HTTP heads are bytes throughout (an old archive may
hold any encoding); columns of text are only taken from header lines, in which
bytes that are not UTF-8 become percent codes.

Edge cases: a null body is an empty payload; a null or blank URL becomes
``unknown:``; white space and control characters in a URL are percent-encoded;
a null key is kept (the record then carries no key field and is read back with
a null key; nulls rank last); rows that repeat key, URL and payload are the same
record and share its type; an empty table gives no records.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm.common import cut, shared_path

ARC_V1 = "URL IP-address Archive-date Content-type Archive-length"
ARC_V2 = ("URL IP-address Archive-date Content-type Result-code Checksum Location "
          "Offset Filename Archive-length")
KEY_FIELD = "X-Source-Key"


def _clean_url(url: Column) -> Column:
    u = F.coalesce(F.trim(url), F.lit(""))
    u = F.when(u == "", F.lit("unknown:")).otherwise(u)
    for ch, code in ((" ", "%20"), ("\t", "%09"), ("\r", "%0D"), ("\n", "%0A"),
                     ("\x0b", "%0B"), ("\x0c", "%0C")):
        u = F.replace(u, F.lit(ch), F.lit(code))
    return u


def write_arc(pages: DataFrame, path: str, *, key: str, url: str, body: str,
              version: int = 1, date: str = "20080430204825",
              max_records: int = 1000) -> None:
    """Write ``pages`` as ARC files.

    A version block stands before every record, as the text writer knows no first
    line of a file; readers skip repeated ones.  Each body is stored as an HTTP response; the key goes into an HTTP field.
    """
    head = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
        F.when(F.col(key).isNull(), F.lit("")).otherwise(
            F.concat(F.lit(f"{KEY_FIELD}: "), F.col(key).cast("string"), F.lit("\r\n"))),
        F.lit("\r\n"))
    content = F.concat(head, F.coalesce(F.col(body), F.lit("")))
    size = F.octet_length(content).cast("string")
    fields = [_clean_url(F.col(url)), F.lit("0.0.0.0"), F.lit(date), F.lit("text/html")]
    if version == 2:
        fields += [F.lit("200"), F.lit("-"), F.lit("-"), F.lit("0"), F.lit("pages.arc")]
    intro = f"{version} 0 Tidepool\n{ARC_V2 if version == 2 else ARC_V1}\n"
    first = ["filedesc://pages.arc", "0.0.0.0", date, "text/plain"]
    if version == 2:
        first += ["200", "-", "-", "0", "pages.arc"]
    block = " ".join([*first, str(len(intro))]) + "\n" + intro
    # the version block stands before every record; readers skip repeated ones
    text = F.concat(F.lit(block + "\n"), F.concat_ws(" ", *fields, size), F.lit("\n"), content)
    (pages.select(text.alias("value")).write.option("lineSep", "\n")
     .option("compression", "gzip").option("maxRecordsPerFile", max_records).text(path))


def parse_arc(data: bytes) -> Iterator[dict]:
    """Records of one ARC byte string, by version-specific header line and declared length."""
    version, at = 1, 0
    while at < len(data):
        if data[at] in b"\r\n":
            at += 1
            continue
        stop = data.find(b"\n", at)
        if stop < 0:
            raise ValueError(f"ARC header line without an end at byte {at}")
        parts = _as_text(data[at:stop].rstrip(b"\r")).split(" ")
        is_block = parts[0].startswith("filedesc://")
        if len(parts) != (10 if len(parts) == 10 and (is_block or version == 2) else 5):
            raise ValueError(f"ARC header line with {len(parts)} fields at byte {at}")
        length = int(parts[-1])
        body = data[stop + 1:stop + 1 + length]
        if len(body) != length:
            raise ValueError(f"ARC record cut short at byte {at}")
        at = stop + 1 + length
        if is_block:
            version = int(body.split(b" ", 1)[0])
            if version not in (1, 2):
                raise ValueError(f"unknown ARC version {version}")
            continue
        yield {"url": parts[0], "ip": parts[1], "date": parts[2], "mime": parts[3],
               "status": int(parts[4]) if version == 2 and parts[4].isdigit() else None,
               "version": version, "content": body}


def _as_text(line: bytes) -> str:
    """A header line; bytes of another encoding become percent codes."""
    try:
        return line.decode("utf-8")
    except UnicodeDecodeError:
        return "".join(chr(b) if b < 128 else f"%{b:02X}" for b in line)


def _http_split(content: bytes) -> tuple[bytes, bytes, str | None]:
    """HTTP head, payload and the key field of an archived response."""
    cut_at = content.find(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") or cut_at < 0:
        return b"", content, None
    head, mark = content[:cut_at + 4], f"{KEY_FIELD}:".encode()
    keys = [ln.split(b":", 1)[1].strip() for ln in head.split(b"\r\n") if ln.startswith(mark)]
    return head, content[cut_at + 4:], keys[0].decode("ascii") if keys and keys[0].lstrip(b"-").isdigit() else None


ARC_SCHEMA = ("key long, url string, ip string, date string, mime string, version int, "
              "http_head binary, payload binary")


def _read_arc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "url", "ip", "date", "mime", "version", "http_head", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(),
             pa.binary(), pa.binary()]
    for batch in batches:
        for data in _contents(batch):
            rows, size = [], 0
            for r in parse_arc(data):
                head, payload, key = _http_split(r["content"])
                rows.append((None if key is None else int(key), r["url"], r["ip"], r["date"],
                             r["mime"], r["version"], head, payload))
                size += len(payload)
                if size > 1 << 23:
                    yield _batch(rows, names, kinds)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names, kinds)


def _contents(batch: pa.RecordBatch) -> Iterator[bytes]:
    for value in batch.column(0):  # one file at a time
        data = value.as_py()
        yield gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(zip(*rows), kinds, strict=True)], names=names)


def read_arc(spark: SparkSession, path: str) -> DataFrame:
    """One row per ARC record under ``path``."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_arc_batches, ARC_SCHEMA)


def to_warc(arc: DataFrame, *, min_revisit: int = 100) -> DataFrame:
    """WARC fields per ARC record: ids, timestamps, types, digests, and the record text."""
    digest = F.sha2(F.col("payload"), 256)
    d = F.col("date")
    stamp = F.concat(F.substring(d, 1, 4), F.lit("-"), F.substring(d, 5, 2), F.lit("-"),
                     F.substring(d, 7, 2), F.lit("T"), F.substring(d, 9, 2), F.lit(":"),
                     F.substring(d, 11, 2), F.lit(":"), F.substring(d, 13, 2), F.lit("Z"))
    base = (arc.withColumn("digest", digest).withColumn("bytes", F.octet_length("payload").cast("long"))
            .withColumn("stamp", stamp)
            .withColumn("ident", _record_id(F.col("key"), F.col("url"), F.col("date"), digest)))
    # the smallest key of each payload; map-side combined, so a hot payload is one row per task
    low = (base.filter(F.col("bytes") >= min_revisit).groupBy("digest")
           .agg(F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "ident", "url"))
                .alias("first"), F.count("*").alias("n"))
           .filter("n > 1").drop("n"))
    low = cut(low, "payloads")  # its size on disk decides how the payloads meet it
    j = base.join(low, "digest", "left")
    # equal keys with equal payloads have equal ids: one of them is the response
    same = F.col("first.ident") == F.col("ident")
    revisit = F.col("first").isNotNull() & ~same
    j = j.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    j = j.withColumn("refers_to", F.when(revisit, F.col("first.key")))
    return j.select("key", "url", "ip", "stamp", "mime", "http_head", "payload", "digest", "bytes",
                    "ident", "record_type", "refers_to",
                    F.when(revisit, F.col("first.ident")).alias("refers_ident"),
                    F.when(revisit, F.col("first.url")).alias("refers_url"))


def _record_id(*parts: Column) -> Column:
    """Name-based UUID (version 8 layout) of what identifies a record."""
    h = F.sha2(F.concat_ws("\x1f", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]), 256)
    return F.concat(F.lit("urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4),
                    F.lit("-8"), F.substring(h, 14, 3), F.lit("-a"), F.substring(h, 18, 3),
                    F.lit("-"), F.substring(h, 21, 12))


def warc_text(records: DataFrame) -> DataFrame:
    """The bytes of each record as one ``value`` column (without the closing separator)."""
    is_rev = F.col("record_type") == "revisit"
    none = F.lit("").cast("binary")
    block = F.concat(F.col("http_head"), F.when(is_rev, none).otherwise(F.col("payload")))   # bytes

    def field(name: str, value: Column) -> Column:
        return F.when(value.isNull(), F.lit("")).otherwise(
            F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")))

    head = F.concat(
        F.lit("WARC/1.1\r\n"), field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.concat(F.lit("<"), F.col("ident"), F.lit(">"))),
        field("WARC-Date", F.col("stamp")), field("WARC-Target-URI", F.col("url")),
        field("WARC-IP-Address", F.col("ip")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(block, 256))),
        field("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_ident"), F.lit(">"))),
        field("WARC-Refers-To-Target-URI", F.col("refers_url")),
        field("WARC-Profile", F.when(is_rev, F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
        field(KEY_FIELD, F.col("key")), field("X-Refers-To-Key", F.col("refers_to")),
        field("X-Payload-Length", F.col("bytes")),
        F.lit("Content-Type: application/http; msgtype=response\r\n"),
        field("Content-Length", F.octet_length(block)), F.lit("\r\n"))
    # the text writer writes a string's bytes as they are
    return records.select(F.concat(head.cast("binary"), block).cast("string").alias("value"))


def write_warc(records: DataFrame, path: str, *, max_records: int = 1000) -> None:
    """Write records as WARC files; the separator after each record is the line separator."""
    (warc_text(records).write.option("lineSep", "\r\n\r\n")
     .option("compression", "gzip").option("maxRecordsPerFile", max_records).text(path))


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of every record, by declared length."""
    at = 0
    while at < len(data):
        stop = data.find(b"\r\n\r\n", at)
        lines = _as_text(data[at:stop]).split("\r\n")
        if stop < 0 or not lines[0].startswith("WARC/1."):
            raise ValueError(f"no WARC record at byte {at}")
        fields = {k.strip().lower(): v.strip() for k, _, v in (ln.partition(":") for ln in lines[1:])}
        a = stop + 4
        b = a + int(fields["content-length"])
        if data[b:b + 4] != b"\r\n\r\n":
            raise ValueError(f"WARC record without its separator at byte {b}")
        yield fields, data[a:b]
        at = b + 4


WARC_SCHEMA = ("key long, url string, stamp string, record_id string, record_type string, "
               "refers_to long, refers_ident string, payload_bytes long, payload_digest string, "
               "payload binary")


def _read_warc_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "url", "stamp", "record_id", "record_type", "refers_to", "refers_ident",
             "payload_bytes", "payload_digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(),
             pa.string(), pa.int64(), pa.string(), pa.binary()]
    num = lambda v: None if v is None else int(v)
    for batch in batches:
        for data in _contents(batch):
            rows, size = [], 0
            for f, block in parse_warc(data):
                _, payload, _ = _http_split(block)
                digest = f["warc-payload-digest"].partition(":")[2]
                if f["warc-block-digest"].partition(":")[2] != hashlib.sha256(block).hexdigest():
                    raise ValueError(f"block digest differs in {f['warc-record-id']}")
                response = f["warc-type"] == "response"
                if response and hashlib.sha256(payload).hexdigest() != digest:
                    raise ValueError(f"payload digest differs in {f['warc-record-id']}")
                rows.append((num(f.get(KEY_FIELD.lower())), f.get("warc-target-uri"), f["warc-date"],
                             f["warc-record-id"].strip("<>"), f["warc-type"],
                             num(f.get("x-refers-to-key")),
                             (f.get("warc-refers-to") or "").strip("<>") or None,
                             len(payload) if response else int(f["x-payload-length"]), digest,
                             payload if response else None))
                size += len(payload)
                if size > 1 << 23:
                    yield _batch(rows, names, kinds)
                    rows, size = [], 0
            if rows:
                yield _batch(rows, names, kinds)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record under ``path``; digests of blocks and payloads are verified."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_read_warc_batches, WARC_SCHEMA)


def convert_pages(pages: DataFrame, *, key: str = "page_id", url: str = "url", body: str = "html",
                  version: int = 2, min_revisit: int = 100) -> DataFrame:
    """Pages to ARC files, ARC to WARC files, and the WARC records read back."""
    spark = pages.sparkSession
    arc, warc = shared_path(spark, "arc"), shared_path(spark, "warc")
    write_arc(pages.select(key, url, body), arc, key=key, url=url, body=body, version=version)
    write_warc(to_warc(read_arc(spark, arc), min_revisit=min_revisit), warc)
    return read_warc(spark, warc)
