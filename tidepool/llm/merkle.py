"""Document fingerprints: a Merkle tree over sections, paragraphs and clauses.

A text is cut without loss: sections end at a blank line, paragraphs at a line
break, clauses at a punctuation mark or after ``CLAUSE`` characters.  A clause
hash is SHA-256 of its text; a paragraph hash is SHA-256 of its clause hashes,
a section hash of its paragraph hashes, the root of its section hashes.  Equal
roots mean equal texts, and descending only into branches whose hashes differ
locates the edits.

``fingerprint`` serialises the tree as text::

    root/section:paragraph=leaf.leaf.leaf,paragraph=leaf.leaf/section:...

with the root in full and inner hashes shortened.  ``likeness`` of two
fingerprints is 1 when the roots are equal, else the Dice coefficient of the
distinct leaves.  ``edits`` lists the paragraph branches of one fingerprint that
the other does not have.

Only DataFrame functions are used; a text is one row, so memory is bounded by
the longest text.  Edge cases: a null text is an empty text; the tree of an
empty text has no sections; equal texts have equal fingerprints whatever their
ids; an empty table gives an empty result; a null id orders first among ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.common import cut

CLAUSE = 48
SHORT = 8    # hexadecimal digits of an inner hash in the serialised tree
GROUP = 400  # documents per ordered group in ``with_next``

SECTION_RE = r"(?s).+?(?:\n{2,}|\z)"
PARAGRAPH_RE = r"[^\n]*\n|[^\n]+"
CLAUSE_RE = rf"(?s)[^.,;:!?\n]{{0,{CLAUSE}}}[.,;:!?\n]+|[^.,;:!?\n]{{1,{CLAUSE}}}"


def _cut(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _join_hash(parts: Column) -> Column:
    return F.sha2(F.array_join(parts, ""), 256)


def leaf_hashes(text: Column) -> Column:
    """Clause hashes of a text: an array (sections) of arrays (paragraphs) of arrays."""
    return F.transform(_cut(F.coalesce(text, F.lit("")), SECTION_RE), lambda s: F.transform(
        _cut(s, PARAGRAPH_RE), lambda p: F.transform(_cut(p, CLAUSE_RE), lambda c: F.sha2(c, 256))))


def _paragraph_nodes(hashes: Column) -> Column:
    return F.transform(hashes, lambda s: F.transform(s, lambda p: F.struct(
        _join_hash(p).alias("h"),
        F.array_join(F.transform(p, lambda x: F.substring(x, 1, SHORT)), ".").alias("leaves"))))


def _section_nodes(paragraphs: Column) -> Column:
    return F.transform(paragraphs, lambda s: F.struct(
        _join_hash(F.transform(s, lambda p: p["h"])).alias("h"),
        F.array_join(F.transform(s, lambda p: F.concat(F.substring(p["h"], 1, SHORT), F.lit("="), p["leaves"])),
                     ",").alias("body")))


def _serialise(sections: Column) -> Column:
    return F.concat_ws("/", _join_hash(F.transform(sections, lambda s: s["h"])), F.array_join(
        F.transform(sections, lambda s: F.concat(F.substring(s["h"], 1, SHORT), F.lit(":"), s["body"])), "/"))


def with_fingerprints(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """Add the fingerprint of each text column (``{new column: text column}``).

    One step per tree level, so every hash is computed once.
    """
    for step in (leaf_hashes, _paragraph_nodes, _section_nodes, _serialise):
        df = df.withColumns({out: step(F.col(text if step is leaf_hashes else out)) for out, text in texts.items()})
    return df


def root(fp: Column) -> Column:
    return F.substring(fp, 1, 64)


def leaves(fp: Column) -> Column:
    """All leaf hashes of a fingerprint, in order."""
    return F.regexp_extract_all(fp, F.lit(rf"(?<=[=.])[0-9a-f]{{{SHORT}}}"), F.lit(0))


def paragraphs(fp: Column) -> Column:
    """The paragraph branches (``hash=leaves``) of a fingerprint, in order."""
    return F.regexp_extract_all(fp, F.lit(r"[0-9a-f]+=[0-9a-f.]*"), F.lit(0))


def likeness_of(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """Dice coefficient of two sets of distinct leaves; 1 for equal roots."""
    total = F.size(leaves_a) + F.size(leaves_b)
    common = F.size(F.array_intersect(leaves_a, leaves_b))
    return (F.when(root_a == root_b, 1.0).when(total == 0, 0.0)
            .otherwise(F.lit(2.0) * common / total))


def likeness(a: Column, b: Column) -> Column:
    """Likeness (0 to 1) of two fingerprints."""
    return likeness_of(root(a), F.array_distinct(leaves(a)), root(b), F.array_distinct(leaves(b)))


def edits(a: Column, b: Column) -> Column:
    """Distinct paragraph branches (``hash=leaves``) of ``a`` that ``b`` does not have."""
    return F.array_except(paragraphs(a), paragraphs(b))


def _group_of(id_: Column, bounds: list[int]) -> Column:
    """Number of bounds at or below ``id_``, by binary search in a literal array."""
    if not bounds:
        return F.lit(0)
    arr = F.array(*[F.lit(b) for b in bounds])
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda lo, step: F.when(
        (lo + step <= len(bounds)) & (F.get(arr, lo + step - 1) <= id_), lo + step).otherwise(lo))


def with_next(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, next_text``: the text of the next id in ascending order, cyclically.

    Ids are cut into ordered groups at approximate quantiles (at most 4,096
    literals), so the order is a window per group; the last document of a group
    takes the first one of the next group from a table with a row per group.
    Equal ids are ordered by their texts.
    """
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    n = base.count()
    groups = max(1, min(4096, n // GROUP))
    bounds = []
    if groups > 1:
        at = [i / groups for i in range(1, groups)]
        got = base.agg(F.percentile_approx("doc_id", at, 100_000)).first()[0]
        bounds = sorted(set(got or []))
    base = base.withColumn("group", _group_of(F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))), bounds))
    lows = (base.groupBy("group").agg(F.min(F.struct("doc_id")).alias("low"))
            .select("group", F.col("low.doc_id").alias("low_id")))
    ring = Window.orderBy("group")  # a row per group
    lows = lows.select(
        F.coalesce(F.lag("group").over(ring), F.max("group").over(Window.partitionBy())).alias("before"),
        F.col("group").alias("g"), "low_id")
    lows = cut(lows, "group-starts")
    first = (base.join(lows, (F.col("group") == F.col("g"))
                       & F.col("doc_id").eqNullSafe(F.col("low_id")))
             .groupBy("before").agg(F.min("text").alias("first_text")))
    first = cut(first, "group-first-texts")
    w = Window.partitionBy("group").orderBy("doc_id", "text")
    out = base.withColumn("following", F.lead("text").over(w))
    return (out.join(first, F.col("following").isNull() & (F.col("group") == F.col("before")), "left")
            .select("doc_id", "text", F.coalesce("following", "first_text").alias("next_text"), "group"))


def fingerprint_edits(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every text, of its edited form, and their likeness.

    Edited: the last ``floor(n_chars / 4)`` code points give way to the first as
    many of the next document.  Columns: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next, edited_at`` (the
    paragraph branches of the edited text that the text does not have).
    """
    t = with_next(docs, id_col=id_col, text_col=text_col)
    n = F.length("text")
    k = F.floor(n / 4).cast("int")
    t = t.withColumn("n_chars", n.cast("long")).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), n - k),
                           F.substring(F.col("next_text"), F.lit(1), k)))
    t = t.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "text", "edited", "next_text")
    fp = with_fingerprints(t, {"fingerprint": "text", "edited_fingerprint": "edited", "next_fingerprint": "next_text"})
    fp = fp.drop("text", "edited", "next_text").withColumns({
        f"leaves_{c}": F.array_distinct(leaves(F.col(f"{c}fingerprint"))) for c in ("", "edited_", "next_")})
    near = lambda c: likeness_of(root(F.col("fingerprint")), F.col("leaves_"),
                                 root(F.col(f"{c}fingerprint")), F.col(f"leaves_{c}"))
    return fp.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                     near("edited_").alias("near_edited"), near("next_").alias("near_next"),
                     edits(F.col("edited_fingerprint"), F.col("fingerprint")).alias("edited_at"))
