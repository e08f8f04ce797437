"""Record-level operators: JSON projection, tuple-text parsing, key/number lines,
row counting through an observation, and tuple-text formatting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def project_json(df: DataFrame, col: str, schema: T.StructType | str,
                 keep: Sequence[str] = (), rejects: bool = False) -> DataFrame:
    """Parse JSON text in ``col`` and return ``keep`` plus one column per field.

    Malformed text gives nulls (PERMISSIVE mode).  With ``rejects=True`` only
    the rows that did not parse (or are null) come back, ``keep`` and the raw
    text, so a caller can route them to a reject sink.
    """
    sch = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    probe = T.StructType(list(sch.fields) + [T.StructField("_tp_corrupt", T.StringType())])
    parsed = F.from_json(F.col(col), probe, {"columnNameOfCorruptRecord": "_tp_corrupt"})
    p = df.select(*keep, col, parsed.alias("_tp_j"))
    if rejects:
        return p.filter(F.col(col).isNull() | F.col("_tp_j._tp_corrupt").isNotNull()).select(*keep, col)
    return p.select(*keep, *[F.col(f"_tp_j.{f.name}").alias(f.name) for f in sch.fields])


def attach_json(df: DataFrame, col: str, keep: Sequence[str], out: str = "json",
                schema: T.DataType | str | None = None, rejects: bool = False) -> DataFrame:
    """Keep ``keep`` and attach the parsed object of ``col``.

    With a schema the object is a struct re-serialised compactly (``to_json``;
    a decimal field keeps its digits); without one it is a variant rendered back
    as text.  Text that does not parse gives null; with ``rejects=True`` only
    those rows come back, ``keep`` and the raw text.
    """
    variant = F.try_parse_json(F.col(col))
    if rejects:
        return df.filter(variant.isNull()).select(*keep, col)
    if schema is not None:
        sch = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        obj = F.when(variant.isNotNull(), F.to_json(F.from_json(F.col(col), sch)))
    else:
        obj = F.to_json(variant)
    return df.select(*keep, obj.alias(out))


def parse_tuples(df: DataFrame, col: str, names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """``(a,b,c)`` text to typed columns; a bad field gives null (``try_cast``)."""
    body = F.expr(f"substring({col}, 2, length({col}) - 2)")
    parts = F.split(body, ",")
    pieces = df.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(f"_tp_{n}")
                         for i, n in enumerate(names)])
    return pieces.select(*[F.expr(f"try_cast(_tp_{n} AS {t})").alias(n)
                           for n, t in zip(names, types)])


def parse_key_number(df: DataFrame, col: str, key: str = "key", number: str = "t") -> DataFrame:
    """``key,number`` lines to ``(key string, number long)``."""
    parts = F.split(F.col(col), ",")
    return df.select(F.try_element_at(parts, F.lit(1)).alias(key),
                     F.try_element_at(parts, F.lit(2)).try_cast("long").alias(number))


def counted(df: DataFrame, name: str = "num_lines") -> tuple[DataFrame, Observation]:
    """Identity that counts its rows; read ``obs.get[name]`` after an action.

    The count is computed inside the job that writes or collects ``df`` (like
    the reference's accumulator) and read on the driver afterwards; it is one
    number, no rows pass through the driver.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias(name)), obs


def tuple_text(cols: Sequence[str | Column]) -> Column:
    """``(a,b,c)``: text form of a tuple row; a null field prints ``null``."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    text = [F.coalesce(c.cast("string"), F.lit("null")) for c in cs]
    return F.concat(F.lit("("), F.concat_ws(",", *text), F.lit(")"))
