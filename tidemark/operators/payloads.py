"""Landed payloads decoded by their declared charset and kind, with what is broken told by position."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import strict_json

#: Charset names that responses declare, and Spark's names of these.
CHARSETS = {
    "utf-8": "UTF-8", "utf8": "UTF-8", "us-ascii": "US-ASCII", "ascii": "US-ASCII", "iso-8859-1": "ISO-8859-1", "latin-1": "ISO-8859-1", "latin1": "ISO-8859-1",
    "utf-16": "UTF-16", "utf-16le": "UTF-16LE", "utf-16be": "UTF-16BE",
}
KINDS = ("binary", "text", "json", "jsonl")


def declared_charset(content_type: Column) -> Column:
    """The charset of a response's media type, in lower case; UTF-8 where it names none."""
    told = F.regexp_extract(F.lower(F.coalesce(content_type, F.lit(""))), r"""charset\s*=\s*["']?([^"';\s]+)""", 1)
    return F.coalesce(F.nullif(told, F.lit("")), F.lit("utf-8"))


def _valid(content: Column, charset: str) -> Column:
    """May the bytes be decoded?  Spark's decoder raises on others, so that these are told apart first."""
    if charset == "ISO-8859-1":
        return F.lit(True)
    if charset == "UTF-8":
        return F.is_valid_utf8(content)
    hexed = F.hex(content)
    if charset == "US-ASCII":
        return ~hexed.rlike("^(..)*[89A-F].(..)*$")
    # pairs of units for characters beyond the first plane, and no half of one alone
    high, low = ("..D[89AB]", "..D[CDEF]") if charset == "UTF-16LE" else ("D[89AB]..", "D[CDEF]..")
    single = "..(?!D[89A-F]).." if charset == "UTF-16LE" else "(?!D[89A-F])...."
    big = hexed.rlike(f"^(?:{single}|{high}{low})*$")
    if charset == "UTF-16":
        little = hexed.rlike("^FFFE(?:..(?!D[89A-F])..|..D[89AB]..D[CDEF])*$")
        return F.when(hexed.startswith("FFFE"), little).otherwise(big)
    return big


def decoded_text(content: Column, charset: Column) -> Column:
    """The text of bytes in a charset that is itself a column; NULL where the charset is unknown or the bytes are not of it."""
    out = None
    for name, spark_name in CHARSETS.items():
        # decoded within the branch, so that broken bytes never reach the decoder
        text = F.when(_valid(content, spark_name), F.decode(content, spark_name))
        out = F.when(charset == name, text) if out is None else out.when(charset == name, text)
    return out


def decoded(df: DataFrame, content: str = "content", kind: str = "kind", charset: str = "charset") -> DataFrame:
    """What each payload holds: ``position`` (a line's number from 1 for jsonl, else 0), ``text``, ``document`` (VARIANT) and ``error``.

    binary: neither text nor document.  text: the text.  json: one document.  jsonl: one for each line that is not
    blank.  What cannot be decoded or parsed has ``error`` (``charset``, ``encoding``, ``json`` or ``kind``) and keeps the text there is, for
    the dead letters; the other lines of a payload go on.  A byte order mark is no part of a text.
    """
    names = [c for c in df.columns if c != content]
    lowered = F.lower(F.trim(F.col(charset)))
    text = F.regexp_replace(decoded_text(F.col(content), lowered), "^﻿", "")
    made = df.withColumn("__text", F.when(F.col(kind) != "binary", text))
    known, encoded = lowered.isin(*CHARSETS), F.col("__text").isNotNull()
    failure = F.when(~F.coalesce(F.col(kind).isin(*KINDS), F.lit(False)), "kind").when(F.col(kind) == "binary", None).when(F.col(content).isNull(), "encoding").when(~F.coalesce(known, F.lit(False)), "charset").when(~encoded, "encoding")
    whole = F.array(F.struct(F.lit(0).alias("position"), F.col("__text").alias("text")))
    lines = F.transform(F.split("__text", "\r?\n"), lambda line, i: F.struct((i + 1).alias("position"), line.alias("text")))
    units = F.when((F.col(kind) == "jsonl") & encoded, F.filter(lines, lambda x: F.trim(x["text"]) != "")).otherwise(whole)
    each = made.withColumn("__failure", failure).select(*names, content, "__failure", F.inline(units))
    document = F.when(F.col("__failure").isNull() & F.col(kind).isin("json", "jsonl"), strict_json(F.col("text")))
    malformed = F.when(F.col("__failure").isNull() & F.col(kind).isin("json", "jsonl") & document.isNull(), "json")
    return each.select(*names, content, "position", "text", document.alias("document"), F.coalesce("__failure", malformed).alias("error"))
