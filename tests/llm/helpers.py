"""Small fixtures that all operators of the subpackage are held against."""

from __future__ import annotations

#: null, empty and blank texts, ties, repeated rows, copies, a null id, a very long text
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\r\n ", "en", "a", 5),
    (4, "one word", "en", "a", 8),
    (5, "the same text as another document has here", "en", "a", 42),
    (6, "the same text as another document has here", "de", "b", 42),
    (6, "the same text as another document has here", "de", "b", 42),
    (7, "x" * 50_000, None, "b", 50_000),
    (8, "der die das und ist nicht " * 4000, "de", "b", 104_000),
    (9, "a  b c \u0085 d\x1ce\tf\n\n g \x0b h  ", "en", "c", 20),
    (10, "<|endoftext|> it's 12,5 \U0001f600 İstanbul K", "en", "c", 30),
    (None, "no id at all", "en", "c", 12),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


def clashing(docs):
    """The same documents with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = ["kept", "words", "score", "shard", "length", "label", "fingerprint", "node", "n", "row", "key", "text_hash", "pos", "hits", "lang_pred", "spans"]
    return docs.select("*", *[F.lit("clash").alias(x) for x in names])


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
