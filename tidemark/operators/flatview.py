"""Header-driven reshape of statistics documents.

A document is a JSON array of flat objects.  The first with ``V`` reading "valor"
(accents and case aside) is its header; all such rows go.  The other rows give a
value, attributes (keys other than ``V`` and ``Dn[CN]``) and dimensions (``DnC``
and ``DnN``, by number), each with the header's labels.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import folded, stripped

DIMENSION = r"^D(\d+)[CN]$"
#: What a dimension's label contains if it is the period, or the variable.
PERIOD_HINTS = ("ano", "periodo", "mes", "trimestre", "semestre")
VARIABLE_HINTS = ("variavel", "indicador")


def is_header(row: Column) -> Column:
    return F.coalesce(folded(stripped(F.try_element_at(row, F.lit("V")))) == "valor", F.lit(False))


def dimension_numbers(keys: Column) -> Column:
    """The numbers of the dimensions that the keys name, ascending."""
    named = F.filter(keys, lambda k: k.rlike(DIMENSION))
    return F.array_sort(F.array_distinct(F.transform(named, lambda k: F.regexp_extract(k, DIMENSION, 1).cast("int"))))


def aggregate_id(url: Column) -> Column:
    """The path segment after ``agregados``."""
    return F.nullif(F.regexp_extract(url, "/agregados/([^/?#]+)", 1), F.lit(""))


def flat_view(df: DataFrame, document: str = "document") -> DataFrame:
    """K7 and K8: a row per data row; a document without a header or without dimensions gives none.  Carries the other columns."""
    carried = [c for c in df.columns if c != document]
    rows = df.select(*carried, F.from_json(document, "array<map<string,string>>").alias("rows"))
    header = F.get(F.filter("rows", is_header), F.lit(0))
    each = rows.select(*carried, header.alias("header"), F.posexplode(F.filter("rows", lambda r: ~is_header(r))).alias("row_index", "row")).where("header IS NOT NULL")
    keys = F.array_distinct(F.concat(F.map_keys("header"), F.map_keys("row")))
    keyed = each.withColumn("keys", F.array_sort(keys)).withColumn("numbers", dimension_numbers(F.col("keys"))).where(F.size("numbers") > 0)
    text = lambda m, k: stripped(F.try_element_at(F.col(m), k))
    plain = F.filter("keys", lambda k: (k != "V") & ~k.rlike(DIMENSION))
    attributes = F.transform(plain, lambda k: F.struct(k.alias("key"), text("header", k).alias("label"), text("row", k).alias("value")))

    def dimension(i: Column) -> Column:
        code, name = (F.concat(F.lit("D"), i.cast("string"), F.lit(x)) for x in "CN")
        return F.struct(F.concat(F.lit("D"), i.cast("string")).alias("id"), i.alias("position"), text("row", code).alias("code"), text("row", name).alias("name"), text("header", code).alias("code_label"), text("header", name).alias("label"))

    shaped = keyed.select(*carried, "row_index", text("row", F.lit("V")).alias("value"), text("header", F.lit("V")).alias("value_label"), attributes.alias("attributes"), F.transform("numbers", dimension).alias("dimensions"))
    first = lambda hints: F.get(F.filter("dimensions", lambda d: folded(d["label"]).rlike("|".join(hints))), F.lit(0))
    return shaped.select(
        "*",
        F.size("attributes").alias("attribute_count"),
        F.size("dimensions").alias("dimension_count"),
        *[first(h)[part].alias(f"{what}_{part}") for what, h in (("period", PERIOD_HINTS), ("variable", VARIABLE_HINTS)) for part in ("code", "name")],
    )


def described(flat: DataFrame, by: Sequence[str]) -> DataFrame:
    """F8: the attribute keys, by name, and the dimension ids, by number, that occur, comma-joined."""
    # few ids in a group, however many rows; one aggregation, so that groups of NULL keys stay
    each = flat.select(*by, F.explode(F.concat(F.transform("attributes", lambda a: F.struct(a["key"].alias("k"), F.lit(None).cast("int").alias("p"))), F.transform("dimensions", lambda d: F.struct(F.lit(None).cast("string").alias("k"), d["position"].cast("int").alias("p"))), F.array(F.struct(F.lit(None).cast("string").alias("k"), F.lit(None).cast("int").alias("p"))))).alias("e"))
    ids = F.transform(F.array_sort(F.collect_set("e.p")), lambda p: F.concat(F.lit("D"), p.cast("string")))
    return each.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_set("e.k")), ",").alias("attribute_keys"), F.array_join(ids, ",").alias("dimension_ids"))
