"""Records, nodes and entities of landed JSON documents.

Documents are VARIANT columns.  A walk expands some levels after each other within
the row, and goes on from the last of them while there is more below.  Order is
kept in ``position``, the array of list positions on the way to a node, which
sorts parents before their children.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.values import field, first_non_blank, meaningful
from tidemark.operators.increment import upsert
from tidemark.sources.scan import page_number
from tidemark.sources.shared import cut

#: The keys under which a response holds its records.
RECORD_KEYS = ("records", "items", "results", "data", "value")
#: Entity types, and the keys that hold a collection of each; the types' order has no meaning.
COLLECTIONS = {
    "dataset": ("datasets", "dataset", "packages", "package"),
    "organization": ("organizations", "organization", "organization_list"),
    "group": ("groups", "group", "group_list"),
    "resource": ("resources", "resource"),
}
#: Keys that hint at a type.
HINTS = {
    "dataset": ("resources", "organization", "groups", "metadata_created", "metadata_modified", "owner_org", "notes", "private"),
    "organization": ("packages", "dataset_count", "package_count", "image_url"),
    "group": ("packages", "dataset_count", "package_count"),
    "resource": ("format", "mimetype", "download_url", "url_type", "resource_type"),
}
#: The order in which types win ties, by what the catalog lists.
PRIORITY = {
    "metadata_catalog": ("dataset", "organization", "group", "resource"),
    "resource_catalog": ("resource", "dataset", "organization", "group"),
}
#: Keys of wrappers around a payload, and of its generic collections.
WRAPPERS = ("result", "data", "payload", "response", "value")
GENERIC = ("results", "items")
#: Keys of an entity's id and name.
ID_KEYS = ("id", "identifier", "name", "slug", "guid", "uri", "url")
NAME_KEYS = ("name", "display_name", "label", "title")
#: Fixed value: the records of a collection that tell its type.
FIRST_RECORDS = 5
#: Levels that a walk expands in one pass.
DEPTH = 8
#: Wrappers within each other that are looked through.
WRAPPED = 3
ROOT = "struct<path:string,rank:array<int>,data:variant>"


def parsed(df: DataFrame, text: str, to: str = "document") -> DataFrame:
    """The text as a VARIANT, NULL where it is malformed."""
    return df.withColumn(to, F.try_parse_json(F.col(text)))


def kind_of(v: Column) -> Column:
    """``object``, ``array`` or ``scalar``; NULL for no value."""
    shape = F.schema_of_variant(v)
    return F.when(shape.startswith("OBJECT"), "object").when(shape.startswith("ARRAY"), "array").when(v.isNotNull(), "scalar")


def _list(v: Column, key: str) -> Column:
    return F.try_variant_get(v, f'$["{key}"]', "array<variant>")


def _items(v: Column) -> Column:
    return F.when(kind_of(v) == "array", F.try_variant_get(v, "$", "array<variant>"))


def records(df: DataFrame, document: str = "document", transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Through ``transform``, the records of each response: a list's items; an object's first list among the usual keys, else the object; nothing for scalars."""
    v = F.col(document)
    lists = F.coalesce(_items(v), *[_list(v, k) for k in RECORD_KEYS])
    whole = F.when(kind_of(v) == "object", F.array(v))
    others = [c for c in df.columns if c != document]
    return transform(df.select(*others, F.posexplode(F.coalesce(lists, whole)).alias("record_index", "record")))


def coerced(df: DataFrame, value: str = "value") -> DataFrame:
    """K9: an object is one record; a list's objects are records, its scalars become {name, value}, its nulls go."""
    others = [c for c in df.columns if c != value]
    return df.select(*others, F.posexplode(coerced_records(F.col(value))).alias("record_index", "record"))


def _is_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", "map<string,variant>").isNotNull()


def coerced_records(v: Column) -> Column:
    """K9 within the row: the records that a value holds, as an array; none for a scalar or no value."""
    items = F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.when(_is_object(v), F.array(v)), F.array().cast("array<variant>"))

    def record(x):
        plain = F.to_json(F.struct(F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)).alias("x")))
        named = F.parse_json(F.concat(F.lit('{"name":'), plain.substr(F.lit(6), F.length(plain) - 6), F.lit(',"value":'), F.to_json(x), F.lit("}")))
        return F.when(_is_object(x), x).otherwise(named)

    return F.transform(F.filter(items, lambda x: x.isNotNull() & ~F.is_variant_null(x)), record)


#: The objects in the list-valued fields of the nodes in a column, as nodes of the next level; SQL, as it takes long to build by calls.
_CHILDREN = """flatten(transform({above}, n -> flatten(filter(transform(map_entries(try_variant_get(n.data, '$', 'map<string,variant>')), e ->
transform(filter(transform(try_variant_get(e.value, '$', 'array<variant>'), (x, i) -> named_struct('at', i, 'data', x)), x -> try_variant_get(x.data, '$', 'map<string,variant>') IS NOT NULL), x -> named_struct(
'parent_path', n.path, 'collection_path', concat(n.path, '.', e.key), 'path', concat(n.path, '.', e.key, '[', CAST(x.at AS STRING), ']'),
'position', concat(n.position, array(concat(lpad(CAST(length(e.key) AS STRING), 6, '0'), e.key, '/', lpad(CAST(x.at AS STRING), 9, '0')))), 'data', x.data, 'level', {level}))), c -> c IS NOT NULL))))"""


def expanded(nodes: DataFrame, carried: Sequence[str], top: int, depth: int, below: bool = False) -> DataFrame:
    """``nodes`` and all in the ``depth`` - 1 levels under them; ``below``: those of the level after these only.

    Levels are columns of a row, each made once, of the one before it, with no join,
    so that a pass is one scan of the documents.
    """
    each = nodes.select(*carried, F.array(F.struct("parent_path", "collection_path", "path", "position", "data", F.lit(top).alias("level"))).alias("__0"))
    for i in range(1, depth + below):
        each = each.select("*", F.expr(_CHILDREN.format(above=f"__{i - 1}", level=top + i)).alias(f"__{i}"))
    # outer, as for others the optimizer adds a filter that makes the array a second time
    made = each.select(*carried, F.inline_outer(f"__{depth}" if below else F.concat(*[f"__{i}" for i in range(depth)])))
    return made.where("path IS NOT NULL") if below else made


def may_go_below(v: Column, depth: int) -> Column:
    """Whether a document may have a level ``depth``: not if its type names fewer lists and leaves nothing open."""
    shape = F.schema_of_variant(v)
    return shape.contains("VARIANT") | (F.regexp_count(shape, F.lit("ARRAY<")) >= depth)


def walk(df: DataFrame, document: str = "document", depth: int = DEPTH) -> DataFrame:
    """K1: every object of each document, depth first by sorted keys: itself and the objects in its lists, not those in its object fields.

    Carries the other columns, with ``parent_path`` (NULL for a root),
    ``collection_path``, ``path``, ``position``, ``level`` and ``data``.

    The documents are written to the checkpoint folder, so that they are made once.
    ``depth`` levels are expanded in one pass over them, within the row.  The nodes
    below these, if any, are written there, too, and walked on from there, so that
    all are found, however deep; documents whose type shows that they are no deeper are not looked at for more.
    """
    df = cut(df)
    carried = [c for c in df.columns if c != document]
    v = F.col(document)
    roots = df.where(kind_of(v) == "object").select(*carried, F.lit(None).cast("string").alias("parent_path"), F.lit("payload").alias("collection_path"), F.lit("payload").alias("path"), F.array().cast("array<string>").alias("position"), v.alias("data"))
    tops = df.where(kind_of(v) == "array").select(*carried, F.posexplode(F.try_variant_get(v, "$", "array<variant>")).alias("at", "data")).where(kind_of(F.col("data")) == "object")
    roots = roots.unionByName(tops.select(*carried, F.lit(None).cast("string").alias("parent_path"), F.lit("payload").alias("collection_path"), F.concat(F.lit("payload["), F.col("at").cast("string"), F.lit("]")).alias("path"), F.array(F.lpad(F.col("at").cast("string"), 9, "0")).alias("position"), "data"))
    nodes, found, top = roots, [], 0
    while True:
        found.append(expanded(nodes, carried, top, depth))
        below = cut(expanded(nodes.where(may_go_below(F.col("data"), depth)), carried, top, depth, below=True))
        top += depth
        if below.isEmpty():
            return reduce(DataFrame.unionByName, found)
        nodes = below


def signals(data: Column, kind: str) -> Column:
    """The hint keys of a type that hold something meaningful, in their order."""
    present = [F.when(meaningful(F.try_variant_get(data, f'$["{k}"]', "variant")), F.lit(k)) for k in HINTS[kind]]
    return F.array_compact(F.array(*present))


def classify(nodes: DataFrame, variant: str = "metadata_catalog", parent_type: str | None = None) -> DataFrame:
    """K4 and K5 per node: ``entity_type``, ``confidence`` and ``signals``.

    ``parent_type`` names a column with the parent's type: resources are in
    datasets, datasets in organizations and groups.  Else the type with most
    signals wins, ties by priority; no signal: unknown.
    """
    data, order = F.col("data"), PRIORITY[variant]
    parent = F.col(parent_type) if parent_type else F.lit(None).cast("string")
    found = {k: signals(data, k) for k in order}
    with_all = nodes.select("*", F.array(*[F.struct(F.size(found[k]).alias("n"), F.lit(-i).alias("rank"), F.lit(k).alias("kind"), found[k].alias("signals")) for i, k in enumerate(order)]).alias("__scores"))
    best = F.array_max("__scores")
    of = lambda kind: F.get(F.filter("__scores", lambda s: s["kind"] == kind), F.lit(0))["signals"]
    given = F.when(parent == "dataset", of("resource")).when(parent.isin("organization", "group"), of("dataset"))
    kind = F.when(parent == "dataset", "resource").when(parent.isin("organization", "group"), "dataset").when(best["n"] == 0, "unknown").otherwise(best["kind"])
    shown = F.when(given.isNotNull(), F.when(F.size(given) > 0, given).otherwise(F.array(F.concat(F.lit("parent:"), parent)))).otherwise(F.when(best["n"] == 0, F.array().cast("array<string>")).otherwise(best["signals"]))
    score = F.coalesce(F.size(given), best["n"])
    sure = F.when(score >= 2, "high").when(given.isNotNull() | (score == 1), "heuristic").otherwise("low")
    return with_all.select(*nodes.columns, kind.alias("entity_type"), sure.alias("confidence"), shown.alias("signals"))


def batch_kind(items: Column, order: Sequence[str], parent: Column) -> Column:
    """K4 for a collection of no kind: by its parent's type, else the type with most hints in its first records, ties by priority; without any hint the first."""
    first = F.slice(items, 1, FIRST_RECORDS)
    score = lambda kind: F.aggregate(F.transform(first, lambda x: F.size(signals(x, kind))), F.lit(0), lambda n, x: n + x)
    best = F.array_max(F.array(*[F.named_struct(F.lit("n"), score(k), F.lit("rank"), F.lit(-i), F.lit("kind"), F.lit(k)) for i, k in enumerate(order)]))
    return F.when(parent == "dataset", "resource").when(parent.isin("organization", "group"), "dataset").otherwise(best["kind"])


def identity(df: DataFrame, data: str = "record", path: str = "path") -> DataFrame:
    """``entity_id``, ``entity_name`` and ``entity_key`` (id, else name, else path)."""
    v = F.col(data)
    ident, name = first_non_blank(*[field(v, k) for k in ID_KEYS]), first_non_blank(*[field(v, k) for k in NAME_KEYS])
    return df.select("*", ident.alias("entity_id"), name.alias("entity_name"), F.coalesce(ident, name, F.col(path)).alias("entity_key"))


def _let(value: Column, then) -> Column:
    """``then(value)``, where ``value`` is evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def held(v: Column, order: Sequence[str]) -> Column:
    """K2: the collections of an object as an array of (kind, key, items): each type's first alias that holds records, else a generic collection of no kind."""
    typed = [(kind, key) for kind in order for key in COLLECTIONS[kind]]
    generic = [(None, key) for key in GENERIC]
    pairs = F.array(*[F.struct(F.lit(kind).cast("string").alias("kind"), F.lit(key).alias("key")) for kind, key in typed + generic])

    def of(fields):
        each = F.transform(pairs, lambda p: F.struct(p["kind"].alias("kind"), p["key"].alias("key"), coerced_records(F.try_element_at(fields, p["key"])).alias("items")))
        return _let(F.filter(each, lambda x: F.size(x["items"]) > 0), chosen)

    def chosen(full):
        first = F.filter(F.transform(F.array(*map(F.lit, order)), lambda k: F.get(F.filter(full, lambda x: x["kind"] == k), F.lit(0))), lambda x: x.isNotNull())
        return F.when(F.size(first) > 0, first).otherwise(F.slice(full, 1, 1))

    return F.coalesce(_let(F.try_variant_get(v, "$", "map<string,variant>"), of), F.slice(of(F.lit(None).cast("map<string,variant>")), 1, 0))


def _inside(v: Column, order: Sequence[str]) -> Column:
    """K3: a record's collections; if it has none itself, those of the objects in its wrappers, all of them."""
    at = lambda prefix: lambda x: F.struct(x["kind"].alias("kind"), F.concat(F.lit("."), prefix, x["key"]).alias("at"), x["items"].alias("items"))
    wrapped = lambda: F.flatten(F.transform(F.array(*map(F.lit, WRAPPERS)), lambda w: F.transform(held(F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), w), order), at(F.concat(w, F.lit("."))))))
    return _let(held(v, order), lambda own: F.when(F.size(own) > 0, F.transform(own, at(F.lit("")))).otherwise(wrapped()))


def unwrapped(document: Column, variant: str = "metadata_catalog") -> Column:
    """K2: (path, data) of the object that holds the collections: the document, or what its wrappers hold, ``WRAPPED`` deep.

    The document itself if no wrapper leads to a collection; a document with more
    wrappers within each other is refused with an error.
    """
    order = PRIORITY[variant]

    def inner(c):
        fields = F.try_variant_get(c["data"], "$", "map<string,variant>")
        made = [F.struct(F.concat(c["path"], F.lit("." + w)).alias("path"), F.concat(c["rank"], F.array(F.lit(i))).alias("rank"), F.try_element_at(fields, F.lit(w)).alias("data")) for i, w in enumerate(WRAPPERS)]
        return F.filter(F.array(*made), lambda x: _is_object(x["data"]))

    root = F.struct(F.lit("payload").alias("path"), F.array().cast("array<int>").alias("rank"), document.alias("data"))

    def grown(levels: list[Column]) -> Column:
        if len(levels) <= WRAPPED + 1:
            return _let(F.flatten(F.transform(levels[-1], inner)), lambda x: grown([*levels, x]))
        # a wrapper's own collections come before those of the wrappers in it
        there = F.filter(F.concat(*levels[:-1]), lambda c: F.size(held(c["data"], order)) > 0)
        first = _let(there, lambda t: F.get(F.filter(t, lambda c: c["rank"] == F.array_min(F.transform(t, lambda x: x["rank"]))), F.lit(0)))
        deeper = F.when(F.size(levels[-1]) > 0, F.raise_error(F.lit(f"wrappers more than {WRAPPED} deep")).cast(ROOT)).otherwise(F.get(levels[0], F.lit(0)))
        return F.coalesce(first, deeper)

    return _let(grown([F.array(root)]), lambda c: F.struct(c["path"].alias("path"), c["data"].alias("data")))


def batches(df: DataFrame, data: str, path: str, variant: str = "metadata_catalog", parent_type: str | None = None) -> DataFrame:
    """K2, K3: the typed records in an object's collections; an object in place of a list is one record, scalars are named.

    A record's wrappers are looked into, one deep.  Without a parent, an object
    that has no collection, or a list, stands for its own records.  A generic
    collection has one type, that of ``batch_kind``.
    """
    v, order = F.col(data), PRIORITY[variant]
    itself = F.filter(F.array(F.struct(F.lit(None).cast("string").alias("kind"), F.lit("").alias("at"), coerced_records(v).alias("items"))), lambda x: F.coalesce(F.size(F.try_variant_get(v, "$", "map<string,variant>")), F.lit(1)) > 0)
    chosen = _inside(v, order)
    if parent_type:
        chosen = _let(chosen, lambda c: F.when((F.size(c) > 0) | F.col(parent_type).isNotNull(), c).otherwise(itself))
    others = [c for c in df.columns if c not in (data, path)]
    each = df.select(*others, F.col(path).alias("parent_path"), F.posexplode(chosen).alias("batch", "b"))
    parent = F.col(parent_type) if parent_type else F.lit(None).cast("string")
    kind = F.coalesce("b.kind", batch_kind(F.col("b.items"), order, parent))
    items = each.select(*others, "parent_path", "batch", kind.alias("entity_type"), F.concat("parent_path", "b.at").alias("collection_path"), F.posexplode("b.items").alias("at", "data"))
    return items.select(*others, "parent_path", "collection_path", "batch", "at", F.concat("collection_path", F.lit("["), F.col("at").cast("string"), F.lit("]")).alias("path"), "data", "entity_type")


def entity_tree(df: DataFrame, document: str = "document", variant: str = "metadata_catalog", levels: int | None = None, transform: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The entities of each document, level by level, with their parents.

    ``transform`` sees each level's records (entity_type, data, path) before they
    are named.  Without ``levels`` it goes on until a level has no entity; every level is then
    written to the checkpoint folder, as the next one is made of it.

    Carries the other columns, with entity_type, entity_key, entity_id,
    parent_entity_type, parent_entity_key, parent_entity_id, collection_path,
    record_path, level, position and payload (canonical JSON).
    """
    carried = [c for c in df.columns if c != document]
    top = df.select(*carried, F.lit(None).cast("string").alias("parent_entity_type"), F.lit(None).cast("string").alias("parent_entity_key"), F.lit(None).cast("string").alias("parent_entity_id"), F.array().cast("array<string>").alias("before"), unwrapped(F.col(document), variant).alias("root"))
    top = top.select(*[c for c in top.columns if c != "root"], "root.data", "root.path")
    out, above, level = [], top, 0
    while levels is None or level < levels:
        found = transform(batches(above, "data", "path", variant, "parent_entity_type"))
        step = F.concat(F.col("batch").cast("string"), F.lit("/"), F.lpad(F.col("at").cast("string"), 9, "0"))
        named = identity(found.withColumn("position", F.concat("before", F.array(step))), "data", "path")
        if levels is None:
            named = cut(named)
            if out and named.isEmpty():
                break
        out.append(named.select(*carried, "entity_type", "entity_key", "entity_id", "parent_entity_type", "parent_entity_key", "parent_entity_id", "collection_path", F.col("path").alias("record_path"), F.lit(level).alias("level"), "position", F.to_json("data").alias("payload")))
        level += 1
        above = named.select(*carried, F.col("entity_type").alias("parent_entity_type"), F.col("entity_key").alias("parent_entity_key"), F.col("entity_id").alias("parent_entity_id"), F.col("position").alias("before"), "data", "path")
    return reduce(DataFrame.unionByName, out)


#: The columns of a catalog row, in order.
CATALOG_ROW = (
    "entity_type", "entity_key", "entity_id", "parent_entity_type", "parent_entity_key", "parent_entity_id", "catalog_collection_path", "catalog_record_path",
    "catalog_request_url", "catalog_request_index", "catalog_page_number", "catalog_offset", "catalog_cursor", "catalog_received_at", "catalog_raw_artifact_path", "payload",
)


def catalog_rows(entities: DataFrame) -> DataFrame:
    """``entity_tree``'s entities as catalog rows of 16 columns.

    What tells of the request (request_url, request_index, page_number, offset,
    cursor, received_at, raw_artifact_path) is taken from the columns that the tree carried; NULL where it
    has none.  A received instant is ISO text.
    """
    kinds = {"request_index": "bigint", "page_number": "bigint", "offset": "bigint"}
    here = set(entities.columns)

    def value(name: str) -> Column:
        plain = name.removeprefix("catalog_")
        if plain == "received_at" and plain in here:
            return F.date_format(F.to_utc_timestamp(plain, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
        return F.col(plain).cast(kinds.get(plain, "string")) if plain in here else F.lit(None).cast(kinds.get(plain, "string"))

    return entities.select(*[value(name).alias(name) for name in CATALOG_ROW])


def merged(entities: DataFrame, order: Sequence[str], keys: Sequence[str] = ("entity_type", "entity_key")) -> DataFrame:
    """Of entities that several pages have, the first in ``order`` (request, page, position).

    An aggregation by key that carries the order's columns along, so that pages can
    come in any sequence and nothing is sorted as a whole.
    """
    return upsert(entities, keys, [F.col(o) for o in order])


def replayed(landed: DataFrame, variant: str = "metadata_catalog", levels: int | None = 1) -> DataFrame:
    """The entities of landed pages (request_index, artifact, text), as the run that landed them had them: merged by request, page number and position."""
    pages = parsed(landed.withColumn("page_number", page_number(F.col("artifact"))), "text").drop("text", "artifact")
    return merged(entity_tree(pages, variant=variant, levels=levels), ["request_index", "page_number", "position"])


def edges(entities: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """K6: what contains what, each pair once."""
    return entities.where("parent_entity_key IS NOT NULL").select(*carried, F.col("parent_entity_key").alias("parent_node_key"), F.col("entity_key").alias("child_node_key"), F.lit("contains").alias("relationship_type")).distinct()


def nodes(entities: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """K6, E5: one node for each (type, key) in a document, with the path of its parent."""
    first = entities.groupBy(*carried, "entity_type", "entity_key").agg(F.min_by(F.struct("record_path", "parent_entity_type", "parent_entity_key", F.sha2("payload", 256).alias("payload_hash")), "position").alias("n"))
    # a node answers for its own key and asks for its parent's: the entities are made once, not for each side of a join
    node = F.struct("entity_type", F.col("entity_key").alias("node_key"), F.col("n.record_path").alias("node_path"), F.col("n.parent_entity_type").alias("parent_type"), F.col("n.parent_entity_key").alias("parent_node_key"), F.col("n.payload_hash").alias("payload_hash"))
    each = first.select(*carried, node.alias("node"))
    none = F.lit(None).cast(each.schema["node"].dataType)
    answer = F.struct(F.col("node.entity_type").alias("type"), F.col("node.node_key").alias("key"), F.col("node.node_path").alias("at"), none.alias("node"))
    ask = F.struct(F.col("node.parent_type").alias("type"), F.col("node.parent_node_key").alias("key"), F.lit(None).cast("string").alias("at"), F.col("node").alias("node"))
    both = each.select(*carried, F.inline(F.array(answer, ask)))
    # a NULL equals nothing, as in a join
    known = reduce(Column.__and__, [F.col(c).isNotNull() for c in (*carried, "type", "key")])
    told = both.withColumn("parent_node_path", F.when(known, F.max("at").over(Window.partitionBy(*carried, "type", "key")))).where("node IS NOT NULL")
    return told.select(*carried, "node.parent_type", "node.parent_node_key", "node.entity_type", "node.node_key", "node.node_path", "node.payload_hash", "parent_node_path")


def parse_summary(classified: DataFrame, by: Sequence[str], parsed_documents: DataFrame | None = None) -> DataFrame:
    """nodes, roots, classified and unknown nodes, warnings (one for each unknown node) and the status of each document's parse.

    Documents without a node, of those given, are ``empty``.
    """
    counts = classified.groupBy(*by).agg(F.count(F.lit(1)).alias("n_nodes"), F.count_if(F.col("parent_path").isNull()).alias("n_roots"), F.count_if(F.col("parent_path").isNotNull()).alias("n_edges"), F.count_if(F.col("entity_type") != "unknown").alias("n_classified"), F.count_if(F.col("entity_type") == "unknown").alias("n_unknown"))
    counts = counts.withColumn("n_warnings", F.col("n_unknown"))
    if parsed_documents is not None:
        every = parsed_documents.select(*[F.col(b).alias(f"__{b}") for b in by]).distinct()
        same = reduce(Column.__and__, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by])
        numbers = [c for c in counts.columns if c not in by]
        counts = every.join(counts, same, "left").select(*[F.col(f"__{b}").alias(b) for b in by], *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers])
    status = F.when(F.col("n_nodes") == 0, "empty").when(F.col("n_classified") == 0, "ambiguous").when(F.col("n_unknown") > 0, "parsed_with_warnings").otherwise("parsed")
    return counts.withColumn("status", status)
