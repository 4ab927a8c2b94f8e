"""Queries on landed documents: records, nodes, entities and statistics views built from the tables and walked back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.values import canonical_json, field, first_non_blank, folded, metadata
from tidemark.operators import documents, flatview, requests
from tidemark.plans.common import table


#: Event ids that one document of a user's response spans.
SPAN = 100_000


def wrapped_events(spark, sf):
    """A response for each user: the events' properties as records, in one of three envelopes.

    A response of more than ``SPAN`` ids goes on in further documents, so that none outgrows a cell;
    ``before`` tells how many records of the user the documents before it have.
    """
    events = table(spark, sf, "events").withColumn("page", F.expr(f"event_id DIV {SPAN}"))
    items = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("event_id", "props"))), lambda e: F.concat(F.lit('{"id":'), e["event_id"].cast("string"), F.lit(',"props":'), e["props"], F.lit("}"))), ",")
    pages = events.groupBy("user_id", "page").agg(items.alias("items"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("user_id").orderBy("page").rowsBetween(Window.unboundedPreceding, -1)
    by_user = pages.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    array = F.concat(F.lit("["), "items", F.lit("]"))
    text = F.when(F.col("user_id") % 3 == 0, array).when(F.col("user_id") % 3 == 1, F.concat(F.lit('{"count":1,"records":'), array, F.lit("}"))).otherwise(F.concat(F.lit('{"data":'), array, F.lit(',"next":null}')))
    return documents.parsed(by_user.select("user_id", "before", text.alias("text")), "text").drop("text")


def _place():
    """A record's place in the whole response of its user."""
    return (F.col("before") + F.col("record_index")).cast("int").alias("record_index")


def document_records(spark, sf):
    each = documents.records(wrapped_events(spark, sf))
    return each.select("user_id", _place(), field(F.col("record"), "id", "bigint").alias("event_id"), field(F.col("record"), "props.k", "bigint").alias("k"))


RECORDS_SQL = """SELECT user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS INTEGER) AS record_index, event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"""


def transform_hooks(spark, sf):
    """Records that a hook has filtered before they are used: those of the even keys."""
    even = lambda df: df.where(field(F.col("record"), "id", "bigint") % 2 == 0)
    each = documents.records(wrapped_events(spark, sf), transform=even)
    return each.select("user_id", _place(), field(F.col("record"), "id", "bigint").alias("event_id"))


HOOKS_SQL = f"SELECT user_id, record_index, event_id FROM ({RECORDS_SQL}) WHERE event_id % 2 = 0"


def first_non_blank_query(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", first_non_blank(F.nullif("source", F.lit("src0")), F.when(F.col("doc_id") % 4 == 0, F.lit("  ")).otherwise(F.col("lang")), F.col("doc_id")).alias("name"))


NON_BLANK_SQL = "SELECT doc_id, CASE WHEN source != 'src0' THEN source WHEN doc_id % 4 != 0 THEN lang ELSE CAST(doc_id AS VARCHAR) END AS name FROM documents"


def catalogs(spark, sf):
    """Catalog pages, of at most a thousand customers of a nation as datasets, with their orders as resources, wrapped."""
    orders = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("r"), F.col("o_orderkey").cast("string")).alias("id"), F.col("o_orderpriority").alias("format"), F.col("o_orderstatus").alias("url_type")))).alias("resources"))
    customers = table(spark, sf, "customer").join(orders, "c_custkey", "left").withColumn("page", F.expr("c_custkey DIV 1000"))
    # a number of its own keeps the partitions apart: pages are small, but it takes long to walk them
    spread = customers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_nationkey", "page")
    sets = spread.groupBy("c_nationkey", "page").agg(F.array_sort(F.collect_list(F.struct(F.concat(F.lit("d"), F.col("c_custkey").cast("string")).alias("id"), F.col("c_name").alias("title"), "resources"))).alias("datasets"))
    body = F.struct(F.lit(True).alias("success"), F.struct(F.size("datasets").alias("count"), "datasets").alias("result"))
    return documents.parsed(sets.select("c_nationkey", "page", F.to_json(body).alias("text")), "text").drop("text")


def entity_tree(spark, sf):
    tree = documents.entity_tree(catalogs(spark, sf), levels=2)
    return tree.select("c_nationkey", "page", "position", F.sha2("payload", 256).alias("payload_hash"), "entity_type", "entity_key", "entity_id", "parent_entity_type", "parent_entity_key", "record_path", "level")


_SETS = "SELECT *, c_custkey // 1000 AS page, row_number() OVER (PARTITION BY c_nationkey, c_custkey // 1000 ORDER BY 'd' || c_custkey) - 1 AS i FROM customer"
_RESOURCES = f"SELECT c_nationkey, page, c_custkey, i, o_orderkey, o_orderpriority, o_orderstatus, row_number() OVER (PARTITION BY o_custkey ORDER BY 'r' || o_orderkey) - 1 AS j FROM ({_SETS}) JOIN orders ON o_custkey = c_custkey"
_LEAF = """'{"format":"' || o_orderpriority || '","id":"r' || o_orderkey || '","url_type":"' || o_orderstatus || '"}'"""
_STEP = "'0/' || lpad(CAST({} AS VARCHAR), 9, '0')"
TREE_SQL = f"""WITH r AS ({_RESOURCES}), leaves AS (SELECT c_custkey, string_agg({_LEAF}, ',' ORDER BY j) AS all FROM r GROUP BY 1)
SELECT c_nationkey, page, [{_STEP.format('i')}] AS position, sha256('{{"id":"d' || c_custkey || '"' || coalesce(',"resources":[' || leaves.all || ']', '') || ',"title":"' || c_name || '"}}') AS payload_hash,
'dataset' AS entity_type, 'd' || c_custkey AS entity_key, 'd' || c_custkey AS entity_id, NULL AS parent_entity_type, NULL AS parent_entity_key, 'payload.result.datasets[' || i || ']' AS record_path, 0 AS level FROM ({_SETS}) LEFT JOIN leaves USING (c_custkey)
UNION ALL SELECT c_nationkey, page, [{_STEP.format('i')}, {_STEP.format('j')}], sha256({_LEAF}), 'resource', 'r' || o_orderkey, 'r' || o_orderkey, 'dataset', 'd' || c_custkey, 'payload.result.datasets[' || i || '].resources[' || j || ']', 1 FROM r"""


def catalog_rows(spark, sf):
    """The catalogs' entities as rows of a catalog table, with the request of each page."""
    pages = catalogs(spark, sf).withColumns({"request_url": F.concat(F.lit("https://data.example.org/api?nation="), "c_nationkey"), "request_index": F.col("page") + 1, "page_number": F.col("page"), "offset": F.col("page") * 1000, "received_at": F.timestamp_seconds(1704067200 + F.col("page"))})
    rows = documents.catalog_rows(documents.entity_tree(pages, levels=2))
    return rows.withColumn("payload", F.sha2("payload", 256))


ROWS_SQL = f"""SELECT entity_type, entity_key, entity_id, parent_entity_type, parent_entity_key, parent_entity_key AS parent_entity_id, regexp_replace(record_path, '\\[[0-9]+\\]$', '') AS catalog_collection_path, record_path AS catalog_record_path,
'https://data.example.org/api?nation=' || c_nationkey AS catalog_request_url, CAST(page + 1 AS BIGINT) AS catalog_request_index, CAST(page AS BIGINT) AS catalog_page_number, CAST(page * 1000 AS BIGINT) AS catalog_offset, NULL AS catalog_cursor,
strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(page), '%Y-%m-%dT%H:%M:%S+00:00') AS catalog_received_at, NULL AS catalog_raw_artifact_path, payload_hash AS payload FROM ({TREE_SQL})"""


def generic_batches(spark, sf):
    """Collections of no kind, of a thousand event ids of a user each: their type is that of the first five records; other events give no hint."""
    events = table(spark, sf, "events").withColumn("page", F.expr("event_id DIV 1000"))
    mime = F.when(F.col("event_type") == "click", ',"mimetype":"a/b","format":"csv"').when(F.col("event_type") == "view", ',"notes":"n"').otherwise("")
    item = F.struct("event_id", F.concat(F.lit('{"id":"e'), F.col("event_id").cast("string"), F.lit('"'), mime, F.lit("}")).alias("text"))
    made = events.groupBy("user_id", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)), lambda e: e["text"]), ",").alias("items"))
    pages = documents.parsed(made.select("user_id", "page", F.concat(F.lit('{"results":['), "items", F.lit("]}")).alias("text")), "text").drop("text")
    tree = documents.entity_tree(pages, levels=1)
    return tree.groupBy("user_id", "page", "entity_type").agg(F.count(F.lit(1)).alias("n_entities"))


GENERIC_SQL = """WITH e AS (SELECT user_id, event_id // 1000 AS page, event_type, row_number() OVER (PARTITION BY user_id, event_id // 1000 ORDER BY event_id) AS i FROM events),
s AS (SELECT user_id, page, count(*) AS n_entities, coalesce(sum(2) FILTER (event_type = 'click' AND i <= 5), 0) AS resource, coalesce(sum(1) FILTER (event_type = 'view' AND i <= 5), 0) AS dataset FROM e GROUP BY 1, 2)
SELECT user_id, page, CASE WHEN resource > dataset THEN 'resource' ELSE 'dataset' END AS entity_type, n_entities FROM s"""


def entity_counts(spark, sf):
    tree = documents.entity_tree(catalogs(spark, sf), levels=2)
    return tree.groupBy("entity_type").agg(F.count(F.lit(1)).alias("n_entities"))


COUNTS_SQL = f"SELECT entity_type, count(*) AS n_entities FROM ({TREE_SQL}) GROUP BY 1"


def catalog_edges(spark, sf):
    return documents.edges(documents.entity_tree(catalogs(spark, sf), levels=2), ["c_nationkey", "page"])


EDGES_SQL = f"SELECT c_nationkey, page, parent_entity_key AS parent_node_key, entity_key AS child_node_key, 'contains' AS relationship_type FROM ({TREE_SQL}) WHERE level = 1"


def catalog_nodes(spark, sf):
    found = documents.nodes(documents.entity_tree(catalogs(spark, sf), levels=2), ["c_nationkey", "page"])
    return found.select("c_nationkey", "page", "entity_type", "node_key", "node_path", "parent_node_key", "parent_node_path")


NODES_SQL = f"SELECT c_nationkey, page, entity_type, entity_key AS node_key, record_path AS node_path, parent_entity_key AS parent_node_key, CASE WHEN level = 1 THEN regexp_replace(record_path, '\\.resources.*$', '') END AS parent_node_path FROM ({TREE_SQL})"


def trees(spark, sf):
    """The catalogs' inner objects, as documents of their own."""
    return catalogs(spark, sf).withColumn("document", F.try_variant_get("document", "$.result", "variant"))


def walk_nodes(spark, sf):
    return documents.walk(trees(spark, sf), depth=4).select("c_nationkey", "page", "path", "collection_path", "parent_path", "level", "position")


_AT = "'{:06d}{}/' || lpad(CAST({} AS VARCHAR), 9, '0')"
WALK_SQL = f"""SELECT DISTINCT c_nationkey, c_custkey // 1000 AS page, 'payload' AS path, 'payload' AS collection_path, NULL AS parent_path, 0 AS level, CAST([] AS VARCHAR[]) AS position FROM customer
UNION ALL SELECT c_nationkey, page, 'payload.datasets[' || i || ']', 'payload.datasets', 'payload', 1, [{_AT.format(8, 'datasets', 'i')}] FROM ({_SETS})
UNION ALL SELECT c_nationkey, page, 'payload.datasets[' || i || '].resources[' || j || ']', 'payload.datasets[' || i || '].resources', 'payload.datasets[' || i || ']', 2, [{_AT.format(8, 'datasets', 'i')}, {_AT.format(9, 'resources', 'j')}] FROM ({_RESOURCES})"""


def deep_nodes(spark, sf):
    """Parts within parts, up to thirty levels, in passes of eight: every level is found, with its place."""
    parts = table(spark, sf, "part").select("p_partkey", (F.col("p_partkey") % 30 + 1).cast("int").alias("n"))
    # few bytes make much work: a number of its own keeps the partitions apart
    parts = parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    text = F.aggregate(F.sequence(F.lit(1), "n"), F.lit("{}"), lambda inner, i: F.concat(F.lit('{"n":'), i.cast("string"), F.lit(',"parts":[7,'), inner, F.lit("]}")))
    found = documents.walk(documents.parsed(parts.select("p_partkey", text.alias("text")), "text").drop("text"))
    return found.select("p_partkey", "level", F.sha2("path", 256).alias("path_hash"), F.col("parent_path").isNull().alias("is_root"), F.size("position").alias("n_steps"), field(F.col("data"), "n", "int").alias("n"))


DEEP_SQL = """SELECT p_partkey, CAST(level AS INTEGER) AS level, sha256('payload' || repeat('.parts[1]', level)) AS path_hash, level = 0 AS is_root, CAST(level AS INTEGER) AS n_steps, CAST(nullif(p_partkey % 30 + 1 - level, 0) AS INTEGER) AS n
FROM (SELECT p_partkey, unnest(range(CAST(p_partkey % 30 + 2 AS INTEGER))) AS level FROM part)"""


def classify_nodes(spark, sf):
    found = documents.classify(documents.walk(trees(spark, sf), depth=4))
    return found.groupBy("level", "entity_type", "confidence", F.array_join("signals", ",").alias("signals")).agg(F.count(F.lit(1)).alias("n_nodes"))


CLASSIFY_SQL = f"""SELECT 0 AS level, 'unknown' AS entity_type, 'low' AS confidence, '' AS signals, count(DISTINCT (c_nationkey, c_custkey // 1000)) AS n_nodes FROM customer
UNION ALL SELECT 1, CASE WHEN o THEN 'dataset' ELSE 'unknown' END, CASE WHEN o THEN 'heuristic' ELSE 'low' END, CASE WHEN o THEN 'resources' ELSE '' END, count(*) FROM (SELECT c_custkey IN (SELECT o_custkey FROM orders) AS o FROM customer) GROUP BY ALL
UNION ALL SELECT 2, 'resource', 'high', 'format,url_type', count(*) FROM ({_RESOURCES})"""


def parse_summary(spark, sf):
    """Of the catalogs' pages, and of a page without an object for each nation."""
    none = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.lit(-1).cast("long").alias("page"), F.parse_json(F.lit("[5]")).alias("document"))
    pages = trees(spark, sf).unionByName(none)
    return documents.parse_summary(documents.classify(documents.walk(pages, depth=4)), ["c_nationkey", "page"], pages)


PARSE_SQL = f"""WITH n AS (SELECT DISTINCT c_nationkey, c_custkey // 1000 AS page, 0 AS level, FALSE AS known FROM customer UNION ALL SELECT c_nationkey, c_custkey // 1000, 1, c_custkey IN (SELECT o_custkey FROM orders) FROM customer UNION ALL SELECT c_nationkey, page, 2, TRUE FROM ({_RESOURCES}))
SELECT c_nationkey, page, count(*) AS n_nodes, count(*) FILTER (level = 0) AS n_roots, count(*) FILTER (level > 0) AS n_edges, count(*) FILTER (known) AS n_classified, count(*) FILTER (NOT known) AS n_unknown, count(*) FILTER (NOT known) AS n_warnings,
CASE WHEN count(*) FILTER (known) = 0 THEN 'ambiguous' ELSE 'parsed_with_warnings' END AS status FROM n GROUP BY 1, 2 UNION ALL SELECT n_nationkey, -1, 0, 0, 0, 0, 0, 0, 'empty' FROM nation"""


def statistics(spark, sf):
    """A statistics document for each region: a header, and a row for each nation and market segment."""
    customers = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    cells = customers.groupBy("n_regionkey", "n_nationkey", "n_name", "c_mktsegment").agg(F.count(F.lit(1)).cast("string").alias("v"))
    rows = F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), F.col("c_mktsegment").alias("s"), "v", "n_name")))
    pair = lambda *kv: F.map_from_arrays(F.array(*[F.lit(k) for k, _ in kv]), F.array(*[v for _, v in kv]))
    header = pair(("V", F.lit(" Valor")), ("MN", F.lit("Unidade")), ("D1C", F.lit("Nação (Código)")), ("D1N", F.lit("Nação")), ("D2C", F.lit("Ano (Código)")), ("D2N", F.lit("Ano")), ("D10N", F.lit("Variável")))
    body = F.transform(rows, lambda r: pair(("V", r["v"]), ("MN", F.lit("pessoas ")), ("D1C", r["k"].cast("string")), ("D1N", r["n_name"]), ("D2C", F.lit("2024")), ("D2N", F.lit("2024")), ("D10N", r["s"])))
    return cells.groupBy("n_regionkey").agg(body.alias("body")).select("n_regionkey", F.to_json(F.concat(F.array(header), "body")).alias("document"))


def flat_view(spark, sf):
    """Each row's value and its dimensions, exploded."""
    flat = flatview.flat_view(statistics(spark, sf))
    each = flat.select("n_regionkey", "row_index", "value", "value_label", "attribute_count", "dimension_count", "period_code", "period_name", "variable_name", F.element_at("attributes", 1)["value"].alias("unit"), F.explode("dimensions").alias("d"))
    return each.select(*[c for c in each.columns if c != "d"], "d.*")


FLAT_SQL = """WITH c AS (SELECT n_regionkey, n_nationkey, n_name, c_mktsegment, count(*) AS v FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, c_mktsegment) - 1 AS INTEGER) AS row_index FROM c)
SELECT n_regionkey, row_index, CAST(v AS VARCHAR) AS value, 'Valor' AS value_label, 1 AS attribute_count, 3 AS dimension_count, '2024' AS period_code, '2024' AS period_name, c_mktsegment AS variable_name, 'pessoas' AS unit,
d.id AS id, d.position AS position, d.code AS code, d.name AS name, d.cl AS code_label, d.label AS label
FROM (SELECT r.*, unnest([{'id': 'D1', 'position': 1, 'code': CAST(n_nationkey AS VARCHAR), 'name': n_name, 'cl': 'Nação (Código)', 'label': 'Nação'}, {'id': 'D2', 'position': 2, 'code': '2024', 'name': '2024', 'cl': 'Ano (Código)', 'label': 'Ano'}, {'id': 'D10', 'position': 10, 'code': '', 'name': c_mktsegment, 'cl': '', 'label': 'Variável'}]) AS d FROM r)"""


def flat_description(spark, sf):
    return flatview.described(flatview.flat_view(statistics(spark, sf)), ["n_regionkey"])


DESCRIBED_SQL = "SELECT DISTINCT n_regionkey, 'MN' AS attribute_keys, 'D1,D2,D10' AS dimension_ids FROM nation JOIN customer ON c_nationkey = n_nationkey"


def cursors(spark, sf):
    """The cursor of the page after each turn, in one of three places."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn").distinct()
    cursor = F.concat(F.lit("c"), (F.col("turn") + 1).cast("string"))
    body = F.when(F.col("turn") % 3 == 0, F.concat(F.lit('{"nextCursor":"'), cursor, F.lit('"}'))).when(F.col("turn") % 3 == 1, F.concat(F.lit('{"meta":{"cursor":"'), cursor, F.lit('"}}'))).otherwise(F.lit('{"items":[]}'))
    return turns.select("conv_id", "turn", requests.next_cursor(F.try_parse_json(body)).alias("next_cursor"))


CURSOR_SQL = "SELECT DISTINCT conv_id, turn, CASE WHEN turn % 3 < 2 THEN 'c' || (turn + 1) END AS next_cursor FROM conversations"


def coerced_records(spark, sf):
    """Lists of mixed values, one for each order status: an object, a text, a number and a null for each priority."""
    groups = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    item = F.concat(F.lit('{"name":"'), "o_orderpriority", F.lit('"},"'), "o_orderpriority", F.lit('",'), F.col("n").cast("string"), F.lit(",null"))
    lists = groups.groupBy("o_orderstatus").agg(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(item)), ","), F.lit("]")).alias("text"))
    each = documents.coerced(lists.select("o_orderstatus", F.parse_json("text").alias("value")))
    return each.select("o_orderstatus", field(F.col("record"), "name").alias("name"), field(F.col("record"), "value").alias("value"))


COERCED_SQL = """WITH g AS (SELECT o_orderstatus, o_orderpriority AS p, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_orderstatus, p AS name, NULL AS value FROM g UNION ALL SELECT o_orderstatus, p, p FROM g UNION ALL SELECT o_orderstatus, CAST(n AS VARCHAR), CAST(n AS VARCHAR) FROM g"""


def canonical_payloads(spark, sf):
    """Properties with keys out of order, as canonical JSON, and their hash; every tenth is broken."""
    events = table(spark, sf, "events")
    text = F.when(F.col("event_id") % 10 == 7, F.lit("{broken")).otherwise(F.concat(F.lit('{"z": 1, "a": '), "props", F.lit("}")))
    return events.select("event_id", canonical_json(text).alias("payload"), F.sha2(canonical_json(text), 256).alias("payload_hash"))


CANONICAL_SQL = """SELECT event_id, p AS payload, sha256(p) AS payload_hash FROM (SELECT event_id, CASE WHEN event_id % 10 != 7 THEN '{"a":{"k":' || json_extract_string(props, '$.k') || '},"z":1}' END AS p FROM events)"""


def metadata_coerce(spark, sf):
    df = table(spark, sf, "customer")
    made = metadata({"segment ": F.col("c_mktsegment"), "nation": F.col("c_nationkey"), "rich": F.col("c_acctbal") > 5000, "note": F.when(F.col("c_custkey") % 2 == 0, F.lit(" ")).otherwise(F.lit(" odd ")), "api_key": F.col("c_name")})
    return df.select("c_custkey", F.explode(made).alias("key", "value"))


METADATA_SQL = """SELECT c_custkey, 'strategy.segment' AS key, c_mktsegment AS value FROM customer UNION ALL SELECT c_custkey, 'strategy.nation', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'strategy.rich', CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END FROM customer UNION ALL SELECT c_custkey, 'strategy.note', 'odd' FROM customer WHERE c_custkey % 2 != 0
UNION ALL SELECT c_custkey, 'strategy.api_key', '***' FROM customer"""


def folded_labels(spark, sf):
    """How many words of each document change when accents are folded."""
    words = table(spark, sf, "documents").select("doc_id", F.explode(F.split("text", " ")).alias("w"))
    return words.groupBy("doc_id").agg(F.count_if(folded(F.col("w")) != F.lower("w")).alias("n_accented"))


FOLDED_SQL = "SELECT doc_id, count(*) FILTER (regexp_matches(lower(w), '[^\\x00-\\x7F]') OR w != trim(w)) AS n_accented FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS w FROM documents) GROUP BY 1"

QUERIES = {
    "catalog_rows": catalog_rows, "generic_batches": generic_batches,
    "transform_hooks": transform_hooks, "document_records": document_records, "first_non_blank": first_non_blank_query, "entity_tree": entity_tree, "entity_counts": entity_counts, "catalog_edges": catalog_edges, "catalog_nodes": catalog_nodes,
    "walk_nodes": walk_nodes, "deep_nodes": deep_nodes, "classify_nodes": classify_nodes, "parse_summary": parse_summary, "flat_view": flat_view, "flat_description": flat_description, "cursors": cursors,
    "coerced_records": coerced_records, "canonical_payloads": canonical_payloads, "metadata_coerce": metadata_coerce, "folded_labels": folded_labels,
}
ORACLES = {
    "catalog_rows": ROWS_SQL, "generic_batches": GENERIC_SQL,
    "transform_hooks": HOOKS_SQL, "document_records": RECORDS_SQL, "first_non_blank": NON_BLANK_SQL, "entity_tree": TREE_SQL, "entity_counts": COUNTS_SQL, "catalog_edges": EDGES_SQL, "catalog_nodes": NODES_SQL,
    "walk_nodes": WALK_SQL, "deep_nodes": DEEP_SQL, "classify_nodes": CLASSIFY_SQL, "parse_summary": PARSE_SQL, "flat_view": FLAT_SQL, "flat_description": DESCRIBED_SQL, "cursors": CURSOR_SQL,
    "coerced_records": COERCED_SQL, "canonical_payloads": CANONICAL_SQL, "metadata_coerce": METADATA_SQL, "folded_labels": FOLDED_SQL,
}
