"""Queries on what lies in zones: tables and their modes, inventories, entity files, page files, numbered requests, shapes of collections."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.operators import documents, flatview, publish, requests
from tidemark.plans.common import scratch, table
from tidemark.sources import scan
from tidemark.sources.shared import cut


def table_modes(spark, sf):
    """A table made with its namespace, appended to with columns in another order, left alone, and replaced with other columns: what it holds after each."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    name = f"zone_{uuid.uuid4().hex[:12]}.orders"
    try:
        seen = []
        for step, (df, mode, parts) in enumerate((
            (orders.where("o_orderstatus = 'O'"), "append", ["o_orderstatus"]),
            (orders.where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey"), "append", ["o_orderstatus"]),
            (orders, "ignore", []),
            (orders.where("o_orderstatus = 'P'").select("o_orderstatus", F.lit("new").alias("note")), "overwrite", []),
        ), 1):
            written = publish.write_table(df, name, mode, parts)
            held = scan.read_table(spark, name, ["o_orderstatus"])
            seen.append(held.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(step).alias("step"), "o_orderstatus", "n_rows", F.lit(written.records).cast("long").alias("written"), F.lit(",".join(sorted(held.columns))).alias("columns")))
            seen[-1] = cut(seen[-1])  # the table is replaced in the next step
        out = seen[0]
        for more in seen[1:]:
            out = out.unionByName(more)
        return out
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"DROP NAMESPACE IF EXISTS {name.partition('.')[0]}")


TABLE_SQL = """WITH n AS (SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1), v AS (FROM (VALUES (1, ['O'], 'O', 'o_orderkey,o_orderstatus'), (2, ['O', 'F'], 'F', 'o_orderkey,o_orderstatus'), (3, ['O', 'F'], '', 'o_orderkey,o_orderstatus'), (4, ['P'], 'P', 'note,o_orderstatus')) v(step, held, wrote, columns))
SELECT step, o_orderstatus, n_rows, coalesce((SELECT m.n_rows FROM n m WHERE m.o_orderstatus = wrote), 0) AS written, columns FROM v JOIN n ON list_contains(held, o_orderstatus)"""


def inventory_tables(spark, sf):
    """Events landed in two formats, each read as the table that the inventory's files of that format are."""
    events, at = table(spark, sf, "events").select("event_id", "user_id", "event_type"), scratch(spark)
    publish.write_path(events.where("event_id % 2 = 0"), f"{at}/events/a", "parquet", "overwrite")
    publish.write_path(events.where("event_id % 2 = 1"), f"{at}/events/b", "csv", "overwrite", options={"header": "true"})
    files = scan.inventory(spark, f"{at}/events").where("filename LIKE 'part-%'")
    both = [scan.read_inventory(files, fmt, events.schema, {"header": "true"} if fmt == "csv" else None).groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("sum_ids")).select(F.lit(fmt).alias("format"), "*") for fmt in ("parquet", "csv")]
    return both[0].unionByName(both[1])


INVENTORY_SQL = "SELECT CASE WHEN event_id % 2 = 0 THEN 'parquet' ELSE 'csv' END AS format, event_type, count(*) AS n_rows, CAST(sum(event_id) AS BIGINT) AS sum_ids FROM events GROUP BY ALL"


def _catalog(spark, sf):
    """Catalog pages of a hundred suppliers as organizations and their nation as a group."""
    suppliers = table(spark, sf, "supplier")
    items = F.array_sort(F.collect_list(F.struct(F.concat(F.lit("o"), F.col("s_suppkey").cast("string")).alias("id"), F.col("s_name").alias("title"))))
    groups = F.array_sort(F.collect_set(F.struct(F.concat(F.lit("g"), F.col("s_nationkey").cast("string")).alias("id"))))
    pages = suppliers.groupBy(F.expr("s_suppkey DIV 100").alias("page")).agg(items.alias("organizations"), groups.alias("groups"))
    return documents.parsed(pages.select("page", F.to_json(F.struct("organizations", "groups")).alias("text")), "text").drop("text")


def entity_files(spark, sf):
    """Entities as JSON lines, a folder for each type, and what a reader of one type's folder finds."""
    tree, at = documents.entity_tree(_catalog(spark, sf), levels=1).select("page", "entity_type", "entity_key", "payload"), scratch(spark)
    written = publish.write_entities(tree, f"{at}/entities")
    read = lambda kind: scan.read_paths(spark, [f"{at}/entities/entity_type={kind}"], "jsonl").select("page", F.lit(kind).alias("entity_type"), "entity_key", F.sha2("payload", 256).alias("payload_hash"))
    return read("organization").unionByName(read("group")).withColumn("written", F.lit(written.records).cast("long"))


ENTITY_SQL = """WITH e AS (SELECT s_suppkey // 100 AS page, 'organization' AS entity_type, 'o' || s_suppkey AS entity_key, '{"id":"o' || s_suppkey || '","title":"' || s_name || '"}' AS payload FROM supplier
UNION ALL SELECT DISTINCT s_suppkey // 100, 'group', 'g' || s_nationkey, '{"id":"g' || s_nationkey || '"}' FROM supplier) SELECT page, entity_type, entity_key, sha256(payload) AS payload_hash, (SELECT count(*) FROM e) AS written FROM e"""


def landed_pages(spark, sf):
    """Page files of several namings, in order of the number in their names, not of the names; others have none and come first."""
    names = table(spark, sf, "customer").select("c_nationkey", "c_custkey", F.concat(F.element_at(F.array(*map(F.lit, ("response/page-", "offset-", "cursor-", "response-", "note-"))), (F.col("c_custkey") % 5 + 1).cast("int")), F.col("c_custkey").cast("string"), F.lit(".json")).alias("path"))
    paged = names.withColumn("page_number", scan.page_number(F.col("path")))
    return paged.select("c_nationkey", "path", "page_number", requests.sequence_number([F.asc_nulls_first("page_number"), F.col("path")], ["c_nationkey"]).cast("long").alias("place"))


PAGES_SQL = """WITH p AS (SELECT c_nationkey, ['response/page-', 'offset-', 'cursor-', 'response-', 'note-'][c_custkey % 5 + 1] || c_custkey || '.json' AS path, CASE WHEN c_custkey % 5 < 4 THEN c_custkey END AS page_number FROM customer)
SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY page_number NULLS FIRST, path) AS place FROM p"""


def numbered_requests(spark, sf):
    """Request rows by nation and segment, NULLs first, each with its number in the whole order."""
    rows = table(spark, sf, "customer").select(F.when(F.col("c_nationkey") % 4 != 0, F.col("c_nationkey")).alias("nation"), F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), F.col("c_custkey").alias("customer"))
    return requests.numbered(rows, ["nation", "segment", "customer"])


NUMBERED_SQL = """SELECT row_number() OVER (ORDER BY nation NULLS FIRST, segment NULLS FIRST, customer) AS request_index, * FROM
(SELECT CASE WHEN c_nationkey % 4 != 0 THEN c_nationkey END AS nation, nullif(c_mktsegment, 'BUILDING') AS segment, c_custkey AS customer FROM customer)"""


def collection_shapes(spark, sf):
    """Suppliers' collections as a list, one object, a scalar, within a wrapper, and within a record's wrapper: the entities, whatever the shape."""
    key = F.col("s_suppkey")
    item = F.concat(F.lit('{"id":"d'), key.cast("string"), F.lit('"}'))
    nested = F.concat(F.lit('{"id":"d'), key.cast("string"), F.lit('","data":{"resources":{"id":"r"}}}'))
    text = (
        F.when(key % 5 == 0, F.concat(F.lit('{"datasets":['), item, F.lit(',null,"plain"]}')))
        .when(key % 5 == 1, F.concat(F.lit('{"dataset":'), item, F.lit("}")))
        .when(key % 5 == 2, F.concat(F.lit('{"datasets":["d'), key.cast("string"), F.lit('"]}')))
        .when(key % 5 == 3, F.concat(F.lit('{"count":1,"result":{"data":{"packages":['), item, F.lit("]}}}")))
        .otherwise(F.concat(F.lit('{"datasets":['), nested, F.lit("]}")))
    )
    pages = documents.parsed(table(spark, sf, "supplier").select("s_suppkey", text.alias("text")), "text").drop("text")
    return documents.entity_tree(pages, levels=2).select("s_suppkey", "entity_type", "entity_key", "parent_entity_key", "record_path", "level")


SHAPES_SQL = """SELECT s_suppkey, 'dataset' AS entity_type, 'd' || s_suppkey AS entity_key, NULL AS parent_entity_key, ['payload.datasets[0]', 'payload.dataset[0]', 'payload.datasets[0]', 'payload.result.data.packages[0]', 'payload.datasets[0]'][s_suppkey % 5 + 1] AS record_path, 0 AS level FROM supplier
UNION ALL SELECT s_suppkey, 'dataset', 'plain', NULL, 'payload.datasets[1]', 0 FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT s_suppkey, 'resource', 'r', 'd' || s_suppkey, 'payload.datasets[0].data.resources[0]', 1 FROM supplier WHERE s_suppkey % 5 = 4"""


def aggregate_ids(spark, sf):
    """The aggregate that a statistics request's address names."""
    key = F.col("p_partkey").cast("string")
    url = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("https://stats.example.org/api/v3/agregados/"), key, F.lit("/periodos/2024?view=flat"))).when(F.col("p_partkey") % 3 == 1, F.concat(F.lit("https://stats.example.org/agregados/"), key, F.lit("?agregados/9"))).otherwise(F.lit("https://stats.example.org/agregados/?x"))
    return table(spark, sf, "part").select("p_partkey", flatview.aggregate_id(url).alias("aggregate_id"))


AGGREGATE_SQL = "SELECT p_partkey, CASE WHEN p_partkey % 3 < 2 THEN CAST(p_partkey AS VARCHAR) END AS aggregate_id FROM part"

QUERIES = {
    "table_modes": table_modes, "inventory_tables": inventory_tables, "entity_files": entity_files, "landed_pages": landed_pages, "numbered_requests": numbered_requests, "collection_shapes": collection_shapes, "aggregate_ids": aggregate_ids,
}
ORACLES = {
    "table_modes": TABLE_SQL, "inventory_tables": INVENTORY_SQL, "entity_files": ENTITY_SQL, "landed_pages": PAGES_SQL, "numbered_requests": NUMBERED_SQL, "collection_shapes": SHAPES_SQL, "aggregate_ids": AGGREGATE_SQL,
}
