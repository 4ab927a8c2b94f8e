"""Queries on documents over whole tables, whatever a document spans."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.test_oracles import plain
from tidemark.operators import documents
from tidemark.plans import document_queries as op


@pytest.mark.parametrize("span", [7, 100_000])
@pytest.mark.parametrize("name", ["document_records", "transform_hooks"])
def test_records_are_numbered_over_the_whole_response(spark, monkeypatch, name, span):
    monkeypatch.setattr(op, "SPAN", span)
    got = op.QUERIES[name](spark, SF)
    numbered = f"(SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS record_index FROM '{SF}/events.parquet')"
    expected = duckdb.sql(f"SELECT user_id, event_id, record_index FROM {numbered} WHERE {name == 'document_records'} OR event_id % 2 = 0").fetchall()
    rows = [(r.user_id, r.event_id, r.record_index) for r in got.collect()]
    assert plain(rows, ["a", "b", "c"]) == plain(expected, ["a", "b", "c"])


def test_a_walk_makes_its_documents_once(spark):
    """However deep: what comes before the walk is not done again for each look."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(i):
        made.add(1)
        return '{"a":[7,' * i + "{}" + "]}" * i

    docs = documents.parsed(spark.range(1, 21).select("id", text(F.col("id").cast("int")).alias("text")), "text").drop("text")
    levels = documents.walk(docs).groupBy("id").agg(F.max("level").alias("deepest"), F.count(F.lit(1)).alias("n")).collect()
    assert {(r.id, r.deepest, r.n) for r in levels} == {(i, i, i + 1) for i in range(1, 21)}
    assert made.value <= 20


def test_nodes_make_their_entities_once(spark):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def path(p):
        made.add(1)
        return p

    schema = "doc int, entity_type string, entity_key string, parent_entity_type string, parent_entity_key string, p string, position array<string>, payload string"
    entities = [(1, "dataset", "a", None, None, "pa", ["1"], "{}"), (1, "resource", "x", "dataset", "a", "px", ["1", "1"], "{}"), (1, "resource", "x", "dataset", "a", "py", ["1", "2"], "{}"), (2, "resource", "x", "dataset", "a", "pz", ["1"], "{}")]
    df = spark.createDataFrame(entities, schema).withColumn("record_path", path("p"))
    got = documents.nodes(df, ["doc"]).select("doc", "node_key", "node_path", "parent_node_path").collect()
    assert {tuple(r) for r in got} == {(1, "a", "pa", None), (1, "x", "px", "pa"), (2, "x", "pz", None)} and len(got) == 3
    assert made.value <= len(entities)
