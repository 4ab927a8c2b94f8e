from __future__ import annotations

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op09_ring as op
from tidemark.llm.common import table


def brute(docs, ring, shards):
    """The walk, document by document.  ``ring`` lists (arc, shard) of each cell; docs carry their cell and order."""
    n = len(docs)
    room = [n // shards + (s < n % shards) for s in range(shards)]
    used, at_arc, owner = [0] * shards, defaultdict(list), {arc: shard for arc, shard in ring}
    for order, cell in sorted(docs):
        at_arc[ring[cell][0]].append(order)
    placed, waiting = {}, []
    for arc in [*sorted(owner), *sorted(owner)]:
        shard, own = owner[arc], at_arc.pop(arc, [])
        later = []
        for order in own:
            if used[shard] < room[shard]:
                placed[order] = (shard, used[shard])
                used[shard] += 1
            else:
                later.append(order)
        while waiting and used[shard] < room[shard]:
            placed[waiting.pop(0)] = (shard, used[shard])
            used[shard] += 1
        waiting += later
    assert not waiting
    return placed


def test_against_a_walk_document_by_document(spark):
    docs = table(spark, SF, "documents")
    for shards, vnodes in ((40, 128), (7, 3), (300, 2)):
        cells = [(r.arc, r.shard) for r in op.ring(spark, shards, vnodes).orderBy("cell").collect()]
        assert len(cells) == 1 << op.RING_BITS
        salt = F.expr(f"pmod(xxhash64(doc_id, CAST(coalesce(octet_length(text), 0) + 16 AS long), crc32(coalesce(text, ''))), {op.SALTS})")
        keyed = docs.select("doc_id", F.xxhash64("doc_id").alias("h"), salt.alias("salt")).collect()
        cell = {r.doc_id: (r.h & (1 << 64) - 1) >> 64 - op.RING_BITS for r in keyed}
        order = {r.doc_id: (r.salt, cell[r.doc_id], r.h, r.doc_id) for r in keyed}
        expected = brute([(order[i], cell[i]) for i in cell], cells, shards)
        got = {order[r.doc_id]: (r.shard, r.slot) for r in op.assign(docs, shards, vnodes).collect()}
        assert got == expected


def test_odd_documents(spark):
    docs = odd(spark)
    out = op.assign(docs, 5, 16).collect()
    assert len(out) == docs.count()
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in out) == sorted((d.doc_id or 0, 16 + len((d.text or "").encode()), zlib.crc32((d.text or "").encode())) for d in docs.collect())
    slots = defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    columns = ["doc_id", "size", "text_crc32", "shard", "slot"]
    assert rows(op.assign(clashing(docs), 5, 16), *columns) == rows(op.assign(docs, 5, 16), *columns)


def test_many_rows_of_one_id(spark):
    """A null id for all rows: one arc, which all shards share."""
    docs = spark.range(3000).selectExpr("CAST(NULL AS long) AS doc_id", "CAST(id % 50 AS string) AS text")
    counts = [r["count"] for r in op.assign(docs, 7, 16).groupBy("shard").count().collect()]
    assert len(counts) == 7 and max(counts) - min(counts) <= 1 and sum(counts) == 3000


def test_empty(spark):
    assert op.assign(odd(spark).limit(0)).count() == 0


def test_query(spark):
    out = op.query(spark, SF)
    assert out.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    counts = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(counts) == 40 and max(counts) - min(counts) <= 1
