"""Ranked lexical search over bit-sliced Bloom signatures.

Terms are runs of letters, digits and characters outside ASCII, A-Z lower-cased.  The
index holds documents in blocks of like sizes; a block has a row of bits, a slice,
for each bit of its documents' Bloom signatures, with a column for each document.
A signature holds every term once for each number of ``LEVELS`` that its
occurrences reach.  Slices of a term, anded, name the documents that may hold it
so often; they never miss one.  Its weight, times what the greatest number of
occurrences below the next level can add, is summed over an item's terms, which bounds
each document's score from above.

A first pass over the index finds the documents of the highest bounds for each item, whose exact
scores give a least score for the result; a second lists every document whose
bound reaches that score, and these are scored exactly from their whole
texts.  All others are provably excluded, so that the result is that of scoring all.

The index does not depend on the items; they are searched in blocks of about
``ITEMS``, whose terms are sent to all tasks.

Defined cases: a text that is null or without terms is found by nothing and counts in neither N
nor L; repeated rows are ranked each, in any order; a null id comes last among equal scores;
very long texts are indexed whole (a signature over ``_MOST_BITS`` bits fills up, which
only raises bounds); items without terms find nothing; rows of one
item id are one item with the terms of all; empty tables give no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import cut, maybe_among, stored, table

TOP = 50
#: Documents of the highest bounds that are scored for an item's least score, for each that is asked for.
SEEDS = 4
#: The occurrences at which a level begins, and the bits that a key of it sets: many for the first, since a rare
#: term that is not there costs most, few for the others, which count only where the level before is there.
LEVELS = ((1, 10), (2, 4), (3, 4), (4, 4), (6, 4), (9, 4), (14, 4))
#: Bits of a signature for each of its keys, at least.
DENSITY = 16
#: Items that are searched together, about.
ITEMS = 4096
_DOCS, _CELLS, _LEAST_BITS, _MOST_BITS, _REMEMBERED = 1024, 1 << 24, 512, 1 << 22, 400_000
#: ASCII that is neither a letter nor a digit becomes a space; A-Z are lower-cased; other bytes stay.
_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c > 127 else 32 for c in range(256))
_ROUND, _ODD = np.uint64(0xBF58476D1CE4E5B8), np.random.default_rng(13).integers(0, 1 << 62, 16, np.uint64) << np.uint64(1) | np.uint64(1)


class _Hashes(dict):
    def __missing__(self, term: bytes) -> int:
        found = xxhash.xxh64_intdigest(term)
        if len(self) < _REMEMBERED:
            self[term] = found
        return found


def terms(text: bytes | str | None) -> list[bytes]:
    return (text.encode() if isinstance(text, str) else text or b"").translate(_TERMS).split()


def _bits_set(hashes: np.ndarray, level: int, probes: int, bits: int) -> np.ndarray:
    """The bits of each term at a level in a signature of ``bits``."""
    mixed = (hashes[:, None] ^ hashes[:, None] >> np.uint64(32)) * (_ROUND + np.uint64(32) * np.uint64(level) + _ODD[:probes])
    return ((mixed >> np.uint64(32)) * np.uint64(bits) >> np.uint64(32)).astype(np.int64)


def _slices(found: list[tuple[np.ndarray, np.ndarray]], bits: int) -> np.ndarray:
    """A block's bitmap of documents for each bit, from each document's terms and their occurrences."""
    cells = np.zeros((bits, -(-len(found) // 8) * 8), np.uint8)
    for i, (hashes, tf) in enumerate(found):
        for level, probes in LEVELS:
            cells[_bits_set(hashes[tf >= level], level, probes, bits).reshape(-1), i] = 1
    return np.packbits(cells, axis=1)


def index(docs: DataFrame) -> DataFrame:
    """Blocks (rows, sizes, most, bits, slices), each batch's first with the batch's document counts of terms by hash (hashes, counts).

    ``rows`` are hashes of the documents' ids and texts, ``sizes`` their terms, ``most`` the occurrences of their most frequent term.
    """

    def of(batches):
        hashes = _Hashes()
        for batch in batches:
            held = []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = terms(text)
                if found:
                    counts = Counter(found)
                    h = np.fromiter(map(hashes.__getitem__, counts), np.uint64, len(counts))
                    tf = np.fromiter(counts.values(), np.int64, len(counts))
                    n_keys = sum(int((tf >= level).sum()) for level, _ in LEVELS)
                    held.append((n_keys, row, len(found), int(tf.max()), h, tf))
            if not held:
                continue
            held.sort(key=lambda x: x[0])
            distinct, counted = np.unique(np.concatenate([x[4] for x in held]), return_counts=True)
            at = 0
            while at < len(held):
                # as many documents as the largest of them leaves room for
                n = 1
                width = lambda i: min(_MOST_BITS, max(_LEAST_BITS, DENSITY * held[i][0]))
                while n < _DOCS and at + n < len(held) and width(at + n) <= 2 * width(at) and width(at + n) * (n + 1) <= _CELLS:
                    n += 1
                block, bits = held[at : at + n], width(at + n - 1)
                made = _slices([x[4:] for x in block], bits)
                partial = (distinct.view(np.int64), counted) if at == 0 else (None, None)
                values = [[x[1] for x in block], [x[2] for x in block], [x[3] for x in block]]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array([v], pa.list_(pa.int64())) for v in values], pa.array([bits], pa.int32()), pa.array([made.tobytes()], pa.binary()), *[pa.array([v], pa.list_(pa.int64())) for v in partial]],
                    ["rows", "sizes", "most", "bits", "slices", "hashes", "counts"],
                )
                at += n

    return _hashed(docs).select("row", "text").mapInArrow(of, "rows array<long>, sizes array<long>, most array<long>, bits int, slices binary, hashes array<long>, counts array<long>")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.xxhash64(F.xxhash64(F.col("doc_id").cast("long")), F.xxhash64("text")).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))


class Query:
    """A block of items: their terms' hashes and weights, the corpus's totals, and each item's least score."""

    def __init__(self, items: dict[int, set[bytes]], df: dict[int, int], n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        weight = lambda n: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1)))
        numbered: dict[bytes, int] = {}
        of_item = {i: [(t, df.get(xxhash.xxh64_intdigest(t), 0)) for t in found] for i, found in items.items()}
        self.weights = {i: {t: weight(n) for t, n in found if n} for i, found in of_item.items()}
        for found in self.weights.values():
            for t in found:
                numbered.setdefault(t, len(numbered))
        self.hashes = np.array([xxhash.xxh64_intdigest(t) for t in numbered], np.uint64)
        self.places = {i: (np.array([numbered[t] for t in w], np.int64), np.array([*w.values()], float)) for i, w in self.weights.items() if w}
        self.least: dict[int, int] = {}

    def length(self, n):
        """A document's m, from its number of terms."""
        return 50 + 50 * n * self.n_docs // self.n_terms

    def score(self, item: int, counts: Counter, n: int) -> int:
        m = self.length(n)
        return sum(w * (1_000_000_000 * counts[t] // (1000 * counts[t] + 20 * m)) for t, w in self.weights[item].items() if t in counts)

    def bounds(self, sizes: np.ndarray, most: np.ndarray, bits: int, slices: bytes):
        """For each item an upper bound of every document's score; whole numbers under 2 ** 53."""
        n, m = len(sizes), self.length(sizes)
        bitmaps = np.frombuffer(slices, np.uint8).reshape(bits, -1)
        maybe, gains, below = [], [], 0
        for (level, probes), (beyond, _) in zip(LEVELS, [*LEVELS[1:], (None, 0)]):
            anded = np.bitwise_and.reduce(bitmaps[_bits_set(self.hashes, level, probes, bits)], axis=1)
            # a term that stands so often stands less often too
            before = anded = anded & before if maybe else anded
            maybe.append(np.unpackbits(anded, axis=1, count=n))
            tf = most if beyond is None else np.minimum(most, beyond - 1)
            gain = 1_000_000_000 * tf // (1000 * tf + 20 * m)
            gains.append((gain - below).astype(float))
            below = gain
        for item, (at, weights) in self.places.items():
            yield item, sum(gain * (weights @ of_level[at].astype(float)) for gain, of_level in zip(gains, maybe))


def _bounded(batches, query: Query):
    for batch in batches:
        for rows, sizes, most, bits, slices in zip(*(batch.column(i) for i in range(5))):
            rows = np.array(rows.values)
            for item, bound in query.bounds(np.array(sizes.values), np.array(most.values), bits.as_py(), slices.as_py()):
                yield item, rows, bound


def _as_batch(items, rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(rows, pa.int64())], ["item", "row"])


def highest_bounds(blocks: DataFrame, query: Query, top: int) -> DataFrame:
    """(item, row): for each item the documents of the highest bounds in each task, then of all."""

    def of(batches):
        best: dict[int, tuple] = {}
        for item, rows, bound in _bounded(batches, query):
            have = best.get(item, (rows[:0], bound[:0]))
            rows, bound = np.concatenate([have[0], rows]), np.concatenate([have[1], bound])
            if len(rows) > top:
                at = np.argpartition(-bound, top)[:top]
                rows, bound = rows[at], bound[at]
            best[item] = rows, bound
        for item, (rows, bound) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), item, np.int32)), pa.array(rows), pa.array(bound.astype(np.int64))], ["item", "row", "bound"])

    each = blocks.select("rows", "sizes", "most", "bits", "slices").mapInArrow(of, "item int, row long, bound long")
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("bound"), "row"))
    return each.withColumn("rank", rank).where(F.col("rank") <= top).select("item", "row")


def not_excluded(blocks: DataFrame, query: Query) -> DataFrame:
    """(item, row): every document whose bound reaches the item's least score."""

    def of(batches):
        for item, rows, bound in _bounded(batches, query):
            found = rows[bound >= max(1, query.least.get(item, 0))]
            if len(found):
                yield _as_batch(np.full(len(found), item), found)

    return blocks.select("rows", "sizes", "most", "bits", "slices").mapInArrow(of, "item int, row long")


def scored(docs: DataFrame, candidates: DataFrame, query: Query) -> DataFrame:
    """(item, doc_id, score): exact scores above 0 of the candidates (item, row), from whole texts."""

    def of(batches):
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text, items in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = terms(text)
                counts = Counter(found)
                out += [(i, doc_id, s) for i in items for s in [query.score(i, counts, len(found))] if s > 0]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))], ["item", "doc_id", "score"])

    # no more items than the block has
    by_row = cut(candidates.distinct().groupBy("row").agg(F.collect_list("item").alias("items")))
    whole = maybe_among(_hashed(docs), "row", by_row.select("row")).where("maybe")
    return whole.join(by_row, "row").select("doc_id", "text", "items").mapInArrow(of, "item int, doc_id long, score long")


def _top(found: DataFrame, by: str, top: int) -> DataFrame:
    # limited in each task before the shuffle
    order = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block: int = ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``top`` documents of the highest scores above 0."""
    spark = docs.sparkSession
    blocks, _ = stored(index(docs))
    totals = blocks.agg(F.sum(F.size("rows")).alias("n_docs"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n_terms")).first()
    each = items.groupBy("item_id").agg(F.collect_set("text").alias("texts")).withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(max(1, -(-items.count() // block)))))
    found = spark.createDataFrame([], items.select("item_id").withColumns({"rank": F.lit(0), "doc_id": F.lit(0).cast("long"), "score": F.lit(0).cast("long")}).schema)
    if not totals.n_docs:
        return found
    counts = blocks.where("hashes IS NOT NULL").select(F.explode(F.arrays_zip("hashes", "counts")).alias("e")).groupBy(F.col("e.hashes").alias("hash")).agg(F.sum("e.counts").alias("df"))
    counts = cut(counts)
    for part in [r.part for r in each.select("part").distinct().collect()]:
        rows = each.where(F.col("part") == part).collect()
        ids = {i: r.item_id for i, r in enumerate(rows)}
        of_item = {i: {t for text in r.texts for t in terms(text)} for i, r in enumerate(rows)}
        signed = lambda t: np.uint64(xxhash.xxh64_intdigest(t)).astype(np.int64).item()
        sought = {signed(t) for found_terms in of_item.values() for t in found_terms}
        if not sought:
            continue
        asked = spark.createDataFrame([(h,) for h in sought], "hash long")
        df = {r["hash"] % (1 << 64): r.df for r in counts.join(F.broadcast(asked), "hash").collect()}
        query = Query(of_item, df, totals.n_docs, totals.n_terms)
        seeds = _top(scored(docs, highest_bounds(blocks, query, SEEDS * top), query), "item", top)
        query.least = {r.item: r.score for r in seeds.where(F.col("rank") == top).collect()}
        best = scored(docs, not_excluded(blocks, query), query)
        named = spark.createDataFrame([(i, x) for i, x in ids.items()], f"item int, item_id {items.schema['item_id'].dataType.simpleString()}")
        found = found.union(_top(best, "item", top).join(F.broadcast(named), "item").select("item_id", "rank", "doc_id", "score"))
    return found


def query(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
