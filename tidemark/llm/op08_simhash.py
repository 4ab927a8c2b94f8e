"""SimHash near-duplicates by pigeonhole blocks.

A text's words (A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``) give 3-word shingles,
repeats included; a fingerprint bit is 1 if it is set in over half of the
shingles' XXH64 hashes (seed 42).  Fingerprints that differ in at most
``max_distance`` bits are linked.

Only distinct fingerprints are compared.  64 bits are cut into
``max_distance + 2`` blocks; two fingerprints within the distance agree on two
blocks at least, so each fingerprint gets a key for every pair of blocks.
Groups of a key with few members are joined and verified by Hamming distance.
Larger groups are not paired up: for a distance of two, fingerprints are within
it just if both are within one bit of a common value, so each member names the
values one bit away among the group's free bits, and all that name a value are
linked to the least of them.  That is linear in the group, and no link is lost.

Defined cases: a null or empty text has fingerprint zero, linked like any other;
repeated rows and equal texts share a fingerprint and so a component; a very long
text is hashed whole, its bits counted in parts; a null id
never becomes a component's id while it has other members; a component of null ids
alone has a null one, and is one component all the same.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, maybe_among, table
from tidemark.llm.components import components

SEED = 42
#: Members up to which a group of one block key is joined pairwise.
PAIRED = 48
_CHUNK = 1 << 15


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """The fingerprint of a UTF-8 text, as an unsigned number."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return 0
    joined, digest = b" ".join(tokens), xxhash.xxh64_intdigest
    n = len(tokens) - words + 1
    if n < 1:
        return digest(joined, SEED)
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = hashes[at : at + _CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, text_hash, fingerprint) per row; the fingerprint as a signed long."""

    def of(batches):
        for batch in batches:
            prints = np.fromiter((fingerprint(t, words) for t in batch.column(2).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["doc_id", "text_hash", "fingerprint"])

    plain = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(of, "doc_id long, text_hash long, fingerprint long")


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def links(prints: DataFrame, max_distance: int = 2) -> DataFrame:
    """(a, b) pairs of distinct fingerprints that connect all within ``max_distance``.

    ``prints`` has one row per distinct fingerprint.  Two at most: for wider
    distances the exact way for large groups would need more than one bit.
    A key that many rows share is one row here; the joins of rows with their
    components are those that adaptive execution splits by itself.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("max_distance must be 0, 1 or 2")
    n_blocks = max_distance + 2
    edges = [64 * i // n_blocks for i in range(n_blocks + 1)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    masks = [x | y for x, y in combinations(blocks, 2)]
    fp = F.col("fingerprint")
    keys = prints.select("fingerprint", F.posexplode(F.array(*[fp.bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("combo", "key"))
    groups = keys.groupBy("combo", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut(keys.join(groups, ["combo", "key"]))

    few = members.where(F.col("n") <= PAIRED)
    left, right = few.select("combo", "key", F.col("fingerprint").alias("a")), few.select("combo", "key", F.col("fingerprint").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    paired = left.join(right, ["combo", "key"]).where((F.col("a") < F.col("b")) & near).select("a", "b")

    free = F.array(*[F.array(F.lit(0), *[F.lit(_signed(1 << i)) for i in range(64) if not m >> i & 1]) for m in masks])
    flips = F.explode(F.element_at(free, F.col("combo") + 1)).alias("flip")
    named = members.where(F.col("n") > PAIRED).select("combo", fp.alias("b"), flips).select("b", fp_xor("b", "flip").alias("centre")).distinct()
    if max_distance < 2:  # one of the two is the centre itself
        near_one = named.join(members.select(fp.alias("a")).distinct(), F.col("centre") == F.col("a")).where((F.col("a") != F.col("b")) & near)
        return paired.union(near_one.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    stars = named.groupBy("centre").agg(F.min("b").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    starred = named.join(stars, "centre").where((F.col("a") != F.col("b")) & near).select("a", "b")
    return paired.union(starred).distinct()


def fp_xor(x: str, y: str):
    return F.col(x).bitwiseXOR(F.col(y))


def labelled_rows(rows: DataFrame, linked: DataFrame) -> DataFrame:
    """``rows`` with the fingerprint in 16 hex digits, the component that ``linked`` gives it, named by its least id, and that component's label.

    The label is there for components without an id, which no name tells apart.
    """
    prints = rows.groupBy("fingerprint").agg(F.min("doc_id").alias("rep"))
    found = components(linked)
    labelled = prints.join(found, prints.fingerprint == found.node, "left").select("fingerprint", "rep", F.coalesce("label", "fingerprint").alias("label"))
    ids = labelled.groupBy("label").agg(F.min("rep").alias("component_id"))
    by_print = labelled.join(ids, "label").select("fingerprint", "component_id", "label")
    return rows.join(by_print, "fingerprint").select("doc_id", "text_hash", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id", "label")


def link(docs: DataFrame, words: int = 3, max_distance: int = 2) -> DataFrame:
    """A row per document: doc_id, text_hash, fingerprint (16 hex digits), component_id, label (of the component, a long that is never null)."""
    rows = cut(fingerprints(docs, words))
    return labelled_rows(rows, links(rows.select("fingerprint").distinct(), max_distance))


def keep_one(docs: DataFrame, words: int = 3, max_distance: int = 2) -> DataFrame:
    """``docs`` with one row for each component: the one of the least id, then of the least text hash."""
    return keep_first(docs, link(docs, words, max_distance))


def keep_first(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with the first row of each component that ``found`` labels.

    Rows that are alone in their component stay where they are: a bitmap of the
    others tells them apart, so that only texts that have copies are shuffled.
    """
    found = cut(found.select("doc_id", "text_hash", "label"))
    # a null id sorts last, so that it stays only if its component has no other
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash"))
    groups = found.groupBy("label").agg(first.alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # two hashes that are never null name a row
    keys = lambda doc_id, text_hash: [F.xxhash64(doc_id).alias("id_hash"), F.col(text_hash).alias("text_hash")]
    members = cut(found.join(groups, "label", "left_semi").select(*keys("doc_id", "text_hash")).distinct())
    others = members.join(groups.select(*keys("best.doc_id", "best.text_hash")), ["id_hash", "text_hash"], "left_anti")
    row_hash = F.xxhash64("id_hash", "text_hash")
    whole = docs.select(F.xxhash64("doc_id").alias("id_hash"), F.xxhash64("text").alias("text_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).withColumn("row_hash", row_hash)
    marked = maybe_among(whole, "row_hash", members.select(row_hash.alias("key")))
    copies = marked.where("maybe").join(others, ["id_hash", "text_hash"], "left_anti").dropDuplicates(["id_hash", "text_hash"])
    return marked.where("NOT maybe").select("row.*").union(copies.select("row.*"))


def query(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")
