"""Near copies by MinHash signatures and a multi-index Hamming join.

A text's words (A-Z lower-cased, ``[^\\x20\\x09-\\x0D]+``) give its set of distinct
shingles of ``words`` words; fewer words are one shingle.  Sets are linked if their
Jaccard similarity is 0.8 or more, counted on the full sets of 64-bit hashes.

A signature has ``CHUNKS`` chunks of ``WIDTH`` minima, ``BITS`` bits each.  Two
signatures that differ in at most 2 * CHUNKS - 1 minima have, by pigeonhole, a chunk
with at most one error.  So a signature gets a key for each chunk and each place
that may be wrong, made of the chunk's other minima, and every pair within that
distance shares a key.  At a similarity of exactly 0.8 a pair is beyond it in 1.5 of
a thousand cases; it still shares a key unless all chunks have two errors, which is
2.3 of 100,000.  Pairs that share a key and differ in no more than ``FAR`` minima
(beyond which 0.8 has a chance under 1e-7) are verified.

Only distinct sets are compared.  Keys of up to ``PAIRED`` sets are joined pairwise.
The sets of a larger group are first compared with its hub, the set in most such
groups; what is then in one component needs no more comparing.  The rest, sets
outside the largest component of their group, are compared with all of the group in full,
in blocks of some ``BLOCK`` sets by ``BLOCK``, where the links are counted and no pair is a row but
those that join components, so that no link between components is lost and a
group is never one task's, nor all its pairs written out.

What the signatures lose is found by a second index, of the full sets: a set of n shingles and one
of 4 / 5 to 5 / 4 of its size that are linked differ in a ninth of their sizes' sum at most.  The
range of hashes is cut into parts, half as many as the least set of a class of sizes has shingles; all but so many parts are
equal in both, and of the equal ones the greatest, in an order that their content gives, is
in each set among the first of that order, one more than may differ.  So a set has these parts as keys,
about a quarter as many as shingles, and sets that are linked share one, always.  Only
keys of several components are looked at; a pair of theirs is verified in full if the parities of the numbers of
shingles in some places, of which at least as many shingles differ as parities do, allow a link.

Defined cases: a text that is null or without words has an empty set and is linked
with nothing; equal texts and repeated rows share a component; a very long
text is taken whole, in parts; a null id never names a component that has other
members, and alone its component is null; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, maybe_among, stored, table
from tidemark.llm.components import components

WORDS = 4
CHUNKS, WIDTH, BITS = 8, 5, 16
#: Minima in which a pair that is verified may differ.
FAR = 24
#: Sets of several components up to which a group of one part is joined pairwise.
FEW = 8
#: Sets up to which a group of one key is joined pairwise; sets, and their shingles, of a block in larger groups, about.
PAIRED, BLOCK, SHINGLES = 48, 1024, 1 << 19
#: Sets of two blocks that share a shingle, up to which they are paired up on it.
RARE = 128
_MINIMA, _PART, _REMEMBERED = CHUNKS * WIDTH, 1 << 13, 200_000
#: Pairs and columns of two blocks that are counted at a time.
_AT_ONCE, _COLUMNS = 1 << 20, 2048
_RNG = np.random.default_rng(11)
_FLIPS = _RNG.integers(0, 1 << 64, _MINIMA, np.uint64)
_ODD = _RNG.integers(0, 1 << 64, _MINIMA, np.uint64) | np.uint64(1)
_PLACES = _RNG.integers(0, 1 << 64, 16, np.uint64) | np.uint64(1)
_JOIN = _RNG.integers(0, 1 << 64, (CHUNKS, WIDTH), np.uint64) | np.uint64(1)


class Hashes(dict):
    """The hashes of words met before."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        if len(self) < _REMEMBERED:
            self[word] = found
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ x >> np.uint64(29)
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ x >> np.uint64(32)


def shingles(text: bytes | None, hashes: Hashes, words: int) -> np.ndarray:
    """The distinct hashes of a UTF-8 text's shingles, sorted."""
    tokens = (text or b"").lower().split()
    if not tokens:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, tokens), np.uint64, len(tokens))
    n = max(1, len(each) - words + 1)
    sums = np.full(n, min(len(each), words), np.uint64)
    for k in range(min(words, len(each))):
        sums += each[k : k + n] * _PLACES[k]
    return np.unique(_mixed(sums))


def signature(found: np.ndarray) -> np.ndarray:
    """The minima of a set, ``BITS`` bits each."""
    least = np.full(_MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), _PART):
        least = np.minimum(least, ((found[at : at + _PART] ^ _FLIPS[:, None]) * _ODD[:, None]).min(1))
    return _mixed(least).astype(np.uint16)


def chunk_keys(signatures: np.ndarray) -> np.ndarray:
    """The keys of each signature: for each chunk and each of its places, that of the chunk without the place."""
    parts = signatures.astype(np.uint64).reshape(-1, CHUNKS, WIDTH) * _JOIN
    without = parts.sum(2, dtype=np.uint64)[:, :, None] - parts
    return _mixed(without.reshape(len(signatures), _MINIMA) + _FLIPS)


def part_keys(found: np.ndarray) -> np.ndarray:
    """The keys of a sorted set's parts: two sets that are linked share at least one.

    Sizes from ``low`` + 1 to 2 * ``low`` are a class; a set that may be linked with larger ones of the next class
    has keys for that class, too.  Parts are in order of their shingles, then of their keys; parts without
    shingles come last.
    """
    n = len(found)
    if n < 4:  # linked only with itself
        return np.zeros(0, np.uint64)
    low, most, made = 1 << (n - 1).bit_length() - 1, 5 * n // 4, []
    each = _mixed(found + _FLIPS[0])
    for least, largest in ((low, min(most, 2 * low)), (2 * low, most)):
        if largest <= least:
            continue
        kept, parts = (n + largest) // 9 + 1, least // 2 + 1
        part = (found >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        starts = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        keys = _mixed(np.add.reduceat(each, starts) + _mixed(part[starts] + np.uint64(least << 32)))
        made.append(keys[np.lexsort((keys, np.diff(np.append(starts, n))))[::-1][:kept]])
        if len(starts) < kept:
            empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part)[::-1][: kept - len(starts)]
            made.append(_mixed(_mixed(empty + np.uint64(least << 32))))
    return np.concatenate(made)


def _as_signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, _MINIMA)


def sliced(batches, rows: int = 512):
    """Batches of fewer rows, so that only their texts' words and shingles are held at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, fingerprint, size, signature) per row; the fingerprint names the set of shingles."""

    def of(batches):
        hashes = Hashes()
        for batch in sliced(batches):
            sets = [shingles(t, hashes, words) for t in batch.column(2).to_pylist()]
            prints = np.fromiter((xxhash.xxh64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets))
            made = [pa.array(prints.view(np.int64)), pa.array([len(s) for s in sets], pa.int32()), pa.array([signature(s).tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], ["doc_id", "text_hash", "fingerprint", "size", "signature"])

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(of, "doc_id long, text_hash long, fingerprint long, size int, signature binary")


def keyed(prints: DataFrame) -> DataFrame:
    """(fingerprint, key): the chunk keys of distinct sets."""

    def of(batches):
        for batch in batches:
            keys = chunk_keys(_as_signatures(batch.column(1).to_pylist())).view(np.int64)
            ends = pa.array(np.arange(0, _MINIMA * batch.num_rows + 1, _MINIMA, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(ends, pa.array(keys.reshape(-1)))], ["fingerprint", "keys"])

    return prints.select("fingerprint", "signature").mapInArrow(of, "fingerprint long, keys array<long>").select("fingerprint", F.explode("keys").alias("key"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near(prints: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes allow a link and whose signatures differ in at most ``FAR`` minima."""

    def of(batches):
        for batch in batches:
            a, b = (_as_signatures(batch.column(i).to_pylist()) for i in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((a != b).sum(1) <= FAR))

    told = lambda side: prints.select(F.col("fingerprint").alias(side), F.col("size").alias(f"size_{side}"), F.col("signature").alias(f"sig_{side}"))
    sized = pairs.join(told("a"), "a").join(told("b"), "b").where("5 * least(size_a, size_b) >= 4 * greatest(size_a, size_b)")
    return sized.select("a", "b", "sig_a", "sig_b").mapInArrow(of, "a long, b long")


def full_sets(docs: DataFrame, rows: DataFrame, needed: DataFrame, words: int) -> DataFrame:
    """(fingerprint, shingles) for the fingerprints ``needed``, each from one row's text."""

    def of(batches):
        hashes = Hashes()
        for batch in sliced(batches):
            found = [shingles(t, hashes, words) for t in batch.column(0).to_pylist()]
            named = [xxhash.xxh64_intdigest(s.tobytes()) for s in found]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(named, np.uint64).view(np.int64)), pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], ["fingerprint", "shingles"])

    # two hashes name a row, so that many copies of a text are not sent to one task
    one = F.min(F.struct(F.xxhash64("doc_id").alias("id_hash"), "text_hash")).alias("one")
    wanted = cut(rows.groupBy("fingerprint").agg(one).join(needed, "fingerprint", "left_semi").select("one.*"))
    row_hash = F.xxhash64("id_hash", "text_hash")
    whole = docs.select(F.xxhash64(F.col("doc_id").cast("long")).alias("id_hash"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text")).withColumn("row_hash", row_hash)
    # most texts have no candidate and are not shuffled
    whole = maybe_among(whole, "row_hash", wanted.select(row_hash.alias("key"))).where("maybe")
    return whole.join(wanted, ["id_hash", "text_hash"], "left_semi").dropDuplicates(["id_hash", "text_hash"]).select("text").mapInArrow(of, "fingerprint long, shingles array<long>")


def verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets have a similarity of 0.8 or more."""
    listed = lambda side: held.select(F.col("fingerprint").alias(side), F.col("shingles").alias(f"of_{side}"))
    both = pairs.join(listed("a"), "a").join(listed("b"), "b").withColumn("shared", F.size(F.array_intersect("of_a", "of_b")))
    # shared / (sum of sizes - shared) >= 4 / 5
    return cut(both.where("9L * shared >= 4L * (size(of_a) + size(of_b))").select("a", "b"))


def shared_counts(left: np.ndarray, sizes: np.ndarray, right: np.ndarray, other_sizes: np.ndarray) -> np.ndarray:
    """The shingles that each set on the left shares with each on the right; the sets' shingles stand one set after the other.

    Shingles of at most ``RARE`` of these sets are counted pair by pair, the others as columns of a product.
    """
    both, shape = np.intersect1d(left, right), (len(sizes), len(other_sizes))
    shared = np.zeros(shape, np.int64)
    if not len(both):
        return shared

    def held_by(shingles, sizes):
        at = np.minimum(np.searchsorted(both, shingles), len(both) - 1)
        found = np.flatnonzero(both[at] == shingles)
        found = found[np.argsort(at[found], kind="stable")]
        return at[found], np.repeat(np.arange(len(sizes)), sizes)[found], np.bincount(at[found], minlength=len(both))

    (a, sets, n), (b, others, n_others) = held_by(left, sizes), held_by(right, other_sizes)
    rare, first = n + n_others <= RARE, np.cumsum(n_others) - n_others
    few, few_sets = a[rare[a]], sets[rare[a]]
    ends, at = np.cumsum(n_others[few]), 0
    while at < len(few):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + _AT_ONCE, "right")))
        times = n_others[few[at:to]]
        meets = np.repeat(first[few[at:to]] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        shared += np.bincount(np.repeat(few_sets[at:to], times) * shape[1] + others[meets], minlength=shared.size).reshape(shape)
        at = to
    common = np.flatnonzero(~rare)
    for at in range(0, len(common), _COLUMNS):
        column = np.full(len(both), -1)
        column[common[at : at + _COLUMNS]] = np.arange(len(common[at : at + _COLUMNS]))

        def holds(shingles, rows, n_rows, column=column):
            matrix = np.zeros((n_rows, column.max() + 1), np.float32)
            matrix[rows[column[shingles] >= 0], column[shingles][column[shingles] >= 0]] = 1
            return matrix

        shared += (holds(a, sets, shape[0]) @ holds(b, others, shape[1]).T).astype(np.int64)
    return shared


def joining(labels: np.ndarray, other_labels: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Of the places that are true in ``linked``, as few as join the same labels."""
    i, j = np.nonzero(linked)
    first = np.unique(np.stack([labels[i], other_labels[j]]), axis=1, return_index=True)[1]
    root: dict[int, int] = {}

    def top(x):
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    found = []
    for at in first.tolist():
        x, y = top(int(labels[i[at]])), top(int(other_labels[j[at]]))
        if x != y:
            root[x] = y
            found.append((int(i[at]), int(j[at])))
    return found


def in_blocks(members: DataFrame, carried: DataFrame, of) -> DataFrame:
    """(a, b) pairs that ``of`` finds in blocks of large groups: ``members`` (key, fingerprint, size, label) of one key whose labels differ.

    The sets outside a group's largest component meet all of the group, a block with a block; ``of`` takes both sides' rows
    with the columns of ``carried``, and gives their places.
    """
    counts = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    largest = F.max(F.struct("n", "label", "size")).alias("main")
    mixed = counts.groupBy("key").agg(largest, F.sum("n").alias("n"), F.sum("size").alias("size"), F.count(F.lit(1)).alias("n_labels")).where("n_labels > 1")
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / SHINGLES))
    parts = mixed.select("key", F.col("main.label").alias("main"), blocks(F.col("n") - F.col("main.n"), F.col("size") - F.col("main.size")).alias("n_outside"), blocks(F.col("n"), F.col("size")).alias("n_all"))
    each = cut(members.drop("size").join(parts, "key"))
    own = lambda n: F.pmod(F.xxhash64("fingerprint"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    outside = each.where("label != main").select("key", own("n_outside").alias("i"), every("n_all").alias("j"), F.lit(True).alias("outside"), "fingerprint", "label")
    everyone = each.select("key", every("n_outside").alias("i"), own("n_all").alias("j"), F.lit(False).alias("outside"), "fingerprint", "label")

    def pairs(block: pa.Table) -> pa.Table:
        left, right = (block.filter(pa.compute.equal(block.column("outside"), outside)).combine_chunks() for outside in (True, False))
        i, j = of(left, right)
        return pa.table([left.column("fingerprint").take(pa.array(i, pa.int64())), right.column("fingerprint").take(pa.array(j, pa.int64()))], ["a", "b"])

    placed = outside.union(everyone).join(carried, "fingerprint")
    return _ordered(placed.groupBy("key", "i", "j").applyInArrow(pairs, "a long, b long"))


def between_components(members: DataFrame, held: DataFrame) -> DataFrame:
    """(a, b) links of large groups that join components: ``members`` (key, fingerprint, size, label) of one key whose labels differ.

    A block's links are counted where full sets meet, and only as many become rows as join its components.
    """

    def of(left, right):
        side = lambda rows: (rows.column("label").to_numpy(), (lists := rows.column("shingles").combine_chunks()).flatten().to_numpy(), lists.value_lengths().to_numpy())
        (labels, own, sizes), (other_labels, others, other_sizes) = side(left), side(right)
        # shared / (sum of sizes - shared) >= 4 / 5
        linked = 9 * shared_counts(own, sizes, others, other_sizes) >= 4 * (sizes[:, None].astype(np.int64) + other_sizes)
        found = joining(labels, other_labels, linked & (labels[:, None] != other_labels))
        return [i for i, _ in found], [j for _, j in found]

    return in_blocks(members, held, of)


def parity(found: np.ndarray) -> bytes:
    """Whether a set has an odd number of shingles in each of four to eight places a shingle; a power of two, one byte at least."""
    places = 8 << max(0, (len(found) - 1).bit_length() - 1)
    return np.packbits(np.bincount((found & np.uint64(places - 1)).astype(np.int64), minlength=places).astype(np.uint8) & 1, bitorder="little").tobytes()


def _bits(parities: list[bytes], width: int) -> np.ndarray:
    """Parities of ``width`` bytes, a row each; longer ones are folded."""
    folded = [np.bitwise_xor.reduce(np.frombuffer(p, np.uint8).reshape(-1, width)) for p in parities]
    return np.unpackbits(np.stack(folded), axis=1).astype(np.float32)


def least_differing(parities: list[bytes], others: list[bytes]) -> np.ndarray:
    """For each set and each of the others, a number of shingles by which they differ at least."""
    width = min(map(len, parities + others))
    a, b = _bits(parities, width), _bits(others, width)
    return a.sum(1)[:, None] + b.sum(1) - 2 * (a @ b.T)


def parities(held: DataFrame) -> DataFrame:
    """(fingerprint, size, parity) of full sets."""

    def of(batches):
        for batch in sliced(batches):
            sets = [np.asarray(x.values).view(np.uint64) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(s) for s in sets], pa.int32()), pa.array([parity(s) for s in sets], pa.binary())], ["fingerprint", "size", "parity"])

    return held.select("fingerprint", "shingles").mapInArrow(of, "fingerprint long, size int, parity binary")


def may_be_linked(pairs: DataFrame, told: DataFrame) -> DataFrame:
    """The pairs (a, b) whose parities allow a link."""

    def of(batches):
        for batch in batches:
            a, b = batch.column("parity_a").to_pylist(), batch.column("parity_b").to_pylist()
            least = [least_differing([x], [y])[0, 0] for x, y in zip(a, b)]
            sizes = batch.column("size_a").to_numpy() + batch.column("size_b").to_numpy()
            yield batch.select(["a", "b"]).filter(pa.array(9 * np.array(least) <= sizes, pa.bool_()))

    side = lambda x: told.select(F.col("fingerprint").alias(x), F.col("size").alias(f"size_{x}"), F.col("parity").alias(f"parity_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(of, "a long, b long")


def may_be_linked_in_groups(members: DataFrame, told: DataFrame) -> DataFrame:
    """The pairs (a, b) of large groups whose labels differ and whose parities allow a link."""

    def of(left, right):
        side = lambda rows: (rows.column("label").to_numpy(), rows.column("size").to_numpy(), rows.column("parity").to_pylist())
        (labels, sizes, own), (other_labels, other_sizes, others) = side(left), side(right)
        if not own or not others:
            return [], []
        return np.nonzero((9 * least_differing(own, others) <= sizes[:, None] + other_sizes) & (labels[:, None] != other_labels))

    return in_blocks(members, told, of)


def parted(docs: DataFrame, words: int) -> DataFrame:
    """(fingerprint, size, parts) per row whose set may be linked with another; ``parts`` are its part keys."""

    def of(batches):
        hashes = Hashes()
        for batch in sliced(batches):
            sets = [s for s in (shingles(t, hashes, words) for t in batch.column(0).to_pylist()) if len(s) > 3]
            prints = np.fromiter((xxhash.xxh64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets))
            yield pa.RecordBatch.from_arrays([pa.array(prints.view(np.int64)), pa.array([len(s) for s in sets], pa.int32()), pa.array([part_keys(s).view(np.int64) for s in sets], pa.list_(pa.int64()))], ["fingerprint", "size", "parts"])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(of, "fingerprint long, size int, parts array<long>")


def missed(docs: DataFrame, rows: DataFrame, linked: DataFrame, words: int) -> DataFrame:
    """(a, b) links that join components of ``linked``; sets that are linked share a part key, so that none is lost."""
    named, _ = stored(components(linked))
    label = F.coalesce("label", "fingerprint").alias("label")
    keys = parted(docs, words).join(named, F.col("fingerprint") == F.col("node"), "left").select(label, F.explode("parts").alias("key"))
    mixed, _ = stored(keys.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a != b").select("key"))
    # the keys are made again, which takes less than to keep them
    again = parted(docs, words).select("fingerprint", "size", F.explode("parts").alias("key"))
    held_by = maybe_among(again, "key", mixed).where("maybe").select("key", "fingerprint", "size").distinct()
    members = cut(held_by.join(mixed, "key").join(named, F.col("fingerprint") == F.col("node"), "left").select("key", "fingerprint", "size", label))
    members = members.join(members.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "key")
    side = lambda x: members.where(F.col("n") <= FEW).select("key", *[F.col(c).alias(f"{c}_{x}") for c in ("size", "label")], F.col("fingerprint").alias(x))
    pairs = cut(side("a").join(side("b"), "key").where("a < b AND label_a != label_b AND 5 * least(size_a, size_b) >= 4 * greatest(size_a, size_b)").select("a", "b").distinct())
    many = members.where(F.col("n") > FEW).drop("n")
    needed = pairs.select(F.col("a").alias("fingerprint")).union(pairs.select("b")).union(many.select("fingerprint")).distinct()
    held = cut(full_sets(docs, rows, needed, words))
    told = cut(parities(held))
    return verified(cut(may_be_linked(pairs, told).union(may_be_linked_in_groups(many, told)).distinct()), held)


def links(docs: DataFrame, rows: DataFrame, words: int = WORDS) -> DataFrame:
    """(a, b) pairs of distinct sets that connect all that are linked."""
    prints = cut(rows.where("size > 0").select("fingerprint", "size", "signature").dropDuplicates(["fingerprint"]))
    keys = keyed(prints)
    groups = cut(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fingerprint").alias("a"), F.max("fingerprint").alias("b")).where("n > 1"))
    more = groups.where("n > 2").select("key", "n")
    # keys of one or two sets are not shuffled again
    members = cut(maybe_among(keys, "key", more.select("key")).where("maybe").drop("maybe").join(more, "key"))
    few = members.where(F.col("n") <= PAIRED)
    paired = few.select("key", F.col("fingerprint").alias("a")).join(few.select("key", F.col("fingerprint").alias("b")), "key").where("a < b")
    many = members.where(F.col("n") > PAIRED).select("key", "fingerprint")
    met = many.groupBy("fingerprint").agg(F.count(F.lit(1)).alias("met"))
    hubs = many.join(met, "fingerprint").groupBy("key").agg(F.max(F.struct("met", F.xxhash64("fingerprint").alias("h"), F.col("fingerprint").alias("b"))).alias("hub")).select("key", "hub.b")
    with_hub = many.join(hubs, "key").select(F.col("fingerprint").alias("a"), "b")
    pairs = cut(near(prints, _ordered(groups.where("n = 2").select("a", "b").union(paired.select("a", "b")).union(with_hub))))
    needed = pairs.select(F.col("a").alias("fingerprint")).union(pairs.select("b")).union(met.select("fingerprint")).distinct()
    held = cut(full_sets(docs, rows, needed, words))
    linked = verified(pairs, held)
    if many.isEmpty():
        return linked.union(missed(docs, rows, linked, words))
    labels = met.select("fingerprint").join(components(linked).withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select("fingerprint", F.coalesce("label", "fingerprint").alias("label"))
    sized = labels.join(prints.select("fingerprint", "size"), "fingerprint")
    linked = linked.union(cut(between_components(many.join(sized, "fingerprint"), held)))
    return linked.union(missed(docs, rows, linked, words))


def link(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """A row per document: doc_id, text_hash, n_shingles, component_id, kept (it names its component)."""
    rows = cut(sketches(docs, words))
    held = rows.where("size > 0").groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    found = components(links(docs, rows, words))
    labelled = held.join(found, held.fingerprint == found.node, "left").select("fingerprint", "least", F.coalesce("label", "fingerprint").alias("label"))
    ids = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    by_print = labelled.join(ids, "label").select("fingerprint", "component_id")
    alone = rows.where("size = 0").withColumn("component_id", F.col("doc_id"))
    both = rows.where("size > 0").join(by_print, "fingerprint").select(*alone.columns).union(alone)
    return both.select("doc_id", "text_hash", F.col("size").cast("long").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")
