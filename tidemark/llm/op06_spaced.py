"""Benchmark decontamination by spaced-seed hashing.

A mask is a pattern over ``SPAN`` successive words of which some are ignored;
the others are hashed.  Every mask is laid on every place of the benchmark items
and of the documents.  Where hashes meet, the words within ``AROUND`` of the hit
are compared one by one, so that substituted words do not break an overlap: a
document and an item overlap if at least ``LEAST`` of them agree (or, for a short
item, ``SHARE`` of its words).  The masks ignore pairs of words three and four
apart, so that a word changed every third to ninth place leaves hits.  An item of
``FEWEST`` to ``SPAN - 1`` words is sought as a whole, without ignored words.
All places where an item repeats a seed count; those whose surroundings are
equal are compared once.

Words are the lower-cased alphanumeric ones.  If the benchmark has at most
``BROADCAST_SEEDS`` seeds, they and the items are broadcast: hashing, join and
comparison take place in the scan's own stage.  The hits of a larger benchmark
are found first: a bitmap of its seeds, of a fixed size, drops most of the
documents' seeds, the others are joined by a shuffle of numbers alone, and only
the stretches around hits are cut out of the texts and shuffled.

Defined cases: null texts have no words; items of fewer than ``FEWEST`` words
stand in clean texts by chance and are no evidence; an item held twice is
reported for each item_id; equal rows are reported once; a very long text is
searched whole; no hit, or an empty table: no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import alnum_words, cut, same_row, table

#: Which of SPAN words are hashed.
MASKS = ("11011011", "11101101", "10110111", "11011101")
SPAN, FEWEST = 8, 4
AROUND = 8
LEAST, SHARE = 12, 0.85
BROADCAST_SEEDS = 2_000_000
BROADCAST_HITS = 500_000
#: Words of 64 bits in the bitmap of a large benchmark's seeds.
_BITMAP_BITS = 22


def seeds(words: Column, pos: Column, masks) -> Column:
    """The hashes of all masks at ``pos`` that end within ``words``; the first value hashed is the mask itself."""
    at = lambda mask: [F.get(words, pos + i) for i, bit in enumerate(mask) if bit == "1"]
    return F.array(*[F.when(pos + len(mask) <= F.size(words), F.xxhash64(F.lit(mask), *at(mask))) for mask in masks])


def _places(rows: DataFrame, masks) -> DataFrame:
    """The columns of ``rows`` with a row for each place ``pos`` and mask, with its ``seed``."""
    least = min(map(len, masks))
    each = rows.select("*", F.posexplode_outer("words").alias("pos", "word")).where(F.col("pos") + least <= F.size("words")).drop("word")
    return each.select("*", F.explode(seeds(F.col("words"), F.col("pos"), masks)).alias("seed")).where("seed IS NOT NULL")


def _since() -> Column:
    return F.greatest(F.col("pos") - AROUND, F.lit(0))


def _around() -> Column:
    """The words around ``pos``: only these go on from a hit, not the whole text."""
    return F.slice("words", _since() + 1, SPAN + 2 * AROUND)


def _hits_first(words: DataFrame, found: DataFrame, by_seed: DataFrame) -> DataFrame:
    """The places of ``found`` that share a seed with the benchmark, with the words around them, as (doc_id, text_hash, pos, since, around, entries)."""
    word, bit = F.shiftrightunsigned("seed", 64 - _BITMAP_BITS), F.expr("shiftleft(1L, int(seed & 63))")
    # 2 ** _BITMAP_BITS rows of two numbers at most, however large the benchmark
    bitmap = by_seed.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    numbers = found.select("doc_id", "text_hash", "pos", "seed", word.alias("word"))
    likely = numbers.join(F.broadcast(bitmap), "word").where(F.col("bits").bitwiseAND(bit) != 0).select("doc_id", "text_hash", "pos", "seed")
    shared = cut(likely.distinct().join(by_seed.select("seed"), "seed", "left_semi"))
    # only documents with a hit, and of these only the stretches around hits, go on
    wanted = shared.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("pos", "seed")).alias("wanted"))
    once = words.alias("words").join(wanted.alias("wanted"), same_row("words", "wanted")).select("words.*", "wanted.wanted")
    stretches = once.select("doc_id", "text_hash", "words", F.inline("wanted")).select("doc_id", "text_hash", "pos", "seed", _since().alias("since"), _around().alias("around")).distinct()
    return stretches.join(by_seed, "seed").drop("seed")


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text_hash, item_id, start_word, matched, compared, item_words): one row for each document and item.

    ``start_word`` is where the first overlap would have the item start, which may
    lie before the text; ``matched`` is the most that agrees around one hit.
    """
    items = benchmark.select("item_id", alnum_words(F.col("text")).alias("words")).distinct().where(F.size("words") >= FEWEST)
    items = items.select("item_id", "words", F.xxhash64("item_id", "words").alias("item"))
    sizes = items.agg(F.sum(F.size("words")).alias("n"), F.collect_set(F.when(F.size("words") < SPAN, F.size("words"))).alias("short")).first()
    short = ["1" * n for n in sorted(sizes["short"])]  # SPAN - FEWEST lengths at most
    masked = _places(items.where(F.size("words") >= SPAN), MASKS)
    for mask in short:
        masked = masked.unionByName(_places(items.where(F.size("words") == len(mask)), [mask]))
    surroundings = F.xxhash64(F.least(F.col("pos"), F.lit(AROUND)), _around())
    places = masked.groupBy("seed", "item", surroundings.alias("like")).agg(F.max("pos").alias("at"))
    by_seed = places.groupBy("seed").agg(F.collect_list(F.struct("item", "at")).alias("entries"))
    texts = items.select("item", "item_id", F.col("words").alias("item_text"))

    # counting the words bounds both tables; the benchmark is not the corpus
    small = len(MASKS) * (sizes["n"] or 0) <= BROADCAST_SEEDS
    near = F.broadcast if small else (lambda x: x)

    words = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), alnum_words(F.col("text")).alias("words"))
    found = _places(words, [*MASKS, *short])
    if small:
        hits = found.join(F.broadcast(by_seed), "seed").select("doc_id", "text_hash", "pos", _since().alias("since"), _around().alias("around"), "entries")
    else:
        hits = _hits_first(words, found, by_seed)
    each = hits.select("doc_id", "text_hash", "pos", "since", "around", F.inline("entries"))
    # the stretch of both texts: as far before the hit as both go, and as far after it
    before = F.least(F.col("pos") - F.col("since"), F.col("at"))
    length = before + SPAN + AROUND
    stretches = each.join(near(texts), "item").select(
        "doc_id", "text_hash", "item_id",
        F.size("item_text").alias("item_words"),
        (F.col("pos") - F.col("at")).alias("diagonal"),
        F.slice("around", F.col("pos") - F.col("since") - before + 1, length).alias("mine"),
        F.slice("item_text", F.col("at") - before + 1, length).alias("theirs"),
    )
    agree = F.filter(F.zip_with("mine", "theirs", lambda a, b: F.coalesce(a == b, F.lit(False))), lambda x: x)
    compared = F.least(F.size("mine"), F.size("theirs"))
    # naming the stretches twice in one column keeps their projection apart from this one, which is
    # interpreted: so the rows that go from one to the other carry stretches and not whole texts
    matched = F.least(F.size(agree), compared)
    compared = stretches.select("doc_id", "text_hash", "item_id", "item_words", "diagonal", matched.alias("matched"), compared.alias("compared"))
    enough = F.col("matched") >= F.least(F.lit(LEAST), F.ceil(SHARE * F.col("item_words")))
    # tested after the aggregation: a filter before it would be moved into the join and compare whole texts' rows there
    best = compared.groupBy("doc_id", "text_hash", "item_id").agg(F.max("matched").alias("matched"), F.max("item_words").alias("item_words"), F.min(F.when(enough, F.col("diagonal"))).alias("diagonal"), F.max("compared").alias("compared"))
    found = best.where("diagonal IS NOT NULL")
    return found.select("doc_id", "text_hash", "item_id", F.col("diagonal").cast("long").alias("start_word"), F.col("matched").cast("long").alias("matched"), F.col("compared").cast("long").alias("compared"), F.col("item_words").cast("long").alias("item_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text overlaps a benchmark item."""
    hit = cut(overlaps(docs, benchmark).select("doc_id", "text_hash").distinct())
    # two numbers for each document that is hit: few of them are broadcast, many are joined by a shuffle
    hit = F.broadcast(hit) if hit.count() <= BROADCAST_HITS else hit
    whole = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.alias("whole").join(hit.alias("hit"), same_row("whole", "hit"), "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_hash")
