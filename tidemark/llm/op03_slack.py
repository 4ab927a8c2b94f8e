"""Packing by minimum bin slack.

Documents become token ids plus one end id; a document longer than a window is
cut into full windows and a rest.  What is left to pack are rests of 1 to
``window - 1`` tokens, and only the count of each length matters: a histogram of
at most ``window`` rows, whatever the corpus.  For the longest length left, a
bitset subset-sum over the multiset of the other lengths finds the sum closest
to the room that remains; walking the bitsets back gives how many of each length
make that sum, and the pattern is used as often as the counts allow.

The patterns are a table too (bounded by the window, not by the corpus).  Pieces
are numbered within their length, in salted parts so that a length that holds a
third of all rows spreads out, and a piece's number names its pattern, its
sequence and its offset.

The ids are those of the named JSON tokenizer at its default settings: the
literal of an added token, as <|endoftext|>, is that token.  A very long text is
encoded whole and cut into windows.

Defined cases: a null or empty text is the end id alone; repeated rows and equal
texts are separate pieces; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from struct import pack as pack_ids

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table

END_ID = 1
#: Rows of one length and salt, about; at least SALTS salts.
ROWS_PER_SALT, SALTS = 50_000, 256
#: Words whose ids a worker remembers.
REMEMBERED = 800_000

_PARTS = regex.compile(r"(?<=\S)(?= \S)")
#: White space other than the space and the line feed.
_RARE = re.compile(r"[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it is printable, else one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class _Words(dict):
    """The ids of words met before, as little-endian unsigned 32-bit numbers.

    They come from the ranks of the tokenizer's vocabulary, which encode a lone
    word without the offsets that the JSON tokenizer makes as well.
    """

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path) as file:
            told = json.load(file)
        model, before, added = told["model"], told["pre_tokenizer"] or {}, told["added_tokens"]
        letters, vocabulary = byte_letters(), told["model"].get("vocab", {})
        merged = [m if isinstance(m, str) else "".join(m) for m in model.get("merges", [])]
        in_order = model["type"] == "BPE" and [vocabulary[m.replace(" ", "")] for m in merged] == [*range(256, 256 + len(merged))]
        if not in_order or told["normalizer"] or (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) != ("ByteLevel", False, True):
            raise ValueError("a byte-level vocabulary in the order of its merges is asked for")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added):
            raise ValueError("added tokens must match as they are")
        ranks = {bytes(map(letters.__getitem__, piece)): rank for piece, rank in vocabulary.items()}
        self.encode = tiktoken.Encoding("byte_level", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.added = {t["content"]: pack_ids("<I", t["id"]) for t in added}
        # the longest of those that begin at a place; none at all never matches
        self.split = re.compile("(" + ("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or "(?!)") + ")").split

    def __missing__(self, part: str) -> bytes:
        found = self.encode(part)
        ids = pack_ids(f"<{len(found)}I", *found)
        if len(self) < REMEMBERED and len(part) < 64:
            self[part] = ids
        return ids


@lru_cache(1)
def words_of(path: str) -> _Words:
    return _Words(path)


def ordinary_ids(text: str, words: _Words) -> bytes:
    """The ids of ``text`` without an added token.  Where one space stands between two words the tokenizer always splits before it."""
    if "  " in text or " \n" in text or "\n " in text or _RARE.search(text):
        parts = _PARTS.split(text)
    else:
        first, *rest = text.split(" ")
        parts = [first, *[" " + p for p in rest]]
    return b"".join(map(words.__getitem__, parts))


def token_ids(text: str, words: _Words) -> bytes:
    """The ids of ``text`` as the tokenizer gives them: its added tokens, found first, and what stands between them."""
    if not any(token in text for token in words.added):
        return ordinary_ids(text, words)
    parts = words.split(text)
    return b"".join(words.added[part] if i % 2 else ordinary_ids(part, words) for i, part in enumerate(parts))


def pieces(docs: DataFrame, window: int = 2048, path: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): windows of each document's ids."""
    path = path or tokenizer_path()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = words_of(path)
        if len(words) >= REMEMBERED:  # frequent words are met early and stay for the whole task
            words.clear()
        end, step = np.array([END_ID], "<u4").tobytes(), 4 * window
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = token_ids(text or "", words) + end
                n = len(ids) // 4
                rows += [(doc_id, at // 4, min(step, len(ids) - at) // 4, zlib.crc32(ids[at : at + step]), n) for at in range(0, len(ids), step)]
            columns = zip(*rows) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def best_fill(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of ``counts``' lengths whose sum is the greatest not over ``room``.

    One bitset per (length, power-of-two batch) says which sums are reachable;
    the walk back takes a batch just where the sum isn't reachable without it.
    """
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        left, batch = min(counts[length], room // length), 1
        while left > 0:
            take = min(batch, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & full
            left -= take
            batch *= 2
        if reach >> room & 1:
            break
    at, used = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + take
            at -= length * take
    return used


def plan(histogram: dict[int, int], window: int = 2048) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(first sequence, how many times, [(length, how often in each)]) until no length is left."""
    left = {k: n for k, n in histogram.items() if n}
    sequence = 0
    while left:
        longest = max(left)
        left[longest] -= 1
        used = best_fill({k: n for k, n in left.items() if n}, window - longest)
        left[longest] += 1
        used[longest] = used.get(longest, 0) + 1
        times = min(left[k] // n for k, n in used.items())
        yield sequence, times, sorted(used.items(), reverse=True)
        sequence += times
        for k, n in used.items():
            left[k] -= times * n
            if not left[k]:
                del left[k]


def _slots(histogram: dict[int, int], window: int) -> np.ndarray:
    """A row for each pattern and length: length, first number, how often, offset in the sequence, first sequence."""
    numbered = dict.fromkeys(histogram, 0)
    rows = []
    for sequence, times, used in plan(histogram, window):
        offset = 0
        for length, n in used:
            rows.append((length, numbered[length], n, offset, sequence))
            numbered[length] += times * n
            offset += length * n
    rows.sort()
    return np.array(rows, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, window: int = 2048, path: str | None = None) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    salt = F.xxhash64("doc_id", "start", "ids_crc32")
    cut_up = cut(pieces(docs, window, path))
    total = cut_up.count()
    salts = max(SALTS, total // ROWS_PER_SALT)
    salted = cut_up.withColumn("salt", F.pmod(salt, F.lit(salts)))
    sizes = salted.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
    bases = sizes.select("length", "salt", before.alias("base"))
    # at most ``window`` rows reach the driver
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(histogram, window))

    within = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("within", within).join(bases, ["length", "salt"])
    numbered = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + F.col("within")).alias("number"))

    def place(batches):
        rows = slots.value
        firsts = rows[:, 0] << 48 | rows[:, 1]
        for batch in batches:
            length, number = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            slot = rows[np.searchsorted(firsts, length << 48 | number, "right") - 1]
            times, which = np.divmod(number - slot[:, 1], slot[:, 2])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(slot[:, 4] + times), pa.array(slot[:, 3] + which * length)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return numbered.mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def query(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
