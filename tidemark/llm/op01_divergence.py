"""Quality rules with distribution divergence.

Base: counts of words, symbols, repeated lines and repeated word triples, and
two limits on them.  Method: a document's histogram of character classes and its
histogram of common words are held against those of each language, by the
Jensen-Shannon distance (the square root of the divergence in bits).

The references are counts over all documents that name a language: first the
common words, found as those that reach ``HEAVY`` of the words in some part of
the corpus (so that every word that frequent over the corpus is among them), of
which the ``COMMON`` most frequent count; then their exact counts, all other
words being one more bin, and the counts of character classes.  These tables are
bounded by languages, classes and common words.

A document fails if it is as far as ``FAR_CLASSES`` or ``FAR_WORDS`` from the
nearest language's reference.  Small samples are far from anything by chance: the
divergence that is expected of a sample of its size is taken off first, so that
even a text without one common word of a language is less far the shorter it is,
and ``UNKNOWN`` of that distance is far enough.  A document of fewer than
``LEAST_WORDS`` words is not judged by the method.

Defined cases: a null text has no words and fails the base; without any
reference the method accepts; repeated rows and repeated ids are judged alike; a
very long text is counted whole; equally frequent common words are taken in the
order of their bytes.  More than ``MOST_LANGS`` languages are refused with an
error, as then the column is no language.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import cut, table

MIN_WORDS, MAX_REPEATED = 50, 0.5
LEAST_WORDS = 50
COMMON, HEAVY = 120, 1e-3
FAR_CLASSES, FAR_WORDS = 0.28, 0.28
#: A short text can't be that far: this share of the distance of one without any common word will do.
UNKNOWN = 0.9
LEAST_DOCS = 20
MOST_LANGS = 1_000
#: Words that reach ``HEAVY`` in some part of the corpus, at most; counted exactly in every task.
MOST_CANDIDATES = 2_000_000
#: Words of a part of the corpus that are counted before it is written out.
_PART = 200_000

#: Those outside ASCII by what their UTF-8 begins with: Latin letters, other letters of two bytes, of three, and four bytes.
CLASSES = ("lower", "upper", "digit", "space", "sentence", "mark", "other", "latin", "two", "three", "four")
_CLASS = np.full(256, len(CLASSES), np.uint8)
_CLASS[:128] = 6
_CLASS[0xC0:0xCA], _CLASS[0xCA:0xE0], _CLASS[0xE0:0xF0], _CLASS[0xF0:] = 7, 8, 9, 10
for _chars, _k in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2), (" \t\n\r\x0b\x0c", 3), (".,;:?'\"-()", 4), ("#*$%&|<>!@^_+=/\\~`[]{}", 5)):
    _CLASS[[ord(c) for c in _chars]] = _k
_SYMBOLS = b"#*$%&|<>"
_OTHERS = bytes(c for c in range(256) if c not in _SYMBOLS)
#: Lower-cased, and without the marks that end a sentence or clause.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else 32 if chr(c) in ".,;:?'\"()" else c for c in range(256))


def class_counts(text: bytes) -> np.ndarray:
    """Characters by class; the bytes that continue a character don't count."""
    return np.bincount(_CLASS[np.frombuffer(text, np.uint8)], minlength=len(CLASSES) + 1)[:-1].astype(float)


def plain_words(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def base_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a UTF-8 text."""
    words = text.split()
    joined = b"".join(words)
    chars = len(joined) - int(np.count_nonzero((np.frombuffer(joined, np.uint8) & 0xC0) == 0x80))
    symbols = len(text.translate(None, _OTHERS))
    lines = [line for line in text.split(b"\n") if line.split()]
    repeated = 0
    triples = [*zip(words, words[1:], words[2:])]
    if len(set(triples)) < len(triples):
        times = Counter(triples)
        last = -1  # words before this place are counted
        for i, t in enumerate(triples):
            if times[t] > 1:
                repeated += i + 3 - max(i, last)
                last = i + 3
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated


def _contribution(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """What a bin of shares p and q adds to the Jensen-Shannon divergence, in bits."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        return (np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)) / 2


def expected_divergence(q: np.ndarray, n: float) -> float:
    """What a sample of ``n`` from the shares ``q`` is expected to diverge from them.

    The expectation is the sum of the bins'; a bin's count is near to a Poisson
    one, which is summed where few are expected, and else near to a normal one.
    """
    q = q[q > 0]
    few = q[n * q < 40]
    k = np.arange(120)
    log_k = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, 120)))])
    odds = np.exp(k * np.log(n * few)[:, None] - (n * few)[:, None] - log_k)
    return float((odds * _contribution(k / n, few[:, None])).sum() + (1 - q[n * q >= 40]).sum() / (8 * np.log(2) * n))


def divergence(counts: np.ndarray, reference: np.ndarray, chance) -> np.ndarray:
    """The Jensen-Shannon distance of one histogram from each row of ``reference``, less what its size makes likely by ``chance(n)``."""
    n = counts.sum()
    if not n:
        return np.ones(len(reference))
    js = _contribution(counts / n, reference / reference.sum(1, keepdims=True)).sum(1)
    return np.sqrt(np.maximum(js - chance(n), 0))


class Chance:
    """``expected_divergence`` of each row of shares, tabled by size."""

    SIZES = np.unique(np.geomspace(1, 2_000_000, 60).round())

    def __init__(self, reference: np.ndarray):
        shares = reference / np.maximum(reference.sum(1, keepdims=True), 1)
        self.tabled = np.array([[np.log(max(expected_divergence(q, n), 1e-12)) for n in self.SIZES] for q in shares]).reshape(len(shares), len(self.SIZES))

    def __call__(self, n: float) -> np.ndarray:
        return np.exp([np.interp(np.log(n), np.log(self.SIZES), row) for row in self.tabled])


class References:
    """Reference histograms by language, in order of its name."""

    def __init__(self, classes: np.ndarray, words: list[bytes], counts: np.ndarray):
        self.classes, self.counts = classes, counts
        self.by_class, self.by_word = Chance(classes), Chance(counts)
        self.bins = {w: i for i, w in enumerate(words)}
        self.unknown = _contribution(np.eye(counts.shape[1])[-1], counts / np.maximum(counts.sum(1, keepdims=True), 1)).sum(1)

    def histogram(self, words: list[bytes]) -> np.ndarray:
        out = np.zeros(len(self.bins) + 1)
        for word, n in Counter(words).items():
            out[self.bins.get(word, -1)] += n
        return out

    def verdict(self, text: bytes) -> tuple[float, float, bool]:
        """The distances from the nearest language by classes and by words, and whether one is far."""
        if not len(self.classes):
            return 0.0, 0.0, False
        words = plain_words(text)
        by_class = divergence(class_counts(text), self.classes, self.by_class)
        by_word = divergence(self.histogram(words), self.counts, self.by_word)
        nearest = np.argmin(by_class / FAR_CLASSES + by_word / FAR_WORDS)
        unknown = np.sqrt(max(self.unknown[nearest] - self.by_word(max(len(words), 1))[nearest], 0))
        far = by_class[nearest] >= FAR_CLASSES or by_word[nearest] >= min(FAR_WORDS, UNKNOWN * unknown) > 0
        return float(by_class[nearest]), float(by_word[nearest]), bool(far)


def references(docs: DataFrame) -> References:
    named = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", F.col("text").cast("binary").alias("text"))
    # one row for each language
    langs = [r["lang"] for r in named.groupBy("lang").count().where(F.col("count") >= LEAST_DOCS).select("lang").take(MOST_LANGS + 1)]
    if len(langs) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} values of lang")
    langs.sort()

    def heavy(batches):
        found, sizes = {}, Counter()

        def part():
            rows = [(lang, w, n) for lang, words in found.items() for w, n in words.items() if n >= HEAVY * sizes[lang]]
            found.clear(), sizes.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(text)
                found.setdefault(lang, Counter()).update(words)
                sizes[lang] += len(words)
                if sum(map(len, found.values())) > _PART:
                    yield part()
        yield part()

    # a part has at most 1 / HEAVY words for each language; a word that is so frequent over all is so in some part
    partial = named.where(F.col("lang").isin(langs)).mapInArrow(heavy, "lang string, word binary, n long").select("word").distinct()
    found = [bytes(r["word"]) for r in partial.take(MOST_CANDIDATES + 1)]
    if len(found) > MOST_CANDIDATES:
        raise ValueError(f"more than {MOST_CANDIDATES} words are frequent in a part of the corpus")
    sought = docs.sparkSession.sparkContext.broadcast(frozenset(found))

    def exact(batches):
        counts, sizes = {}, Counter()
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = plain_words(text)
                counts.setdefault(lang, Counter()).update(filter(sought.value.__contains__, words))
                sizes[lang] += len(words)
        rows = [(lang, w, n) for lang, words in counts.items() for w, n in words.items()] + [(lang, None, n) for lang, n in sizes.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"])

    # what is chosen rests on these counts alone, however the input is split
    counted = cut(named.where(F.col("lang").isin(langs)).mapInArrow(exact, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    all_words = counted.where("word IS NULL").select("lang", F.col("n").alias("n_all"))
    candidates = counted.where("word IS NOT NULL").join(F.broadcast(all_words), "lang").where(F.col("n") >= HEAVY * F.col("n_all"))  # a row for each language
    # first the most frequent of each of 64 parts of the words, then of these
    best = lambda df, *by: df.withColumn("rank", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("n"), "word"))).where(F.col("rank") <= COMMON)
    chosen = best(best(candidates.withColumn("part", F.pmod(F.xxhash64("word"), F.lit(64))), "lang", "part"), "lang").select("word").distinct()
    words = sorted(bytes(r["word"]) for r in chosen.collect())  # COMMON for each language
    empty = References(np.zeros((0, len(CLASSES))), words, np.zeros((0, len(words) + 1)))

    def count(batches):
        kept: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one = np.concatenate([class_counts(text), empty.histogram(plain_words(text))])
                kept[lang] = kept[lang] + one if lang in kept else one
        rows = [(lang, i, int(n)) for lang, counts in kept.items() for i, n in enumerate(counts) if n]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.int32(), pa.int64()))], ["lang", "bin", "n"])

    counted = named.where(F.col("lang").isin(langs)).mapInArrow(count, "lang string, bin int, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    both = np.zeros((len(langs), len(CLASSES) + len(words) + 1))
    for r in counted.collect():  # languages x bins
        both[langs.index(r["lang"]), r["bin"]] = r["n"]
    both = both[both[:, len(CLASSES) :].sum(1) > 0]
    return References(both[:, : len(CLASSES)], words, both[:, len(CLASSES) :])


def judge(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, the counts, base_failed, kept, js_classes, js_words."""
    known = docs.sparkSession.sparkContext.broadcast(references(docs))

    def of(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or b""
                n, chars, symbols, lines, repeated = base_counts(text)
                failed = n < MIN_WORDS or repeated > MAX_REPEATED * n
                classes, words, far = known.value.verdict(text) if n >= LEAST_WORDS else (None, None, False)
                rows.append((n, chars, symbols, lines, repeated, failed, not failed and not far, classes, words))
            kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2
            columns = zip(*rows) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds)]], NAMES)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(of, SCHEMA)


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "js_classes", "js_words"]
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, js_classes double, js_words double"


def query(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))
