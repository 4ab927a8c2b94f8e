"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents of the learned fold are the positives; a sample of all
its documents, labelled or not, is the unlabelled text, which holds toxic ones in
the share ``prior`` that the fold's labels show.  A linear classifier is trained
in numpy by full-batch Adam.  The risk of the unlabelled text, less the share of
it that the positives explain, estimates the risk of the negatives; where that
estimate falls below zero, which no risk can, the step ascends it instead (the
non-negative correction).

The features are words and their stems.  The classifier is fitted on a bounded
sample: about ``POSITIVES`` and ``UNLABELLED`` documents (those of the smallest
hashes, equal word sets once), none of over ``CHARS_PER_DOC`` characters, and the
words whose share differs between the two by ``SCREEN`` standard errors, the
``WORDS`` most different at most: long texts hold hundreds of rare words, whose
chance differences would drown those that tell.  The words are counted and
screened by Spark; one task gets the numbers of the screened words that each
document of the sample has, and fits.  Every word of every text is looked up.

Defined cases: a null or empty text, and any without a known word, gets the
classifier's bias; without a single positive the score is 0 for all; labels of
the other fold, or null, are not used; an id that is labelled twice is toxic if
one label says so; repeated rows get equal scores; of words that differ equally
the first in order is taken; a very long text is scored whole.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, held_out, table
from tidemark.llm.wordcounts import letter_words

FOLD = (5, 0)
POSITIVES, UNLABELLED, CHARS_PER_DOC = 4_000, 12_000, 200_000
#: A word must be in LEAST_DOCS documents of the sample, and in LEAST_SHARE of one side.
WORDS, LEAST_DOCS, LEAST_SHARE, SCREEN = 2_000, 3, 0.01, 6.0
#: Besides a word itself, its first bytes are features, so that forms of one stem count together.
STEMS = (5, 7)
STEPS, RATE, DECAY = 400, 0.05, 1e-5


def present(text: bytes | None) -> set[bytes]:
    """The words of a text, and their stems, which are marked by a dot."""
    words = set(letter_words(text))
    return words.union(*[{w[:k] + b"." for w in words if len(w) > k} for k in STEMS])


class Sparse:
    """Rows of feature numbers; their scores and the gradient of their weights."""

    def __init__(self, rows: list[np.ndarray], n_features: int):
        self.n, self.n_features = len(rows), n_features
        self.owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        self.features = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)

    def probabilities(self, w: np.ndarray) -> np.ndarray:
        z = w[-1] + np.bincount(self.owner, w[self.features], self.n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(self, slope: np.ndarray) -> np.ndarray:
        """The mean over rows of ``slope`` times the row's features and 1 for the bias."""
        return np.append(np.bincount(self.features, slope[self.owner], self.n_features), slope.sum()) / self.n


def fit(positive: Sparse, unlabelled: Sparse, prior: float) -> np.ndarray:
    """Weights of the features, and the bias last, of the least non-negative risk under the logistic loss."""
    w = np.zeros(positive.n_features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    loss = lambda s: -np.log1p(-np.minimum(s, 1 - 1e-12)).mean()  # noqa: E731  of calling these negative
    for step in range(1, STEPS + 1):
        p, u = positive.probabilities(w), unlabelled.probabilities(w)
        plus = prior * positive.gradient(p - 1)
        minus = unlabelled.gradient(u) - prior * positive.gradient(p)
        g = plus + minus if loss(u) - prior * loss(p) >= 0 else -minus
        g[:-1] += DECAY * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def screened(sets: DataFrame) -> list[bytes]:
    """The words whose shares of positive and unlabelled rows of ``sets`` (positive, words) differ most, the most different first."""
    sizes = sets.agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u")).first()
    if not sizes["p"] or not sizes["u"]:
        return []
    counts = sets.select("positive", F.explode("words").alias("word")).groupBy("word").agg(F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("u"))
    p, u = F.col("p") / sizes["p"], F.col("u") / sizes["u"]
    both = (F.col("p") + F.col("u")) / (sizes["p"] + sizes["u"])
    spread = F.sqrt(both * (1 - both) * (1 / sizes["p"] + 1 / sizes["u"]))
    common = (F.col("p") + F.col("u") >= LEAST_DOCS) & (F.greatest(p, u) >= LEAST_SHARE)
    z = F.when(spread > 0, F.abs(p - u) / spread)
    return [bytes(r["word"]) for r in counts.where(common).select("word", z.alias("z")).where(F.col("z") >= SCREEN).orderBy(F.desc("z"), "word").limit(WORDS).collect()]


def train(docs: DataFrame, labels: DataFrame) -> dict[bytes, float]:
    """The weight of each word that counts, and of b"" the bias; at most WORDS of them."""
    toxic = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out(*FOLD))
    shares = toxic.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    if not shares["toxic"]:
        return {}
    prior = min(max(shares["toxic"] / shares["n"], 0.001), 0.999)
    fold = docs.where(~held_out(*FOLD) & (F.length("text") <= CHARS_PER_DOC)).select("doc_id", "text")
    n_docs = docs.select("doc_id").where(~held_out(*FOLD)).count()
    share = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    confirmed = toxic.where((F.col("toxic") == 1) & (share * shares["toxic"] < POSITIVES)).select("doc_id", F.lit(True).alias("confirmed"))
    # confirmed holds about POSITIVES ids at most
    # a confirmed document may be drawn for the unlabelled side too: that side must hold as many toxic ones as the corpus
    drawn = share * max(n_docs, 1) < UNLABELLED
    sides = F.array_compact(F.array(F.when(F.col("confirmed"), F.lit(True)), F.when(drawn, F.lit(False))))
    marked = fold.join(F.broadcast(confirmed), "doc_id", "left").select(F.explode(sides).alias("positive"), "text")

    def words_of(batches):
        for batch in batches:
            sets = [sorted(present(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.binary()))], ["positive", "words"])

    rows = marked.select("positive", F.col("text").cast("binary").alias("text")).mapInArrow(words_of, "positive boolean, words array<binary>")
    sets = cut(rows.withColumn("same", F.xxhash64("words")).dropDuplicates(["positive", "same"]).drop("same"))
    known = {w: i for i, w in enumerate(screened(sets))}
    if not known:
        return {}

    def numbers_of(batches):
        for batch in batches:
            found = [sorted(known[w] for w in words if w in known) for words in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.int32()))], ["positive", "numbers"])

    def fit_one(pdf: pd.DataFrame) -> pd.DataFrame:
        sides = [sorted(n.tolist() for n, p in zip(pdf.numbers, pdf.positive) if p == side) for side in (True, False)]  # rows arrive in any order
        w = fit(*[Sparse([np.array(n, np.int64) for n in side], len(known)) for side in sides], prior)
        return pd.DataFrame({"place": np.arange(len(w)), "weight": w})

    # at most POSITIVES + UNLABELLED rows, about, of at most WORDS numbers
    numbers = sets.mapInArrow(numbers_of, "positive boolean, numbers array<int>")
    fitted = numbers.groupBy(F.lit(1).alias("all")).applyInPandas(lambda pdf: fit_one(pdf), "place long, weight double")
    words = [*known, b""]
    return {words[r["place"]]: r["weight"] for r in fitted.collect()}


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per document: doc_id, held_out, score, predicted."""
    weights = docs.sparkSession.sparkContext.broadcast(train(docs, labels))

    def of(batches):
        w = weights.value
        bias = w.get(b"", -30.0)
        for batch in batches:
            z = np.array([bias + sum(w[x] for x in present(t) & w.keys()) for t in batch.column(2).to_pylist()], float)
            s = 1 / (1 + np.exp(-np.clip(z, -30, 30))) if w else np.zeros(batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    plain = docs.select("doc_id", held_out(*FOLD).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(of, "doc_id long, held_out boolean, score double, predicted int")


def query(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
