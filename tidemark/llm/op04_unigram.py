"""Language identification by segmentation-marginalised unigrams.

The vocabulary is fixed and public: all pieces of a byte-level tokenizer that
consist of a-z, bytes outside ASCII and a leading space.  Every language has a
probability for each piece; a word's probability is the sum over all ways to cut
it into pieces of the product of theirs, which a forward pass over the word's
bytes yields, and a text's is the product over its words.  Pieces don't cross
words, so that this is the sum over the text's segmentations.  All sums are of
logarithms, so that no word is too long.

The probabilities are learned by expectation maximisation with the matching
backward pass, over all words of a bounded sample of labelled rows: about
``DOCS_PER_LANG`` documents of a language (those of the smallest hashes), fewer
where these would have over ``CHARS_PER_LANG`` characters, of at most
``CHARS_PER_DOC`` characters each.  The held-out fold and rows without a language
are not learned from.  Scoring covers every byte of every word of every text: a
batch's distinct words go through the forward pass together, as a matrix.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a
single learned language gets score 1; none: all are ``und``; ties go to the first
language in order; repeated rows get the same prediction; a very long word, as of
a text without spaces, costs time in proportion to its length.  More than
``MOST_LANGS`` values of ``lang`` are refused with an error, as then the column is
no language.
"""

from __future__ import annotations

import base64
from collections import Counter
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import held_out, table
from tidemark.llm.wordcounts import Numbered, letter_words, sum_by_doc

DOCS_PER_LANG, CHARS_PER_LANG, CHARS_PER_DOC = 2_000, 8_000_000, 1_000_000
MOST_LANGS = 1_000
ROUNDS = 4
#: Bytes of words of about one length that go through the forward pass together; from how many bytes words are cut into
#: segments, and a segment that cannot be cut goes alone, byte by byte.
_MATRIX, _ALONE = 400_000, 400
#: Texts of a batch whose words are held at a time.
_JUDGED = 2_000
FOLD = (4, 2)
_SMOOTHING = 0.05


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Trie:
    """The pieces as a table of transitions; node 0 is dead, node 1 the root.  Nodes that have none come last and share a row."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pieces = [base64.b64decode(line.split()[0]) for line in lines]
        usable = set(b"abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
        chosen = [p for p in pieces if set(p[1:]) <= usable and (p[0] in usable or p[0] == 32)]
        # every byte that a word may hold is a piece, so each word can be cut up
        chosen = sorted({*chosen, *(bytes([b]) for b in usable | {32})})
        self.size, self.depth = len(chosen), max(map(len, chosen))
        self.code = np.zeros(256, np.uint8)
        alphabet = sorted({b for p in chosen for b in p})
        self.code[alphabet] = np.arange(1, len(alphabet) + 1)
        prefixes = {p[:k] for p in chosen for k in range(1, len(p) + 1)}
        inner = sorted({p[:-1] for p in prefixes})  # the root is the first
        nodes = {p: i for i, p in enumerate([*inner, *sorted(prefixes.difference(inner))], 1)}
        self.inner = len(inner)
        self.step = np.zeros((self.inner + 2, len(alphabet) + 1), np.int32)
        self.piece = np.full(len(nodes) + 1, self.size, np.int32)  # ``size`` stands for no piece
        for prefix in prefixes:
            self.step[nodes[prefix[:-1]], self.code[prefix[-1]]] = nodes[prefix]
        for number, p in enumerate(chosen):
            self.piece[nodes[p]] = number

    def walk(self, node, code):
        """The nodes that lie beyond."""
        return self.step[np.minimum(node, self.inner + 1), code]


@lru_cache(1)
def trie_of(path: str) -> Trie:
    return Trie(path)


def matrices(trie: Trie, words: list[bytes]):
    """(row numbers, codes) of words of about the same length; a word stands behind a space and is padded with 0."""
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(-(-(len(w) + 1) // 4) * 4, []).append(i)
    for length, rows in by_length.items():
        for at in range(0, len(rows), -(-_MATRIX // length)):
            part = rows[at : at + -(-_MATRIX // length)]
            flat = b"".join((b" " + words[i]).ljust(length, b"\0") for i in part)
            yield np.array(part), trie.code[np.frombuffer(flat, np.uint8).reshape(len(part), length)]


def spans(trie: Trie, codes: np.ndarray):
    """(start, end, rows, pieces) of every piece in every word of a matrix, by start."""
    every = np.arange(len(codes))
    for start in range(codes.shape[1]):
        rows, node = every, np.ones(len(codes), np.int32)
        for end in range(start + 1, min(start + trie.depth, codes.shape[1]) + 1):
            node = trie.walk(node, codes[rows, end - 1])
            alive = node > 0
            if not alive.all():
                rows, node = rows[alive], node[alive]
            if not len(rows):
                break
            piece = trie.piece[node]
            there = piece < trie.size
            if there.all():
                yield start, end, rows, piece
            elif there.any():
                yield start, end, rows[there], piece[there]


def _forward(trie: Trie, logs: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """log P by language of each row of codes, padded with 0."""
    alpha = np.full((codes.shape[1] + 1, len(codes), logs.shape[1]), -np.inf)
    alpha[0] = 0
    for start, end, at, piece in spans(trie, codes):
        alpha[end, at] = np.logaddexp(alpha[end, at], alpha[start, at] + logs[piece])
    return alpha[(codes > 0).sum(1), np.arange(len(codes))]


def segments(trie: Trie, codes: np.ndarray) -> list[np.ndarray]:
    """A long word cut wherever no piece lies across, so that log P of the word is the sum of its segments'."""
    n, rows, node = len(codes), np.arange(len(codes)), np.ones(len(codes), np.int32)
    across = np.zeros(n + 1, np.int64)
    for length in range(1, trie.depth + 1):
        inside = rows + length <= n
        rows, node = rows[inside], node[inside]
        node = trie.walk(node, codes[rows + length - 1])
        rows, node = rows[node > 0], node[node > 0]
        if not len(rows):
            break
        starts = rows[trie.piece[node] < trie.size]
        across += np.bincount(starts + 1, minlength=n + 1)[: n + 1] - np.bincount(starts + length, minlength=n + 1)
    return np.split(codes, np.flatnonzero(np.cumsum(across)[1:n] == 0) + 1)


def _alone(trie: Trie, logs: np.ndarray, word: bytes = b"", codes: np.ndarray | None = None) -> np.ndarray:
    """log P by language of one word, or of the codes of a segment; only the sums that a piece can still reach are kept."""
    codes = trie.code[np.frombuffer(b" " + word, np.uint8)] if codes is None else codes
    depth, step, pieces, inner = trie.depth, trie.step, trie.piece, trie.inner
    ahead = np.full((depth + 1, logs.shape[1]), -np.inf)
    ahead[0] = 0
    for start in range(len(codes)):
        here, node = ahead[start % (depth + 1)].copy(), 1
        ahead[start % (depth + 1)] = -np.inf
        for end in range(start + 1, min(start + depth, len(codes)) + 1):
            node = step[node, codes[end - 1]] if node <= inner else 0
            if not node:
                break
            if (piece := pieces[node]) < trie.size:
                there = ahead[end % (depth + 1)]
                np.logaddexp(there, here + logs[piece], there)
    return ahead[len(codes) % (depth + 1)]


def long_scores(trie: Trie, logs: np.ndarray, words: list[bytes]) -> np.ndarray:
    """log P by language of long words: by their segments, equal ones once, short ones together."""
    numbers: dict[bytes, int] = {}
    made = [[numbers.setdefault(s.tobytes(), len(numbers)) for s in segments(trie, trie.code[np.frombuffer(b" " + w, np.uint8)])] for w in words]
    each, scores = [*numbers], np.zeros((len(numbers), logs.shape[1]))
    by_length: dict[int, list[int]] = {}
    for i, s in enumerate(each):
        by_length.setdefault(-(-len(s) // 4) * 4, []).append(i)
    for length, members in by_length.items():
        if length >= _ALONE:
            for i in members:
                scores[i] = _alone(trie, logs, codes=np.frombuffer(each[i], np.uint8))
            continue
        for at in range(0, len(members), -(-_MATRIX // length)):
            part = members[at : at + -(-_MATRIX // length)]
            flat = b"".join(each[i].ljust(length, b"\0") for i in part)
            scores[part] = _forward(trie, logs, np.frombuffer(flat, np.uint8).reshape(len(part), length))
    return np.stack([(np.bincount(m, minlength=len(each))[:, None] * scores).sum(0) if len(m) > len(each) else scores[m].sum(0) for m in made])


def word_scores(trie: Trie, logs: np.ndarray, words: list[bytes]) -> np.ndarray:
    """log P(word) by language; ``logs`` has a row for each piece and a column for each language."""
    out = np.zeros((len(words), logs.shape[1]))
    short = [i for i, w in enumerate(words) if len(w) < _ALONE]
    if len(short) < len(words):
        long = [i for i, w in enumerate(words) if len(w) >= _ALONE]
        out[long] = long_scores(trie, logs, [words[i] for i in long])
    for rows, codes in matrices(trie, [words[i] for i in short]):
        out[np.array(short)[rows]] = _forward(trie, logs, codes)
    return out


def learn(trie: Trie, words: list[bytes], counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """The piece probabilities that expectation maximisation finds for one language's counted words."""
    weight = np.array(counts, float)
    p = np.full(trie.size, 1 / trie.size)
    for _ in range(rounds):
        expected, logs = np.full(trie.size, _SMOOTHING), np.log(p)
        for rows, codes in matrices(trie, words):
            found = [*spans(trie, codes)]
            alpha = np.full((codes.shape[1] + 1, len(rows)), -np.inf)
            beta = np.full_like(alpha, -np.inf)
            alpha[0] = 0
            beta[(codes > 0).sum(1), np.arange(len(rows))] = 0
            for start, end, at, piece in found:
                alpha[end, at] = np.logaddexp(alpha[end, at], alpha[start, at] + logs[piece])
            for start, end, at, piece in reversed(found):
                beta[start, at] = np.logaddexp(beta[start, at], logs[piece] + beta[end, at])
            for start, end, at, piece in found:
                share = np.exp(alpha[start, at] + logs[piece] + beta[end, at] - beta[0, at])
                expected += np.bincount(piece, share * weight[rows[at]], trie.size)
        p = expected / expected.sum()
    return p


def sample(docs: DataFrame) -> DataFrame:
    """(lang, text): of the learned fold, about ``DOCS_PER_LANG`` documents of each language, by a hash of text and id."""
    n_chars = F.length("text")
    fold = docs.where(~held_out(*FOLD) & F.col("lang").isNotNull() & (n_chars <= CHARS_PER_DOC)).select("doc_id", "lang", "text")
    # a row for each language
    sizes = fold.groupBy("lang").agg(F.least(F.lit(1.0), DOCS_PER_LANG / F.count(F.lit(1)), CHARS_PER_LANG / F.greatest(F.sum(n_chars), F.lit(1))).alias("share"))
    if len(sizes.select("lang").take(MOST_LANGS + 1)) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} values of lang")
    place = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / (1 << 30)
    return fold.join(F.broadcast(sizes), "lang").where(place < F.col("share")).select("lang", "text")


def fit(docs: DataFrame, path: str) -> tuple[list[str], np.ndarray]:
    """The languages in order, and a column of piece probabilities for each: languages x pieces numbers, whatever the corpus."""

    def count(batches):
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, Counter()).update(letter_words(text))
            rows = [(lang, w, n) for lang, words in found.items() for w, n in words.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 3, (pa.string(), pa.binary(), pa.int64()))], ["lang", "word", "n"])

    def learn_lang(pdf: pd.DataFrame) -> pd.DataFrame:
        # the words of about CHARS_PER_LANG characters at most
        p = learn(trie_of(path), list(pdf.word), pdf.n.to_numpy())
        return pd.DataFrame({"lang": [pdf.lang.iloc[0]], "p": [p.tolist()]})

    counted = sample(docs).select("lang", F.col("text").cast("binary")).mapInArrow(count, "lang string, word binary, n long")
    words = counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    models = {r["lang"]: r["p"] for r in words.groupBy("lang").applyInPandas(learn_lang, "lang string, p array<double>").collect()}
    langs = sorted(models)
    return langs, np.array([models[x] for x in langs]).T if langs else np.ones((1, 0))


def judge(texts: list[bytes | None], names: list[str], logs: np.ndarray, trie: Trie) -> tuple[list[str], np.ndarray]:
    """The language and its probability, for each text of a batch."""
    numbered = Numbered()
    numbers = [[numbered[w] for w in letter_words(t)] for t in texts]
    known = [bool(names) and t is not None and any(map(str.isalpha, t.decode())) for t in texts]
    if not any(known):
        return ["und"] * len(texts), np.zeros(len(texts))
    total = sum_by_doc(word_scores(trie, logs, list(numbered)), numbers)
    odds = np.exp(total - total.max(1, keepdims=True))
    return [names[b] if k else "und" for b, k in zip(total.argmax(1), known)], np.where(known, 1 / odds.sum(1), 0.0)


def _model(docs: DataFrame, path: str):
    langs, probabilities = fit(docs, path)
    return docs.sparkSession.sparkContext.broadcast((langs, np.log(probabilities)))


def predict(docs: DataFrame, path: str | None = None) -> DataFrame:
    """A row per document: doc_id, held_out, lang_pred, score."""
    path = path or vocabulary_path()
    model = _model(docs, path)

    def of(batches):
        for batch in batches:
            pred, score = judge(batch.column(2).to_pylist(), *model.value, trie_of(path))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(pred, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])

    plain = docs.select("doc_id", held_out(*FOLD).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(of, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, least: float = 0.5, path: str | None = None) -> DataFrame:
    """``docs`` without the rows that have no language, or none of probability ``least``.  Rows are judged in place, none is shuffled."""
    path = path or vocabulary_path()
    model = _model(docs, path)

    @F.pandas_udf("boolean")
    def identified(texts: pd.Series) -> pd.Series:
        kept: list[bool] = []
        for at in range(0, len(texts), _JUDGED):
            pred, score = judge(list(texts[at : at + _JUDGED]), *model.value, trie_of(path))
            kept += [p != "und" and x >= least for p, x in zip(pred, score)]
        return pd.Series(kept)

    return docs.where(identified(F.col("text").cast("binary")))


def query(spark, sf_dir: str) -> DataFrame:
    return predict(table(spark, sf_dir, "documents"))
