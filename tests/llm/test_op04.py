from __future__ import annotations

import base64
import functools
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest

from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op04_unigram as op
from tidemark.llm.common import table

COLUMNS = ["doc_id", "held_out", "lang_pred", "score"]


@pytest.fixture(scope="module")
def trie():
    return op.Trie(op.vocabulary_path())


def number(trie, piece):
    node = 1
    for b in piece:
        node = int(trie.walk(node, trie.code[b])) if node and trie.code[b] else 0
    return int(trie.piece[node]) if node else trie.size


def segmentations(trie, word):
    """The piece numbers of every way to cut a word."""
    text = b" " + word
    for cuts in itertools.product([0, 1], repeat=len(text) - 1):
        ends = [i + 1 for i, c in enumerate(cuts) if c] + [len(text)]
        found = [number(trie, text[a:b]) for a, b in zip([0, *ends], ends)]
        if trie.size not in found:
            yield found


def test_scores_sum_all_segmentations(trie):
    """Against every way to cut a word, one by one."""
    p = np.random.default_rng(1).random((trie.size, 2)) / 50
    words = [b"a", b"the", b"hello", "über".encode(), b"nation", b"x" * 7]
    for word, got in zip(words, op.word_scores(trie, np.log(p), words)):
        assert np.allclose(got, np.log(sum(np.prod(p[found], axis=0) for found in segmentations(trie, word))))
        assert np.allclose(got, op._alone(trie, np.log(p), word))


def test_learning_against_every_segmentation(trie):
    """One round's expected counts, from all segmentations one by one."""
    words, counts = [b"the", b"then", b"other"], [5, 2, 1]
    expected = np.full(trie.size, op._SMOOTHING)
    for word, n in zip(words, counts):
        all_ways = [*segmentations(trie, word)]
        odds = np.array([trie.size ** -float(len(w)) for w in all_ways])
        for way, share in zip(all_ways, odds / odds.sum()):
            np.add.at(expected, way, n * share)
    assert np.allclose(op.learn(trie, words, np.array(counts), 1), expected / expected.sum())


def test_learning_raises_the_likelihood(trie):
    words, counts = [b"the", b"then", b"other", b"nation"], np.array([50, 10, 5, 3])
    fits = [op.learn(trie, words, counts, k) for k in (1, 2, 4, 8)]
    likelihood = [float(counts @ op.word_scores(trie, np.log(p)[:, None], words)[:, 0]) for p in fits]
    assert all(b > a - 1e-3 for a, b in zip(likelihood, likelihood[1:]))  # the smoothing costs a little at the end
    assert all(math.isclose(p.sum(), 1) for p in fits)


def test_long_words_of_any_script(trie):
    """Words without a common piece, trained with large counts: no score is lost, nor any part of a word."""
    long = "ᛗᛖᚾᛋᚲᛖᚾᚹᚢᚱᛞᛖᚾ".encode()
    p = [op.learn(trie, [b"the", b"dog", long * 20], np.array([5e6, 5e6, 3]), 2), op.learn(trie, [b"der", b"hund"], np.array([5e6, 5e6]), 2)]
    logs = np.log(np.array(p).T)
    for word in (long, long * 20, long * 300, "ꙮ".encode() * 14, b"x" * 100_000):
        assert np.isfinite(op.word_scores(trie, logs, [word])).all()
    assert np.allclose(op.word_scores(trie, logs, [long * 8]), op._alone(trie, logs, long * 8))
    texts = ["ꙮ" * 14, "the dog and " + "ꙮ" * 500, (long * 20).decode(), "x" * 50_000, "der " + "x" * 1000]
    pred, score = op.judge([t.encode() for t in texts], ["en", "de"], logs, trie)
    assert all(0 <= x <= 1 for x in score)
    assert pred[1] == pred[2] == "en"
    assert op.judge([("y" * 300 + "the").encode()], ["en"], logs[:, :1], trie)[1] == [1]


def test_predictions_against_plain_sums(spark, trie):
    """Every row of a table, by a forward pass in plain Python over a dictionary of pieces."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    names, probabilities = op.fit(docs, op.vocabulary_path())
    with open(op.vocabulary_path(), "rb") as lines:
        pieces = [base64.b64decode(x.split()[0]) for x in lines]
    pieces = {x for x in pieces if re.fullmatch(rb"[a-z\x80-\xff ][a-z\x80-\xff]*", x)} | {bytes([b]) for b in [*range(97, 123), *range(128, 256), 32]}
    known = {x: np.log(probabilities[number(trie, x)]) for x in pieces}
    assert len(known) == trie.size

    @functools.cache
    def word_score(word):
        text = b" " + word
        alpha = [np.zeros(len(names))]
        for end in range(1, len(text) + 1):
            alpha.append(np.logaddexp.reduce([alpha[start] + known[text[start:end]] for start in range(max(0, end - trie.depth), end) if text[start:end] in known]))
        return alpha[-1]

    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in op.predict(docs).collect():
        words = re.findall(rb"[a-z\x80-\xff]+", (texts[r.doc_id] or "").encode().lower())
        total = sum(map(word_score, words), np.zeros(len(names)))
        odds = np.exp(total - total.max())
        assert r.lang_pred == (names[int(total.argmax())] if words else "und")
        assert r.score == pytest.approx(1 / odds.sum() if words else 0, rel=1e-6)


def test_odd_documents(spark):
    docs = odd(spark)
    got = {r.doc_id: r for r in op.predict(docs).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0
    assert got[8].lang_pred == "de" and got[4].lang_pred in ("en", "de")
    for r in got.values():
        assert 0 <= r.score <= 1
        assert r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    assert rows(op.predict(clashing(docs)), *COLUMNS) == rows(op.predict(docs), *COLUMNS)
    assert op.predict(docs.limit(0)).count() == 0
    nothing = docs.selectExpr("doc_id", "text", "CAST(NULL AS string) AS lang")
    assert {r.lang_pred for r in op.predict(nothing).collect()} == {"und"}
    kept = op.keep_identified(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert not {1, 2, 3} & {r.doc_id for r in kept.collect()}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = table(spark, sf, "documents")
    told = op.query(spark, sf).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert told.count() > 200
    assert told.where("lang = lang_pred").count() >= 0.99 * told.count()


def test_the_held_out_fold_and_other_columns_teach_nothing(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    changed = docs.selectExpr("doc_id", "text", "IF(crc32(CAST(doc_id AS string)) % 4 = 2, 'xx', lang) AS lang", "'z' AS source", "0L AS n_chars")
    assert rows(op.predict(changed), *COLUMNS) == rows(op.predict(docs), *COLUMNS)


def long_words():
    rng = random.Random(6)
    letters = [chr(c) for c in rng.sample(range(0x4E00, 0x9FA5), 300)]
    return [w.encode() for w in ("".join(rng.choices(letters, k=500)), "".join(rng.choices("abcdefghij", k=3000)), "the" * 200 + "".join(rng.choices(letters, k=200)), "x" * 2500, "".join(rng.choices(letters + list("aeiou"), k=900)))]


def test_long_words_score_as_they_do_whole():
    trie, rng = op.trie_of(op.vocabulary_path()), np.random.default_rng(2)
    logs = np.log(rng.dirichlet(np.ones(trie.size), 4)).T
    words = long_words()
    whole = np.stack([op._alone(trie, logs, w) for w in words])
    assert np.allclose(op.word_scores(trie, logs, [b"short", *words, b"words"])[1:-1], whole, rtol=1e-9)


def test_a_megabyte_without_spaces_takes_seconds():
    import time

    trie, rng = op.trie_of(op.vocabulary_path()), random.Random(3)
    logs = np.log(np.random.default_rng(2).dirichlet(np.ones(trie.size), 4)).T
    word = "".join(rng.choices([chr(c) for c in range(0x4E00, 0x5E00)], k=350_000)).encode()
    began = time.time()
    assert np.isfinite(op.word_scores(trie, logs, [word])).all()
    took = time.time() - began
    print(len(word), took)
    assert took < 6
