from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op01_divergence as op
from tidemark.llm.common import table

COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def brute(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", text)
    lines = text.split("\n")
    dup = sum(bool(re.search("[^\x20\x09-\x0d]", x)) and x in lines[:i] for i, x in enumerate(lines))
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = set()
    for i, t in enumerate(triples):
        if triples.count(t) > 1:
            covered |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(covered)


def test_base_against_brute_force():
    rng = random.Random(8)
    parts = ["a", "b", "é", "\U0001f600", "x#", "|", " ", "  ", "\n", "\t", "\x0b", "\x1c", "\u0085", " a", " b", "\nline one here"]
    for _ in range(500):
        text = "".join(rng.choices(parts, k=rng.randrange(40)))
        assert op.base_counts(text.encode()) == brute(text), repr(text)


def test_divergence_against_the_formula():
    p, q = np.array([3.0, 1, 0, 6]), np.array([2.0, 2, 4, 2])
    a, b = p / p.sum(), q / q.sum()
    m = (a + b) / 2
    kl = lambda x: sum(u * np.log2(u / v) for u, v in zip(x, m) if u)
    expected = np.sqrt((kl(a) + kl(b)) / 2 - 0.01)
    assert np.isclose(op.divergence(p, q[None], lambda n: 0.01)[0], expected)


@pytest.mark.parametrize("n", [1, 20, 50, 100, 1000])
def test_what_chance_makes_of_a_sample(n):
    """Against samples that are drawn."""
    rng = np.random.default_rng(n)
    q = rng.random(150) ** 6
    drawn = rng.multinomial(n, q / q.sum(), 4000)
    told = np.mean([op._contribution(x / n, q / q.sum()).sum() for x in drawn])
    assert np.isclose(op.expected_divergence(q / q.sum(), n), told, rtol=0.03)
    assert np.isclose(op.Chance(q[None])(n)[0], told, rtol=0.05)


def test_word_junk_of_any_length_goes(spark):
    """Unknown words with usual characters, from the least length that is judged on."""
    known = op.references(table(spark, "/root/testdata/sf0.01", "documents"))
    rng = random.Random(2)
    for n in (50, 75, 100, 150, 1000):
        for _ in range(10):
            text = " ".join("".join(rng.choices("abcdefghijklmnoprstuvwz", k=rng.randrange(2, 9))) for _ in range(n))
            assert known.verdict(text.encode())[2]


def test_other_scripts_have_classes_of_their_own():
    counts = dict(zip(op.CLASSES, op.class_counts("aé Ж中\U0001f600".encode())))
    assert counts == dict.fromkeys(op.CLASSES, 0) | {"lower": 1, "latin": 1, "space": 1, "two": 1, "three": 1, "four": 1}


def test_verdicts_over_a_table(spark):
    """Every row's ``kept`` from the definitions, with counters."""
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    known = op.references(docs)
    shares = lambda counts: counts / counts.sum()

    def distance(p, q, n):
        m = (p + q) / 2
        js = sum(x * math.log2(x / z) for x, z in zip(p, m) if x) / 2 + sum(y * math.log2(y / z) for y, z in zip(q, m) if y) / 2
        return math.sqrt(max(0, js - op.expected_divergence(q, n)))

    texts = {d.doc_id: d.text or "" for d in docs.collect()}
    for r in op.judge(docs).collect():
        if r.base_failed:
            assert not r.kept
            continue
        words = Counter(op.plain_words(texts[r.doc_id].encode()))
        mine = np.array([*[words[w] for w in known.bins], sum(n for w, n in words.items() if w not in known.bins)], float)
        kinds = op.class_counts(texts[r.doc_id].encode())
        unknown = np.eye(len(mine))[-1]
        told = [(distance(shares(kinds), shares(a), kinds.sum()), distance(shares(mine), shares(b), mine.sum()), distance(unknown, shares(b), mine.sum())) for a, b in zip(known.classes, known.counts)]
        near = min(told, key=lambda x: x[0] / op.FAR_CLASSES + x[1] / op.FAR_WORDS)
        assert (r.js_classes, r.js_words) == pytest.approx(near[:2], abs=0.01)
        limit = min(op.FAR_WORDS, op.UNKNOWN * near[2])
        if abs(near[0] - op.FAR_CLASSES) > 0.01 and abs(near[1] - limit) > 0.01:
            assert r.kept == (near[0] < op.FAR_CLASSES and near[1] < limit)


def test_odd_documents(spark):
    docs = odd(spark)
    got = rows(op.judge(docs), *COLUMNS)
    expected = []
    for d in docs.collect():
        if d.doc_id != 8:  # brute force is slow there
            n = brute(d.text)
            expected.append((d.doc_id, *n, n[0] < 50 or 100 * n[4] > 50 * n[0]))
    assert sorted((r[:7] for r in got if r[0] != 8), key=repr) == sorted(expected, key=repr)
    assert [r for r in got if r[0] == 8][0][1:7] == (24_000, 80_000, 0, 0, 24_000, True)
    assert not any(r[7] for r in got if r[6])
    assert rows(op.judge(clashing(docs)), *COLUMNS) == got
    assert op.judge(docs.limit(0)).count() == 0


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    told = op.query(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("NOT base_failed").toPandas()
    assert told[told.quality == 1].kept.mean() > 0.995
    assert told[told.quality == 0].kept.mean() < 0.3


def test_references_count_everything(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    found = op.references(docs)
    texts = {}
    for d in docs.collect():
        texts.setdefault(d.lang, []).append((d.text or "").encode())
    langs = sorted(k for k, v in texts.items() if len(v) >= op.LEAST_DOCS)
    for row, lang in enumerate(langs):
        assert found.classes[row].tolist() == sum(op.class_counts(t) for t in texts[lang]).tolist()
        words = [w for t in texts[lang] for w in op.plain_words(t)]
        assert found.counts[row].sum() == len(words)
        assert all(found.counts[row, i] == words.count(w) for w, i in found.bins.items())


def test_partitions_do_not_matter(spark):
    """One and sixteen parts of the input give equal rows."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    one, many = (rows(op.judge(docs.repartition(n)), "doc_id", "kept", "js_classes", "js_words") for n in (1, 16))
    assert one == many
