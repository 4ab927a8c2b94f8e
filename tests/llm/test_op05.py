from __future__ import annotations

import re
import zlib

import numpy as np
import pytest

from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op05_nnpu as op
from tidemark.llm.common import table

COLUMNS = ["doc_id", "held_out", "score", "predicted"]


def test_fit_finds_the_positives_among_the_unlabelled():
    rng = np.random.default_rng(0)
    make = lambda toxic: np.unique(np.append(rng.integers(5, 40, 8), rng.integers(0, 5, 2) if toxic else []).astype(np.int64))
    positive = [make(True) for _ in range(200)]
    hidden = rng.random(1500) < 0.1
    unlabelled = [make(t) for t in hidden]
    w = op.fit(op.Sparse(positive, 40), op.Sparse(unlabelled, 40), 0.1)
    called = op.Sparse(unlabelled, 40).probabilities(w) >= 0.5
    assert (called == hidden).mean() > 0.98


def test_gradient_and_risk_against_differences():
    """The step's gradient is that of the non-negative risk, by finite differences."""
    rng = np.random.default_rng(1)
    sides = [[np.unique(rng.integers(0, 6, 3)) for _ in range(n)] for n in (20, 50)]
    positive, unlabelled = (op.Sparse(s, 6) for s in sides)
    w, prior = rng.normal(size=7), 0.2

    def risk(w):
        z = [np.array([w[-1] + w[x].sum() for x in s]) for s in sides]
        softplus = lambda v: np.log1p(np.exp(v)).mean()
        return prior * softplus(-z[0]) + softplus(z[1]) - prior * softplus(z[0])

    p, u = positive.probabilities(w), unlabelled.probabilities(w)
    told = prior * positive.gradient(p - 1) + unlabelled.gradient(u) - prior * positive.gradient(p)
    by_steps = [(risk(w + 1e-6 * e) - risk(w - 1e-6 * e)) / 2e-6 for e in np.eye(7)]
    assert np.allclose(told, by_steps, atol=1e-6)


def test_screening_against_counters(spark):
    rng = np.random.default_rng(2)
    sets = [(bool(i % 3 == 0), sorted({b"w%d" % k for k in rng.integers(0, 30, 6)} | ({b"bad"} if i % 3 == 0 and i % 2 else set()))) for i in range(300)]
    got = op.screened(spark.createDataFrame(sets, "positive boolean, words array<binary>"))
    n_p, n_u = sum(p for p, _ in sets), sum(not p for p, _ in sets)
    told = []
    for word in {w for _, s in sets for w in s}:
        p, u = (sum(word in s for x, s in sets if x == side) for side in (True, False))
        both = (p + u) / (n_p + n_u)
        z = abs(p / n_p - u / n_u) / (both * (1 - both) * (1 / n_p + 1 / n_u)) ** 0.5
        if z >= op.SCREEN:
            told.append((-z, word))
    assert got == [w for _, w in sorted(told)] == [b"bad"]


def test_scores_are_the_sums_of_weights(spark):
    """Every row of a table, by looking up each of its words."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    weights = op.train(docs, labels)
    texts = {d.doc_id: d.text or "" for d in docs.collect()}
    for r in op.score(docs, labels).collect():
        words = set(re.findall(rb"[a-z\x80-\xff]+", "".join(c.lower() if c.isascii() else c for c in texts[r.doc_id]).encode()))
        features = words | {w[:k] + b"." for k in op.STEMS for w in words if len(w) > k}
        z = weights.get(b"", -30) + sum(weights.get(x, 0) for x in features)
        assert r.score == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))) if weights else 0, rel=1e-6)
        assert r.predicted == (r.score >= 0.5)


def test_odd_documents(spark):
    docs, none = odd(spark), spark.createDataFrame([(1, 1, 0), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")
    out = op.score(docs, none).collect()
    assert len(out) == docs.count() and {(r.score, r.predicted) for r in out} == {(0.0, 0)}
    assert op.score(docs.limit(0), none).count() == 0
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out)
    labels = spark.createDataFrame([(i, 1, int(i % 2)) for i in range(1, 11)] * 2, "doc_id long, quality int, toxic int")
    told = rows(op.score(docs, labels), *COLUMNS)
    assert all(0 <= r[2] <= 1 and r[3] == (r[2] >= 0.5) for r in told)
    assert rows(op.score(clashing(docs), labels), *COLUMNS) == told


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    told = op.query(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    toxic, clean = told[told.toxic == 1], told[told.toxic == 0]
    assert len(toxic) > 50 and toxic.predicted.mean() > 0.85 and clean.predicted.mean() < 0.03
    assert np.mean([(a > clean.score).mean() for a in toxic.score]) > 0.93


def test_the_held_out_fold_and_other_columns_teach_nothing(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    changed = labels.selectExpr("doc_id", "0 AS quality", "IF(crc32(CAST(doc_id AS string)) % 5 = 0, 1 - toxic, toxic) AS toxic")
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'z' AS source", "0L AS n_chars")
    assert rows(op.score(other, changed), *COLUMNS) == rows(op.score(docs, labels), *COLUMNS)
