from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op02_skipchain as op
from tidemark.llm.common import table


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c)) // 10 + (2 * int(c)) % 10 for i, c in enumerate(reversed(d))) % 10 == 0


def brute(text):
    text = text or ""
    count = lambda m: len(re.findall("[0-9]", m[0]))
    spans = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    spans += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    spans += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 16 <= count(m) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))]
    spans += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= count(m) <= 15]
    return spans


def test_base_against_the_patterns():
    rng = random.Random(7)
    parts = ["a", "b.c", "@", "%", "-", ".", " ", "+", "1", "12", "255", "256", "4111111111111111", "4111 1111-1111 1111", "(", ")", "é", "\U0001f600", "x@y.z", "+1 (988) 555-2485", "10.0.0.1"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randrange(14)))
        assert op.base_spans(text) == brute(text), repr(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "@" * 200_000, "a@" * 50_000, "+1" * 50_000, "1." * 50_000, "1 " * 100_000, "dot at " * 20_000):
        op.find(text, np.zeros((op.N_FEATURES + 1, 5)), np.zeros((5, 5)))


def test_messages_are_exact_on_a_tree():
    """Beliefs against summing over all labellings, where the graph has no loop."""
    rng = np.random.default_rng(3)
    text = "0123456789 1234567890 " + "x" * 100 + " 2223334445"
    nodes = [(op.NONE, 0, 10), (op.NONE, 11, 21), (op.NONE, 122, 132)]
    unary, chain = rng.normal(size=(3, 5)), rng.normal(size=(5, 5))
    got = op.propagate(nodes, unary, text, chain)
    p = np.zeros((3, 5))
    for labels in itertools.product(range(5), repeat=3):
        weight = np.exp(sum(unary[i, k] for i, k in enumerate(labels)) + chain[labels[0], labels[1]])
        for i, k in enumerate(labels):
            p[i, k] += weight
    assert np.allclose(got, p / p.sum(1, keepdims=True))


@pytest.fixture(scope="module")
def model(spark):
    return op.train(table(spark, "/root/testdata/sf0.1", "documents"))


def test_repeats_take_the_label_of_the_first(model):
    text = "call +1 (988) 555-2485 now, " + "words " * 50 + "or 1 988 555 2485 or 988-555-2485; ref 123-456-7890"
    base, added = op.find(text, *model)
    assert [text[a:b] for _, a, b in base] == ["+1 (988) 555-2485"]
    assert [(op.KINDS[k], text[a:b]) for k, a, b in added] == [("phone", "1 988 555 2485"), ("phone", "988-555-2485")]
    base, added = op.find("joe.d@example.com or joe.d [at] example [dot] com", *model)
    assert [op.KINDS[k] for k, _, _ in added] == ["email"]
    assert op.find("order 4111111111111112 of 2024-01-01, 123 456 7890", *model) == ([], [])
    assert op.masked("a b@c.de, +1 988 555 2485.", *model) == "a <email>, <phone>."


def test_odd_documents(spark):
    docs = odd(spark)
    expected = [(d.doc_id, *[sum(s[0] == k for s in brute(d.text)) for k in range(4)], hashlib.sha256(op.listed(brute(d.text)).encode()).hexdigest()) for d in docs.collect()]
    assert rows(op.scan(docs), *op.NAMES[:6]) == sorted(expected, key=repr)
    assert rows(op.scan(clashing(docs)), *op.NAMES) == rows(op.scan(docs), *op.NAMES)
    assert op.scan(docs.limit(0)).count() == 0
    clean = op.mask(clashing(docs))
    assert clean.columns == clashing(docs).columns
    assert rows(clean, "doc_id", "text") == rows(docs, "doc_id", "text")


def test_whole_table(spark):
    docs = {d.doc_id: d.text for d in table(spark, SF, "documents").collect()}
    for r in op.query(spark, SF).collect():
        base = brute(docs[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(s[0] == k for s in base) for k in range(4))
        assert r.base_sha256 == hashlib.sha256(op.listed(base).encode()).hexdigest()
        assert set(op.listed(base).split(",")) - {""} <= set(r.spans.split(","))
    masked = op.mask(table(spark, SF, "documents"))
    assert not any(brute(r.text) for r in masked.collect())
    assert masked.where("n_chars != length(text)").count() == 0


def test_many_spans_take_time_in_proportion():
    import time

    text = " ".join(f"a{i}@b.example or a{i} at b dot example or +1 555 01{i:06d} or 555-01{i:06d}" for i in range(50_000))
    base = op.base_spans(text)
    assert len(base) >= 100_000
    began = time.time()
    found = op.candidates(text, base)
    assert len(found) >= 150_000 and time.time() - began < 10
    # a long span that starts well before keeps what lies in it from being a candidate
    covered = op.candidates("x" * 10 + " 12 34 56 78 90 12 34 56", [(0, 0, 34), (1, 2, 3), (1, 4, 5), (1, 6, 7)])
    assert [n for n in covered if n[0] == op.NONE] == []
