from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.helpers import SCHEMA, clashing, odd
from tidemark.llm import op13_bitsliced as op
from tidemark.llm.common import table

PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
COLUMNS = ("item_id", "rank", "doc_id", "score")


def words(text):
    return re.findall(PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=op.TOP):
    """Every document scored for every item."""
    found = [(d.doc_id, Counter(words(d.text))) for d in docs]
    found = [(i, c, sum(c.values())) for i, c in found if c]
    n_docs, n_terms = len(found), sum(n for _, _, n in found)
    df = Counter(t for _, c, _ in found for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for i in items:
        asked.setdefault(i.item_id, set()).update(words(i.text))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c, n in found:
            m = 50 + 50 * n * n_docs // n_terms
            score = sum(weight[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in ts if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=repr)


def ranked(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_odd_documents(spark):
    docs = odd(spark)
    items = spark.createDataFrame([(1, "The SAME text"), (2, "der die das und ist nicht der"), (3, None), (4, ""), (5, "--- !"), (6, "K \U0001f600 12"), (7, "x" * 50_000), (None, "no id"), (8, "one"), (8, "word"), (8, "word"), (9, "absent")], "item_id long, text string")
    for top in (1, 3, 50):
        expected = brute(docs.collect(), items.collect(), top)
        assert ranked(op.search(docs, items, top)) == expected
        assert ranked(op.search(clashing(docs), clashing(items.withColumn("doc_id", items.item_id)), top, block=2)) == expected
    assert {r[0] for r in expected} == {1, 2, 6, 7, 8, None}
    assert op.search(docs.limit(0), items).count() == 0 == op.search(docs, items.limit(0)).count()


@pytest.mark.parametrize("top", [1, 7, 50])
def test_whole_table(spark, top):
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert ranked(op.search(docs, items, top)) == brute(docs.collect(), items.collect(), top)


def test_many_equal_scores(spark):
    """More copies than places: the least ids stay."""
    rng = random.Random(2)
    docs = spark.createDataFrame([(i, "common words of a copy" if i % 2 else " ".join(rng.choices("abcdef", k=9)), "en", "s", 0) for i in range(2000)], SCHEMA).repartition(6)
    items = spark.createDataFrame([(1, "words of"), (2, "a b")], "item_id long, text string")
    got = ranked(op.search(docs, items))
    assert got == brute(docs.collect(), items.collect())
    assert sorted(r[2] for r in got if r[0] == 1) == list(range(1, 100, 2))


@pytest.mark.parametrize("density", [1, 16])
def test_bounds_are_never_below_scores(density, monkeypatch):
    """Whatever is in a signature, even one that is nearly full, a bound is at least the score."""
    monkeypatch.setattr(op, "DENSITY", density)
    rng = random.Random(4)
    texts = [" ".join(rng.choices([f"w{j}" for j in range(300)], [1 / (j + 1) for j in range(300)], k=rng.randrange(1, 400))).encode() for _ in range(200)]
    counts = [Counter(op.terms(t)) for t in texts]
    hashed = [(np.array([op._Hashes()[t] for t in c], np.uint64), np.array([*c.values()])) for c in counts]
    df = Counter(op._Hashes()[t] for c in counts for t in c)
    items = {i: {f"w{rng.randrange(320)}".encode() for _ in range(8)} for i in range(20)}
    sizes = np.array([sum(c.values()) for c in counts])
    query = op.Query(items, df, len(texts), int(sizes.sum()))
    for bits in (64, 4096):
        slices = op._slices(hashed, bits).tobytes()
        for item, bound in query.bounds(sizes, np.array([max(c.values()) for c in counts]), bits, slices):
            scores = [query.score(item, c, n) for c, n in zip(counts, sizes.tolist())]
            assert all(b >= s for b, s in zip(bound, scores)) and max(scores) > 0


def test_few_documents_are_rescored(spark):
    """The bounds exclude most: of 1,000 documents for each of 40 items, under a tenth is left."""
    sf = "/root/testdata/sf0.01"
    left, full = [], op.not_excluded
    try:
        op.not_excluded = lambda *a: left.append(full(*a)) or left[-1]
        n = op.query(spark, sf).count()
    finally:
        op.not_excluded = full
    assert n == 40 * 50 and left[0].count() < 4000
