from __future__ import annotations

import math
import random
import time

import pytest

from tidemark.llm import components as op
from tidemark.llm import op08_simhash


def least_reachable(pairs):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long").repartition(8)


@pytest.mark.parametrize("order", ["ascending", "random", "zigzag"])
def test_long_paths_end_in_logarithmically_many_even_rounds(spark, order):
    n = 10_000
    names = list(range(n))
    if order == "random":
        random.Random(2).shuffle(names)
    elif order == "zigzag":
        names = [i // 2 if i % 2 else n - i // 2 for i in range(n)]
    pairs, took, began = list(zip(names, names[1:])), [], time.time()
    for edges, _ in op.rounds(frame(spark, pairs)):
        took.append(time.time() - began)
        began = time.time()
    assert {r.high: r.low for r in edges.collect()} == {x: min(names) for x in names if x != min(names)}
    assert len(took) <= 2 * math.log2(n)
    assert max(took[5:]) < 3 * max(took[1:5])  # no round is slower than the first few


def test_any_graph(spark):
    rng = random.Random(7)
    pairs = [(rng.randrange(-500, 500), rng.randrange(-500, 500)) for _ in range(450)] + [(0, 0), (3, 4), (4, 3), (3, 4)]
    got = {r.node: r.label for r in op.components(frame(spark, pairs)).collect()}
    assert got == {k: v for k, v in least_reachable([p for p in pairs if p[0] != p[1]]).items()}
    assert op.components(frame(spark, pairs).limit(0)).count() == 0


def test_hub(spark):
    """One node in every link, of the least or the greatest label, is one round's work."""
    for hub in (-1, 10**6):
        found = list(op.rounds(frame(spark, [(hub, i) for i in range(5000)])))
        assert len(found) <= 4
        assert op.components(frame(spark, [(hub, i) for i in range(5000)])).select("label").distinct().count() == 1


def test_chain_of_texts(spark):
    """200 texts, each three words from the one before: its SimHash components are those of all pairs."""
    rng = random.Random(1)
    words, texts = [f"w{i}" for i in range(400)], []
    for _ in range(200):
        texts.append(" ".join(words))
        for at in rng.sample(range(400), 3):
            words[at] = f"x{rng.randrange(10**9)}"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    from tests.llm.test_op08 import brute
    from tests.llm.helpers import rows

    assert rows(op08_simhash.link(docs), "doc_id", "fingerprint", "component_id") == brute(docs.collect())
