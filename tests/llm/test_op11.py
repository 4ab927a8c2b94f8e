from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.helpers import SCHEMA, clashing, odd, rows
from tests.llm.test_components import least_reachable
from tidemark.llm import op11_multiindex as op
from tidemark.llm.common import table


def shingled(text, k=op.WORDS):
    words = tuple((text or "").encode().lower().split())
    return frozenset(words[i : i + k] for i in range(max(1, len(words) - k + 1))) if words else frozenset()


def linked(texts, k=op.WORDS):
    """Pairs of distinct sets with a Jaccard similarity of 0.8 or more, of all that share a shingle."""
    sets, holders = {shingled(t, k) for t in texts} - {frozenset()}, defaultdict(list)
    each = list(sets)
    for i, s in enumerate(each):
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for h in holders.values():
        for p in combinations(h, 2):
            shared[p] += 1
    return [(each[i], each[j]) for (i, j), n in shared.items() if 9 * n >= 4 * (len(each[i]) + len(each[j]))]


def brute(docs):
    own = {d: shingled(d.text) for d in docs}
    order = {s: i for i, s in enumerate(set(own.values()))}
    label = least_reachable([(order[a], order[b]) for a, b in linked([d.text for d in docs])])
    least = {}
    for d, s in own.items():
        if d.doc_id is not None:
            at = label.get(order[s], order[s])
            least[at] = min(least.get(at, d.doc_id), d.doc_id)
    found = lambda d, s: least.get(label.get(order[s], order[s])) if s else d.doc_id
    return sorted(((d.doc_id, len(own[d]), found(d, own[d]), found(d, own[d]) == d.doc_id) for d in docs), key=repr)


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], SCHEMA).repartition(8)


def edited(rng, words, n, made=lambda rng: f"x{rng.randrange(10**9)}"):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = made(rng)
    return words


def test_odd_documents(spark):
    docs = odd(spark)
    expected = brute(docs.collect())
    assert rows(op.link(docs), *COLUMNS) == expected
    assert rows(op.link(clashing(docs)), *COLUMNS) == expected
    assert op.link(docs.limit(0)).count() == 0


def test_whole_table(spark):
    assert rows(op.query(spark, SF), *COLUMNS) == brute(table(spark, SF, "documents").collect())


def families():
    """Families of copies: with a hub, without one, as a chain, with few other words, and one that only shares half."""
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    base = lambda n: rng.choices(vocabulary, k=n)
    hub, absent, few, half = base(150), base(150), base(150), base(80)
    texts = [" ".join(hub)] + [" ".join(edited(rng, hub, 1 + i % 8)) for i in range(400)]
    texts += [" ".join(edited(rng, absent, 4)) for i in range(200)]
    texts += [" ".join(edited(rng, few, 1 + i % 8, lambda r: f"y{r.randrange(3)}")) for i in range(200)]
    texts += [" ".join(half + base(80)) for _ in range(150)]
    chain = base(150)
    for _ in range(200):
        texts.append(" ".join(chain))
        chain = edited(rng, chain, 3)
    return texts


@pytest.mark.parametrize("paired, block, rare", [(48, 256, 128), (2, 16, 1), (5, 32, 4)])
def test_families(spark, monkeypatch, paired, block, rare):
    """Components, and no link between different components, are those of all pairs, whatever a large group is."""
    for name, value in (("PAIRED", paired), ("BLOCK", block), ("RARE", rare)):
        monkeypatch.setattr(op, name, value)
    docs = frame(spark, families())
    assert rows(op.link(docs), *COLUMNS) == brute(docs.collect())


def test_keys_meet_within_the_guaranteed_distance():
    """All pairs of signatures up to 2 * CHUNKS - 1 errors share a key, wherever the errors are."""
    rng = np.random.default_rng(3)
    one = rng.integers(0, 1 << 16, op.CHUNKS * op.WIDTH).astype(np.uint16)
    for _ in range(3000):
        other = one.copy()
        at = rng.choice(len(one), 2 * op.CHUNKS - 1, replace=False)
        other[at] ^= rng.integers(1, 1 << 16, len(at)).astype(np.uint16)
        a, b = op.chunk_keys(np.stack([one, other]))
        assert (a == b).any()
    worst = one.copy()
    worst.reshape(op.CHUNKS, op.WIDTH)[:, :2] ^= 1
    a, b = op.chunk_keys(np.stack([one, worst]))
    assert not (a == b).any()


def test_recall_at_the_threshold(spark):
    """Of 2,000 pairs with a similarity of just 0.8, one in a thousand may be missed; 2.3 in 100,000 are expected."""
    rng = random.Random(8)
    texts = []
    for i in range(2000):
        words = [f"a{i}x{j}" for j in range(120)]
        texts += [" ".join(words), " ".join([*words[:107], *(f"b{i}x{j}" for j in range(13))])]
    a, b = shingled(texts[0]), shingled(texts[1])
    assert 5 * len(a & b) == 4 * len(a | b)
    assert op.link(frame(spark, texts)).where("NOT kept").count() >= 1998


def test_counts_of_two_blocks(monkeypatch):
    """Shared shingles are those of sets, whether a shingle is rare or common, and however few are counted at a time."""
    rng = random.Random(6)
    sets = [sorted(rng.sample(range(60), rng.randrange(1, 30)) + rng.sample(range(100, 2000), 5)) for _ in range(50)]
    flat = lambda some: (np.array([x for s in some for x in s], np.int64), np.array([len(s) for s in some], np.int32))
    expected = [[len(set(a) & set(b)) for b in sets[20:]] for a in sets[:20]]
    for rare, at_once, columns in ((0, 1, 7), (8, 16, 7), (128, 1 << 20, 2048)):
        for name, value in (("RARE", rare), ("_AT_ONCE", at_once), ("_COLUMNS", columns)):
            monkeypatch.setattr(op, name, value)
        assert op.shared_counts(*flat(sets[:20]), *flat(sets[20:])).tolist() == expected
    assert not op.shared_counts(*flat(sets[:3]), *flat([[5000], [5001]])).any()


def rows_of_joins(spark, made):
    """The most rows that a join makes, over all that ``made`` runs."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    made()
    most = 0
    for e in (store.executionsList().apply(i) for i in range(int(before), int(store.executionsCount()))):
        values = store.executionMetrics(e.executionId())
        nodes = store.planGraph(e.executionId()).allNodes()
        for node in (nodes.apply(i) for i in range(nodes.size())):
            for m in (node.metrics().apply(i) for i in range(node.metrics().size())):
                if "Join" in node.name() and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                    most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return most


def test_no_join_makes_all_pairs_of_a_family(spark):
    """Copies too far from each other, with shingles that a hundred of them share: joins make no more rows than pairs of small groups."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(150)]
    docs = frame(spark, [" ".join(edited(rng, base, 5, lambda r: f"y{r.randrange(2)}")) for _ in range(150)])
    found = []
    most = rows_of_joins(spark, lambda: found.extend(rows(op.link(docs), *COLUMNS)))
    assert found == brute(docs.collect())
    assert 0 < most <= 150 * op.CHUNKS * op.WIDTH * op.PAIRED / 2


def lost(i, words):
    """Two texts with a similarity of 0.8, a word apart; for some ``i`` their signatures share no key."""
    told = [f"w{i}x{j}" for j in range(10 * words - 1)]
    return " ".join(told), " ".join(told[: len(told) // 2] + [f"v{i}"] + told[len(told) // 2 + 1 :])


@pytest.mark.parametrize("i, words", [(5018, 4), (127118, 4), (7303, 5), (56908, 5)])
def test_pairs_that_signatures_lose_are_linked(spark, i, words):
    texts = [*lost(i, words), "a text that is like no other"]
    signatures = np.stack([op.signature(op.shingles(t.encode(), op.Hashes(), words)) for t in texts])
    keys = op.chunk_keys(signatures)
    assert not set(keys[0]) & set(keys[1]) and len(linked(texts, words)) == 1
    assert [r.component_id for r in op.link(frame(spark, texts), words).orderBy("doc_id").collect()] == [0, 0, 2]


def test_linked_sets_share_a_part():
    """Sets of all sizes, as far apart as links allow: more shingles, fewer or others; a set of no part in common is not linked."""
    rng = np.random.default_rng(3)
    for n in [*range(4, 80), 127, 128, 129, 200, 255, 256, 257, 640, 3000]:
        for other in {n, n + 1, (n + 5 * n // 4) // 2, 5 * n // 4}:
            shared = -(-4 * (n + other) // 9)
            if shared > n:
                continue
            for _ in range(20 if n < 300 else 3):
                drawn = rng.integers(0, 1 << 64, n + other - shared, np.uint64)
                a, b = np.sort(drawn[:n]), np.sort(drawn[n - shared :])
                assert len(b) == other and set(op.part_keys(a).tolist()) & set(op.part_keys(b).tolist())
    sets = [np.sort(rng.integers(0, 1 << 64, 300, np.uint64)) for _ in range(200)]
    keys = [set(op.part_keys(s).tolist()) for s in sets]
    assert sum(bool(x & y) for x, y in combinations(keys, 2)) == 0 and max(map(len, keys)) <= 76


def test_large_group_that_shares_a_part(spark):
    """More than ``FEW`` sets with a passage in common: only those that are linked are, each by its own text."""
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"t{i}x{j}" for j in range(1 + i % 12)]) for i in range(60)]
    texts += [" ".join(edited(rng, passage, 6)) for _ in range(40)]
    docs = frame(spark, texts)
    prints = docs.rdd.map(lambda r: r.text).collect()
    no_links = spark.createDataFrame([], "a long, b long")
    rows_ = op.sketches(docs)
    found = {tuple(sorted(r)) for r in op.missed(docs, rows_, no_links, op.WORDS).collect()}
    named = {r.fingerprint: r.doc_id for r in rows_.collect()}
    pairs = [(named[a], named[b]) for a, b in found]
    label = least_reachable(pairs)
    order = {shingled(t): i for i, t in enumerate(texts)}
    true = least_reachable([(order[a], order[b]) for a, b in linked(prints)])
    assert {i: label.get(i, i) for i in range(100)} == {i: true.get(i, i) for i in range(100)} and len(pairs) > 20


def test_parities_bound_what_differs():
    """Sets differ in as many shingles as their parities at least, whatever their sizes; few sets that are not linked pass."""
    rng = np.random.default_rng(5)
    for n, other in ((4, 5), (5, 5), (60, 70), (128, 129), (500, 600), (3000, 3600)):
        for shared in (n, n - 1, n * 9 // 10, n // 2, 0):
            drawn = rng.integers(0, 1 << 64, n + other - shared, np.uint64)
            least = op.least_differing([op.parity(drawn[:n])], [op.parity(drawn[n - shared :])])[0, 0]
            assert least <= n + other - 2 * shared and (shared > n // 2 or n < 60 or 9 * least > n + other)
