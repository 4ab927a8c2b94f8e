from __future__ import annotations

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op08_simhash as op
from tidemark.llm.common import table


def brute_print(text, k=3):
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    """{fingerprint: a label} by union-find over all pairs."""
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    each = list(parent)
    for i, a in enumerate(each):
        for b in each[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[root(a)] = root(b)
    return {p: root(p) for p in each}


def brute(docs):
    prints = [(d.doc_id, brute_print(d.text)) for d in docs]
    label = brute_components({p for _, p in prints})
    least = {}
    for i, p in prints:
        if i is not None:
            least[label[p]] = min(i, least.get(label[p], i))
    return sorted(((i, f"{p:016x}", least.get(label[p])) for i, p in prints), key=repr)


def test_odd_documents(spark):
    docs = odd(spark)
    expected = brute(docs.collect())
    assert rows(op.link(docs), "doc_id", "fingerprint", "component_id") == expected
    assert rows(op.link(clashing(docs)), "doc_id", "fingerprint", "component_id") == expected
    assert op.link(docs.limit(0)).count() == 0
    kept = op.keep_one(clashing(docs))
    assert kept.columns == clashing(docs).columns
    assert kept.count() == len({x[1] for x in expected})
    assert {1, 4, 5, 7, 8, 9, 10, None} == {r.doc_id for r in kept.collect()}


def test_whole_table(spark):
    docs = table(spark, SF, "documents")
    assert rows(op.query(spark, SF), "doc_id", "fingerprint", "component_id") == brute(docs.collect())


@pytest.mark.parametrize("paired, distance", [(2, 2), (48, 2), (2, 1), (2, 0)])
def test_links_connect_all_within_the_distance(spark, monkeypatch, paired, distance):
    monkeypatch.setattr(op, "PAIRED", paired)
    rng = random.Random(3)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(12):
            prints.add(p)
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    frame = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    links = op.links(frame, distance)
    assert links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) > distance).count() == 0
    found = {signed[r.node]: r.label for r in op.components(links).collect()}
    label = brute_components(prints, distance)
    by_root = {}
    for p in prints:
        by_root.setdefault(label[p], set()).add(found.get(p, ("alone", p)))
    assert all(len(v) == 1 for v in by_root.values())
    assert len({next(iter(v)) for v in by_root.values()}) == len(by_root)


def test_linked_texts_without_ids(spark):
    """Texts within two bits whose ids are all null are one component, of which one row stays."""
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join([*words, f"y{k}"]) for k in range(60)]
    prints = {op.fingerprint(t.encode()): t for t in texts}
    one = min(prints)
    other = next(p for p in prints if 0 < (p ^ one).bit_count() <= 2)
    docs = spark.createDataFrame([(None, t, "en", "s", len(t)) for t in (prints[one], prints[other], "another text")], odd(spark).schema)
    kept = [r.text for r in op.keep_one(docs).collect()]
    assert len(kept) == 2 and kept.count("another text") == 1
    assert rows(op.link(docs), "doc_id", "fingerprint", "component_id") == brute(docs.collect())
