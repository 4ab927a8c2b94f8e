from __future__ import annotations

import zlib

import corpus_pipeline
import numpy as np
from tests.conftest import SF
from tests.llm.helpers import odd
from tests.llm.test_op02 import brute as personal
from tests.llm.test_op06 import brute as leaks
from tests.llm.test_op11 import linked, shingled
from tidemark.llm import op03_slack
from tidemark.llm.common import table


def first_of_components(docs):
    """The least id of each component of equal word lists and of five-word similarity of 0.8 or more."""
    parent = {shingled(d.text, 5): shingled(d.text, 5) for d in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked([d.text for d in docs], 5):
        parent[root(a)] = root(b)
    first = {}
    for d in docs:
        label = root(shingled(d.text, 5))
        first[label] = min(d.doc_id, first.get(label, d.doc_id))
    return first.values()


def test_stages_against_brute_force(spark):
    """Each stage on what its predecessor kept; the last packs exactly the texts that are left."""
    docs = table(spark, SF, "documents")
    columns = docs.columns
    held = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).cache()
        held[name] = docs
        if name == "language":
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}  # all texts there have a language
        elif name == "near_duplicates":
            assert sorted(r.doc_id for r in docs.collect()) == sorted(first_of_components(before.collect()))
        elif name == "decontamination":
            hit = {r[0] for r in leaks(before.collect(), table(spark, SF, "benchmark").collect())}
            assert hit and {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()} - hit
        elif name == "personal_data":
            assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in before.collect()}
            texts = {r.doc_id: r.text for r in before.collect()}
            assert any(personal(t) for t in texts.values())
            for r in docs.collect():
                assert not personal(r.text) and r.n_chars == len(r.text)
                assert personal(texts[r.doc_id]) or r.text == texts[r.doc_id] or "<" in r.text
        if name != "packing":
            assert docs.columns == columns
    words = op03_slack.words_of(op03_slack.tokenizer_path())
    expected = {}
    for r in held["personal_data"].collect():
        ids = op03_slack.token_ids(r.text or "", words) + np.array([1], "<u4").tobytes()
        expected |= {(r.doc_id, at // 4): zlib.crc32(ids[at : at + 8192]) for at in range(0, len(ids), 8192)}
    assert {(r.doc_id, r.start): r.ids_crc32 for r in held["packing"].collect()} == expected


def test_run_gives_the_last_stage(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert out.count() > 100


def test_odd_documents(spark):
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        empty = stage(spark, odd(spark).limit(0), SF)
        assert empty.count() == 0 and empty.columns == docs.columns
    assert {5, 8} & {r.doc_id for r in docs.collect()}
