from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF
from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op03_slack as op
from tidemark.llm.common import table


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(op.tokenizer_path())


def test_ids_are_the_tokenizers(tokenizer):
    words = op.words_of(op.tokenizer_path())
    alphabet = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "1", ",", " ", "\u0085", "\x1c", "<|endoftext|>", "<|endof", "\U0001f600", " the"]
    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(12)))
        assert op.token_ids(text, words) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), repr(text)


def test_an_added_token_is_its_id():
    words = op.words_of(op.tokenizer_path())
    assert np.frombuffer(op.token_ids("end of one <|endoftext|> start", words), "<u4").tolist() == [437, 286, 530, 220, 50256, 923]


def test_other_kinds_of_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        op.words_of(public_tokenizers.path("word_bpe_49k.json"))
    op.words_of.cache_clear()


def test_best_fill_against_brute_force():
    rng = random.Random(1)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(4)}
        room = rng.randrange(0, 70)
        used = op.best_fill(counts, room)
        assert all(used[k] <= counts[k] for k in used)
        sums = [sum(k * n for k, n in zip(counts, c)) for c in itertools.product(*[range(n + 1) for n in counts.values()])]
        assert sum(k * n for k, n in used.items()) == max(s for s in sums if s <= room)


def check(docs, out, tokenizer, window):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    expected = defaultdict(list)
    for d in docs:
        ids = [*tokenizer.encode(d.text or "", add_special_tokens=False).ids, 1]
        expected[d.doc_id] += [(at, len(ids[at : at + window]), zlib.crc32(np.array(ids[at : at + window], "<u4").tobytes()), len(ids)) for at in range(0, len(ids), window)]
    assert {k: Counter(v) for k, v in expected.items()} == {k: Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in v) for k, v in by_doc.items()}
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return sum(r.length for r in out) / (window * len(by_sequence))


def test_odd_documents(spark, tokenizer):
    docs = odd(spark)
    out = op.pack(docs, 64).collect()
    check(docs.collect(), out, tokenizer, 64)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert rows(op.pack(clashing(docs), 64), *columns) == rows(op.pack(docs, 64), *columns)


def test_empty(spark):
    assert op.pack(odd(spark).limit(0)).count() == 0


def test_whole_table(spark, tokenizer):
    out = op.query(spark, SF)
    filled = check(table(spark, SF, "documents").collect(), out.collect(), tokenizer, 2048)
    assert filled > 0.97
