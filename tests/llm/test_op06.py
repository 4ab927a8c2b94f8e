from __future__ import annotations

import math
import random
import re
from collections import defaultdict
from itertools import product

import pytest

from tests.conftest import SF
from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op06_spaced as op
from tidemark.llm.common import ALNUM, table


def words(text):
    return re.findall(ALNUM, "".join(c.lower() if c.isascii() else c for c in text or ""))


def places(words, mask, only=None):
    """{masked window: {the words around it: (first, last) place}}; places with the same surroundings are one."""
    around, at = range(-op.AROUND, op.SPAN + op.AROUND), [i for i, bit in enumerate(mask) if bit == "1"]
    found = defaultdict(dict)
    for p in range(len(words) - len(mask) + 1):
        window = tuple(words[p + i] for i in at)
        if only is None or window in only:
            near = tuple(words[p + i] if 0 <= p + i < len(words) else None for i in around)
            found[window][near] = found[window].get(near, (p, p))[0], p
    return found


def brute(docs, benchmark):
    """Every pair of places that share a masked window, compared word by word."""
    found, items = {}, [(item.item_id, words(item.text)) for item in benchmark]
    for mask in [*op.MASKS, *("1" * n for n in range(op.FEWEST, op.SPAN))]:
        sought = defaultdict(list)
        for item_id, v in items:
            if len(v) == len(mask) or len(v) > len(mask) == op.SPAN:
                for window, stretches in places(v, mask).items():
                    sought[window] += [(item_id, len(v), near, last) for near, (_, last) in stretches.items()]
        for d in docs:
            for window, stretches in places(words(d.text), mask, sought).items():
                for (near, (first, _)), (item_id, n, other, last) in product(stretches.items(), sought[window]):
                    matched = sum(x is not None and x == y for x, y in zip(near, other))
                    if matched >= min(op.LEAST, math.ceil(op.SHARE * n)):
                        key = (d.doc_id, item_id)
                        least, most = found.get(key, (first - last, 0))
                        found[key] = min(least, first - last), max(most, matched)
    return sorted(((*k, *v) for k, v in found.items()), key=repr)


@pytest.fixture(scope="module")
def planted(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(200)]
    make = lambda n: rng.choices(vocabulary, k=n)
    items = [make(n) for n in (5, 8, 14, 40, 60)] + [[], make(3), make(6) * 9]
    docs = []
    for k, item in enumerate(items):
        for every in (0, 9, 5, 2):
            copy = [("changed" if every and i % every == every - 1 else x) for i, x in enumerate(item)]
            docs.append((10 * k + every, " ".join([*make(30), *copy, *make(30)]), "en", "s", 0))
        docs.append((10 * k + 7, " ".join(item[len(item) // 3 :] + make(5)), "en", "s", 0))
        docs.append((10 * k + 8, "Intro, " + "-".join(item).upper() + ".", "en", "s", 0))
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(90, " ".join(items[3])), (None, None)], "item_id long, text string")
    return spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), bench


@pytest.mark.parametrize("broadcast", [True, False])
def test_planted(planted, monkeypatch, broadcast):
    docs, bench = planted
    if not broadcast:
        monkeypatch.setattr(op, "BROADCAST_SEEDS", 0)
    got = rows(op.overlaps(docs, bench), "doc_id", "item_id", "start_word", "matched")
    assert got == brute(docs.collect(), bench.collect())
    hit = {r[0] for r in got}
    assert {20, 29, 25, 30, 39, 35, 40, 49, 45, 38, 48, 37, 47} <= hit  # copies with every fifth word changed, and two thirds of an item
    assert {0, 8, 9, 70, 78} <= hit  # an item of five words as a whole, and one that repeats itself
    assert not {5, 7, 32, 42, 50, 60, 68} & hit


@pytest.mark.parametrize("every", range(3, 10))
def test_a_word_changed_at_every_few_places(spark, every):
    rng = random.Random(every)
    item = [f"w{rng.randrange(10**6)}" for _ in range(60)]
    docs = [(k, " ".join("changed" if i % every == k else x for i, x in enumerate(item)), "en", "s", 0) for k in range(every)]
    bench = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = op.overlaps(spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"), bench)
    assert {r.doc_id for r in got.collect()} == set(range(every))


def test_no_whole_text_is_shuffled(planted, monkeypatch):
    """With a large benchmark the exchanges above the documents' scan carry numbers and stretches."""
    monkeypatch.setattr(op, "BROADCAST_SEEDS", 0)
    docs, bench = planted
    execution = op.overlaps(docs, bench)._jdf.queryExecution()
    plan = execution.explainString(docs.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    exchanges = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\((\w+)", plan)
    by_seed = [columns for columns, key in exchanges if key == "seed"]
    assert any("around#" in x for x in by_seed) and not any(re.search(r"\bwords#", x) for x in by_seed)


def test_odd_documents(spark, planted):
    docs, bench = odd(spark), planted[1]
    assert op.overlaps(docs, bench).count() == 0
    own = docs.selectExpr("doc_id AS item_id", "text")
    got = rows(op.overlaps(docs, own), "doc_id", "item_id", "start_word", "matched")
    assert got == sorted(set(brute(docs.collect(), own.collect())), key=repr)
    assert {(5, 5), (5, 6), (6, 6), (8, 8)} <= {r[:2] for r in got}
    assert rows(op.overlaps(clashing(docs), own), "doc_id", "item_id", "start_word", "matched") == got
    left = op.decontaminate(clashing(docs), own)
    assert left.columns == clashing(docs).columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == sorted(d.doc_id or 0 for d in docs.collect() if d.doc_id not in {r[0] for r in got})
    assert op.overlaps(docs.limit(0), own).count() == 0 == op.overlaps(docs, own.limit(0)).count()


def test_whole_table(spark):
    docs, bench = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert rows(op.query(spark, SF), "doc_id", "item_id", "start_word", "matched") == brute(docs.collect(), bench.collect())
