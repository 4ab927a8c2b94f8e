from __future__ import annotations

import random
import re

from tests.conftest import SF
from tests.llm.helpers import clashing, odd, rows
from tidemark.llm import op10_diagonal as op
from tidemark.llm.common import ALNUM, table

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]


def brute(text):
    words = re.findall(ALNUM, "".join(c.lower() if c.isascii() else c for c in text or ""))
    places, labels, accepted, score = [], set(), set(), 0.0
    for t, (template, label) in enumerate(op.BASE + op.TEMPLATES):
        v = op.template_words(template)
        n = len(v) - op.K + 1
        at = {}
        for q in range(n):
            at.setdefault(tuple(v[q : q + op.K]), []).append(q)
        hits = {}
        for p in range(len(words) - op.K + 1):
            for q in at.get(tuple(words[p : p + op.K]), ()):
                hits.setdefault(p - q, []).append(p)
        if t < len(op.BASE):
            here = [i for i in range(len(words)) if words[i : i + len(v)] == v]
            places += here
            labels |= {label} if here else set()
            score = max([score, *(len(ps) / n for ps in hits.values())])
            continue
        bands = []
        for d in sorted(hits):
            if bands and d - bands[-1][-1] <= op.SLIP:
                bands[-1].append(d)
            else:
                bands.append([d])
        for band in bands:
            ps = [p for d in band for p in hits[d]]
            covered = min(1.0, len(ps) / n)
            score = max(score, covered)
            if covered >= op.COVERED and max(ps) - min(ps) + 1 <= op.LONGER * n + op.SLIP:
                accepted.add(label)
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | accepted)), score


def expect(docs):
    return sorted(((d.doc_id, *brute(d.text)) for d in docs), key=repr)


def test_templates_with_changes(spark):
    rng = random.Random(6)
    texts = []
    for template, _ in op.BASE + op.TEMPLATES:
        words = template.split()
        for change in range(4):
            some = [*words]
            for _ in range(change):
                at = rng.randrange(len(some))
                some[at : at + 1] = rng.choice([[], ["other"], [some[at], "more"]])
            texts.append("Before it. " * rng.randrange(3) + " ".join(some) + rng.choice([".", "\nMIT mit under the MIT-license", " cc by nc cc BY-NC"]))
    texts += ["under the mit license under the mit license", "ccK by nc", "CC BY NC", "under the mit license"]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    assert rows(op.scan(docs), *COLUMNS) == expect(docs.collect())


def test_a_body_without_its_opening(spark):
    grant, notice = op.TEMPLATES[12][0], op.TEMPLATES[13][0]
    texts = [f"Some words before. {grant}: {notice}. And after.", "The above copyright is ours, and notices shall be included where copies of the software are sold."]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r.labels for r in op.scan(docs).orderBy("doc_id").collect()] == ["mit", ""]


def test_odd_documents(spark):
    docs = odd(spark)
    assert rows(op.scan(docs), *COLUMNS) == expect(docs.collect())
    assert rows(op.scan(clashing(docs)), *COLUMNS) == expect(docs.collect())
    assert op.scan(docs.limit(0)).count() == 0


def test_whole_table(spark):
    assert rows(op.query(spark, SF), *COLUMNS) == expect(table(spark, SF, "documents").collect())
