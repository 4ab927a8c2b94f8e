from __future__ import annotations

import base64
import hashlib
import math
import random
import re
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from tests.llm.helpers import clashing, odd
from tidemark.llm import op07_randomness as op
from tidemark.llm.common import table

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def brute(text):
    text = text or ""
    spans = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def held(docs, out):
    expected = {}
    for d in docs:
        spans = brute(d.text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected[d.doc_id] = (*[sum(s[0] == k for s in spans) for k in ("assign", "access", "hex")], hashlib.sha256(listed.encode()).hexdigest())
    assert {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in out} == expected
    for r in out:
        base = [s for s in r.spans.split(",") if s and not s.startswith("random")]
        assert hashlib.sha256(",".join(base).encode()).hexdigest() == r.base_sha256


def run(docs):
    rows = op.scan(docs)
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).alias(f"n_{kind}")
    return rows.select("doc_id", count("assign"), count("access"), count("hex"), F.sha2(op._listed(F.col("base")), 256).alias("base_sha256"), op._listed(F.array_sort(F.concat("base", "added"))).alias("spans")).collect()


def documents(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def test_base_spans(spark):
    rng = random.Random(2)
    parts = ["password", "Secret", "token", "api_key", "APIKEY", ":", "=", " ", '"', "'", "abc", "abcdef", "AKIA", "ABCDEFGHIJKLMNOP1234", "deadbeefdeadbeefdeadbeef", "é", "\U0001f600", "\n", "-", "ſecret"]
    docs = documents(spark, ["".join(rng.choices(parts, k=rng.randrange(25))) for _ in range(400)])
    held(docs.collect(), run(docs))


def test_odd_documents(spark):
    docs = odd(spark)
    out = run(docs)
    assert len(out) == docs.count()
    held(docs.collect(), out)
    assert sorted(run(clashing(docs)), key=repr) == sorted(out, key=repr)
    assert run(docs.limit(0)) == []


def test_random_strings_are_found_and_words_are_not(spark):
    rng = random.Random(9)
    keys = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(60)]
    plain = ["donaudampfschifffahrtsgesellschaft", "internationalisation_and_localisation", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaZ9", "12345678901234567890123", "a-very-long-file-name-with-words", "=" * 40]
    docs = documents(spark, [f"see {k} here" for k in keys] + [f"see {p} here" for p in plain])
    out = {r.doc_id: r.spans for r in run(docs)}
    assert sum("random" in out[i] for i in range(60)) >= 54
    assert out[0].startswith("random:4:44") or "random" not in out[0]
    assert not any("random" in out[60 + i] for i in range(len(plain)))


def test_whole_table(spark):
    held(table(spark, SF, "documents").collect(), op.query(spark, SF).collect())


ALPHANUMERIC = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def tail(z):
    """The normal distribution's two tails beyond ``z``."""
    return math.erfc(abs(z) / math.sqrt(2))


def brute_words(texts):
    """log of the steps of the word model, from all texts less their candidates."""
    kind = lambda c: "a" if c in op.LETTERS else "A" if c.lower() in op.LETTERS and c.isascii() else "0" if c in "0123456789" else "-" if c in "+/-_" else " "
    steps = Counter()
    for text in texts:
        marks = "".join(map(kind, " " + re.sub(r"[A-Za-z0-9+/_-]{20,}", " ", text or "") + " "))
        steps.update(zip(marks, marks[1:]))
    model = {}
    for x in "aA0- ":
        prior = op.SHARES[x]
        total = sum(steps[x, y] for y in prior) + op.PRIOR
        model |= {(x, y): math.log(0.9 * (steps[x, y] + op.PRIOR * p) / total + 0.1 * p) for y, p in prior.items()}
    letters = {c: math.log(0.9 * n / sum(op.LETTERS.values()) + 0.1 / 26) for c, n in op.LETTERS.items()}
    return kind, model, letters


def brute_tests(token, words):
    """(encoding, p_random, log_p_words) of one candidate, or None."""
    kind, model, letters = words
    found = next(((name, a) for name, a in op.ENCODINGS if set(token) <= set(a)), None)
    if found is None:
        return None
    name, alphabet = found
    n, k = len(token), len(alphabet)
    x = [alphabet.index(c) for c in token]
    chi2, df = sum((x.count(v) - n / k) ** 2 / (n / k) for v in range(k)), k - 1
    z = [((chi2 / df) ** (1 / 3) - 1 + 2 / (9 * df)) / math.sqrt(2 / (9 * df))]
    high = sum(2 * v >= k for v in x)
    runs = 1 + sum((2 * a >= k) != (2 * b >= k) for a, b in zip(x, x[1:]))
    mean = 2 * high * (n - high) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    z.append((runs - mean) / math.sqrt(var) if var > 0 else 99)
    m = sum(x) / n
    spread = sum((v - m) ** 2 for v in x)
    z.append((sum((a - m) * (b - m) for a, b in zip(x, x[1:])) / spread + 1 / n) * math.sqrt(n) if spread else 99)
    marks = " " + "".join(map(kind, token))
    log_words = sum(model[p] for p in zip(marks, marks[1:])) + sum(letters[c.lower()] if c.isalpha() else math.log(1 / 10 if c.isdigit() else 1 / 4) for c in token)
    return name, min(1, 3 * tail(max(map(abs, z)))), min(0, log_words + n * math.log(k) + math.log(8))


def mixed_texts(rng, every=3):
    words = "the and nder Haus zeit Lieder CHEVAL agua noche being tion".split()
    texts = []
    for i in range(300):
        tokens = [rng.choice(words) for _ in range(12)]
        tokens.append("".join(rng.choice(words).capitalize() for _ in range(5)) + str(i))
        tokens.append("/".join(rng.choices(words, k=5)) + "-" * (i % 2) + str(i % 7) * 9)
        if i % every == 0:
            tokens.append("".join(rng.choices(rng.choice([ALPHANUMERIC, ALPHANUMERIC[26:], ALPHANUMERIC[36:], ALPHANUMERIC + "+/"]), k=rng.choice([20, 24, 32, 36, 40, 64]))))
        rng.shuffle(tokens)
        texts.append(" ".join(tokens))
    return texts


def test_battery_and_thresholds_against_brute_force(spark):
    texts = mixed_texts(random.Random(4))
    docs = documents(spark, [*texts, None])
    rows = op.cut(op.spans_of(docs))
    got = {(r.doc_id, r.start): r for r in op.tested(docs, rows).collect()}
    words = brute_words(texts)
    told = {}
    for i, text in enumerate(texts):
        taken = [s[1:] for s in brute(text)]
        for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", text):
            if not any(a < m.end() and b > m.start() for a, b in taken) and (found := brute_tests(m[0], words)):
                told[i, m.start()] = (m[0], *found)
    assert got.keys() == told.keys() and len(told) > 300
    for key, (token, name, p_random, log_p) in told.items():
        r = got[key]
        assert (r.found, r.encoding, r.n) == (token, name, len(token))
        assert r.p_random == pytest.approx(p_random, rel=1e-5) and r.log_p_words == pytest.approx(log_p, rel=1e-6, abs=1e-6)

    # Benjamini-Hochberg by encoding and length, on p values rounded up to their bins
    classes = defaultdict(list)
    for key, (token, name, p_random, log_p) in told.items():
        classes[name, int(math.log2(len(token)))].append((min(op.BINS, math.floor(-100 * log_p)), key))
    expected = set()
    for members in classes.values():
        members.sort(reverse=True)
        rank = {b: sum(x >= b for x, _ in members) for b, _ in members}
        passing = [b for b in rank if math.exp(-b / 100) <= op.FDR * rank[b] / len(members)]
        expected |= {key for b, key in members if passing and b >= min(passing)}
    mixed = lambda token: sum(bool(re.search(x, token)) for x in ("[a-z]", "[A-Z]", "[0-9]")) >= 2
    expected = {k for k in expected if told[k][2] > op.REJECT and mixed(told[k][0])}
    added = {(r.doc_id, x.start) for r in op.scan(docs).collect() for x in r.added}
    assert added == expected and len(expected) > 80


def test_recall_by_length_among_clean_candidates(spark):
    """Random strings of 20 characters and more are found; CamelCase, paths and numbered names are left."""
    rng = random.Random(8)
    lengths = [20, 24, 32, 36, 40, 64]
    keys = ["".join(rng.choices(ALPHANUMERIC, k=lengths[i % 6])) for i in range(300)]
    clean = [t for text in mixed_texts(rng, 10**9)[1:] for t in text.split() if len(t) >= 20]
    out = {r.doc_id: len(r.added) for r in op.scan(documents(spark, [f"See {t} here" for t in keys + clean])).collect()}
    for k in range(6):
        assert sum(out[i] for i in range(k, 300, 6)) >= 45, lengths[k]
    assert len(clean) > 300 and sum(out[300 + i] for i in range(len(clean))) <= 0.02 * len(clean)


def test_long_tokens_and_many(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHANUMERIC, k=100_000)), " ".join("".join(rng.choices(ALPHANUMERIC, k=30)) for _ in range(5000)), "q" * 500_000, "ab" * 100_000 + "Z9"]
    began = time.time()
    out = {r.doc_id: r.added for r in op.scan(documents(spark, texts)).collect()}
    assert time.time() - began < 120
    assert [(x.start, x.end) for x in out[0]] == [(0, 100_000)] and out[2] == out[3] == []
    assert len(out[1]) > 4500 and all(x.start % 31 == 0 and x.end == x.start + 30 for x in out[1])
