"""Personal data by a skip-chain conditional random field.

Base: four patterns with their checks.  Method: a document's candidates (what the
patterns match, and other numbers and addresses that look alike: see
``CANDIDATES``) are the nodes of a field; all other text is outside for certain.
A node's label is one of the kinds, or none.

- node potentials: softmax regression on binary features of the candidate and of
  the words before it, trained on the candidates of the whole corpus, labelled by
  the base.  Only the count of each feature pattern and label is gathered, a
  table bounded by the features' combinations;
- chain potentials between candidates that follow each other within ``NEAR``
  characters: log of how often the labels of neighbours go together, from the
  same pass;
- skip potentials (``SAME``) between distant candidates whose tokens repeat, or
  are similar: equal digits, or equal but for case, or the same last digits.

Loopy belief propagation passes messages until they settle or ``ROUNDS`` is
reached; base candidates are clamped to their kind.  A key's occurrences are
linked one to the next and to the first, so that the graph is linear in the
candidates.  A candidate whose kind has probability ``ACCEPT`` and which overlaps
no base span is added: so the second mention of a number, in another notation,
gets the label of the first.

Defined cases: a null text is empty; no spans: counts 0, the digest of the empty
string; repeated rows are judged alike.  Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

KINDS = ("email", "ip", "card", "phone")
NONE = len(KINDS)
NEAR, SAME, ROUNDS, ACCEPT = 40, 4.0, 8, 0.9

# fixed patterns of the base; the possessive forms and the look-behind only spare the search hopeless starts
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Numbers with at least seven digits and the usual marks between them, and addresses spelt with "at" and "dot".
CANDIDATES = (
    re.compile(r"(?<![0-9A-Za-z])\(?[0-9](?:[\x20().-]{0,2}[0-9]){6,18}(?![0-9A-Za-z])"),
    re.compile(r"(?<![0-9A-Za-z])[A-Za-z0-9._%+-]{1,64}\x20?[\[(]?(?:at|AT)[\])]?\x20?[A-Za-z0-9-]{1,63}(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[A-Za-z0-9-]{1,63})+"),
)
CUES = {"email": ("mail", "write"), "ip": ("ip", "host", "server", "address"), "card": ("card", "visa", "credit"), "phone": ("phone", "tel", "call", "mobile", "fax")}
_CUE = re.compile(r"[a-z]+")


def luhn(digits: str) -> bool:
    numbers = [int(d) for d in reversed(digits)]
    return sum(numbers[::2] + [2 * d - 9 * (d > 4) for d in numbers[1::2]]) % 10 == 0


def digits_of(found: str) -> str:
    return "".join(c for c in found if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    spans: list[tuple[int, int, int]] = []
    if "@" in text:
        # one "@" per match: the local part is the run before it, as far as no earlier match took it
        last = 0
        for run in _LOCAL.finditer(text):
            start, at = max(run.start(), last), run.end()
            if start < at < len(text) and text[at] == "@" and (domain := _DOMAIN.match(text, at + 1)):
                last = domain.end()
                spans.append((0, start, last))
    if re.search(r"[0-9]", text):
        spans += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups())]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 16 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
                spans.append((2, *m.span()))
        spans += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(digits_of(m[0])) <= 15]
    return spans


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(label, start, end) in order: base spans with their kind, and what looks alike outside them with ``NONE``."""
    nodes = [(k, a, b) for k, a, b in base]
    taken = sorted((a, b) for _, a, b in base)
    starts, furthest = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    numbers, spelt = re.search(r"[0-9]{2}|[0-9][\x20().-]{1,2}[0-9]", text), "dot" in text or "DOT" in text
    for pattern, worthwhile in zip(CANDIDATES, (numbers, spelt)):
        if worthwhile:
            for m in pattern.finditer(text):
                a, b = m.span()
                # of the spans that start before its end, does the furthest reach into it?
                i = bisect_left(starts, b)
                if not i or furthest[i - 1] <= a:
                    nodes.append((NONE, a, b))
    return sorted(nodes, key=lambda n: (n[1], n[2], n[0]))


def features(text: str, start: int, end: int) -> int:
    """The candidate's binary features, as the bits of a number."""
    found, n = text[start:end], len(digits_of(text[start:end]))
    before = set(_CUE.findall(text[max(0, start - 24) : start].lower())[-3:])
    bits = [
        "@" in found,
        n == 0,
        1 <= n < 8,
        8 <= n <= 15,
        16 <= n <= 19,
        n >= 16 and n <= 19 and luhn(digits_of(found)),
        found.startswith("+"),
        found.count(".") == 3,
        "(" in found or " " in found,
        "-" in found,
        bool(re.search("[A-Za-z]", found)),
        *[any(c in before for c in CUES[k]) for k in KINDS],
    ]
    return sum(1 << i for i, x in enumerate(bits) if x)


N_FEATURES = 15


def unpacked(patterns: np.ndarray) -> np.ndarray:
    return np.column_stack([(patterns >> i) & 1 for i in range(N_FEATURES)] + [np.ones_like(patterns)]).astype(float)


def keys(found: str) -> list[tuple[str, str]]:
    """What a token shares with those that repeat or resemble it."""
    digits = digits_of(found)
    out = [("text", re.sub(r"[^a-z0-9]", "", re.sub(r"(?i)[\[(]?\b(at|dot)\b[\])]?|[@.]", "", found).lower()))]
    if len(digits) >= 7:
        out += [("digits", digits), ("last", digits[-7:])]
    return [k for k in out if len(k[1]) >= 5]


def propagate(nodes: list[tuple[int, int, int]], unary: np.ndarray, text: str, chain: np.ndarray) -> np.ndarray:
    """Label probabilities of the nodes by loopy sum-product."""
    n, labels = len(nodes), NONE + 1
    same = np.eye(labels) * SAME
    pairs: dict[tuple[int, int], np.ndarray] = {}
    for i in range(n - 1):
        if nodes[i + 1][1] - nodes[i][2] <= NEAR:
            pairs[i, i + 1] = chain
    first: dict[tuple[str, str], int] = {}
    last: dict[tuple[str, str], int] = {}
    for i, (_, a, b) in enumerate(nodes):
        for key in keys(text[a:b]):
            for j in {first.setdefault(key, i), last.get(key, i)} - {i}:
                pairs.setdefault((j, i), np.zeros((labels, labels)))
                pairs[j, i] = np.maximum(pairs[j, i], same)
            last[key] = i
    if not pairs:
        belief = unary
    else:
        left, right = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
        potential = np.stack([*pairs.values()])
        forth, back = np.zeros((len(left), labels)), np.zeros((len(left), labels))
        for _ in range(ROUNDS):
            belief = unary.copy()
            np.add.at(belief, right, forth)
            np.add.at(belief, left, back)
            new_forth = np.logaddexp.reduce(potential + (belief[left] - back)[:, :, None], axis=1)
            new_back = np.logaddexp.reduce(potential + (belief[right] - forth)[:, None, :], axis=2)
            new_forth -= new_forth.max(1, keepdims=True)
            new_back -= new_back.max(1, keepdims=True)
            moved = max(np.abs(new_forth - forth).max(), np.abs(new_back - back).max())
            forth, back = new_forth, new_back
            if moved < 1e-3:
                break
        belief = unary.copy()
        np.add.at(belief, right, forth)
        np.add.at(belief, left, back)
    belief = belief - belief.max(1, keepdims=True)
    return np.exp(belief) / np.exp(belief).sum(1, keepdims=True)


def train(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(weights by feature and label, chain potentials), from counts over all documents."""

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = text or ""
                nodes = candidates(text, base_spans(text))
                seen.update(("node", features(text, a, b), k) for k, a, b in nodes)
                seen.update(("chain", x[0], y[0]) for x, y in zip(nodes, nodes[1:]) if y[1] - x[2] <= NEAR)
        rows = [(*k, n) for k, n in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["what", "x", "y", "n"])

    counted = docs.select("text").mapInArrow(count, "what string, x long, y long, n long").groupBy("what", "x", "y").agg(F.sum("n").alias("n")).collect()
    labels = NONE + 1
    weights = np.zeros((N_FEATURES + 1, labels))
    nodes = [(r["x"], r["y"], r["n"]) for r in sorted(counted) if r["what"] == "node"]
    if nodes:
        x, y, n = (np.array(c) for c in zip(*nodes))
        f, target, share = unpacked(x), np.eye(labels)[y], n / n.sum()
        for _ in range(500):
            z = f @ weights
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            weights -= 1.0 * (f.T @ ((p - target) * share[:, None]) + 1e-4 * weights)
    chain = np.ones((labels, labels))
    for r in counted:
        if r["what"] == "chain":
            chain[r["x"], r["y"]] += r["n"]
    chain = np.log(chain * chain.sum() / (chain.sum(1, keepdims=True) * chain.sum(0, keepdims=True)))
    return weights, np.clip(chain, -2, 2)


def find(text: str, weights: np.ndarray, chain: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base spans, added spans)."""
    base = base_spans(text)
    nodes = candidates(text, base)
    if all(k != NONE for k, _, _ in nodes):
        return base, []
    z = unpacked(np.array([features(text, a, b) for _, a, b in nodes])) @ weights
    unary = z - np.logaddexp.reduce(z, axis=1, keepdims=True)
    for i, (k, _, _) in enumerate(nodes):
        if k != NONE:
            unary[i] = -50.0
            unary[i, k] = 0.0
    p = propagate(nodes, unary, text, chain)
    added, end = [], -1
    for (k, a, b), q in zip(nodes, p):
        best = int(q[:NONE].argmax())
        if k == NONE and q[best] >= ACCEPT and a >= end:
            added.append((best, a, b))
            end = b
    return base, added


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def scan(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    def of(batches):
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = find(text or "", *model.value)
                counts = Counter(k for k, _, _ in base)
                rows.append((*[counts[k] for k in range(NONE)], hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + added)))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)]], NAMES)

    return docs.select("doc_id", "text").mapInArrow(of, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


NAMES = ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]


def masked(text: str | None, weights: np.ndarray, chain: np.ndarray) -> str | None:
    """``text`` with each span, overlapping ones together, replaced by its kind in angle brackets."""
    if text is None:
        return None
    base, added = find(text, weights, chain)
    if not base and not added:
        return text
    out, last = [], 0
    for a, b, k in sorted((a, b, k) for k, a, b in base + added):
        if a >= last:
            out += [text[last:a], f"<{KINDS[k]}>"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def mask(docs: DataFrame) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced, and ``n_chars`` of the new text."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs))

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        return pd.Series([masked(t, *model.value) for t in texts], dtype=object)

    text = clean(F.col("text"))
    changed = docs.withColumn("text", text)
    return changed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else changed


def query(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
