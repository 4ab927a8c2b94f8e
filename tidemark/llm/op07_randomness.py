"""Secret scans by a battery of randomness tests.

Base: three patterns (assignments to secret-like names, access keys, long
hexadecimal runs).  Besides, every run of ``SHORTEST`` or more characters of the
base64 alphabets outside these spans is a candidate, of the smallest encoding
that holds all its characters, and is put to three tests:

- chi-squared: are the encoding's characters equally frequent?
- runs: does the sequence cross the middle of the alphabet as often as chance does?
- serial correlation: does a character tell of the next?

A candidate must not be rejected as random by any test at ``REJECT`` (shared among
the three), must mix at least two of lower case, upper case and digits, and must
be unlike words.  For that the null hypothesis is a model of words: a chain of
character classes (lower, upper, digit, sign), whose steps are counted over all
texts of the corpus less their candidates, besides a prior, and letters of usual
frequency.  The probability of the candidate under the model over that under
uniform characters is a p value by Markov's inequality: under the null the
inverse ratio has expectation 1 at most for each encoding.  It falls
exponentially with the length for random text, while chi-squared alone has no
power against words at 20 to 40 characters.  These p values pass a
false-discovery control at ``FDR`` in classes of encoding and length
(Benjamini-Hochberg over the corpus, on p values binned by their logarithm, so
that a bounded table of counts gives the thresholds).

The work is linear in a text and in a candidate, however long.

Defined cases: a null text is empty; no spans: counts 0, the digest of the empty
string, empty spans; equal rows are counted once by the control and reported once
each; candidates of equal p value pass or fail together; an empty table gives no
rows.  Positions are code points.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import cut, same_row, table

#: Fixed patterns of the base, in the order of the kinds.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
SHORTEST = 20
CANDIDATE = rf"[A-Za-z0-9+/_-]{{{SHORTEST},}}"
#: The encodings, smallest first, with their characters in order of value.
ENCODINGS = [
    ("digits", "0123456789"),
    ("hex", "0123456789abcdef"),
    ("hex_upper", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "abcdefghijklmnopqrstuvwxyz0123456789"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
]
REJECT = 0.01
FDR = 0.01
#: p values are binned by hundredths of their natural logarithm, into this many bins at most.
BINS = 4000

SIGNS = "+/-_"
#: How often letters stand in words, about, in parts of a thousand.
LETTERS = {
    "a": 82, "b": 15, "c": 28, "d": 43, "e": 127, "f": 22, "g": 20, "h": 61, "i": 70, "j": 2, "k": 8, "l": 40, "m": 24,
    "n": 67, "o": 75, "p": 19, "q": 1, "r": 60, "s": 63, "t": 91, "u": 28, "v": 10, "w": 24, "x": 2, "y": 20, "z": 1,
}
#: A character for each class; a blank stands for all others.
CLASSES, OUTSIDE = "aA0-", " "
CHANGES = [x + y for x in CLASSES + OUTSIDE for y in CLASSES + OUTSIDE if x != y]
#: The prior of the word model: so many steps from each class, in these shares; and letters that are equally frequent.
PRIOR = 1000
SHARES = {
    "a": {"a": 0.85, "A": 0.05, "0": 0.05, "-": 0.05},
    "A": {"a": 0.5, "A": 0.4, "0": 0.05, "-": 0.05},
    "0": {"a": 0.07, "A": 0.07, "0": 0.8, "-": 0.06},
    "-": {"a": 0.4, "A": 0.3, "0": 0.2, "-": 0.1},
    " ": {"a": 0.4, "A": 0.3, "0": 0.25, "-": 0.05},
}
#: This share of the word model is its prior, whatever the counts, so that a rare step, as inside CamelCase, is not all but impossible.
MIXED = 0.1
#: Matches are placed in blocks of this size.
_BLOCK = 256


def let(value: Column, then) -> Column:
    """``then(value)``, where ``value`` is evaluated once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def found_in(text: Column, pattern: str) -> Column:
    """The matches of ``pattern`` as an array of (start, end, found); the places are sought only where there are any.

    Block by block, so that an array that grows is copied for each block and not for each match.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    none = F.lit([]).cast("array<struct<start:bigint,end:bigint,found:string>>")

    def step(s, x):
        start = s["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.alias("at"), F.concat(s["out"], F.array(F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("found")))).alias("out"))

    def block_step(s, block):
        inner = F.aggregate(block, F.struct(s["at"].alias("at"), none.alias("out")), step)
        return let(inner, lambda r: F.struct(r["at"].alias("at"), F.concat(s["out"], F.array(r["out"])).alias("out")))

    def placed(hits):
        gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits))
        zipped = F.zip_with(gaps, hits, lambda g, h: F.struct(g.alias("gap"), h.alias("hit")))
        blocks = let(zipped, lambda z: F.transform(F.sequence(F.lit(1), F.size(z), F.lit(_BLOCK)), lambda b: F.slice(z, b, F.lit(_BLOCK))))
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit([]).cast("array<array<struct<start:bigint,end:bigint,found:string>>>").alias("out"))
        return F.flatten(F.aggregate(blocks, start, block_step, lambda s: s["out"]))

    return let(hits, lambda h: F.when(F.size(h) > 0, placed(h)).otherwise(none))


def upper_tail(z: Column) -> Column:
    """The normal distribution's upper tail, to a relative error of about 1e-7 at any z: the exponential of a polynomial for erfc."""
    x = F.abs(z) / F.sqrt(F.lit(2.0))
    t = 1 / (1 + x / 2)
    poly = F.lit(0.0)
    for c in (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    tail = t * F.exp(poly - x * x) / 2
    return F.when(z >= 0, tail).otherwise(1 - tail)


def times(text: Column, part: str) -> Column:
    """How often ``part``, which doesn't overlap itself, stands in ``text``."""
    return ((F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))) / len(part)).cast("long")


def class_counts(text: Column) -> Column:
    """How many characters of each class there are, and how many steps between unlike classes, as one array of longs."""
    marks = [*zip(CLASSES, ("[a-z]+", "[A-Z]+", "[0-9]+", "[+/_-]+")), (OUTSIDE, "[^aA0-]+")]

    def marked(short, sizes, left):
        """Each run becomes its class's mark; what that takes off is the size of the runs less their number."""
        if left:
            return let(F.regexp_replace(short, left[0][1], left[0][0]), lambda x: marked(x, [*sizes, F.length(short) - F.length(x)], left[1:]))
        totals = [(gone + times(short, x)).cast("long") for gone, x in zip(sizes, CLASSES)]
        return F.array(*totals, *[times(short, x) for x in CHANGES])

    return let(F.concat(F.lit(OUTSIDE), text, F.lit(OUTSIDE)), lambda x: marked(x, [], marks))


class Words:
    """The model of words: logarithms of the frequencies of letters, and of steps between classes."""

    def __init__(self, counts):
        steps = _steps(counts)
        total = sum(LETTERS.values())
        self.letters = {c: log((1 - MIXED) * n / total + MIXED / len(LETTERS)) for c, n in LETTERS.items()}
        self.steps = {}
        for x in CLASSES + OUTSIDE:
            total = sum(steps[x + y] for y in CLASSES) + PRIOR
            self.steps |= {x + y: log((1 - MIXED) * (steps[x + y] + PRIOR * p) / total + MIXED * p) for y, p in SHARES[x].items()}

    def log_probability(self, text: Column) -> Column:
        """Of a text of the classes' characters."""
        letters = let(F.lower(text), lambda x: sum(times(x, c) * p for c, p in self.letters.items()))

        def chain(counts):
            of = [F.get(counts, F.lit(i)).cast("double") for i in range(4 + len(CHANGES))]
            uniform = of[CLASSES.index("0")] * log(1 / 10) + of[CLASSES.index("-")] * log(1 / len(SIGNS))
            found = _steps(of)
            return uniform + sum(found[s] * p for s, p in self.steps.items())

        return letters + let(class_counts(text), chain)


def _steps(counts) -> dict:
    """Counts of all steps from class to class, from those of ``class_counts``: what does not leave a class stays in it."""
    totals, steps = dict(zip(CLASSES, counts[:4])), dict(zip(CHANGES, counts[4:]))
    return steps | {x + x: totals[x] - sum(steps[x + y] for y in CLASSES + OUTSIDE if y != x) for x in CLASSES}


def words_of(docs: DataFrame) -> Words:
    """The word model of all texts.  A row of counts for each place of the array reaches the driver."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = docs.select(F.posexplode(class_counts(F.regexp_replace(text, CANDIDATE, OUTSIDE))).alias("place", "n"))
    found = {r["place"]: r["n"] for r in counted.groupBy("place").agg(F.sum("n").alias("n")).collect()}
    return Words([found.get(i, 0) for i in range(4 + len(CHANGES))])


def battery(candidates: DataFrame, words: Words) -> DataFrame:
    """``candidates`` (with ``found``) with encoding, n, p_random, log_p_words and classes."""
    fits = F.lit(None).cast("int")
    for i, (_, letters) in reversed([*enumerate(ENCODINGS)]):
        fits = F.when(F.col("found").rlike(f"^[{letters.replace('-', chr(92) + '-')}]+$"), F.lit(i)).otherwise(fits)
    alphabets, names = F.array(*[F.lit(a) for _, a in ENCODINGS]), F.array(*[F.lit(n) for n, _ in ENCODINGS])
    token = F.col("found")

    def walk(s, v):
        """Sums over values and over successive ones; crossings of the middle."""
        high = (2 * v >= s["size"]).cast("double")
        first = s["last"] < 0
        return F.struct(
            s["size"].alias("size"), (s["x"] + v).alias("x"), (s["xx"] + v * v).alias("xx"), (s["xy"] + F.when(first, 0.0).otherwise(s["last"] * v)).alias("xy"), (s["high"] + high).alias("high"),
            (s["runs"] + F.when(first | ((2 * s["last"] >= s["size"]) != (2 * v >= s["size"])), 1.0).otherwise(0.0)).alias("runs"), F.when(first, v).otherwise(s["first"]).alias("first"), v.alias("last"),
        )

    def measured(alphabet):
        size = F.length(alphabet).cast("double")
        values = F.transform(F.split(token, ""), lambda c: (F.position(c, alphabet) - 1).cast("double"))
        zero = F.struct(size.alias("size"), *[F.lit(0.0).alias(x) for x in ("x", "xx", "xy", "high", "runs", "first")], F.lit(-1.0).alias("last"))
        often = lambda c: F.length(token) - F.length(F.replace(token, c, F.lit("")))
        squares = F.aggregate(F.split(alphabet, ""), F.lit(0.0), lambda s, c: s + F.pow(often(c).cast("double"), F.lit(2.0)))
        return F.struct(F.aggregate(values, zero, walk).alias("s"), squares.alias("squares"), words.log_probability(token).alias("log_words"))

    # a generator evaluates its argument once a row, however often the fields are used
    named = candidates.withColumn("enc", fits).where("enc IS NOT NULL")
    rows = named.select(*candidates.columns, "enc", F.inline(F.array(let(F.get(alphabets, F.col("enc")), measured)))).select(*candidates.columns, "enc", "s.*", "squares", "log_words")
    n, size = F.length(token).cast("double"), F.col("size")
    df = size - 1
    # the cube root of chi-squared over its mean is nearly normal
    chi2 = size / n * F.col("squares") - n
    z_chi2 = (F.cbrt(F.greatest(chi2, F.lit(0.0)) / df) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
    high, low = F.col("high"), n - F.col("high")
    mean_runs = 2 * high * low / n + 1
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    z_runs = F.when(var_runs > 0, (F.col("runs") - mean_runs) / F.sqrt(var_runs)).otherwise(F.lit(99.0))
    mean = F.col("x") / n
    spread = F.col("xx") - n * mean * mean
    together = F.col("xy") - mean * (2 * F.col("x") - F.col("first") - F.col("last")) + (n - 1) * mean * mean
    z_serial = F.when(spread > 0, (together / spread + 1 / n) * F.sqrt(n)).otherwise(F.lit(99.0))
    strangest = F.greatest(F.abs(z_chi2), F.abs(z_runs), F.abs(z_serial))
    p_random = F.least(F.lit(1.0), 6 * upper_tail(strangest))
    log_p_words = F.least(F.lit(0.0), F.col("log_words") + n * F.log(size) + log(len(ENCODINGS)))
    mixed = sum(token.rlike(c).cast("int") for c in ("[a-z]", "[A-Z]", "[0-9]"))
    return rows.select(*candidates.columns, F.get(names, F.col("enc")).alias("encoding"), n.cast("long").alias("n"), p_random.alias("p_random"), log_p_words.alias("log_p_words"), mixed.alias("classes"))


def discoveries(tested: DataFrame) -> DataFrame:
    """The candidates that are random by the battery and unlike words under the false-discovery control."""
    length_class = F.floor(F.log2(F.col("n").cast("double")))
    bin_of = F.least(F.lit(BINS), F.floor(-100 * F.col("log_p_words"))).cast("int")
    binned = tested.withColumn("class", F.struct("encoding", length_class.alias("length"))).withColumn("bin", bin_of)
    counts = binned.groupBy("class", "bin").agg(F.count(F.lit(1)).alias("k"))
    by_class = W.partitionBy("class")
    # rank: how many are at least as small; a bin's greatest p value stands for it
    rank = F.sum("k").over(by_class.orderBy(F.desc("bin")).rowsBetween(W.unboundedPreceding, W.currentRow))
    total = F.sum("k").over(by_class)
    passing = counts.select("class", "bin", (F.exp(-F.col("bin") / 100) <= FDR * rank / total).alias("passes"))
    least = passing.where("passes").groupBy("class").agg(F.min("bin").alias("least_bin"))
    # a row for each encoding and length class
    return binned.join(F.broadcast(least), "class").where((F.col("bin") >= F.col("least_bin")) & (F.col("p_random") > REJECT) & (F.col("classes") >= 2))


def spans_of(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, text_hash, the base spans, and the candidates outside them."""
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text.alias("text"))
    span = lambda i, kind: lambda x: F.struct(x["start"].alias("start"), F.lit(i).alias("number"), F.lit(kind).alias("kind"), x["end"].alias("end"))
    secret_size = lambda x: F.length(F.regexp_extract(x["found"], ASSIGN, 1))
    assign = F.filter(found_in(F.col("text"), ASSIGN), lambda x: secret_size(x) >= 6)
    access = F.filter(found_in(F.col("text"), ACCESS), lambda x: x["end"] - x["start"] >= 20)
    hexes = found_in(F.col("text"), HEX)
    base = F.array_sort(F.concat(F.transform(assign, span(0, "assign")), F.transform(access, span(1, "access")), F.transform(hexes, span(2, "hex"))))
    return plain.select("doc_id", "text_hash", base.alias("base"), found_in(F.col("text"), CANDIDATE).alias("candidates"))


def tested(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, start, end, found, encoding, n, p_random, log_p_words, classes) for each candidate outside the base of ``rows``."""
    each = rows.where(F.size("candidates") > 0).select("doc_id", "text_hash", "base", F.inline("candidates"))
    outside = each.where(~F.exists("base", lambda b: (b["start"] < F.col("end")) & (b["end"] > F.col("start")))).drop("base")
    return battery(outside, words_of(docs))


def scan(docs: DataFrame) -> DataFrame:
    """A row per document: doc_id, text_hash, base and added, arrays of (start, kind number, kind, end)."""
    rows = cut(spans_of(docs))
    measured = cut(tested(docs, rows).drop("found").dropDuplicates(["doc_id", "text_hash", "start"]))
    found = discoveries(measured)
    added = found.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", F.lit(3).alias("number"), F.lit("random").alias("kind"), "end"))).alias("added"))
    joined = rows.alias("rows").join(added.alias("added"), same_row("rows", "added"), "left")
    return joined.select("rows.doc_id", "rows.text_hash", "rows.base", F.coalesce("added.added", F.slice("rows.base", 1, 0)).alias("added"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def query(spark, sf_dir: str) -> DataFrame:
    rows = scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return rows.select(
        "doc_id",
        *[count(k) for k in ("assign", "access", "hex")],
        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )
