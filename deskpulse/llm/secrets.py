"""Secrets by a battery of randomness tests (operator 6, native).

Method. Base patterns (assign, access, hex) give the certain spans. Beside
them, every long token is a candidate. Its encoding is inferred from its
characters (hex, base32, base36, base64) and a battery tests the hypothesis
that it is uniform over that alphabet: chi-squared of the character counts,
a runs test about the alphabet's middle, and the lag-1 serial correlation.
A candidate that the battery rejects (Bonferroni over the three tests, level
ALPHA) is not random and is left alone. The others are tested against the
opposite hypothesis, an ordinary token: under it the number of changes
between lower case, upper case and digits is Poisson with TEXT_CHANGES per
character, and a hex token must have drawn all its characters from sixteen.
These p-values shrink with the token's length; a Benjamini-Hochberg step
within each length class (from a histogram of p-values over all documents,
61 bins a class) keeps the false discovery rate at FDR in every class.

All of it is Spark expressions. Only the histogram (bounded by bins x
classes) reaches the driver.

Defined cases: a null text counts as empty and has no spans; repeated rows
each get their spans; texts are searched whole (patterns use possessive loops,
so long runs stay linear); an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.io import cut, free_name, table
from deskpulse.llm.spans import joined, redact, with_matches

KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]++"
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}+"
TOKEN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}+={0,2}"
ALPHA = 0.001
FDR = 0.001
TEXT_CHANGES = 0.08  # changes of character class per character of ordinary tokens
TEXT_IN_HEX = 0.4  # share of an ordinary token's characters in 0-9a-f
LENGTHS = [20, 32, 48, 64]  # lower ends of the length classes
BINS = 60  # of -log10 p; the last one holds all beyond
#: Alphabets in the order in which they are tried: name, pattern, characters by value.
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ALPHABETS = [
    ("hex", "^(?:[0-9a-f]+|[0-9A-F]+)$", _DIGITS + "abcdef"),
    ("base32", "^[A-Z2-7]+=*$", _UPPER + "234567"),
    ("base36", "^(?:[0-9a-z]+|[0-9A-Z]+)$", _DIGITS + _LOWER),
    ("base64", "", _UPPER + _LOWER + _DIGITS + "+/"),
]


def _tail(z: Column) -> Column:
    """Upper tail of the normal distribution, z >= 0 (logistic approximation, error below 2e-4)."""
    return 1 / (1 + F.exp(1.5976 * z + 0.070566 * z * z * z))


def _battery(values: Column, n: Column, size: Column) -> Column:
    """Bonferroni p-value of uniformity of an array of character values."""
    counts = F.transform(F.array_distinct(values), lambda d: F.size(F.filter(values, lambda v: v == d)).cast("double"))
    chi2 = F.aggregate(counts, F.lit(0.0), lambda a, c: a + c * c) * size / n - n
    df = size - 1
    z_chi = (F.pow(chi2 / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))  # Wilson-Hilferty
    middle = (size - 1) / 2
    up = F.aggregate(values, F.lit(0.0), lambda a, v: a + F.when(v > middle, 1.0).otherwise(0.0))
    steps = F.sequence(F.lit(0), F.size(values) - 2)
    changes = F.aggregate(steps, F.lit(0.0), lambda a, i: a + F.when((F.get(values, i) > middle) != (F.get(values, i + 1) > middle), 1.0).otherwise(0.0))
    z_runs = F.abs(changes - (n - 1) / 2) / F.sqrt((n - 1) / 4)
    z_share = F.abs(up - n / 2) / F.sqrt(n / 4)
    spread = (size * size - 1) / 12
    serial = F.aggregate(steps, F.lit(0.0), lambda a, i: a + (F.get(values, i) - middle) * (F.get(values, i + 1) - middle))
    z_serial = F.abs(serial / spread) / F.sqrt(n - 1)
    p_runs = 2 * F.least(_tail(z_runs), _tail(z_share)) * 2
    return F.least(F.lit(1.0), 3 * F.least(_tail(F.greatest(z_chi, F.lit(0.0))), p_runs, 2 * _tail(z_serial)))


def _text_score(m: Column, n: Column, is_hex: Column) -> Column:
    """-log10 of the p-value of an ordinary token (Chernoff bound of the Poisson tail)."""
    classes = F.translate(m, _DIGITS + _LOWER + _UPPER, "0" * 10 + "a" * 26 + "A" * 26)
    t = F.char_length(F.regexp_replace(classes, "(?<=0)(?=[aA])|(?<=a)(?=[0A])|(?<=A)(?=[0a])", "#")) - F.char_length(classes)
    mu = n * TEXT_CHANGES
    chernoff = F.when(t > mu, (t * F.log(t / mu) - t + mu) / math.log(10)).otherwise(0.0)
    return F.greatest(chernoff, F.when(is_hex, n * -math.log10(TEXT_IN_HEX)).otherwise(0.0))


def _judged(s: Column) -> Column:
    """struct<start, end, len, p_random, score> of one candidate token."""
    m = F.rtrim(s["m"], F.lit("="))
    n = F.char_length(m).cast("double")
    which = F.lit(len(ALPHABETS) - 1)
    for i in reversed(range(len(ALPHABETS) - 1)):
        which = F.when(s["m"].rlike(ALPHABETS[i][1]), i).otherwise(which)
    letters = F.get(F.array(*[F.lit(a) for _, _, a in ALPHABETS]), which)
    size = F.char_length(letters).cast("double")
    # hex and base36 may be written in capitals; base64 may use - and _
    plain = F.when(which.isin(0, 2), F.lower(m)).when(which == 3, F.translate(m, "-_", "+/")).otherwise(m)
    values = F.transform(F.split(plain, ""), lambda c: (F.instr(letters, c) - 1).cast("double"))
    return F.struct(
        s["start"].alias("start"), s["end"].alias("end"), n.cast("int").alias("len"),
        _battery(values, n, size).alias("p_random"), _text_score(m, n, which == 0).alias("score"),
    )


def with_found(docs: DataFrame, base: str, cand: str, text: str = "text") -> DataFrame:
    """``docs`` plus ``base`` (certain spans) and ``cand`` (judged candidate tokens beside them)."""
    t = F.col(text)
    tmp = free_name(docs, "found")
    docs = with_matches(docs, f"{tmp}0", text, ASSIGN, look=0)
    docs = with_matches(docs, f"{tmp}1", text, ACCESS, F.contains(t, F.lit("AKIA")), look=0)
    docs = with_matches(docs, f"{tmp}2", text, HEX, look=0)
    docs = with_matches(docs, f"{tmp}3", text, TOKEN, look=0)
    ok = [
        lambda s: F.char_length(F.regexp_extract(s["m"], ASSIGN, 2)) >= 8,
        lambda s: F.char_length(s["m"]) >= 16,
        lambda s: F.lit(True),
    ]
    span = lambda k: lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end"))
    docs = docs.withColumn(base, F.array_sort(F.concat(*[F.transform(F.filter(f"{tmp}{k}", ok[k]), span(k)) for k in range(3)])))
    beside = F.filter(f"{tmp}3", lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return docs.withColumn(cand, F.transform(beside, _judged)).drop(*[f"{tmp}{k}" for k in range(4)])


def _length_class(n: Column) -> Column:
    return sum((n >= k).cast("int") for k in LENGTHS[1:])


def discovery_thresholds(found: DataFrame, cand: str) -> list[float]:
    """Per length class the least -log10 p that Benjamini-Hochberg accepts."""
    c = found.select(F.explode(cand).alias("c")).where(F.col("c.p_random") >= ALPHA)
    rows = c.groupBy(_length_class(F.col("c.len")).alias("k"), F.least(F.floor("c.score"), F.lit(BINS)).cast("int").alias("bin")).count().collect()
    out = []
    for k in range(len(LENGTHS)):
        hist = {r["bin"]: r["count"] for r in rows if r["k"] == k}
        total, beyond, least = sum(hist.values()), 0, float("inf")
        for b in range(BINS, -1, -1):
            beyond += hist.get(b, 0)
            if beyond and 10.0**-b <= FDR * beyond / total:  # every p in these bins is at most 10 ** -b
                least = float(b)
        out.append(least)
    return out


def all_spans(base: str, cand: str, thresholds: list[float]) -> Column:
    pick = lambda s: (s["p_random"] >= ALPHA) & (F.floor(s["score"]) >= F.get(F.array(*[F.lit(t) for t in thresholds]), _length_class(s["len"])))
    more = F.transform(F.filter(cand, pick), lambda s: F.struct(s["start"].alias("start"), F.lit(3).alias("kind"), s["end"].alias("end")))
    return F.array_sort(F.concat(F.col(base), more))


def redact_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by ``[KIND]``; a null text stays null."""
    b, c = free_name(docs, "base"), free_name(docs, "cand")
    found = with_found(docs, b, c, text)
    spans = F.coalesce(all_spans(b, c, discovery_thresholds(cut(found.select(c)), c)), F.array())
    return found.withColumn(text, redact(F.col(text), spans, KINDS)).select(*docs.columns)


def secret_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): arrays of struct<start, kind, end> per row of ``docs``."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = cut(with_found(d, "base", "cand").select("doc_id", "base", "cand"))
    return found.select("doc_id", "base", all_spans("base", "cand", discovery_thresholds(found, "cand")).alias("spans"))


def op6_secret_scan(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    s = secret_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k))
    return s.select(
        "doc_id",
        *[count(i).cast("long").alias(f"n_{KINDS[i]}") for i in range(3)],
        F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.col("spans"), KINDS).alias("spans"),
    )
