"""Private data by boosted trees over candidate spans (operator 4, native).

Method: high-recall generators propose spans that may overlap: the four base
patterns (email, ip, card, phone) and looser forms of each (spelled-out
emails, IPv6, cards with other separators, national phone numbers). Boosted
trees score a candidate from format and context features (shape, lengths,
separators, cue words before it, what touches it). Their targets are weak
labels from checks that the features leave out (Luhn, octet range, digit
count, domain ending), and an isotonic curve fitted on held-out documents sets
the threshold at which the score is worth a redaction. Base spans that pass
their checks always stay; a candidate that the trees select is added if it
overlaps no base span.

Everything over the documents is a Spark expression. Training collects one
row per distinct feature vector; the bins bound their number (FEATURE_ROWS),
not the data. The trees are scored as an expression.

The patterns are written with possessive loops and look-behinds so that they
match what the plain ones match in linear time on long runs.

Defined cases: a null text counts as empty and has no spans; repeated rows
each get their spans; texts are searched whole; an empty table gives no rows
(and no trees: only base spans are reported then); clashing column names are
avoided by working on ``doc_id`` and ``text`` alone.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.boost import Boosted, Isotonic
from deskpulse.llm.io import cut, free_name, table
from deskpulse.llm.spans import joined, redact, with_matches

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.9  # calibrated probability from which a candidate is redacted
#: Base patterns, in the order of KINDS.
BASE = [
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
#: Looser generators: (kind, pattern, guard).
LOOSE = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?(?:\[at\]|\(at\)| at ) ?[A-Za-z0-9-]{1,63}+(?: ?(?:\[dot\]|\(dot\)| dot ) ?[A-Za-z0-9-]{1,63}+)++", "dot"),
    ("ip", r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])", ":"),
    ("card", r"(?<![0-9])[0-9]{4}(?:[./_][0-9]{4}){3}(?![0-9])", None),
    ("phone", r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])", None),
]
CUES = [r"mail|contact", r"\bip\b|host|server|addr", r"card|visa|credit|konto|tarjeta|carte", r"tel|phone|call|mobil|fax|ruf"]
FEATURES = ["kind", "digits", "separators", "length", "cue", "glued", "distinct", "loose"]
FEATURE_ROWS = 4 * 24 * 4 * 6 * 2 * 3 * 5 * 2  # distinct feature vectors at most


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Checksum of a digit string: from the right, every second digit doubled, less 9 beyond 9."""
    back = F.reverse(digits)
    total = F.aggregate(
        F.transform(
            F.split(back, ""),
            lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(F.get(F.array(*[F.lit(2 * k - 9 * (k > 4)) for k in range(10)]), d.cast("int"))),
        ),
        F.lit(0),
        lambda a, d: a + F.coalesce(d, F.lit(0)),
    )
    return total % 10 == 0


def _passes(kind: int, m: Column) -> Column:
    """The base check of a base match."""
    if KINDS[kind] == "email":
        return F.lit(True)
    if KINDS[kind] == "ip":
        # leading zeros don't count; parts of more than three digits then exceed 255
        return F.forall(F.split(m, r"\."), lambda p: (F.char_length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.left(F.ltrim(p, F.lit("0")), F.lit(3)).try_cast("int"), F.lit(0)) <= 255))
    n = F.char_length(digits_of(m))
    return (n.between(13, 19) & luhn(digits_of(m))) if KINDS[kind] == "card" else n.between(9, 15)


def _weak_label(kind: str, m: Column) -> Column:
    """A check that none of the features can see, for base and loose candidates alike."""
    d = digits_of(m)
    if kind == "email":
        return m.rlike(r"[.\s\])]+(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$")
    if kind == "ip":
        return F.when(F.instr(m, ":") > 0, ~m.rlike(r"^(0+:)+")).otherwise(_passes(1, m))
    if kind == "card":
        return F.char_length(d).between(13, 19) & luhn(d)
    return F.char_length(d).between(9, 15) & ~d.rlike(r"^(.)\1+$")


def _features(kind: int, loose: bool, s: Column) -> Column:
    m = s["m"]
    plain = digits_of(m)
    several = F.size(F.array_distinct(F.split(F.regexp_replace(m, "[A-Za-z0-9]", ""), "")))
    return F.struct(
        F.lit(kind).alias("kind"),
        F.least(F.char_length(plain), F.lit(23)).alias("digits"),
        F.least(several, F.lit(3)).alias("separators"),
        F.least(F.floor(F.char_length(m) / 8).cast("int"), F.lit(5)).alias("length"),
        F.lower(s["before"]).rlike(f"(?:{CUES[kind]})[^a-z]*$").cast("int").alias("cue"),
        (s["before"].rlike(r"[\p{L}\p{N}]$").cast("int") + s["after"].rlike(r"[\p{L}\p{N}]").cast("int")).alias("glued"),
        F.least(F.floor(F.size(F.array_distinct(F.split(plain, ""))) / 2).cast("int"), F.lit(4)).alias("distinct"),
        F.lit(int(loose)).alias("loose"),
    )


def with_candidates(docs: DataFrame, out: str, text: str = "text") -> DataFrame:
    """``docs`` plus array ``out`` of struct<kind, start, end, base, label, f>:
    every proposed span, whether it is a base span, its weak label and features."""
    t = F.col(text)
    guards = [F.contains(t, F.lit("@")), t.rlike(r"[0-9]\.[0-9]"), t.rlike(r"[0-9][\x20-]?[0-9]"), F.contains(t, F.lit("+"))]
    parts = []
    tmp = free_name(docs, "found")
    for k, pattern in enumerate(BASE):
        docs = with_matches(docs, f"{tmp}{k}", text, pattern, guards[k])
        parts.append((k, False, f"{tmp}{k}"))
    digits = t.rlike(r"[0-9]{3}")
    for i, (kind, pattern, need) in enumerate(LOOSE):
        guard = F.contains(t, F.lit(need)) if need else digits
        docs = with_matches(docs, f"{tmp}l{i}", text, pattern, guard)
        parts.append((KINDS.index(kind), True, f"{tmp}l{i}"))

    def shape(k: int, loose: bool):
        return lambda s: F.struct(
            F.lit(k).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            (F.lit(False) if loose else F.coalesce(_passes(k, s["m"]), F.lit(False))).alias("base"),
            F.coalesce(_weak_label(KINDS[k], s["m"]), F.lit(False)).alias("label"),
            _features(k, loose, s).alias("f"),
        )

    docs = docs.withColumn(out, F.concat(*[F.transform(c, shape(k, loose)) for k, loose, c in parts]))
    return docs.drop(*[c for _, _, c in parts])


def fit_candidates(cands: DataFrame, col: str, id_col: str = "doc_id"):
    """Trees and the calibrated raw-score threshold, or None without candidates
    of both labels. One row per distinct feature vector, label and fold is
    collected (bounded by FEATURE_ROWS x 4)."""
    fold = F.pmod(F.xxhash64(id_col), F.lit(4)).cast("int")
    flat = cands.select(fold.alias("fold"), F.explode(col).alias("c")).select("fold", "c.label", "c.f.*")
    rows = flat.groupBy(*FEATURES, (F.col("fold") == 0).alias("held")).agg(F.count("*").alias("n"), F.sum(F.col("label").cast("long")).alias("pos")).collect()
    rows.sort(key=lambda r: tuple(r[f] for f in FEATURES) + (r["held"],))
    x = np.array([[r[f] for f in FEATURES] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    n, pos, held = (np.array([r[c] for r in rows], dtype=float) for c in ("n", "pos", "held"))
    fit, cal = held == 0, held == 1
    if not fit.any() or pos[fit].sum() in (0, n[fit].sum()):
        return None
    trees = Boosted(rounds=30, depth=3, rate=0.3).fit(x[fit], pos[fit] / n[fit], n[fit])
    use = cal if cal.any() else fit
    curve = Isotonic(trees.raw(x[use]), pos[use] / n[use], n[use])
    return trees, curve.least_score(PRECISION)


def select_spans(col: str, model) -> Column:
    """Array of struct<kind, start, end>, by kind and start: base spans, and
    what the trees add beside them."""
    bare = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    base = F.filter(col, lambda s: s["base"])
    if model is None or model[1] == float("inf"):
        return F.array_sort(F.transform(base, bare))
    trees, least = model
    likely = F.filter(col, lambda s: ~s["base"] & (trees.column([s["f"][f].cast("double") for f in FEATURES]) >= least))
    free = F.filter(likely, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return F.array_sort(F.array_distinct(F.transform(F.concat(base, free), bare)))


def redact_pii(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``docs`` with every selected span replaced by ``[KIND]``; same columns.
    A null text stays null."""
    c = free_name(docs, "candidates")
    found = with_candidates(docs, c, text)
    model = fit_candidates(cut(found.select(id_col, c)), c, id_col)  # candidates only, without the texts
    return found.withColumn(c, F.coalesce(select_spans(c, model), F.array())).withColumn(text, redact(F.col(text), F.col(c), KINDS)).select(*docs.columns)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``redact_pii`` for rows of ``documents``: n_chars becomes the length of the new text."""
    return redact_pii(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pii_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, base, spans): arrays of struct<kind, start, end> per row of ``docs``."""
    d = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = cut(with_candidates(d, "c").select("doc_id", "c"))
    model = fit_candidates(found, "c")
    base = F.array_sort(F.transform(F.filter("c", lambda s: s["base"]), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))))
    return found.select("doc_id", base.alias("base"), select_spans("c", model).alias("spans"))


def op4_pii(spark, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    s = pii_spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return s.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(joined(F.col("base"), KINDS), 256).alias("base_sha256"),
        joined(F.col("spans"), KINDS).alias("spans"),
    )
