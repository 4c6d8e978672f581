"""Positions of all matches of a pattern, in Spark expressions.

Spark returns the matches (``regexp_extract_all``) and the texts between them
(``split``), but no positions. Both walk the text with the same matcher, so a
running sum of the two lists' lengths gives every start and end in code
points. Patterns must not match the empty string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEP = 64


def running_sum(a: Column) -> Column:
    """Inclusive running sum of an array of ints, in two levels: within slices
    of STEP elements, and over the slices' sums."""
    size = F.size(a)
    cuts = F.when(size > 0, F.sequence(F.lit(0), F.floor((size - 1) / STEP).cast("int"))).otherwise(F.array().cast("array<int>"))
    parts = F.transform(cuts, lambda c: F.slice(a, c * STEP + 1, F.lit(STEP)))
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v)
    sums = F.transform(parts, total)
    before = F.transform(cuts, lambda c: F.aggregate(F.slice(sums, F.lit(1), c), F.lit(0), lambda s, v: s + v))
    return F.flatten(F.zip_with(parts, before, lambda p, b: F.transform(p, lambda _, i: b + total(F.slice(p, F.lit(1), i + 1)))))


def with_matches(df: DataFrame, out: str, text: str, pattern: str, guard: Column | None = None, look: int = 24) -> DataFrame:
    """``df`` plus array ``out`` of struct<start, end, m, before, after>: every
    match, its code-point span, up to ``look`` characters before it (back to
    the match before) and one after. ``guard``: a cheap necessary condition."""
    empty = F.array().cast("array<string>")
    t = F.col(text)
    hit = guard if guard is not None else F.lit(True)
    df = df.withColumn(f"{out}__m", F.when(hit, F.regexp_extract_all(t, F.lit(pattern), F.lit(0))).otherwise(empty))
    has = F.size(f"{out}__m") > 0
    df = df.withColumn(f"{out}__p", F.when(has, F.split(t, pattern, -1)).otherwise(empty))
    lens = F.zip_with(f"{out}__m", F.slice(f"{out}__p", F.lit(1), F.size(f"{out}__m")), lambda m, p: F.char_length(m) + F.char_length(p))
    df = df.withColumn(f"{out}__e", running_sum(lens))

    def item(m: Column, i: Column) -> Column:
        end = F.get(f"{out}__e", i)
        return F.struct(
            (end - F.char_length(m)).alias("start"),
            end.alias("end"),
            m.alias("m"),
            F.right(F.get(f"{out}__p", i), F.lit(look)).alias("before"),
            F.left(F.get(f"{out}__p", i + 1), F.lit(1)).alias("after"),
        )

    return df.withColumn(out, F.transform(f"{out}__m", item)).drop(f"{out}__m", f"{out}__p", f"{out}__e")


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` of an array of struct<kind (number), start, end>, comma-joined in the given order."""
    names = F.array(*[F.lit(k) for k in kinds])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, kinds: list[str]) -> Column:
    """``text`` with each span replaced by ``[KIND]``; overlapping spans are
    cut at the end of those before them."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in kinds])
    s = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), x["kind"].alias("kind"))))
    done = F.aggregate(
        s,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int,kind:int>>").alias("keep")),
        lambda acc, x: F.when(
            x["end"] > acc["at"],
            F.struct(x["end"].alias("at"), F.concat(acc["keep"], F.array(F.struct(acc["at"].alias("from"), F.greatest(acc["at"], x["start"]).alias("to"), x["kind"].alias("kind")))).alias("keep")),
        ).otherwise(acc),
    )
    head = lambda d: F.array_join(F.transform(d["keep"], lambda x: F.concat(F.substr(text, x["from"] + 1, x["to"] - x["from"]), F.get(names, x["kind"]))), "")
    return F.when(F.size(spans) == 0, text).otherwise(F.get(F.transform(F.array(done), lambda d: F.concat(head(d), F.substr(text, d["at"] + 1, F.char_length(text)))), 0))
