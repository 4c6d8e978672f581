"""Numeric helpers (F7, F9-F14, F17) and the productivity formulas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def mmss_to_seconds(x) -> Column:
    """'mm:ss' text -> seconds (bigint).

    Split-and-multiply, so minutes of 60 or more and unpadded text are read
    as numbers; malformed text gives NULL.
    """
    parts = F.split(_c(x), ":")
    m = F.get(parts, 0).try_cast("bigint")
    s = F.get(parts, 1).try_cast("bigint")
    return F.when(F.size(parts) == 2, m * 60 + s)


def nan_to_null(x) -> Column:
    """NaN -> NULL, other values unchanged."""
    c = _c(x)
    return F.when(~F.isnan(c), c)


def round_avg_text(x, half_even: bool = False) -> Column:
    """F9 + F12: round a mean to a whole number and print it as text the
    way a numeric column prints ('12', not '12.0'); NaN prints 'NaN'.  Halves
    go away from zero, or to the even neighbour if ``half_even`` (H5)."""
    c = _c(x)
    return (F.when(F.isnan(c), F.lit("NaN"))
             .otherwise((F.bround(c) if half_even else F.round(c)).cast("bigint").cast("string")))


def num_text(x) -> Column:
    """Number -> text: whole values without a fraction, NaN as 'NaN'."""
    c = _c(x)
    return (F.when(F.isnan(c), F.lit("NaN"))
             .when(c == F.floor(c), F.floor(c).cast("bigint").cast("string"))
             .otherwise(c.cast("string")))


def numeric_id_text(x) -> Column:
    """numeric text id such as '123.0' -> '123' (truncated); NULL when
    the text is not a number."""
    n = _c(x).try_cast("decimal(38,6)")
    return F.when(n < 0, F.ceil(n)).otherwise(F.floor(n)).cast("string")


def true_divide(num, den) -> Column:
    """True division; NULL when the denominator is 0 or NULL."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def round2(x) -> Column:
    """round half away from zero to two decimals, via decimal so the
    result does not depend on binary floating-point ties."""
    return F.round(_c(x).cast("decimal(38,10)"), 2).cast("double")


def rate_or_count(tickets, primary_seconds, fallback_seconds=None) -> Column:
    """Tickets per hour, using the primary hours when non-NULL and
    non-zero, else the fallback hours when non-NULL and non-zero, else the
    plain ticket count."""
    t = _c(tickets)
    secs = F.when(_c(primary_seconds) != 0, _c(primary_seconds))
    if fallback_seconds is not None:
        secs = F.coalesce(secs, F.when(_c(fallback_seconds) != 0, _c(fallback_seconds)))
    return F.when(secs.isNull(), t.cast("double")).otherwise(
        t.cast("double") / (secs.cast("double") / 3600.0))
