"""Text helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def full_name(first, last) -> Column:
    """'first last', with a NULL part read as empty text."""
    return F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "),
                    F.coalesce(_c(last), F.lit("")))


def like_any(x, patterns) -> Column:
    """Q6: column LIKE any of the patterns."""
    c = _c(x)
    return reduce(lambda a, b: a | b, [c.like(p) for p in patterns])


def not_like_all(x, patterns) -> Column:
    """Q8: column NOT LIKE every pattern (NULL stays NULL, so it is dropped
    by a filter)."""
    c = _c(x)
    return reduce(lambda a, b: a & b, [~c.like(p) for p in patterns])
