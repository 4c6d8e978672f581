"""Helpers shared by the report plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Periods that a ticket's day determines.
PERIODS = {"_week": "local_date_created", "_month": "local_date_created"}


def lit_like(df: DataFrame, col: str, value) -> Column:
    """A literal typed like ``df[col]``, so a comparison with it keeps the
    column bare and the filter reaches the parquet scan."""
    return F.lit(value).cast(df.schema[col].dataType)


def sort_exprs(order: Sequence[tuple[str, str]], out_cols: Sequence[str]) -> list[Column]:
    """Report ordering: ascending keys put NULLs last, descending keys put
    them first; the remaining output columns follow as ascending
    tie-breaks so that a row cap picks a well-defined set of rows."""
    ex = [F.col(c).desc_nulls_first() if d == "desc" else F.col(c).asc_nulls_last() for c, d in order]
    used = {c for c, _ in order}
    return ex + [F.col(c).asc_nulls_last() for c in out_cols if c not in used]


def top_k(df: DataFrame, order: Sequence[tuple[str, str]], k: int | None,
          out_cols: Sequence[str], ordered: bool = False) -> DataFrame:
    """O3: the first ``k`` rows in report order; ``k=None`` returns every row,
    sorted by a range shuffle if ``ordered`` (O1).

    With a cap every task keeps its own first k rows and one task merges
    those (``TakeOrderedAndProject``, k rows in memory), in any session.  The
    ordering ends with every output column, so the result does not depend
    on which task a row was in.
    """
    if k is None and not ordered:
        return df.select(*out_cols)
    out = df.orderBy(*sort_exprs(order, out_cols))
    return (out if k is None else out.limit(k)).select(*out_cols)


def roster(t, account: str | None) -> DataFrame:
    """Agent roster (optionally one account) keyed by ``_rid``."""
    r = t.agent_roster
    if account is not None:
        r = r.where(F.col("client_account") == account)
    return r.select(F.col("assignee_id").alias("_rid"), "agent_name", "agent_email")
