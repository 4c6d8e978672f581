"""Exclusion of listed ids (C14, J7), also of lists too long to broadcast.

A shuffled anti join sends every row of the large side over the network to
drop a few.  The split form makes a Bloom filter of the list.  Rows that it
does not hold stay where they are; only the possible hits take the exact
anti join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of one block: what a bitmap of ``bitmap_construct_agg`` holds (4 KB).
BLOCK_BITS = 32768
#: Blocks of the filter.  Its size is fixed by them, 4 KB each (4 MB), however long the list is.
FILTER_BLOCKS = 1024


def exclude_ids(df: DataFrame, key: str, excl: DataFrame, excl_key: Column, method: str = "join",
                blocks: int = FILTER_BLOCKS) -> DataFrame:
    """Drop rows whose ``key`` equals some exclusion key (anti join).
    Rows with a NULL key stay; NULL exclusion keys match nothing.

    ``method="join"`` (default) is one anti join; Spark broadcasts a list that
    it has measured small.  ``method="bloom"`` is for lists above the broadcast
    threshold: ``split_by_filter``, the anti join for the possible hits only,
    and a union.  The result is the same, the filter only decides the way a row
    takes.  Two bits an id: with the default 2^25 bits, a list of a million ids
    sends 0.3 % of the other rows over the exact way, ten million 20 %;
    ``blocks`` scales with the list.
    """
    e = excl.select(excl_key.alias("_excl_key")).where(F.col("_excl_key").isNotNull())
    anti = lambda rows: rows.join(e, F.col(key) == F.col("_excl_key"), "left_anti")
    if method == "join":
        return anti(df)
    possible, clear = split_by_filter(df, key, e, "_excl_key", blocks)
    return clear.unionByName(anti(possible))


def split_by_filter(df: DataFrame, key: str, ids: DataFrame, id_col: str,
                    blocks: int = FILTER_BLOCKS) -> tuple[DataFrame, DataFrame]:
    """``df`` in two: rows whose ``key`` may be in ``ids`` (all that are, and
    few others), and rows whose key is not.

    The filter is a table of at most ``blocks`` bitmaps of 4 KB, built by a
    grouped aggregation and broadcast; a row finds its block by a hash join and
    tests two bits in it.  Both parts need the same columns, so what lies above
    the last exchange of ``df`` is read twice, what lies below it once.
    """
    bits = (ids.select(_block(id_col, blocks).alias("_fb"), F.explode(F.array(*_positions(id_col))).alias("_pos"))
               .groupBy("_fb").agg(F.bitmap_construct_agg("_pos").alias("_bits")))
    tested = df.withColumn("_rb", _block(key, blocks)).join(F.broadcast(bits), F.col("_rb") == F.col("_fb"), "left")
    first, second = (F.getbit(F.conv(F.hex(F.substring("_bits", (p / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int"),
                              (p % 8).cast("int")) == 1 for p in _positions(key))
    hit = F.coalesce(first & second, F.lit(False))
    return tested.where(hit).select(*df.columns), tested.where(~hit).select(*df.columns)


def _block(col: str, blocks: int) -> Column:
    return F.pmod(F.xxhash64(col), F.lit(blocks))


def _positions(col: str) -> list[Column]:
    """Two bits of an id within its block, from a hash independent of the block's."""
    h = F.xxhash64(F.col(col), F.lit(1))
    return [F.pmod(h, F.lit(BLOCK_BITS)), F.pmod(F.shiftright(h, 32), F.lit(BLOCK_BITS))]
