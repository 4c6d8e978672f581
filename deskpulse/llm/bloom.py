"""A Bloom filter of fixed size over integer ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskpulse.llm.textvec import mix

BITS = 25  # 2 ** 25 bits: 4 MB, whatever the number of ids
HASHES = 4
PARTS = 8  # partial filters that meet on the driver


def _places(ids: np.ndarray) -> np.ndarray:
    h = mix(ids.astype(np.int64).view(np.uint64))
    step = mix(h) | np.uint64(1)
    return (h[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) >> np.uint64(64 - BITS)


def bloom_filter(ids: DataFrame) -> np.ndarray:
    """Filter over the first column of ``ids``; PARTS partial filters are collected (32 MB at most)."""

    def run(batches):
        bits = np.zeros(2**BITS, bool)
        for b in batches:
            bits[_places(b.column(0).to_numpy(zero_copy_only=False)).ravel()] = True
        yield pa.record_batch([pa.array([np.packbits(bits).tobytes()])], names=["bits"])

    out = np.zeros(2**BITS // 8, np.uint8)
    dealt = ids.repartition(PARTS, F.col(ids.columns[0]))
    for r in dealt.mapInArrow(run, "bits binary").toLocalIterator():
        out |= np.frombuffer(r["bits"], np.uint8)
    return out


def in_bloom(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Whether each id may be in the filter (never wrong for one that is)."""
    p = _places(ids)
    return ((bits[p >> np.uint64(3)] >> (np.uint8(7) - (p & np.uint64(7)).astype(np.uint8))) & 1).all(1)
