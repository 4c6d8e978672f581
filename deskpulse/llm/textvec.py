"""Word hashing of whole Arrow batches with numpy.

A batch of texts is one UTF-8 buffer. Words are maximal runs of bytes
outside the separators (0x20, 0x09-0x0D); A-Z are lower-cased. Both are
ASCII, so working on bytes equals working on code points. Every word gets a
64-bit hash; memory is a small multiple of the batch's text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SEP = np.zeros(256, dtype=bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE = np.random.default_rng(20260101).integers(1, 2**63, 256, dtype=np.uint64)[_LOWER]
_BYTE[_SEP] = 0
_K = 0x9E3779B97F4A7C15
_K_INV = pow(_K, -1, 2**64)
_TABLES = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]
STRETCH = 1 << 20  # bytes hashed at once, and the most powers that are kept


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (xor-shift multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base and of its inverse, modulo 2**64, up to STRETCH."""
    if len(_TABLES[0]) < n:
        size = max(n, min(2 * len(_TABLES[0]), STRETCH))
        for i, base in enumerate((_K, _K_INV)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _TABLES[i] = np.multiply.accumulate(p)
    return _TABLES[0][:n], _TABLES[1][:n]


def word_sums(weight: np.ndarray, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per word the sum of its bytes' weights times the power of their place in it.

    A word goes from its start to the next one; bytes outside words weigh nothing. The buffer is
    worked through in stretches of STRETCH bytes, so memory beside the results does not depend on
    the longest text; a word that goes on into the next stretch gets the rest of its sum there."""
    out = np.zeros(len(starts), np.uint64)
    for lo in range(0, len(data), STRETCH):
        vals = weight[data[lo : lo + STRETCH]]
        power, inverse = _powers(len(vals))
        vals *= power
        a, b = np.searchsorted(starts, [lo, lo + len(vals)])
        own = starts[a:b] - lo
        if a < b:  # the power of a word's place in the stretch is divided out again
            out[a:b] = np.add.reduceat(vals, own) * inverse[own]
        head = vals[: own[0]] if a < b else vals
        if a and len(head):
            out[a - 1 : a] += head.sum(dtype=np.uint64, keepdims=True) * np.uint64(pow(_K, lo - int(starts[a - 1]), 2**64))
    return out


def arrow_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    n = len(col)
    bufs = col.buffers()
    offsets = np.frombuffer(bufs[1], dtype=np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(bufs[2], dtype=np.uint8)[offsets[0] : offsets[-1]] if bufs[2] is not None and n else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and per text the index of its first word
    (length: texts + 1)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    sep = _SEP[data]
    first = ~sep
    first[1:] &= sep[:-1]
    begins = offsets[(offsets > 0) & (offsets < n)]  # a word never goes on into the next text
    first[begins] = ~sep[begins]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return mix(word_sums(_BYTE, data, starts)), np.searchsorted(starts, offsets)


def slices(batch: pa.RecordBatch, col: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices of about ``most`` bytes of text, one row at least,
    so that memory depends on the longest text and not on the batch size."""
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False)
    at = 0
    while at < batch.num_rows:
        ends = np.cumsum(sizes[at : at + 20_000])
        take = max(1, int(np.searchsorted(ends, most, side="right")))
        yield batch.slice(at, min(take, batch.num_rows - at))
        at += take


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of one text; a text
    with fewer words has its whole sequence as one, an empty text none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    w = k if n >= k else n
    acc = np.full(n - w + 1, w, dtype=np.uint64)
    for j in range(w):
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + words[j : n - w + 1 + j]
    return np.unique(mix(acc))
