"""Ragged id arrays, and tokenizing by distinct pieces of text.

Texts are cut at places that no token crosses, the distinct pieces of a batch
are encoded once by the tokenizer's library, and the ids are put together
again in the order of the text. Which places are safe is the caller's part.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from deskpulse.llm.textvec import arrow_buffers, mix, word_sums

MOST_CACHED = 200_000  # pieces that a task keeps,
MOST_BYTES = 64 << 20  # and their bytes; past that it forgets those met in one batch only, or all


def ragged_take(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The pieces ``flat[s : s + n]`` of each (s, n), one after the other."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return flat[:0]
    step = np.repeat(starts - (ends - lengths), lengths)
    step += np.arange(ends[-1])
    return flat.take(step)


def picked(flat: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of pieces that lie one after the other in ``flat``: those of the numbers ``which``, one after the other, and where
    they begin (the last place: where they end). Arrow copies the pieces as strings of bytes."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * flat.itemsize
    pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(flat)])
    _, begins, data = pieces.take(pa.array(which)).buffers()
    begins = np.frombuffer(begins, np.int64, len(which) + 1) // flat.itemsize
    return np.frombuffer(data, flat.dtype, begins[-1]) if begins[-1] else flat[:0], begins


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of ``values[o[i] : o[i + 1]]`` for each i (empty ranges give 0)."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


_WEIGHT = np.random.default_rng(20260102).integers(1, 2**63, 256, dtype=np.uint64)


def hashes(pieces: pa.Array) -> np.ndarray:
    """A 64-bit hash of the bytes of each piece."""
    data, offsets = arrow_buffers(pieces)
    out, some = np.zeros(len(pieces), np.uint64), offsets[1:] > offsets[:-1]
    out[some] = mix(word_sums(_WEIGHT, data, offsets[:-1][some]))
    return out


class Growing:
    """A flat array of ids that grows, cut into pieces."""

    def __init__(self):
        self.flat, self.used = np.zeros(1 << 12, np.int32), 0
        self.starts = self.lengths = np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(flat) > len(self.flat):
            grown = np.zeros(2 * (self.used + len(flat)), np.int32)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used : self.used + len(flat)] = flat
        self.starts = np.concatenate([self.starts, self.used + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.used += len(flat)

    def kept(self, which: np.ndarray) -> Growing:
        """The pieces ``which`` alone."""
        out, lengths = Growing(), self.lengths[which]
        out.add(ragged_take(self.flat, self.starts[which], lengths), lengths)
        return out


class Pieces:
    """Ids of the distinct pieces a task has met, for one or several tokenizers. ``encode`` gives, for each tokenizer,
    (flat ids, number of ids) of an array of pieces."""

    def __init__(self, encode: Callable[[pa.Array], list[tuple[np.ndarray, np.ndarray]]], sides: int = 1, most: int | None = None):
        self.encode, self.n, self.most = encode, sides, most or MOST_CACHED
        self.clear()

    def clear(self) -> None:
        self.known = None  # the pieces by their number
        self.hashes, self.of = np.zeros(0, np.uint64), np.zeros(0, np.int64)  # theirs, sorted, and their numbers
        self.met = np.zeros(0, np.int64)  # in how many batches, since they came or were kept
        self.sides = [Growing() for _ in range(self.n)]

    def forget(self) -> None:
        """Keeps the pieces that several batches had; none if these are too many as well."""
        kept = np.flatnonzero(self.met > 1)
        known = self.known.take(pa.array(kept))
        if len(kept) > self.most // 2 or known.nbytes > MOST_BYTES // 2:
            return self.clear()
        self.known, self.met, self.sides = known, np.ones(len(kept), np.int64), [side.kept(kept) for side in self.sides]
        h = hashes(known)
        self.of = np.argsort(h)
        self.hashes = h[self.of]

    def find(self, words: pa.Array, h: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each of ``words``, -1 if it isn't known: by its hash, then by its text; and the place of each in the
        sorted hashes, in the ``order`` of its own hash."""
        which, own = np.full(len(words), -1, np.int64), h[order]
        places = np.searchsorted(self.hashes, own)
        if len(self.of):
            at = np.minimum(places, len(self.of) - 1)
            equal = self.hashes[at] == own
            here, number = order[equal], self.of[at[equal]]
            same = pc.equal(words.take(pa.array(here)), self.known.take(pa.array(number))).to_numpy(zero_copy_only=False)
            which[here[same]] = number[same]
        return which, places

    def numbers(self, pieces: pa.Array) -> np.ndarray:
        """Number of each of ``pieces``, which may repeat; unknown ones are encoded first."""
        if self.known is not None and (len(self.known) > self.most or self.known.nbytes + pieces.nbytes > MOST_BYTES):
            self.forget()
        if not len(pieces):
            return np.zeros(0, np.int64)
        coded = pieces.dictionary_encode()
        words = coded.dictionary
        if self.known is None:
            self.known = words.slice(0, 0)
        h = hashes(words)
        order = np.argsort(h)  # one after the other, sorted hashes are found fast
        which, places = self.find(words, h, order)
        fresh = np.flatnonzero(which < 0)
        if len(fresh):
            unknown = words.take(pa.array(fresh))
            for side, (flat, lengths) in zip(self.sides, self.encode(unknown)):
                side.add(flat, lengths)
            added = which[order] < 0
            which[fresh] = len(self.known) + np.arange(len(fresh))
            added, at = order[added], places[added]
            self.hashes, self.of = np.insert(self.hashes, at, h[added]), np.insert(self.of, at, which[added])
            self.known = pa.concat_arrays([self.known, unknown])
            self.met = np.concatenate([self.met, np.zeros(len(fresh), np.int64)])
        self.met[which] += 1
        return which[coded.indices.to_numpy(zero_copy_only=False)]

    def ids(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, number of ids) of each of ``pieces`` by the first tokenizer."""
        which, side = self.numbers(pieces), self.sides[0]
        flat, begins = picked(side.flat, side.lengths, which)
        return flat, np.diff(begins)
