"""Dense features of whole texts with numpy, for the classifiers.

A text is one UTF-8 buffer. Tokens are runs of ASCII letters, digits and
non-ASCII bytes, lower-cased, plus the characters that stand for letters in
disguised words (``@ $ * !`` inside a token). Every function works on a batch
and needs memory in proportion to its text.
"""

from __future__ import annotations

import numpy as np

from deskpulse.llm.textvec import mix, word_sums

_RANDOM = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[65:91] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PLAIN_PUNCT = np.zeros(256, bool)
_PLAIN_PUNCT[list(b".,;:'\"-()?!")] = True
_SYMBOL = ~(_LETTER | _DIGIT | _SPACE | _PLAIN_PUNCT)

_BODY = _LETTER | _DIGIT
_plain = np.arange(256)
_plain[65:91] += 32
_leet = _plain.copy()
for _a, _b in zip(b"013457@$!", b"oieastasi", strict=True):
    _leet[_a] = _b
_disguise = np.zeros(256, bool)
_disguise[list(b"@$!*")] = True


class Vocabulary:
    """Token hashes under one reading of the bytes."""

    def __init__(self, body: np.ndarray, as_: np.ndarray):
        self.body = body
        self.table = np.where(body, _RANDOM[as_], 0).astype(np.uint64)

    def tokens(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hashes in order, index of each text's first token and the end)."""
        n = len(data)
        if not n:
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        inside = self.body[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begins = offsets[(offsets > 0) & (offsets < n)]
        first[begins] = inside[begins]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
        return mix(word_sums(self.table, data, starts)), np.searchsorted(starts, offsets)

    def of(self, words) -> np.ndarray:
        """Sorted hashes of the given words (each one token)."""
        raw = [w.encode() for w in words]
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum([0, *map(len, raw)])
        h, first = self.tokens(data, ends)
        if len(h) != len(raw):
            raise ValueError("a lexicon entry must be one token")
        return np.unique(h)


PLAIN = Vocabulary(_BODY, _plain)
DISGUISED = Vocabulary(_BODY | _disguise, _leet)


def member(h: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(sorted_set, h), len(sorted_set) - 1)
    return sorted_set[at] == h


def per_text(marks: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of ``marks`` within each text, given the texts' cumulative ends."""
    c = np.concatenate([[0], np.cumsum(marks, dtype=np.float64)])
    return np.diff(c[ends])


def byte_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Counts per text of characters, capitals, letters, digits, symbols, bangs, question marks, bars, lines."""
    n = lambda table: per_text(table[data], offsets)
    one = lambda c: per_text(data == c, offsets)
    return {
        "chars": per_text((data & 0xC0) != 0x80, offsets),
        "upper": n(_UPPER),
        "letters": n(_LETTER),
        "digits": n(_DIGIT),
        "symbols": n(_SYMBOL),
        "space": n(_SPACE),
        "bangs": one(33),
        "asks": one(63),
        "bars": one(124),
        "lines": one(10),
    }


def repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Share of each text's lines that repeat an earlier line of it."""
    out = np.zeros(len(offsets) - 1)
    for i in range(len(out)):
        lines = [x for x in data[offsets[i] : offsets[i + 1]].tobytes().split(b"\n") if x.strip()]
        if len(lines) > 1:
            out[i] = 1 - len(set(lines)) / len(lines)
    return out


def runs_of(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Share of distinct values within each text."""
    out = np.zeros(len(first) - 1)
    for i in range(len(out)):
        v = values[first[i] : first[i + 1]]
        out[i] = len(np.unique(v)) / len(v) if len(v) else 1.0
    return out
