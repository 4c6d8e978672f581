"""Adaptive context-mixing range coder for sequences of ids.

Every block starts from an empty model and is coded on its own; many blocks
advance together, one id each per step, so that each step is a few numpy
operations over all of them. Within a block an id goes by its number, which
is the count of distinct ids up to its first place (from 1); 0 is no id.

Model of a block. Four predictions share the coding interval:

* order 2: the id expected after the last two ids (hashed table);
* order 1: the id expected after the last id;
* order 0: the ids the block has had so far, in a list in which an id moves
  half-way to the front each time it is coded here; place k has a share of
  about 1 / (k + 32);
* a new id, uniform over the vocabulary.

The mixing weights of the four are learned per context, which is the
confidence of the order-2 and of the order-1 prediction and whether both
expect the same id: after every id the weights move to the prediction that
coded it. All arithmetic is on integers, so any reader gets the same numbers.

The range coder keeps 56 bits and emits 16 at a time; a carry goes to the
words before. The reader holds the distance of its code from the low end only.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

U = np.uint64
SHARE_BITS = 12  # mixing weights of a context sum to 2 ** SHARE_BITS
LEAST = 6  # least weight of a prediction
RATE = U(5)
FIELDS = 0x0001_0001_0001_0001  # a context's four weights lie in one integer, 16 bits each
FLOOR = U(LEAST * FIELDS)
KEEP = U(0x07FF * FIELDS)  # what a field has left after a shift by RATE
SUM = U(FIELDS)
FIELD = U(0xFFFF)
TOPS = U(0x8000 * FIELDS)  # the top bit of each field, and of the first three
TOPS_3 = U(0x8000_8000_8000)
EVEN = U((1 << SHARE_BITS) // 4 * FIELDS)
TABLE_BITS = 11
DOWN = np.uint32(32 - TABLE_BITS)
CONTEXTS = 32
FAST = "clip"  # take without a look for places out of range, which there are none of
TURNED = 64  # rows or columns of a tile
PAD = 32  # lanes more in a row of steps, so that rows don't begin a power of two apart
ROOM = 3 * TURNED + 8  # words that a lane may add in TURNED steps and at its end
BOTTOM, LOW = U(1 << 40), U((1 << 40) - 1)
S4, S16, S24, S32, S40, S48 = U(4), U(16), U(24), U(32), U(40), U(48)
SHARE = U(SHARE_BITS)


@lru_cache(maxsize=4)
def _places(n: int, vocabulary: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Shares of the order-0 list. By place (from 1; 0 is no place, a whole share): its share and the sum of those before.
    By number of places: 2 ** 40 over the sum of their shares (0: over the vocabulary) and the last point of the
    sum. By point of the sum: the place, from 0."""
    share = (1 << 16) // (np.arange(n, dtype=np.int64) + 32)
    sums = np.concatenate([[0], np.cumsum(share)])
    parts = (1 << 40) // np.concatenate([[vocabulary], sums[1:]])
    shares, before = np.concatenate([[1], share]), np.concatenate([[0], sums[:-1]])
    return *(x.astype(np.uint64) for x in (shares, before, parts, np.maximum(sums - 1, 0))), np.repeat(np.arange(n, dtype=np.uint16 if n <= 1 << 16 else np.uint32), share)


class Model:
    """State of ``lanes`` blocks of at most ``most`` ids each. Tables by number, by place and by context hold all lanes'
    cells of a number together: the few numbers that most ids have stay in the cache."""

    def __init__(self, lanes: int, most: int, vocabulary: int):
        self.kind = np.uint16 if most < 1 << 14 else np.uint32  # of number * 4 + confidence
        size, self.lanes = 1 << TABLE_BITS, lanes
        self.lane = np.arange(lanes, dtype=np.int64)
        self.share = np.full(CONTEXTS * lanes, EVEN)
        self.after = np.zeros((size + most + 1) * lanes, self.kind)  # expected number * 4 + confidence (0 to 3); order 2, order 1
        self.known = np.zeros(lanes, np.int64)
        self.last, self.before = np.zeros(lanes, np.uint32), np.zeros(lanes, np.uint32)
        self.slots = np.stack([self.lane * size, self.lane + size * lanes])  # of order 2: a table each lane; order 1
        self.at = self.slots.copy()
        self.listed = np.repeat(np.arange(1, most + 2, dtype=self.kind), lanes)  # number at each place; a new one is there already
        self.shares, self.sums, self.parts, self.ends, self.places = _places(most, vocabulary)

    def predict(self, n: int) -> None:
        """Predictions of the first ``n`` lanes and the bounds of their shares."""
        self.at = at = self.at[:, :n]
        np.add(self.slots[0, :n], (self.last[:n] * np.uint32(0x9E3779B1) + self.before[:n]) >> DOWN, out=at[0])
        self.p = p = self.after.take(at, mode=FAST)
        self.c, self.sure = c, sure = p >> 2, p & 3
        level = (sure[0] << 3) + (sure[1] << 1) + (c[0] == c[1])
        self.context = level * np.int64(self.lanes) + self.lane[:n]
        self.weights = self.share.take(self.context, mode=FAST)
        self.bounds = self.weights * SUM  # sums of the first one, two, three and four weights

    def narrow(self, n: int, kind: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and size of the share of the prediction that codes each lane's id, and the units it is cut
        into: shares of the list, ids of the vocabulary, or one."""
        self.by16 = by16 = kind.astype(np.uint64) << S4
        begin = r * ((self.bounds << S16 >> by16) & FIELD)
        r = r * ((self.weights >> by16) & FIELD)
        self.is_new = kind == 3
        self.from_list, self.new = one(kind == 2), one(self.is_new)
        self.listing = self.known[:n] * self.from_list  # how many are listed, 0 for other kinds
        unit = ((r >> S24) * self.parts.take(self.listing, mode=FAST)) >> S16
        np.copyto(unit, r, where=kind < 2)
        return begin, unit

    def forward(self, here: np.ndarray, there: np.ndarray, moved: np.ndarray) -> np.ndarray:
        """Moves numbers from their places ``here`` to ``there`` and returns those that were there and change with them."""
        other = self.listed.take(there, mode=FAST)
        self.listed[here], self.listed[there] = other, moved
        return other

    def learn(self, n: int, y: np.ndarray, cell: np.ndarray) -> None:
        """Moves the weights to the prediction that coded each id, and the tables to the ids' numbers, of these cells."""
        w = self.weights
        less = ((w - FLOOR) >> RATE) & KEEP
        self.share[self.context] = w - less + (((less * SUM) >> S48) << self.by16)
        # a hit raises the confidence up to 3, a miss lowers it and below 2 puts the new number in
        hit, fresh = self.c == y, (y << 2) + 1
        moved = self.p + hit * ((self.sure < 3) + self.kind(1)) - 1
        self.after[self.at] = fresh + (moved - fresh) * (hit | (self.sure > 1))
        np.multiply(self.last[:n], np.uint32(0x85EBCA6B), out=self.before[:n])
        self.last[:n] = y
        np.add(self.slots[1, 0], cell, out=self.at[1])


def one(flags: np.ndarray) -> np.ndarray:
    """1 where a flag holds, 0 elsewhere, as whole numbers that need no cast in a step."""
    return flags.view(np.int8).astype(np.int64)


def _shapes(lengths: np.ndarray):
    """Lanes in order of falling length, and for each step how many of them still run."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths.max(initial=0))
    left = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, left.tolist()


def _turned(x: np.ndarray) -> np.ndarray:
    """The transpose, copied in tiles."""
    out = np.empty(x.shape[::-1], x.dtype)
    for k in range(0, x.shape[1], TURNED):
        out[k : k + TURNED] = x[:, k : k + TURNED].T
    return out


def encode_blocks(blocks: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """The coded bytes of each block of ids (0 <= id < vocabulary <= 2 ** 29)."""
    lengths = np.array([len(b) for b in blocks], np.int64)
    order, left = _shapes(lengths)
    lanes, most = len(blocks), max(1, int(lengths.max(initial=0)))
    m = Model(lanes, most, vocabulary)
    numbers = np.zeros((most, lanes + PAD), m.kind)  # by step, so that a step's numbers are together
    names = np.zeros((most + 1, lanes), np.int32)  # the id of each number of a lane
    first, steps = np.zeros(vocabulary, m.kind), np.arange(most, dtype=m.kind)
    y, number = np.zeros((TURNED, most), m.kind), np.zeros(most, m.kind)
    for lo in range(0, lanes, TURNED):
        own = order[lo : lo + TURNED]
        for lane, k in enumerate(own):
            n, b = int(lengths[k]), blocks[k].astype(np.int64)
            at = steps[:n]
            first[b[::-1]] = at[::-1]
            at_first = first.take(b, mode=FAST)
            new = (at_first == at).nonzero()[0]
            number[new] = steps[: len(new)] + m.kind(1)
            y[lane, :n] = number.take(at_first, mode=FAST)
            names[1 : len(new) + 1, lo + lane] = b.take(new)
        numbers[:, lo : lo + len(own)] = y[: len(own)].T
    names, place = names.reshape(-1), np.repeat(np.maximum(np.arange(most + 1) - 1, 0).astype(m.kind), lanes)  # of each number in the list
    low, span = np.zeros(lanes, np.uint64), np.full(lanes, 1 << 56, np.uint64)
    width = most * 7 // 8 + ROOM | 1  # words of a lane, more if need be
    words, lane = np.zeros((lanes, width), np.uint32), m.lane
    at, flat = lane * width, words.reshape(-1)
    for step, (n, y) in enumerate(zip(left, numbers)):
        if step % TURNED == 0 and (used := int((at - lane * width).max())) + ROOM > width:
            more = (used + ROOM) * 3 // 2 | 1
            words, at = np.pad(words, ((0, 0), (0, more - width))), at + lane * (more - width)
            flat, width = words.reshape(-1), more
        y, lo = y[:n], low[:n]
        m.predict(n)
        miss = (m.c != y).view(np.int8)
        kind = miss[0] * (miss[1] * ((y > m.known[:n]).view(np.int8) + np.int8(1)) + np.int8(1))
        begin, unit = m.narrow(n, kind, span[:n] >> SHARE)
        m.known[:n] += m.new
        cell = y * np.int64(lanes) + lane[:n]
        k = place.take(cell, mode=FAST) * m.from_list
        share = k + m.from_list
        lo += begin
        lo += unit * m.sums.take(share, mode=FAST)
        r = unit * m.shares.take(share, mode=FAST)
        new = m.is_new.nonzero()[0]
        lo[new] += unit.take(new) * names.take(cell.take(new)).astype(U)
        moves = (k != 0).nonzero()[0]
        k, row = k.take(moves), lane.take(moves)
        half = k >> 1
        other = m.forward(k * lanes + row, half * lanes + row, y.take(moves))
        place[other * np.int64(lanes) + row] = k
        place[cell.take(moves)] = half
        m.learn(n, y, cell)
        go = (r < BOTTOM).nonzero()[0]
        while len(go):
            a, b, j = lo.take(go), r.take(go) << S16, at.take(go)
            flat[j] = (a >> S40).astype(np.uint32)
            at[go] = j + 1
            lo[go], r[go] = (a & LOW) << S16, b
            go = go[b < BOTTOM]
        span[:n] = r
    for _ in range(4):
        flat[at] = low >> S40
        at += 1
        low = (low & LOW) << S16
    while (over := np.flatnonzero(flat > 0xFFFF)).size:  # carries; a block's first word has none
        flat[over] &= 0xFFFF
        flat[over - 1] += 1
    words = words.astype(">u2")
    out = [b""] * lanes
    for k, w, n in zip(order, words, (at - lane * width).tolist()):
        out[k] = w[:n].tobytes()
    return out


def decode_blocks(coded: list[bytes], lengths, vocabulary: int) -> list[np.ndarray]:
    """The ids of each block, from its bytes and its number of ids."""
    lengths = np.asarray(lengths, np.int64)
    order, left = _shapes(lengths)
    lanes, most = len(coded), max(1, int(lengths.max(initial=0)))
    longest = max([len(c) // 2 for c in coded], default=0) + 8
    words = np.zeros((lanes, longest | 1), np.uint16)
    for lane, k in enumerate(order):
        w = np.frombuffer(b"\0" + coded[k] + b"\0", ">u2")  # 56 bits are four words but for a byte
        words[lane, : len(w)] = w
    code = np.zeros(lanes, np.uint64)
    for j in range(4):
        code = (code << S16) | words[:, j]
    at, flat = np.arange(lanes, dtype=np.int64) * words.shape[1] + 4, words.reshape(-1)
    m = Model(lanes, most, vocabulary)
    numbers, names = np.zeros((most, lanes + PAD), m.kind), np.zeros((most + 1) * lanes, np.int32)  # by step; by number
    lane = m.lane
    span, top = np.full(lanes, 1 << 56, np.uint64), U(vocabulary - 1)
    for n, y in zip(left, numbers):
        y, cd = y[:n], code[:n]
        m.predict(n)
        r = span[:n] >> SHARE
        # how many of the first three bounds the point has reached: a field's top bit stays where it isn't less
        kind = np.bitwise_count(((cd // r) * SUM + TOPS - m.bounds) & TOPS_3)
        begin, unit = m.narrow(n, kind, r)
        cd -= begin
        point = cd // unit
        k = m.places.take(np.minimum(point, m.ends.take(m.listing, mode=FAST)).view(np.int64), mode=FAST)
        share = k + m.from_list
        cd -= unit * m.sums.take(share, mode=FAST)
        r = unit * m.shares.take(share, mode=FAST)
        m.known[:n] += m.new
        here = k * np.int64(lanes) + lane[:n]
        y[:] = m.listed.take(here, mode=FAST)
        np.copyto(y, m.c[0], where=kind == 0)
        np.copyto(y, m.c[1], where=kind == 1)
        new = m.is_new.nonzero()[0]
        x, number = np.minimum(point.take(new), top), m.known.take(new)
        cd[new] -= unit.take(new) * x
        y[new] = number
        cell = y * np.int64(lanes) + lane[:n]
        names[cell.take(new)] = x
        moves = (k != 0).nonzero()[0]
        m.forward(here.take(moves), (k.take(moves) >> 1) * np.int64(lanes) + lane.take(moves), y.take(moves))
        m.learn(n, y, cell)
        go = (r < BOTTOM).nonzero()[0]
        while len(go):
            j, b = at.take(go), r.take(go) << S16
            cd[go] = (cd.take(go) << S16) | flat.take(j).astype(U)
            at[go] = j + 1
            r[go] = b
            go = go[b < BOTTOM]
        span[:n] = r
    numbers, names = _turned(numbers), _turned(names.reshape(most + 1, lanes)[: m.known.max(initial=0) + 1])
    out = [None] * lanes
    for k, y, name in zip(order, numbers, names):
        out[k] = name.take(y[: lengths[k]], mode=FAST)
    return out
