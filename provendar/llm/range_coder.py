"""An adaptive context-mixing range coder for token ids, in independently reset, checksummed blocks.

Ids are cut into blocks of BLOCK ids. A block's models start afresh, so blocks
are coded side by side: lane k of every array below belongs to block k, and one
step codes one id of each block. All numbers are integers, so any machine
decodes what another one wrote.

For each id three predictions are mixed:
* orders 2 and 1 each name one id: the one that came last after the same two ids,
  or the same one, with a confidence of 0 to 3 (hits since it was named).
* order 0 names all ids of the stretch, by the counts that the header keeps, in a
  frequent and a rare half.
The weights are adaptive: order 2's share is learned per pair of confidences
(and whether both name the same id), order 1's share of the rest likewise, and
the frequent half's share of what remains per block. One step of the range
narrows to the predictor, a second one to the id inside order 0; 32 bits are given
off at most once an id, carries are added at the end.

Format of a stretch, little-endian: magic, ids, block size, number of different
ids; these by falling count, and their counts; per block its bytes and the crc32 of its
ids; the blocks. A block needs only the header, not its neighbours. Stretches
may follow one another.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Ids of a block, and blocks coded side by side.
BLOCK, LANES = 1024, 8192
MAGIC = b"PTI1"
#: Entries of the tables of order 1 and order 2 in each block, as bits.
BITS = 8
#: Different ids that a stretch may hold; one with more is written as two.
DIFFERENT = 60_000
#: Ids below this are counted in a table.
SMALL = 1 << 20
#: Odds stay within these 65536ths, so that the range is never used up within one id.
LEAST, MOST = 2048, 63488
_HEAD = struct.Struct("<4sQII")
U = np.uint64
_32, _16 = U(32), U(16)


class CorruptBlock(ValueError):
    """A block whose ids do not give its checksum, or bytes that are no stretch."""


class _Prior:
    """Order 0 of a stretch. Ids go by their place in the order of falling counts; places before `half` hold half of all ids."""

    def __init__(self, counts: np.ndarray):
        total = int(counts.sum())
        self.half = h = max(1, min(len(counts) - 1, int(np.searchsorted(np.cumsum(counts), total / 2)) + 1)) if len(counts) > 1 else 1
        self.share = np.zeros(len(counts), np.int64)
        self.below = np.zeros(len(counts), np.int64)
        self.find = np.zeros(1 << 17, np.int32)  # which place a point of either half belongs to
        for c, (s, e) in enumerate(((0, h), (h, len(counts)))):
            if e > s:
                n = counts[s:e].astype(np.int64)
                f = 1 + n * (65536 - (e - s)) // int(n.sum())
                f[0] += 65536 - int(f.sum())
                self.share[s:e], self.below[s:e] = f, np.cumsum(f) - f
                self.find[c << 16 : (c + 1) << 16] = np.repeat(np.arange(s, e, dtype=np.int32), f)


class _Models:
    """The models of n blocks; coding and decoding share every step. Arrays of two rows hold order 1 and order 2, or the odds of order 2 and order 1."""

    def __init__(self, n: int):
        lane = np.arange(n)
        self.table = np.full(2 * n << BITS, 0xFFFFFFFC, np.uint32)  # place of the named id << 2 | confidence; order 1's half, then order 2's
        self.base, self.lanes = np.stack([lane, lane + n]) << BITS, np.stack([lane, lane + n]) << 5
        self.odds = np.full(2 * n << 5, 16384, np.int32)
        self.q0 = np.full(n, 32768, np.int32)
        self.c1 = np.zeros(n, np.uint32)
        self.c2 = np.zeros(n, np.uint32)
        self._room(n)

    def _room(self, n: int) -> None:
        self.bounds = np.zeros((5, n), np.int32)
        self.bounds[4] = 65536
        self.keys, self.hits = np.zeros((2, n), np.uint32), np.zeros((2, n), bool)

    def fewer(self, n: int) -> None:
        """Blocks that have ended are the last ones; the others go on."""
        self.base, self.lanes = self.base[:, :n].copy(), self.lanes[:, :n].copy()
        self.q0, self.c1, self.c2 = self.q0[:n].copy(), self.c1[:n], self.c2[:n]
        self._room(n)

    def predict(self) -> None:
        """named: the places that orders 1 and 2 name; bounds: where the shares of order 2, order 1 and order 0's halves end."""
        one, two = self.keys
        np.multiply(self.c1, np.uint32(0x9E3779B1), out=one)
        np.right_shift(one, np.uint32(15), out=two)
        two ^= one
        two += self.c2
        two *= np.uint32(0x85EBCA6B)
        self.keys >>= np.uint32(32 - BITS)
        self.at = self.base + self.keys
        self.entry = self.table[self.at]
        self.named = (self.entry >> np.uint32(2)).view(np.int32)
        self.sure = self.entry & np.uint32(3)
        self.other = self.named[0] != self.named[1]
        k = self.sure[1] << np.uint32(3)
        k += self.sure[0] << np.uint32(1)
        k += self.other
        self.place = self.lanes + k
        self.q = self.odds[self.place]
        _, b1, b2, b3, _ = self.bounds
        b1[:] = self.q[0]
        rest = 65536 - b1
        rest >>= 1
        np.multiply(rest, self.q[1], out=b2)
        b2 >>= 15
        b2 *= self.other
        b2 += b1
        np.subtract(65536, b2, out=rest)
        rest >>= 1
        np.multiply(rest, self.q0, out=b3)
        b3 >>= 15
        b3 += b2

    def learn(self, place: np.ndarray, not2: np.ndarray, neither: np.ndarray, rare: np.ndarray) -> None:
        """place: what came. not2: order 2 had not named it; neither: nor had order 1; rare: it is of the rare half."""
        hits = self.hits
        np.logical_not(not2, out=hits[0])
        np.logical_xor(not2, neither, out=hits[1])
        aim = hits * np.int32(MOST - LEAST)
        aim += LEAST
        aim -= self.q
        aim >>= 4
        aim[1] *= not2 & self.other
        self.q += aim
        self.odds[self.place] = self.q
        aim = rare * np.int32(LEAST - MOST)
        aim += MOST
        aim -= self.q0
        aim >>= 5
        aim *= neither
        self.q0 += aim
        come = place.view(np.uint32)
        kept = np.where(self.sure > 1, self.entry - np.uint32(2), come << np.uint32(2))
        self.entry += self.sure < 3
        self.table[self.at] = np.where(self.named == place, self.entry, kept)
        self.c2 = self.c1
        self.c1 = come + np.uint32(1)


def _steps(size: np.ndarray):
    """(step, blocks that still have an id); size: ids of each block, the last one may be shorter."""
    for t in range(int(size[0])):
        yield t, len(size) - int(t >= size[-1])


def _encode_lanes(place: np.ndarray, size: np.ndarray, prior: _Prior) -> list[np.ndarray]:
    """place: (steps, lanes) places of ids; size: ids of each lane. Returns each lane's 32-bit words."""
    steps, n = place.shape
    m = _Models(n)
    low, span = np.zeros(n, U), np.full(n, 0xFFFFFFFFFFFFFFFF, U)
    room = steps + 4
    out, carry = np.zeros(n * room, np.uint32), np.zeros(n * room + 1, bool)
    end = np.arange(n) * room
    at, lane = end, np.arange(n)
    for t, k in _steps(size):
        if k < len(low):
            m.fewer(k)
            done = low[k:], span[k:]
            low, span, at, lane = low[:k].copy(), span[:k].copy(), at[:k], lane[:k]
        x = place[t, :k]
        m.predict()
        not2 = m.named[1] != x
        neither = not2 & (m.named[0] != x)
        rare = neither & (x >= prior.half)
        kind = not2.astype(np.int64)
        kind += neither
        kind += rare
        kind *= k
        kind += lane
        flat = m.bounds.ravel()
        below = flat[kind]
        kind += k
        width = flat[kind] - below
        span >>= _16
        add = span * below.astype(U)
        span *= width.astype(U)
        add += low
        over = add < low
        span >>= _16
        below = prior.below[x] * neither
        width = (prior.share[x] - 65536) * neither
        width += 65536
        low = add + span * below.view(U)
        over |= low < add
        if over.any():
            carry[at[over]] = True
        span *= width.view(U)
        give = span < U(1 << 32)
        out[at] = low >> _32
        shift = give.astype(U)
        shift <<= U(5)
        low <<= shift
        span <<= shift
        at += give
        m.learn(x, not2, neither, rare)
    lows = low if len(low) == n else np.concatenate([low, done[0]])
    out[end], out[end + 1] = lows >> _32, lows & U(0xFFFFFFFF)
    up = np.flatnonzero(carry) - 1  # a carry goes into the word given off before, and on where that is full
    while len(up):
        out[up] += np.uint32(1)
        up = up[out[up] == 0] - 1
    return [out[k * room : int(e) + 2] for k, e in enumerate(end)]


def _decode_lanes(words: np.ndarray, at: np.ndarray, size: np.ndarray, prior: _Prior) -> np.ndarray:
    """words: those of all lanes, and some behind the last; at: each lane's first. Returns (steps, lanes) places."""
    n, steps = len(size), int(size[0])
    m = _Models(n)
    at, lane = at.astype(np.int64), np.arange(n)
    code = words[at].astype(U) << _32 | words[at + 1].astype(U)
    at += 2
    span = np.full(n, 0xFFFFFFFFFFFFFFFF, U)
    out = np.zeros((steps, n), np.int32)
    for t, k in _steps(size):
        if k < len(code):
            m.fewer(k)
            code, span, at, lane = code[:k].copy(), span[:k].copy(), at[:k], lane[:k]
        m.predict()
        span >>= _16
        point = (code // span).astype(np.int32)
        _, b1, b2, b3, _ = m.bounds
        not2 = point >= b1
        neither = point >= b2
        rare = point >= b3
        kind = not2.astype(np.int64)
        kind += neither
        kind += rare
        kind *= k
        kind += lane
        flat = m.bounds.ravel()
        below = flat[kind]
        kind += k
        width = flat[kind] - below
        code -= span * below.astype(U)
        span *= width.astype(U)
        span >>= _16
        point = (code // span).astype(np.int64)
        point *= neither
        point += rare.astype(np.int64) << 16
        x = prior.find[point]
        below = prior.below[x] * neither
        width = (prior.share[x] - 65536) * neither
        width += 65536
        code -= span * below.view(U)
        span *= width.view(U)
        x = np.where(neither, x, np.where(not2, m.named[0], m.named[1]))
        give = span < U(1 << 32)
        shift = give.astype(U)
        nxt = words[at] * give
        shift <<= U(5)
        code <<= shift
        code |= nxt
        span <<= shift
        at += give
        m.learn(x, not2, neither, rare)
        out[t, :k] = x
    return out


def encode(ids: np.ndarray) -> bytes:
    """Ids (unsigned, under 2^30) as one stretch, or more where they differ too much."""
    ids = np.asarray(ids)
    if len(ids) and int(ids.max()) < SMALL:
        counts = np.bincount(ids)
        different = np.flatnonzero(counts)
        counts = counts[different]
        rank = np.zeros(int(different[-1]) + 1, np.int32)
        rank[different] = np.arange(len(different), dtype=np.int32)
        place = rank[ids]
    else:
        different, place, counts = np.unique(ids, return_inverse=True, return_counts=True)
    if len(different) > DIFFERENT:
        return encode(ids[: len(ids) // 2]) + encode(ids[len(ids) // 2 :])
    order = np.argsort(-counts, kind="stable")
    different, counts = different[order], counts[order]
    head = _HEAD.pack(MAGIC, len(ids), BLOCK, len(different)) + different.astype("<u4").tobytes() + counts.astype("<u4").tobytes()
    if not len(ids):
        return head
    prior = _Prior(counts)
    to = np.empty(len(order), np.int32)
    to[order] = np.arange(len(order), dtype=np.int32)
    place = to[place]
    n = -(-len(ids) // BLOCK)
    table, body = [], []
    for i in range(0, n, LANES):
        j = min(i + LANES, n)
        size = np.minimum(BLOCK, len(ids) - np.arange(i, j) * BLOCK)
        some = place[i * BLOCK : min(j * BLOCK, len(ids))]
        lanes = np.zeros((j - i) * int(size[0]), np.int32)
        lanes[: len(some)] = some
        lanes = np.ascontiguousarray(lanes.reshape(j - i, int(size[0])).T)
        for k, w in enumerate(_encode_lanes(lanes, size, prior)):
            raw = w.astype("<u4").tobytes()
            at = (i + k) * BLOCK
            table.append((len(raw), zlib.crc32(ids[at : at + BLOCK].astype("<u4").tobytes())))
            body.append(raw)
    return head + np.array(table, "<u4").tobytes() + b"".join(body)


def decode(raw: bytes):
    """Yields the ids of all stretches, LANES blocks at a time; a block that does not give its checksum raises CorruptBlock."""
    raw, at = memoryview(raw), 0
    while at < len(raw):
        magic, total, block, k = _HEAD.unpack_from(raw, at)
        if magic != MAGIC:
            raise CorruptBlock("not a stretch of token ids")
        at += _HEAD.size
        different = np.frombuffer(raw, "<u4", k, at)
        counts = np.frombuffer(raw, "<u4", k, at + 4 * k)
        at += 8 * k
        if not total:
            continue
        prior = _Prior(counts.astype(np.int64))
        n = -(-total // block)
        table = np.frombuffer(raw, "<u4", 2 * n, at).reshape(n, 2)
        at += 8 * n
        for i in range(0, n, LANES):
            j = min(i + LANES, n)
            size = np.minimum(block, total - np.arange(i, j) * block)
            length = table[i:j, 0].astype(np.int64)
            end = at + int(length.sum())
            words = np.concatenate([np.frombuffer(raw[at:end], "<u4"), np.zeros(4, np.uint32)])
            try:
                with np.errstate(divide="ignore"):
                    place = _decode_lanes(words, (np.cumsum(length) - length) // 4, size, prior)
                ids = different[place.T.ravel()[: int(size.sum())]]
            except IndexError as e:
                raise CorruptBlock(f"blocks from {i} on do not decode") from e
            at = end
            for b in range(i, j):
                if zlib.crc32(ids[(b - i) * block : (b - i + 1) * block].tobytes()) != table[b, 1]:
                    raise CorruptBlock(f"block {b} does not give its checksum")
            yield ids
