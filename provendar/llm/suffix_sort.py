"""Suffix sorting by external induction, with common-prefix values.

The scheme is the induced-sorting one: suffixes are of type L (greater than
their successor) or S; an S suffix after an L one is S*. The S* substrings are
sorted and named in order, the string of names is sorted recursively by the
same scheme, and from the sorted S* suffixes first all L and then all S
suffixes are induced - on every level, through a priority queue keyed by first
symbol that carries tuples (suffix, common prefix with its forerunner).

Tuples of one symbol arrive in their final order, so the queue needs no
comparisons: it is first-in first-out runs. On the first level a run holds one
symbol. Names are many, so on deeper levels a run holds a range of symbols
(`_Wide`); a range is put in order by symbol when its turn comes, and is worked
off in steps that stop before anything the step itself pushes in between.

Common prefixes are counted in bytes on all levels. Inducing adds a symbol's
length to the least value met since the last tuple pushed for that symbol. On
deeper levels values count whole equal names - a lower bound, exact for all
that is equal by name; on the first level the bound of neighbouring S* suffixes
is completed by comparing the bytes behind it, and all values are exact.

External: a sorter has `limit` bytes. Queued tuples beyond their share lie in
temporary files and are read back in blocks; the string, types, names and
positions of any level lie in files as soon as they exceed theirs; S*
substrings that do not fit are dealt by their first symbols into files that
do. Files are unlinked at once and belong to the process: nothing outlives a
task, and a task that is lost is run again.
"""

from __future__ import annotations

import os
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np

#: Common prefixes are carried up to this length; what is asked is whether they reach it.
CAP = 100
#: Bytes in memory before a sorter's queues, or its arrays, go to files.
LIMIT = 64 << 20
#: Tuples taken from a run at once, symbols' tuples in a range, tuples in a first and in the largest step, places handled at once.
POP_TUPLES, RANGE_TUPLES, FIRST_STEP, LAST_STEP, BLOCK = 1 << 20, 1 << 14, 256, 1 << 13, 1 << 18
#: Tuples that a range pushes into itself and that wait beside it before they are merged with its others.
WAITING = 1 << 10
_TUPLE = np.dtype([("pos", "<i4"), ("lcp", "<i2")])
#: On deeper levels a tuple is two numbers: a key - twice the symbol's place in the sweep, plus one for what joins behind
#: the queue's tuples - and its position and value, the latter in the low bits.
_LOW = 8
_PAIR = np.dtype(("<i8", 2))
_BIG = np.int16(32000)


def _file():
    """A file that has no name: beside Spark's own spill files where there are such."""
    folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0]
    return tempfile.TemporaryFile(dir=folder if folder and os.access(folder, os.W_OK) else None)


class Space:
    """Arrays in memory up to `limit` bytes altogether, then in files."""

    def __init__(self, limit: int):
        self.limit, self.held, self.filed, self.queued = limit, 0, 0, 0

    def array(self, n: int, dtype) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if self.held + size <= self.limit or not n:
            self.held += size
            return np.empty(n, dtype)
        self.filed += size
        return np.memmap(_file(), dtype, "w+", shape=(n,))

    def free(self, *arrays: np.ndarray) -> None:
        for a in arrays:
            if not isinstance(a, np.memmap):
                self.held -= a.nbytes


class BucketQueue:
    """First-in first-out runs of tuples, one per symbol (or range of symbols), spilling to one temporary file."""

    def __init__(self, symbols: int, space: Space, dtype=_TUPLE):
        self.runs: list[deque] = [deque() for _ in range(symbols)]
        self.space, self.dtype, self.held, self.file, self.end = space, dtype, 0, None, 0

    def push(self, symbol: int, block: np.ndarray) -> None:
        if self.held + block.nbytes > self.space.limit // 4:
            if self.file is None:
                self.file = _file()
            self.file.seek(self.end)
            self.file.write(block.tobytes())
            self.runs[symbol].append((self.end, len(block)))
            self.end += block.nbytes
            self.space.queued += block.nbytes
        else:
            self.held += block.nbytes
            self.runs[symbol].append(block)

    def _load(self, x) -> np.ndarray:
        if isinstance(x, np.ndarray):
            return x
        self.file.seek(x[0])
        raw = self.file.read(x[1] * self.dtype.itemsize)
        return np.frombuffer(raw, np.int64).reshape(-1, 2) if self.dtype is _PAIR else np.frombuffer(raw, self.dtype)

    def pop(self, symbol: int) -> Iterator[np.ndarray]:
        """Blocks of a symbol in order; those pushed meanwhile follow."""
        run = self.runs[symbol]
        while run:
            got, n = [], 0
            while run and n < POP_TUPLES:
                x = run.popleft()
                if isinstance(x, np.ndarray):
                    self.held -= x.nbytes
                got.append(self._load(x))
                n += len(got[-1])
            yield np.concatenate(got) if len(got) > 1 else got[0]

    def read(self, symbol: int) -> np.ndarray:
        """All tuples of a symbol, left in the queue."""
        got = [self._load(x) for x in self.runs[symbol]]
        return np.concatenate(got) if got else np.zeros(0, self.dtype)  # of pairs: (0, 2)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _blocks(n: int, back: bool = False) -> Iterator[slice]:
    at = range(0, n, BLOCK)
    for a in reversed(at) if back else at:
        yield slice(a, min(a + BLOCK, n))


def types(t: np.ndarray, space: Space | None = None) -> np.ndarray:
    """True where the suffix is of type S; the last symbol, the unique least, is S."""
    n = len(t)
    out = (space or Space(1 << 62)).array(n, bool)
    out[n - 1] = after = True
    for z in _blocks(n - 1, back=True):
        part = t[z.start : z.stop + 1].astype(np.int64)
        up = np.append(np.sign(part[1:] - part[:-1]), 1 if after else -1)
        at = np.where(up != 0, np.arange(len(up)), len(up))
        up = up[np.minimum.accumulate(at[::-1])[::-1]] > 0
        out[z] = up[:-1]
        after = bool(up[0])
    return out


def _stars(s: np.ndarray, space: Space) -> np.ndarray:
    """Places of the S* suffixes; the last place is one."""
    many = sum(int((s[z.start + 1 : z.stop + 1] & ~s[z][: len(s) - 1 - z.start]).sum()) for z in _blocks(len(s)))
    out, n = space.array(many, np.int64), 0
    for z in _blocks(len(s)):
        got = np.flatnonzero(s[z.start + 1 : z.stop + 1] & ~s[z][: len(s) - 1 - z.start]) + z.start + 1
        out[n : n + len(got)] = got
        n += len(got)
    return out


# --------------------------------------------------------------------------- names of S* substrings


def _refine(rank: np.ndarray, active: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Splits equal ranks by key, in place; returns the members of active that still share a rank.

    A rank is the number of smaller entries, so it stays valid while others are split.
    """
    order = np.lexsort((key, rank[active])) if rank[active].any() else np.argsort(key, kind="stable")
    a, k = active[order], key[order]
    r = rank[a]
    group = np.ones(len(a), bool)
    group[1:] = r[1:] != r[:-1]
    new = group.copy()
    new[1:] |= k[1:] != k[:-1]
    at = np.flatnonzero(new)
    start = np.maximum.accumulate(np.where(group, np.arange(len(a)), 0))
    sub = np.repeat(at, np.diff(np.append(at, len(a))))
    rank[a] = r + (sub - start)
    many = np.repeat(np.diff(np.append(at, len(a))) > 1, np.diff(np.append(at, len(a))))
    return a[many]


class _Substrings:
    """The S* substrings of a string: places, sizes, and some symbols of each, with their types, as one number."""

    def __init__(self, t: np.ndarray, s: np.ndarray, star: np.ndarray, symbols: int):
        self.t, self.s, self.star, self.bits = t, s, star, max(int(symbols * 2 - 1).bit_length(), 1)
        self.per = max(64 // self.bits, 1)

    def sizes(self, which: np.ndarray) -> np.ndarray:
        return self.star[np.minimum(which + 1, len(self.star) - 1)] - self.star[which] + 1

    def keys(self, which: np.ndarray, at: int) -> np.ndarray:
        """Symbols at .. at + per of the substrings; those behind an end count 0 (no substring is a proper prefix of another)."""
        start, size = self.star[which], self.sizes(which)
        key = np.zeros(len(which), np.uint64)
        for k in range(self.per):
            place = np.minimum(start + at + k, len(self.t) - 1)
            code = self.t[place].astype(np.uint64) * np.uint64(2) + self.s[place]
            key = (key << np.uint64(self.bits)) | np.where(at + k < size, code, 0)
        return key

    def ranks(self, which: np.ndarray, at: int) -> np.ndarray:
        """Ranks of some substrings that agree before `at`; equal ones share a rank."""
        rank, active, size = np.zeros(len(which), np.int64), np.arange(len(which)), self.sizes(which)
        while len(active):
            active = _refine(rank, active, self.keys(which[active], at))
            at += self.per
            active = active[size[active] > at]
        return rank


def _names(sub: _Substrings, space: Space, out: np.ndarray) -> int:
    """Writes the substrings' names - dense, in their order - to out; returns how many names there are."""
    n, used = len(sub.star), 0

    def settle(which: np.ndarray, at: int) -> None:
        nonlocal used
        _, dense = np.unique(sub.ranks(which, at), return_inverse=True)
        out[which] = dense + used
        used += int(dense.max()) + 1

    room = max(space.limit // 64, 1024)  # substrings ranked at once

    def deal(lots: Iterator[np.ndarray], many: int, at: int) -> list[tuple]:
        """Substrings by their next symbols, in order: (file, how many, whether they agree on these symbols)."""
        held, sample = _file(), []
        for lot in lots:
            held.write(np.ascontiguousarray(lot, np.int64).tobytes())
            sample.append(sub.keys(lot[:: max(1, many // 4096)], at))
        space.filed += many * 8
        edges = np.unique(np.concatenate(sample))
        edges = edges[:: max(1, len(edges) // 100, len(edges) * room // (4 * many))]
        parts = [_file() for _ in range(2 * len(edges) + 1)]  # 2k: between edges, 2k + 1: an edge itself
        counts = np.zeros(len(parts), np.int64)
        for lot in _lots(held):
            key = sub.keys(lot, at)
            part = np.searchsorted(edges, key, "left") + np.searchsorted(edges, key, "right")
            order = np.argsort(part, kind="stable")
            for p, block in zip(*_groups(part[order], lot[order]), strict=True):
                parts[p].write(block.tobytes())
                counts[p] += len(block)
        held.close()
        return [(f, int(m), p % 2 == 1) for p, (f, m) in enumerate(zip(parts, counts, strict=True)) if m]

    todo = [((np.arange(z.start, z.stop) for z in _blocks(n)), n, 0)]
    while todo:
        lots, many, at = todo.pop()
        if at is None:
            for lot in lots:
                out[lot] = used
            used += 1
            continue
        if many <= room:
            settle(np.concatenate(list(lots)), at)
            continue
        later = []
        for f, m, agree in deal(lots, many, at):
            one = next(_lots(f))[:1]
            if agree and sub.sizes(one)[0] <= at + sub.per:
                later.append((_lots(f), 0, None))  # equal substrings
            else:
                later.append((_lots(f), m, at + sub.per if agree else at))
        todo += later[::-1]
    return used


def _lots(f) -> Iterator[np.ndarray]:
    f.seek(0)
    while raw := f.read(BLOCK * 8):
        yield np.frombuffer(raw, np.int64)


def _groups(key: np.ndarray, rows: np.ndarray) -> tuple[list[int], list[np.ndarray]]:
    """Runs of equal keys: (keys, rows of each)."""
    if not len(key):
        return [], []
    at = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[at].tolist(), np.split(rows, at[1:])


# --------------------------------------------------------------------------- inducing


class _Scan:
    """One inducing sweep: takes blocks in scan order and gives the tuples of their left neighbours of the wanted type, by symbol.

    The least value since a symbol's last push is found from the last place of each value: values up to the cap are few.
    """

    def __init__(self, t: np.ndarray, wanted, symbols: int, space: Space, cap: int, length=None):
        self.t, self.wanted, self.cap, self.length = t, wanted, cap, length
        self.last = space.array(symbols, np.int64)  # place in scan order of each symbol's last push
        self.last[:] = -1
        self.place, self.seen = np.full(cap + 1, -1, np.int64), 0

    def pushes(self, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of a block have a wanted left neighbour, its symbol)."""
        before = pos - 1
        hit = (self.wanted(before) & (pos > 0)).nonzero()[0]  # the place before the first is the last, which has no use here
        return hit, self.t[before[hit]]

    def __call__(self, pos: np.ndarray, lcp: np.ndarray, hit: np.ndarray, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(symbols in order, positions, values) of the tuples that a block pushes; hit, sym: from pushes()."""
        base, m, out = self.seen, len(hit), (sym[:0], pos[:0], lcp[:0])
        if m:
            order = sym.argsort(kind="stable")
            at, sym = hit[order], sym[order]
            head = np.ones(m, bool)
            np.not_equal(sym[1:], sym[:-1], out=head[1:])
            pair = np.empty((m, 2), np.int64)
            pair[1:, 0] = at[:-1] + 1
            pair[head, 0] = 0
            pair[:, 1] = at + 1
            padded = np.empty(len(lcp) + 1, np.int64)
            padded[:-1], padded[-1] = lcp, _BIG
            value = np.minimum.reduceat(padded, pair.ravel())[::2]
            heads = head.nonzero()[0]
            # before this block: the least value whose last place lies behind the symbol's last push
            first = sym[heads]
            last = self.last[first]
            value[heads] = np.minimum(value[heads], np.maximum.accumulate(self.place).searchsorted(last, "right"))
            before = pos[at] - 1
            value = np.minimum(value + (1 if self.length is None else self.length(before)), self.cap)
            value[heads[last < 0]] = 0
            tails = np.empty(len(heads), np.int64)
            tails[:-1], tails[-1] = heads[1:] - 1, m - 1
            self.last[first] = base + at[tails]
            out = sym, before, value
        self.place[lcp] = np.arange(base, base + len(lcp))
        self.seen += len(lcp)
        return out


def _records(dtype, **cols) -> np.ndarray:
    out = np.empty(len(cols["pos"]), dtype)
    for k, v in cols.items():
        out[k] = v
    return out


def _pairs(key: np.ndarray, pos: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    out = np.empty((len(pos), 2), np.int64)
    out[:, 0], out[:, 1] = key, pos
    out[:, 1] <<= _LOW
    out[:, 1] |= lcp
    return out


def _parts(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values."""
    return rec[:, 1] >> _LOW, rec[:, 1] & ((1 << _LOW) - 1)


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Both by key; of equal keys those of a come first, each in their order."""
    both = np.concatenate([a, b])
    return both[both[:, 0].argsort(kind="stable")]


class _Wide:
    """A sweep over many symbols: the queue's runs hold ranges of symbols, in the order of the sweep (down: the greatest first)."""

    def __init__(self, t: np.ndarray, wanted, symbols: int, space: Space, cap: int, length, down: bool):
        self.symbols, self.down, self.length = symbols, down, length
        self.scan = _Scan(t, wanted, symbols, space, cap, length)
        self.width = max(1, -(-symbols * RANGE_TUPLES // max(len(t), 1)))
        self.ranges = -(-symbols // self.width)
        self.queue, self.done = (BucketQueue(self.ranges, space, _PAIR) for _ in (0, 1))
        self.outbox: list[np.ndarray] = []

    def turn(self, sym: np.ndarray) -> np.ndarray:
        """A symbol's place in the order of the sweep, and back."""
        return self.symbols - 1 - sym if self.down else sym

    def _send(self) -> None:
        if self.outbox:
            rec = np.concatenate(self.outbox)
            self.outbox = []
            r = (rec[:, 0] >> 1) // self.width
            order = r.argsort(kind="stable")
            for k, block in zip(*_groups(r[order], rec[order]), strict=True):
                self.queue.push(k, block)

    def run(self, seeds) -> None:
        """seeds(range) gives what joins behind the queue's tuples of each symbol, in scan order, values to the forerunner among themselves. Queued tuples end up in done, by range."""
        prior = -1
        for r in range(self.ranges):
            self._send()
            rec = _merged(np.concatenate([*self.queue.pop(r), np.zeros((0, 2), np.int64)]), seeds(r))
            wait, at, step, bound = rec[:0], 0, FIRST_STEP, (r + 1) * self.width * 2
            while at < len(rec) or len(wait):
                # the next tuples: of the range as it was, and of those that wait
                part, order = rec[at : at + step], None
                if len(wait):
                    end = rec[at + step, 0] if at + step < len(rec) else 1 << 62
                    k = min(int(wait[:, 0].searchsorted(end)), step)
                    if k < len(wait) and len(part):
                        part = part[: part[:, 0].searchsorted(wait[k, 0], "right")]
                    now = np.concatenate([part, wait[:k]])
                    order = now[:, 0].argsort(kind="stable")
                    now = now[order]
                else:
                    now = part
                n, key = len(now), now[:, 0]
                pos, lcp = _parts(now)
                hit, sym = self.scan.pushes(pos)
                if n > 1 and len(hit):
                    # nothing may be passed that this step itself pushes in before it
                    least = np.full(n, 1 << 62)
                    least[hit] = self.turn(sym.astype(np.int64)) * 2
                    late = np.minimum.accumulate(least)[:-1] < key[1:]
                    cut = int(late.argmax())
                    if late[cut]:
                        n = cut + 1
                        k = int(hit.searchsorted(n))
                        hit, sym, pos, lcp, key, now = hit[:k], sym[:k], pos[:n], lcp[:n], key[:n], now[:n]
                step = min(max(2 * n, FIRST_STEP), LAST_STEP)
                own = n if order is None else int((order[:n] < len(part)).sum())
                at, wait = at + own, wait[n - own :]
                joins = (key & 1).astype(bool)
                queued = now
                if joins.any():
                    # the first seed of a symbol follows a queued tuple of it (which has at least the symbol in common), or another symbol
                    before = np.empty(n, np.int64)
                    before[0], before[1:] = prior, key[:-1]
                    f = (joins & (key != before)).nonzero()[0]
                    lcp[f] = np.where(before[f] >> 1 == key[f] >> 1, np.minimum(self.length(pos[f]), self.scan.cap), 0)
                    queued = now[~joins]
                prior = int(key[-1])
                if len(queued):
                    self.done.push(r, queued)
                sym, before, value = self.scan(pos, lcp, hit, sym)
                if not len(sym):
                    continue
                got = _pairs(self.turn(sym.astype(np.int64)) * 2, before, value)
                if self.down:
                    got = got[got[:, 0].argsort(kind="stable")]
                k = int(got[:, 0].searchsorted(bound))
                if k < len(got):
                    self.outbox.append(got[k:])
                if k:
                    wait = _merged(wait, got[:k]) if len(wait) else got[:k]
                    if len(wait) > WAITING:
                        rec, wait, at = _merged(rec[at:], wait), wait[:0], 0


def _sorted_names(t: np.ndarray, chars: np.ndarray, symbols: int, space: Space, cap: int, trace: list | None, level: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, values) of all suffixes of a string of names whose last one is the unique least. chars: where each name starts in the text, and where the last ends. Values count whole equal names, in bytes."""
    n = len(t)
    order, value = space.array(n, np.int64), space.array(n, np.int16)
    if symbols == n:  # names that are all different are ranks
        for z in _blocks(n):
            order[t[z]] = np.arange(z.start, z.stop)
            value[z] = 0
        return order, value
    s = types(t, space)
    star = _stars(s, space)
    star_order, star_value = _star_order(t, s, star, symbols, chars, space, cap, trace, level)
    length = lambda pos: np.minimum(chars[pos + 1] - chars[pos], cap)

    up = _Wide(t, lambda p: ~s[p], symbols, space, cap, length, False)
    first = _cuts(t, star_order, up)

    def stars(r: int) -> np.ndarray:
        z = slice(first[r], first[r + 1])
        return _pairs(t[star_order[z]].astype(np.int64) * 2 + 1, star_order[z], star_value[z])

    up.run(stars)
    down = _Wide(t, lambda p: s[p], symbols, space, cap, length, True)

    def larger(r: int) -> np.ndarray:
        """L suffixes of a range of the downward sweep: of at most two ranges of the upward one."""
        low, high = symbols - min((r + 1) * down.width, symbols), symbols - r * down.width  # symbols low .. high - 1
        rec = np.concatenate([up.done.read(k) for k in range(low // up.width, (high - 1) // up.width + 1)])
        pos, lcp = _parts(rec)
        lcp[:-1] = lcp[1:]  # backwards, the forerunner is the next one
        sym = rec[:, 0] >> 1
        own = ((sym >= low) & (sym < high)).nonzero()[0][::-1]
        sym, lcp = sym[own], lcp[own]
        last = np.ones(len(sym), bool)
        last[1:] = sym[1:] != sym[:-1]
        lcp[last] = 0
        return _pairs(down.turn(sym) * 2 + 1, pos[own], lcp)

    down.run(larger)
    order[0], value[0], at = n - 1, 0, 1  # nothing induces the last suffix, the least
    for r in range(up.ranges):
        low = up.done.read(r)
        high = _upward(down, r * up.width, min((r + 1) * up.width, symbols))
        both = _merged(low, high)
        key, (pos, lcp) = both[:, 0], _parts(both)
        edge = np.ones(len(key), bool)
        edge[1:] = key[1:] != key[:-1]
        meets = np.zeros(len(key), bool)
        meets[1:] = edge[1:] & (key[1:] >> 1 == key[:-1] >> 1)
        lcp[edge] = 0
        lcp[meets] = length(pos[meets])
        order[at : at + len(both)], value[at : at + len(both)] = pos, lcp
        at += len(both)
    if trace is not None:
        trace.append((level, n, space.queued, space.filed))
    for q in (up.queue, up.done, down.queue, down.done):
        q.close()
    space.free(s, star, star_order, star_value, up.scan.last, down.scan.last)
    return order, value


def _upward(down: _Wide, low: int, high: int) -> np.ndarray:
    """S tuples of the symbols low .. high - 1 in upward order, with values to the forerunner in that order, as seeds."""
    ranges = range((down.symbols - high) // down.width, (down.symbols - 1 - low) // down.width + 1)
    rec = np.concatenate([down.done.read(k) for k in ranges])
    turned = rec[:, 0] >> 1
    rec = rec[(turned >= down.symbols - high) & (turned < down.symbols - low)][::-1]
    pos, lcp = _parts(rec)
    lcp[1:] = lcp[:-1].copy()
    return _pairs(down.turn(rec[:, 0] >> 1) * 2 + 1, pos, lcp)


def _cuts(t: np.ndarray, order: np.ndarray, wide: _Wide) -> np.ndarray:
    """Where the ranges of a sweep begin in sorted suffixes."""
    edge = np.arange(wide.ranges + 1) * wide.width
    out = np.zeros(wide.ranges + 1, np.int64)
    for z in _blocks(len(order)):
        out += np.searchsorted(t[order[z]], edge, "left")
    return out


def _star_order(t: np.ndarray, s: np.ndarray, star: np.ndarray, symbols: int, chars: np.ndarray | None, space: Space, cap: int, trace: list | None, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The S* suffixes in order, and values by the names they share."""
    names = space.array(len(star), np.int32)
    used = _names(_Substrings(t, s, star, symbols), space, names)
    begin = space.array(len(star) + 1, np.int64)
    for z in _blocks(len(star)):
        begin[z] = star[z] if chars is None else chars[star[z]]
    begin[len(star)] = begin[len(star) - 1]
    order, value = _sorted_names(names, begin, used, space, cap, trace, level + 1)
    for z in _blocks(len(order)):
        order[z] = star[order[z]]
    space.free(names, begin)
    return order, value


def common_prefix(data: np.ndarray, a: np.ndarray, b: np.ndarray, cap: int = CAP, known=0) -> np.ndarray:
    """Common prefix lengths of data[a:] and data[b:] up to cap, eight bytes at a time from what is known."""
    n = len(data)
    out = np.zeros(len(a), np.int64) + known
    live = np.flatnonzero(out < cap)
    while len(live):
        x, y = a[live] + out[live], b[live] + out[live]
        d = np.zeros(len(live), np.uint64)
        for k in range(8):
            inside = np.maximum(x, y) + k < n
            d |= np.where(inside, data[np.minimum(x + k, n - 1)] ^ data[np.minimum(y + k, n - 1)], 255).astype(np.uint64) << np.uint64(8 * k)
        low = d & (~d + np.uint64(1))
        same = np.where(d == 0, 8, (np.frexp(low.astype(np.float64))[1] - 1) >> 3)
        out[live] += same
        live = live[(same == 8) & (out[live] < cap)]
    return np.minimum(out, cap)


def _run(t: np.ndarray, pos: int, cap: int) -> int:
    """Length of the run of equal symbols from pos on."""
    part = t[pos : pos + cap + 1]
    other = np.flatnonzero(part != part[0])
    return min(int(other[0]) if len(other) else len(part), cap)


def sort_suffixes(data: np.ndarray, cap: int = CAP, limit: int = LIMIT, trace: list | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks (positions, common prefix with the forerunner, up to cap) of all suffixes of bytes, in order.

    trace, if given, gets (level, symbols, bytes of queued tuples in files so far, bytes of arrays in files so far).
    """
    n = len(data)
    if not n:
        return
    space = Space(limit // 2)
    t = space.array(n + 1, np.uint16)
    for z in _blocks(n):
        t[z] = data[z]
        t[z] += 1
    t[n] = 0
    symbols = 257
    s = types(t, space)
    star = _stars(s, space)
    order, value = _star_order(t, s, star, symbols, None, space, cap, trace, 0)
    space.free(star)
    for z in _blocks(len(order)):
        a, b = order[max(z.start - 1, 0) : z.stop - 1], order[max(z.start, 1) : z.stop]
        value[max(z.start, 1) : z.stop] = common_prefix(data, a, b, cap, value[max(z.start, 1) : z.stop])
    value[0] = 0
    first = np.zeros(symbols + 1, np.int64)
    for z in _blocks(len(order)):
        first += np.searchsorted(t[order[z]], np.arange(symbols + 1))

    large, small, done, kept = (BucketQueue(symbols, space) for _ in range(4))

    def sweep(scan: _Scan, queue: BucketQueue, pos: np.ndarray, lcp: np.ndarray) -> None:
        hit, sym = scan.pushes(pos)
        sym, before, value = scan(pos, lcp, hit, sym)
        for c, block in zip(*_groups(sym, _records(_TUPLE, pos=before, lcp=value)), strict=True):
            queue.push(c, block)

    try:
        scan = _Scan(t, lambda p: ~s[p], symbols, space, cap)
        for c in range(symbols):
            last = -1
            for block in large.pop(c):
                done.push(c, block)
                sweep(scan, large, block["pos"].astype(np.int64), block["lcp"])
                last = block["pos"][-1]
            for z in range(first[c], first[c + 1], BLOCK):
                part = slice(z, min(z + BLOCK, first[c + 1]))
                lcp = value[part].copy()
                if z == first[c]:
                    lcp[0] = min(_run(t, last, cap), _run(t, order[z], cap)) if last >= 0 else 0
                sweep(scan, large, order[part], lcp)
        scan = _Scan(t, lambda p: s[p], symbols, space, cap)
        for c in range(symbols - 1, -1, -1):
            last = -1
            for block in small.pop(c):
                kept.push(c, block)
                sweep(scan, small, block["pos"].astype(np.int64), block["lcp"])
                last = block["pos"][-1]
            block = done.read(c)
            if len(block):
                lcp = np.zeros(len(block), np.int16)
                lcp[1:] = block["lcp"][:0:-1]
                lcp[0] = min(_run(t, last, cap), _run(t, block["pos"][-1], cap)) if last >= 0 else 0
                sweep(scan, small, block["pos"][::-1].astype(np.int64), lcp)
        if trace is not None:
            trace.append((0, n, space.queued, space.filed))
        for c in range(1, symbols):
            low, high = done.read(c), kept.read(c)
            if len(low):
                yield low["pos"], low["lcp"]
            if len(high):
                pos, lcp = high["pos"][::-1], np.zeros(len(high), np.int16)
                lcp[1:] = high["lcp"][:0:-1]
                lcp[0] = min(_run(t, low["pos"][-1], cap), _run(t, pos[0], cap)) if len(low) else 0
                yield pos, lcp
    finally:
        for q in (large, small, done, kept):
            q.close()
