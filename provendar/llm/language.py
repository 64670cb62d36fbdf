"""Language identification of words in context: a linear-chain conditional random field.

A word is a maximal run of letters, lower-cased. Its emission score for a
language is a sum of learned weights of hashed features: prefixes and suffixes
(affixes), character n-grams inside the word, the word itself (the lexicon:
only words seen at least LEXICON_MIN times in training have a weight), and a
bias. Learned transition weights tie neighbouring words. A text is one chain,
however long: forward-backward gives each word its language probabilities, so
code-switched text is labelled word by word (`identify` with spans=True returns
the runs of words of one language). A document's language is the one with the
greatest mean probability over all its words; that mean is its score.

Long chains: a chain is cut into segments of SEGMENT words whose transfer
matrices are worked out side by side; multiplying them one after the other
gives the exact forward and backward vectors at all borders, from which the
segments are filled in, again side by side. A text of more than two blocks is
read in windows twice - once for the matrices, once for the words - so that
beyond the text itself memory holds one window and a matrix per segment.

Training maximises the conditional likelihood of the words' languages with
mini-batch gradient steps on a bounded sample (SAMPLE_PER_LANG texts of each
language by id hash, none over common.SAMPLE_TEXT_BYTES, and SAMPLE_LANG_BYTES
in all). A training text has one language; so that switches are learnt and not
assumed, the texts are cut into pieces of PIECE_WORDS words, which are shuffled
across languages and joined to the sequences of the training.

Defined cases: a text that is null or has no letter gets `und` with score 0;
without any training text every document gets `und`. A null language is not
learnt. Repeated ids are labelled row by row; an empty table gives an empty
result; extra columns are ignored. More than MAX_LANGS languages are an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C
from .toxicity import windows

BITS = 16
SEGMENT = 32
PREFIXES, SUFFIXES, GRAMS = (1, 2, 3), (1, 2, 3, 4), (2, 3)
LEXICON_MIN = 3
SAMPLE_PER_LANG, SAMPLE_LANG_BYTES, EPOCHS, BATCH_CHAINS, RATE = 150, 512 << 10, 3, 128, 0.03
#: Languages that a model can have: this bounds what is broadcast and what the driver fits on.
MAX_LANGS = 1000
#: Words of a training sequence, and least and most words of its one-language pieces.
SEQUENCE, PIECE_WORDS = 64, (4, 28)
#: Probabilities are summed as whole numbers of this fraction, so that sums don't depend on windows.
UNITS = 2.0**36
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For code points below 65536: lower case, letter or not, random number. Built from the rule of str.lower and str.isalpha."""
    low = np.arange(65536, dtype=np.uint32)
    letter = np.zeros(65536, bool)
    for k in range(65536):
        ch = chr(k)
        letter[k] = ch.isalpha()
        if len(ch.lower()) == 1:
            low[k] = min(ord(ch.lower()), 65535)
    return low, letter, C.mix(np.arange(1, 65537, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _letters(chars: np.ndarray) -> np.ndarray:
    out = _tables()[1][np.minimum(chars, 65535)]
    for k in np.flatnonzero(chars > 65535):
        out[k] = chr(chars[k]).isalpha() if chars[k] <= sys.maxunicode else False
    return out


def _index(h: np.ndarray, kind: int) -> np.ndarray:
    return (C.mix(h + np.uint64(kind * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(64 - BITS)).astype(np.int32)


@dataclass
class Words:
    """Features of the words of a block: per word (n x features, -1 where it has none) and per n-gram position."""

    fixed: np.ndarray
    gram: list[tuple[np.ndarray, np.ndarray]]  # (feature, word of it)
    first: np.ndarray  # per row: index of its first word (rows + 1)
    start: np.ndarray  # places of all words in the text, in characters of the block
    end: np.ndarray
    chars: np.ndarray  # per row: its first character (rows + 1)
    which: np.ndarray | None = None  # position in the text -> word form, where equal words share one form

    @property
    def n(self) -> int:
        return len(self.fixed)


def analyse(data: np.ndarray, off: np.ndarray, forms: bool = False) -> Words:
    """forms: work out the features of each different word of the block only once."""
    chars = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return analyse_chars(chars, lead[off], forms)


def gram_features(chars: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(feature, place) of all n-grams of a stretch of letters."""
    low, _, rnd = _tables()
    p = np.zeros(len(chars) + 1, np.uint64)
    up, down = C.powers(len(chars) + 1)
    np.cumsum(rnd[low[np.minimum(chars, 65535)]] * up[: len(chars)], out=p[1:])
    for kind, k in enumerate(GRAMS, 1 + len(PREFIXES) + len(SUFFIXES)):
        place = np.arange(max(len(chars) - k + 1, 0))
        yield _index((p[place + k] - p[place]) * down[place], kind), place


def analyse_chars(chars: np.ndarray, at: np.ndarray, forms: bool = False) -> Words:
    low, _, rnd = _tables()
    ink = _letters(chars)
    c = low[np.minimum(chars, 65535)]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(chars))]
    first[cut] = ink[cut]
    last[cut - 1] = ink[cut - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    fr = np.searchsorted(s, at)
    p = np.zeros(len(c) + 1, np.uint64)
    up, down = C.powers(len(c) + 1)
    np.cumsum(rnd[c] * up[: len(c)], out=p[1:])
    span = lambda a, b: (p[b] - p[a]) * down[a]
    whole, which, places = span(s, e), None, (s, e)
    if forms:
        _, one, which = np.unique(whole, return_index=True, return_inverse=True)
        s, e, whole = s[one], e[one], whole[one]
    size = e - s
    cols, kind = [_index(whole, 0)], 1
    for k in PREFIXES:
        cols.append(np.where(size >= k, _index(span(s, np.minimum(s + k, e)), kind), -1))
        kind += 1
    for k in SUFFIXES:
        cols.append(np.where(size >= k, _index(span(np.maximum(e - k, s), e), kind), -1))
        kind += 1
    gram = []
    for k in GRAMS:
        many = np.maximum(size - k + 1, 0)
        word = np.repeat(np.arange(len(s), dtype=np.int32), many)
        start = np.repeat(s - np.concatenate([[0], np.cumsum(many)[:-1]]) if len(s) else s, many) + np.arange(len(word))
        gram.append((_index(span(start, start + k), kind), word))
        kind += 1
    return Words(np.stack(cols, 1) if len(s) else np.zeros((0, len(cols)), np.int32), gram, fr, *places, at, which)


@dataclass
class Crf:
    langs: list[str]
    emit: np.ndarray  # (2**BITS + 1) x L, the last row stays 0
    bias: np.ndarray
    trans: np.ndarray  # L x L

    def emissions(self, w: Words) -> np.ndarray:
        out = np.tile(self.bias, (w.n, 1))
        for k in range(w.fixed.shape[1]):
            out += self.emit[w.fixed[:, k]]
        for idx, word in w.gram:
            if len(idx):
                many = np.bincount(word, minlength=w.n)
                has = many > 0
                start = np.concatenate([[0], np.cumsum(many)[:-1]])
                out[has] += np.add.reduceat(self.emit[idx], start[has])
        return out if w.which is None else out[w.which]

    def marginals(self, em: np.ndarray, chains: np.ndarray, counts: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Forward-backward over chains (start offsets, one more than chains), all chains at once, step by step.

        Returns the words' probabilities (n x L) and, if asked for, the expected transition counts (L x L).
        """
        n, L = em.shape
        if not n:
            return em, np.zeros((L, L))
        x = np.exp(np.clip(em - em.max(1, keepdims=True), -60, 0))
        t = np.exp(self.trans - self.trans.max())
        size = np.diff(chains)
        order = np.argsort(-size, kind="stable")
        start, size = chains[:-1][order], size[order]
        longest = int(size[0])
        fwd, bwd = np.empty_like(x), np.ones_like(x)
        live = np.searchsorted(-size, -np.arange(longest), "left")  # chains longer than step
        a = x[start]
        a = a / a.sum(1, keepdims=True)
        fwd[start] = a
        for k in range(1, longest):
            at = start[: live[k]] + k
            a = (a[: live[k]] @ t) * x[at]
            a /= a.sum(1, keepdims=True)
            fwd[at] = a
        expected = np.zeros((L, L))
        for k in range(longest - 1, 0, -1):
            at = start[: live[k]] + k
            b = bwd[at] * x[at]
            back = b @ t.T
            norm = back.sum(1, keepdims=True)
            bwd[at - 1] = back / norm
            if not counts:
                continue
            pair = fwd[at - 1][:, :, None] * t[None] * b[:, None, :]
            expected += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
        m = fwd * bwd
        return m / m.sum(1, keepdims=True), expected

    # ---- unbroken chains, segment by segment

    def _step(self, a: np.ndarray, t: np.ndarray) -> np.ndarray:
        """a @ t, added up in a fixed order (a row's result does not depend on the others)."""
        out = a[..., :1] * t[0]
        for k in range(1, len(t)):
            out += a[..., k : k + 1] * t[k]
        return out

    def _weights(self, em: np.ndarray) -> np.ndarray:
        return np.exp(np.clip(em - em.max(1, keepdims=True), -60, 0)) if len(em) else em

    def transfers(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, head: np.ndarray) -> np.ndarray:
        """Per segment the matrix that takes the forward vector before it to that at its end. head: the segment begins a chain (nothing leads to its first word)."""
        t, L = np.exp(self.trans - self.trans.max()), x.shape[1]
        out = np.where(head[:, None, None], np.eye(L), t) * x[start][:, None, :]
        for k in range(1, int(size.max(initial=0))):
            on = np.flatnonzero(size > k)
            step = self._step(out[on], t) * x[start[on] + k][:, None, :]
            out[on] = step / step.max((1, 2), keepdims=True)
        return out

    def borders(self, moves: np.ndarray, chains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward vectors before and backward vectors after each segment. chains: first segment of each chain, one more than chains."""
        L = self.trans.shape[0]
        ahead, back = np.ones((len(moves), L)), np.ones((len(moves), L))
        many = np.diff(chains)
        for k in range(1, int(many.max(initial=0))):
            at = chains[:-1][many > k] + k
            v = (ahead[at - 1][:, :, None] * moves[at - 1]).sum(1)
            ahead[at] = v / v.sum(1, keepdims=True)
            at = chains[1:][many > k] - k
            v = (moves[at] * back[at][:, None, :]).sum(2)
            back[at - 1] = v / v.sum(1, keepdims=True)
        return ahead, back

    def inside(self, x: np.ndarray, start: np.ndarray, size: np.ndarray, head: np.ndarray, ahead: np.ndarray, back: np.ndarray) -> np.ndarray:
        """The words' probabilities, from the vectors at their segments' borders."""
        t = np.exp(self.trans - self.trans.max())
        fwd, bwd = np.empty_like(x), np.empty_like(x)
        longest = int(size.max(initial=0))
        a = np.where(head[:, None], 1.0, self._step(ahead, t)) * x[start]
        fwd[start] = a / a.sum(1, keepdims=True)
        for k in range(1, longest):
            at = start[size > k] + k
            a = self._step(fwd[at - 1], t) * x[at]
            fwd[at] = a / a.sum(1, keepdims=True)
        bwd[start + size - 1] = back
        turned = np.ascontiguousarray(t.T)
        for k in range(longest - 1, 0, -1):
            at = start[size > k] + k
            b = self._step(bwd[at] * x[at], turned)
            bwd[at - 1] = b / b.sum(1, keepdims=True)
        m = fwd * bwd
        return m / m.sum(1, keepdims=True)

    def smooth(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probabilities of the words of whole rows (first: each row's first word, rows + 1)."""
        many = -(-np.diff(first) // SEGMENT)
        chains = np.concatenate([[0], np.cumsum(many)])
        row = np.repeat(np.arange(len(many)), many)
        nth = np.arange(chains[-1]) - chains[:-1][row]
        start = first[:-1][row] + nth * SEGMENT
        size = np.minimum(first[1:][row] - start, SEGMENT)
        head = nth == 0
        moves = self.transfers(x, start, size, head) if (many > 1).any() else np.zeros((len(start), x.shape[1], x.shape[1]))
        return self.inside(x, start, size, head, *self.borders(moves, chains))

    def _windowed(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(weights, places, ends) of the words of one long text, in lots of whole segments (but for the last lot)."""
        held = [np.zeros((0, len(self.langs))), np.zeros(0, np.int64), np.zeros(0, np.int64)]
        for em, start, end in self._pieces(data):
            held = [np.concatenate(p) for p in zip(held, (self._weights(em), start, end), strict=True)]
            cut = len(held[0]) // SEGMENT * SEGMENT
            if cut:
                yield tuple(h[:cut] for h in held)
                held = [h[cut:] for h in held]
        if len(held[0]):
            yield tuple(held)

    def _pieces(self, data: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(emissions, places, ends) of the words of one text, window by window; no window ends inside a word."""
        done = 0  # characters
        held: list[np.ndarray] = []  # windows of a word that is longer than a window
        for part, own in windows(data, C.BLOCK_BYTES, 0):
            part = part[:own]
            chars = np.frombuffer(part.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
            gap = np.flatnonzero(~_letters(chars))
            if not len(gap):
                held.append(chars)
                continue
            lead, cut = np.concatenate([*held, chars[: gap[0]]]), int(gap[-1]) + 1
            if len(lead):
                yield self.giant(lead)[None], np.array([done]), np.array([done + len(lead)])
            done += len(lead)
            body = chars[gap[0] : cut].tobytes().decode("utf-32-le").encode()
            w = analyse(np.frombuffer(body, np.uint8), np.array([0, len(body)]), forms=True)
            yield self.emissions(w), w.start + done, w.end + done
            done += cut - int(gap[0])
            held = [chars[cut:]] if cut < len(chars) else []
        if held:
            lead = np.concatenate(held)
            yield self.giant(lead)[None], np.array([done]), np.array([done + len(lead)])

    def giant(self, chars: np.ndarray) -> np.ndarray:
        """Emissions of one word of any length: of a long one, the n-grams window by window."""
        whole = lambda c: analyse_chars(c, np.array([0, len(c)]))
        if len(chars) <= C.BLOCK_BYTES:
            return self.emissions(whole(chars))[0]
        low, _, rnd = _tables()
        out, total, power = self.bias.copy(), 0, 1
        ahead = max(GRAMS) - 1
        for at in range(0, len(chars), C.BLOCK_BYTES):
            part = chars[at : at + C.BLOCK_BYTES + ahead]
            own = min(C.BLOCK_BYTES, len(chars) - at)
            for idx, place in gram_features(part):
                out += self.emit[idx[place < own]].sum(0)
            up = C.powers(own)[0][:own]
            total += power * int((rnd[low[np.minimum(part[:own], 65535)]] * up).sum(dtype=np.uint64))
            power = power * pow(C._R, own, 1 << 64) % (1 << 64)
        out += self.emit[_index(np.array([total % (1 << 64)], np.uint64), 0)[0]]
        # affixes: those of the first and of the last letters (the middle of these words is left out)
        ends = whole(np.concatenate([chars[:8], chars[-8:]]))
        return out + self.emit[ends.fixed[0, 1:]].sum(0)

    def label(self, data: np.ndarray, off: np.ndarray, spans: bool = False):
        """Per row: index of the language (-1: no letter) and its mean word probability; with spans also (first run of each row, rows + 1; runs' starts, ends and languages)."""
        if len(off) == 2 and len(data) > 2 * C.BLOCK_BYTES:
            return self._label_long(data, spans)
        w = analyse(data, off, forms=True)
        m = self.smooth(self._weights(self.emissions(w)), w.first)
        count = np.diff(w.first)
        total = np.zeros((len(count), len(self.langs)))
        has = count > 0
        if has.any():
            total[has] = np.add.reduceat(np.rint(m * UNITS).astype(np.int64), w.first[:-1][has])
        out = self._best(total, count)
        if not spans:
            return out
        row = np.repeat(np.arange(len(count)), count)
        s, e, best, edge = _runs(row, w.start - w.chars[row], w.end - w.chars[row], m.argmax(1))
        return *out, np.searchsorted(row[edge], np.arange(len(count) + 1)), s, e, best

    def _best(self, total: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mean = total / UNITS / np.maximum(count, 1)[:, None]
        return np.where(count > 0, mean.argmax(1), -1), np.where(count > 0, np.minimum(mean.max(1), 1.0), 0.0)

    def _label_long(self, data: np.ndarray, spans: bool):
        lots, n = [], 0

        def cut(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            start = np.arange(0, len(x), SEGMENT)
            return start, np.minimum(len(x) - start, SEGMENT), (start + n) == 0

        for x, _, _ in self._windowed(data):
            lots.append(self.transfers(x, *cut(x)))
            n += len(x)
        total, count, at, runs = np.zeros(len(self.langs), np.int64), n, 0, []
        if n:
            moves = np.concatenate(lots)
            ahead, back = self.borders(moves, np.array([0, len(moves)]))
            n = 0
            for x, s, e in self._windowed(data):
                part = cut(x)
                z = slice(at, at + len(part[0]))
                m = self.inside(x, *part, ahead[z], back[z])
                total += np.rint(m * UNITS).astype(np.int64).sum(0)
                if spans:
                    runs.append(_runs(np.zeros(len(x), np.int64), s, e, m.argmax(1))[:3])
                at, n = z.stop, n + len(x)
        out = self._best(total[None].astype(np.float64), np.array([count]))
        if not spans:
            return out
        s, e, best = (np.concatenate([r[k] for r in runs]) if runs else np.zeros(0, np.int64) for k in range(3))
        s, e, best, _ = _runs(np.zeros(len(s), np.int64), s, e, best)
        return *out, np.array([0, len(s)]), s, e, best


def _runs(row: np.ndarray, start: np.ndarray, end: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, ...]:
    """(starts, ends, languages, first words) of the runs of words of one row and language."""
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (best[1:] != best[:-1])
    f = np.flatnonzero(new)
    return start[f], end[np.append(f[1:], len(row)) - 1] if len(f) else end[:0], best[f], f


def chain_starts(first: np.ndarray) -> np.ndarray:
    """One chain for each row that has words."""
    return np.append(first[:-1][np.diff(first) > 0], first[-1])


def fit(texts: list[str], langs: list[str], seed: int = 3) -> Crf | None:
    names = sorted(set(langs))
    if not names:
        return None
    L, rng = len(names), np.random.default_rng(seed)
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    w = analyse(np.frombuffer(b"".join(raw), np.uint8), off)
    y = np.repeat([names.index(x) for x in langs], np.diff(w.first))
    # the lexicon: words seen less often have no weight of their own
    seen = np.bincount(w.fixed[:, 0], minlength=1 << BITS) if w.n else np.zeros(1 << BITS, int)
    rare = np.flatnonzero(seen < LEXICON_MIN)
    model = Crf(names, np.zeros(((1 << BITS) + 1, L)), np.zeros(L), np.zeros((L, L)))
    if not w.n or L == 1:
        return model
    chains, order_of = sequences(w.first, rng)
    drop = np.isin(w.fixed[:, 0], rare)
    fixed = w.fixed.copy()
    fixed[drop, 0] = -1
    flat = [(fixed[:, k], np.arange(w.n)) for k in range(fixed.shape[1])] + w.gram
    row = np.concatenate([b[a >= 0] for a, b in flat])
    col = np.concatenate([a[a >= 0] for a, _ in flat])
    order = np.argsort(row, kind="stable")
    row, col = row[order], col[order]
    edge = np.searchsorted(row, np.arange(w.n + 1))
    square, t_square = np.full(model.emit.shape, 1e-8), np.full((L, L), 1e-8)
    for _ in range(EPOCHS):
        picked = rng.permutation(len(chains) - 1)
        for i in range(0, len(picked), BATCH_CHAINS):
            some = np.sort(picked[i : i + BATCH_CHAINS])
            size = chains[some + 1] - chains[some]
            words_at = order_of[np.repeat(chains[some] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
            start = np.concatenate([[0], np.cumsum(size)])
            many = edge[words_at + 1] - edge[words_at]
            f = col[np.repeat(edge[words_at] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
            em = model.bias + np.add.reduceat(model.emit[f], np.concatenate([[0], np.cumsum(many)[:-1]]))
            m, expected = model.marginals(em, start, True)
            gold = np.zeros_like(m)
            gold[np.arange(len(m)), y[words_at]] = 1
            d = (gold - m) / len(m)
            same = np.ones(len(m), bool)
            same[start[:-1]] = False
            here = np.flatnonzero(same)
            real = np.bincount(y[words_at[here - 1]] * L + y[words_at[here]], minlength=L * L).reshape(L, L)
            each = np.repeat(d, many, axis=0)
            for k in range(L):
                g = np.bincount(f, each[:, k], 1 << BITS) - 1e-6 * model.emit[:-1, k]
                square[:-1, k] += g * g
                model.emit[:-1, k] += RATE * g / np.sqrt(square[:-1, k])
            g = (real - expected) / len(m)
            t_square += g * g
            model.trans += RATE * g / np.sqrt(t_square)
            model.bias += RATE * d.sum(0)
    return model


def sequences(first: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Training sequences that switch: (their borders, the words in their order). Texts are cut into pieces, and the pieces of all texts shuffled."""
    pieces = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        while a < b:
            n = int(rng.integers(PIECE_WORDS[0], PIECE_WORDS[1] + 1))
            pieces.append(np.arange(a, min(a + n, b)))
            a += n
    order = np.concatenate([pieces[k] for k in rng.permutation(len(pieces))])
    return np.append(np.arange(0, len(order), SEQUENCE), len(order)), order


def train(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG, seed: int = 23) -> Crf | None:
    """Fits on at most per_lang texts of each language, chosen by id hash among rows that are not held out."""
    fits = F.octet_length("text").between(1, C.SAMPLE_TEXT_BYTES)
    ok = docs.select("doc_id", "lang", F.xxhash64(F.lit(seed), "doc_id").alias("_h")).where(C.trainable() & F.col("lang").isNotNull())
    # ids are thinned by a threshold on the hash before they are ranked, so no task sees a whole language; twice as many as
    # wanted are fetched, as some of their texts may be empty or too long
    counts = ok.groupBy("lang").agg(F.count("*").alias("_n"))
    share = F.least(F.lit(1.0), 6.0 * per_lang / F.col("_n"))
    if counts.limit(MAX_LANGS + 1).count() > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    some = ok.join(F.broadcast(counts), "lang").where(F.pmod("_h", F.lit(1 << 30)) < share * (1 << 30))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("_h", "doc_id"))
    some = some.withColumn("_r", rank).where(F.col("_r") <= 2 * per_lang).select("doc_id", "lang", "_h").distinct()
    got = docs.select("doc_id", "text", "lang").where(fits).join(F.broadcast(some), ["doc_id", "lang"]).groupBy("doc_id", "lang").agg(F.min("text").alias("text"), F.first("_h").alias("_h"))
    rows = got.toPandas().sort_values(["lang", "_h", "doc_id"])
    if rows.empty:
        return None
    rows = rows[rows.groupby("lang").cumcount() < per_lang]
    size = rows["text"].str.encode("utf-8").str.len()
    rows = rows[size.groupby(rows["lang"]).cumsum() <= SAMPLE_LANG_BYTES]
    return fit(list(rows["text"]), list(rows["lang"]))


def identify(docs: DataFrame, model: Crf | None, key: str = "doc_id", text: str = "text", spans: bool = False) -> DataFrame:
    """(key, lang_pred, score[, spans]) for every row; spans: the runs of words of one language as (start, end, lang), in characters of the text."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*(model.langs if model else []), UNKNOWN], object)
        for b in batches:
            for i, j, data, off in C.text_blocks(b, "_t"):
                none = (np.full(j - i, -1), np.zeros(j - i), np.zeros(j - i + 1, np.int64), *[np.zeros(0, np.int64)] * 3)
                best, score, *runs = model.label(data, off, spans) if model else none
                cols = [b.column(0)[i:j], pa.array(list(names[best]), pa.string()), pa.array(score)]
                if spans:
                    at, s, e, lang = runs
                    items = pa.StructArray.from_arrays([pa.array(s, pa.int64()), pa.array(e, pa.int64()), pa.array(list(names[lang]), pa.string())], ["start", "end", "lang"])
                    cols.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), items))
                yield pa.RecordBatch.from_arrays(cols, ["_k", "lang_pred", "score", "spans"][: len(cols)])

    schema = f"_k {kind}, lang_pred string, score double" + (", spans array<struct<start:bigint,end:bigint,lang:string>>" if spans else "")
    return C.arrow(docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")), run, schema).withColumnRenamed("_k", key)
