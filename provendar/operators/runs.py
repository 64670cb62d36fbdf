"""Runs of postings: what a search index holds of a stretch of labels, a row per gram or word and locale. Arrow batches, arrays only.

Postings are many times as many as runs, so that it is runs that are sorted and moved.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import fixed as K
from ..functions.text import fold_table

#: A stretch has at most so many labels and, unless a single one is longer, so many characters.
LABELS, CHARS = 4096, 1 << 22
#: Largest tables of flags: what is denser is told apart by flags, else by sorting.
FLAGS, CUBE = 1 << 26, 1 << 22
#: Runs are unpacked by so many postings, or one by one.
POSTINGS = 1 << 18
GRAM, WORD, TOTAL = 0, 1, 2
_ALL, _END, _GONE = 0x110000, 10, 0xFFFFFFFF


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def text_of(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def word_table(separators: bytes) -> np.ndarray:
    """What each character is in a word: itself folded, a space where it separates, or nothing."""
    single, to, gone = fold_table()
    out = np.arange(_ALL, dtype=np.uint32)
    out[code_points(single)] = code_points(to)
    out[np.unpackbits(np.frombuffer(separators, np.uint8), count=_ALL).astype(bool)[out]] = 32
    out[code_points(gone)] = _GONE
    return out


def _pairs(term: np.ndarray, who: np.ndarray, terms: int, n: int) -> np.ndarray:
    """Different (term, who) as term * n + who, ascending."""
    key = term.astype(np.int64) * n + who
    if terms * n > FLAGS:
        return np.unique(key)
    seen = np.zeros(terms * n, bool)
    seen[key] = True
    return np.flatnonzero(seen)


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins, and the end."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(new), len(new)).astype(np.int64)


def grams_of(texts: list[str], owner: np.ndarray, n: int) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The three-character strings of texts, each one's owner below n: (different grams, and as pairs without repeats gram's place, owner)."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    texts, owner, size = [t for t in texts if len(t) > 2], owner[size > 2], size[size > 2]
    if not texts:
        return [], np.empty(0, np.int64), np.empty(0, np.int64)
    codes = code_points("".join(texts))
    end = np.cumsum(size)
    begins = np.ones(len(codes), bool)
    begins[end - 1] = begins[end - 2] = False
    at, who = np.flatnonzero(begins), np.repeat(owner, size - 2)
    seen = np.zeros(_ALL, bool)
    seen[codes] = True
    letters, place = np.flatnonzero(seen), np.zeros(_ALL, np.int32)
    a = len(letters)
    place[letters] = np.arange(a)
    c = place[codes].astype(np.int64)
    c = (c[at] * a + c[at + 1]) * a + c[at + 2]
    if a**3 <= CUBE:
        seen, dense = np.zeros(a**3, bool), np.zeros(a**3, np.int32)
        seen[c] = True
        cubes = np.flatnonzero(seen)
        dense[cubes] = np.arange(len(cubes))
        c = dense[c]
    else:
        cubes, c = np.unique(c, return_inverse=True)
    key = _pairs(c, who, len(cubes), n)
    said = text_of(letters[np.stack([cubes // (a * a), cubes // a % a, cubes % a], axis=1)])
    return [said[k : k + 3] for k in range(0, len(said), 3)], key // n, key % n


def words_in(texts: list[str], table: np.ndarray) -> list[list[str]]:
    """The words of each text, folded, as functions.scalar.words_of has them."""
    joined = []
    for t in texts:
        for a, b in K.LIGATURES.items():
            t = t.replace(a, b) if a in t else t
        joined.append(t)
    codes = table[code_points("".join(t + "\n" for t in joined))]
    codes[np.cumsum([len(t) + 1 for t in joined]) - 1] = _END
    return [t.split() for t in text_of(codes[codes != _GONE]).split("\n")[:-1]]


SCHEMA = pa.schema([("kind", pa.int32()), ("term", pa.string()), ("locale", pa.string()), ("first", pa.int64()), ("n", pa.int64()), ("total", pa.int64()), ("wide", pa.int32()), ("packed", pa.binary())])


def _rows(kind: int, term: pa.Array, locale: pa.Array, **rest: pa.Array) -> pa.RecordBatch:
    n = len(locale)
    known = {"kind": pa.array(np.full(n, kind, np.int32)), "term": term, "locale": locale} | rest
    return pa.RecordBatch.from_arrays([known.get(f.name, pa.nulls(n, f.type)).cast(f.type) for f in SCHEMA], schema=SCHEMA)


def _packed(at: np.ndarray, ids: np.ndarray, *more: np.ndarray) -> dict[str, pa.Array]:
    """Columns of runs that begin at at: the first id, how many, and each one's steps from id to id (and what else it has) in as few bytes as all take."""
    step = np.zeros(len(ids), np.uint64)
    step[1:] = ids[1:].view(np.uint64) - ids[:-1].view(np.uint64)  # modulo 2^64, as when they are added up again
    step[at[:-1]] = 0
    rows = np.stack([step, *(x.astype(np.uint64) for x in more)], axis=1)
    wide = next(w for w in (1, 2, 4, 8) if w == 8 or int(rows.max()) < 1 << 8 * w)
    data, off = rows.astype(f"<u{wide}").tobytes(), at * (wide * rows.shape[1])
    packed = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(off.astype(np.int32).tobytes()), pa.py_buffer(data)])
    return {"first": pa.array(ids[at[:-1]]), "n": pa.array(np.diff(at)), "wide": pa.array(np.full(len(at) - 1, wide, np.int32)), "packed": packed}


def _unpacked(wide: np.ndarray, n: np.ndarray, first: np.ndarray, packed: pa.Array, columns: int) -> np.ndarray:
    """A row per posting: the id and what else it has."""
    end = np.cumsum(n)
    out = np.empty((int(end[-1]), columns), np.uint64)
    for w in np.unique(wide).tolist():
        here = np.flatnonzero(wide == w)
        own = n[here]
        off = np.frombuffer(b"".join(packed.take(pa.array(here)).to_pylist()), f"<u{w}").reshape(-1, columns)
        out[np.repeat(end[here] - np.cumsum(own), own) + np.arange(len(off))] = off
    total, begin = np.cumsum(out[:, 0]), end - n
    out[:, 0] = total + np.repeat(first.view(np.uint64) - total[begin], n)
    return out


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (term, locale, first, n, wide, packed) of gram runs to (term, locale, ids)."""
    for b, n, rows in _parts(batches, 1):
        ids = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)).astype(np.int32)), pa.array(rows[:, 0]))
        yield pa.RecordBatch.from_arrays([b["term"], b["locale"], ids], names=["term", "locale", "ids"])


def unpack_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same of word runs, which are short, to a row per posting: (term, locale, id, tf, len)."""
    for b, n, rows in _parts(batches, 3):
        run = pa.array(np.repeat(np.arange(len(n)), n))
        yield pa.RecordBatch.from_arrays([b["term"].take(run), b["locale"].take(run), *(pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3))], names=["term", "locale", "id", "tf", "len"])


def _parts(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with their runs' sizes and unpacked postings."""
    for b in batches:
        wide, n, first = (b[k].to_numpy() for k in ("wide", "n", "first"))
        start = 0
        while start < b.num_rows:
            size = max(1, int(np.searchsorted(np.cumsum(n[start:]), POSTINGS, "right")))
            part = slice(start, start + size)
            here = b.slice(start, size)
            yield here, n[part], _unpacked(wide[part], n[part], first[part], here["packed"], columns).view(np.int64)
            start += size


def stretch(b: pa.RecordBatch, table: np.ndarray, with_grams: bool) -> Iterator[pa.RecordBatch]:
    """The runs of a few labels, each kind in one batch."""
    b = b.take(pc.sort_indices(b, sort_keys=[("locale", "ascending"), ("label_id", "ascending")]))  # the labels of a locale lie side by side
    places = b["locale"].dictionary_encode(null_encoding="encode")
    locale, names, ids, n = places.indices.to_numpy(), places.dictionary, b["label_id"].to_numpy(), b.num_rows
    lower, norm, has = (b[k].to_pylist() for k in ("lower", "norm", "any"))

    both = [(t, k) for k in range(n) if with_grams and has[k] and norm[k] is not None for t in (norm[k], lower[k]) if t is not None]
    grams, g, who = grams_of([t for t, _ in both], np.array([k for _, k in both], np.int64), n)
    if len(g):
        at = _starts(g, locale[who])
        yield _rows(GRAM, pa.array(grams).take(pa.array(g[at[:-1]])), names.take(pa.array(locale[who[at[:-1]]])), **_packed(at, ids[who]))

    words = words_in([t or "" for t in norm], table)
    size = np.fromiter(map(len, words), np.int64, n)
    if size.any():
        coded = pa.array(list(chain.from_iterable(words)), pa.string()).dictionary_encode()
        key, tf = np.unique(coded.indices.to_numpy().astype(np.int64) * n + np.repeat(np.arange(n), size), return_counts=True)
        w, who = key // n, key % n
        at = _starts(w, locale[who])
        yield _rows(WORD, coded.dictionary.take(pa.array(w[at[:-1]])), names.take(pa.array(locale[who[at[:-1]]])), **_packed(at, ids[who], tf, size[who]))
        at = _starts(locale)[:-1]
        yield _rows(TOTAL, pa.nulls(len(at), pa.string()), names.take(pa.array(locale[at])), n=pa.array(np.add.reduceat((size > 0).astype(np.int64), at)), total=pa.array(np.add.reduceat(size, at)))


class Runs:
    """Batches of (label_id, locale, lower, norm, any) to batches of runs (see search.RUNS)."""

    def __init__(self, separators: bytes, grams: bool = True):
        self.separators, self.grams = separators, grams

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = word_table(self.separators)
        for b in batches:
            size = sum(pc.fill_null(pc.utf8_length(b[k]), 0).to_numpy().astype(np.int64) for k in ("lower", "norm"))
            start = 0
            while start < b.num_rows:
                n = max(1, int(np.searchsorted(np.cumsum(size[start : start + LABELS]), CHARS, "right")))
                yield from stretch(b.slice(start, n), table, self.grams)
                start += n
