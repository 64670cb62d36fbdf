"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

Words are runs of letters and digits, lower-cased (ASCII and Latin-1), as
64-bit hashes. An item is found in a document where their best local alignment
(match +2, mismatch -1, gap -1) reaches `threshold` of a perfect copy's score,
and the score of LEAST_WORDS matches (of all words, if the item has fewer).

Seeds lose no such alignment. With n words, a needed score S, m matches and e
edits, 2m - e >= S; the matches lie in at most e + 1 unbroken runs. So at least
ceil((S - e) / 2) - 1 word pairs are intact, and at least ceil((S + e) / 2)
words match. For any E, then, either e <= E and one of the rarest n - b pairs is
intact, where b = ceil((S - E) / 2) - 1; or e > E and one of the rarest
n - ceil((S + E + 1) / 2) + 1 words matches. Document counts of all words and
pairs of the items are taken over the whole corpus, and for each item the E
with the fewest expected hits is chosen. No n-gram is left out for being common
unless the bound allows it.

Each hit marks the stretch where the item could lie (its length, and as many
inserted words on both sides as the score allows); overlapping stretches of an
item are joined. An item is aligned there unless even all its words that occur
in the stretch could not reach the score - an exact bound.

The corpus is never shuffled: items travel to the tasks in blocks of at most
BLOCK_BYTES of item text, one pass over the corpus for the counts and one for
the alignments per block. The driver holds one block: its words, its n-grams
and their counts, some 100 bytes a word.

Defined cases: null and empty texts on either side, and texts without words,
match nothing; repeated documents are reported row by row; of items with one id
(null is one) the best is reported; a null document id is handled like any
other; empty tables give an empty result; extra columns are ignored. A long
text is hashed in windows; beyond it, memory holds eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from . import common as C

MATCH, MISMATCH, GAP = 2, -1, -1
THRESHOLD, LEAST_WORDS = 0.5, 5
#: Item text that travels to the tasks at once; more items take further passes.
BLOCK_BYTES = 16 << 20
#: Words of a long text that are looked up at once.
LOOKED_UP = 1 << 16
_U = np.uint64
_COEF = C.mix(np.arange(7, 9, dtype=_U)) | _U(1)


def _fold(data: np.ndarray) -> np.ndarray:
    low = C.LOWER[data]
    # capital letters of the Latin-1 block: C3 80-9E without C3 97 become C3 A0-BE
    after = np.flatnonzero(low[:-1] == 0xC3) + 1
    after = after[(low[after] >= 0x80) & (low[after] <= 0x9E) & (low[after] != 0x97)]
    low[after] += 0x20
    return low


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and each row's first word (rows + 1)."""
    return C.hash_words(data, off, _fold, C.NOT_ALNUM)


def gram_hashes(w: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams (n: 1 or 2) that stay in their row, and the word each starts at."""
    if n == 1:
        return C.mix(w * _COEF[0] + _U(1)), np.arange(len(w))
    inside = np.ones(max(len(w) - 1, 0), bool)
    inside[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < len(w))] - 1] = False
    at = np.flatnonzero(inside)
    return C.mix(w[at] * _COEF[0] + w[at + 1] * _COEF[1] + _U(2)), at


def needed(n: int, threshold: float) -> int:
    """The score that an item of n words must reach."""
    return max(int(np.ceil(threshold * MATCH * n - 1e-9)), MATCH * min(n, LEAST_WORDS))


def seeds(n: int, score: int, words: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of an item's seeds among its words and among its pairs; words, pairs: their document counts."""
    by_word, by_pair = np.argsort(words, kind="stable"), np.argsort(pairs, kind="stable")
    cost_w, cost_p = (np.concatenate([[0], np.cumsum(x[o])]) for x, o in ((words, by_word), (pairs, by_pair)))
    best = None
    for most in range(-1, min(MATCH * n - score, score - 3) + 1):
        # up to `most` edits: a pair is intact; beyond: a word matches
        of_pairs = 0 if most < 0 else n - (-(-(score - most) // 2) - 1)
        of_words = 0 if most >= MATCH * n - score else n - -(-(score + most + 1) // 2) + 1
        cost = cost_p[of_pairs] + cost_w[of_words]
        if best is None or cost < best[0]:
            best = cost, of_words, of_pairs
    return by_word[: best[1]], by_pair[: best[2]]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score of two word sequences and the position in text where it ends (first of equals)."""
    steps = np.arange(1, len(text) + 1) * -GAP
    above, best, end = np.zeros(len(text) + 1, np.int64), 0, 0
    for x in item:
        row = np.maximum(above[:-1] + np.where(text == x, MATCH, MISMATCH), above[1:] + GAP)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + steps) - steps  # gaps in the item
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k + 1
        above = np.concatenate([[0], row])
    return best, end


class Items:
    """A block of test items: their words, the n-grams of which documents are counted, and - once counted - their seeds."""

    def __init__(self, ids: list, texts: list[str], threshold: float = THRESHOLD):
        raw = [(t or "").encode() for t in texts]
        off = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        self.words, self.first = word_hashes(np.frombuffer(b"".join(raw), np.uint8), off)
        self.ids, self.size = ids, np.diff(self.first)
        self.score = np.array([needed(int(n), threshold) for n in self.size], np.int64)
        seen: dict = {}
        self.name = np.array([seen.setdefault(i, k) for k, i in enumerate(ids)], np.int64)  # the first item of the same id
        self.keys = [np.unique(gram_hashes(self.words, self.first, n)[0]) for n in (1, 2)]

    def choose(self, counts: list[np.ndarray]) -> None:
        """Takes the document counts of the keys, in their order, and leaves the seeds as (hash, item, place), by hash."""
        chosen: list[list] = [[], []]
        (words, _), (pairs, at) = (gram_hashes(self.words, self.first, n) for n in (1, 2))
        df = [counts[k][np.searchsorted(self.keys[k], h)] for k, h in enumerate((words, pairs))]
        first_pair = np.searchsorted(at, self.first)
        for i in np.flatnonzero(self.size):
            a, b, p, q = self.first[i], self.first[i + 1], first_pair[i], first_pair[i + 1]
            for k, (own, start) in enumerate(zip(seeds(int(self.size[i]), int(self.score[i]), df[0][a:b], df[1][p:q]), (a, p), strict=True)):
                chosen[k].append((own + start, np.full(len(own), i), own))
        self.seeds = []
        for got, h in zip(chosen, (words, pairs), strict=True):
            which, item, place = (np.concatenate([g[k] for g in got]) if got else np.zeros(0, np.int64) for k in range(3))
            order = np.argsort(h[which], kind="stable")
            self.seeds.append((h[which][order], item[order].astype(np.int32), place[order].astype(np.int32)))
        self.keys = [np.unique(h) for h, _, _ in self.seeds]

    def hits(self, w: np.ndarray, first: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place among the keys, word position) of the n-grams of the texts that are among the keys, some words at a time."""
        keys = self.keys[n - 1]
        for at in range(0, len(w) if len(keys) else 0, LOOKED_UP):
            part = w[at : at + LOOKED_UP + n - 1]
            h, pos = gram_hashes(part, np.clip(first - at, 0, len(part)), n)
            k = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            ok = np.flatnonzero((keys[k] == h) & (pos < LOOKED_UP))
            yield k[ok], pos[ok] + at

    def stretches(self, w: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, item, from word, to word) where an item could lie: one for each joined run of hits."""
        row, item, a, b = ([np.zeros(0, np.int64)] for _ in range(4))
        for n in (1, 2):
            h, of, place = self.seeds[n - 1]
            for k, at in self.hits(w, first, n):
                key = self.keys[n - 1][k]
                lo, hi = np.searchsorted(h, key, "left"), np.searchsorted(h, key, "right")
                many = hi - lo
                which = np.repeat(lo - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())
                at = np.repeat(at, many)
                r, i = np.searchsorted(first, at, "right") - 1, of[which].astype(np.int64)
                slack = MATCH * self.size[i] - self.score[i]  # the most words that can be inserted
                row.append(r)
                item.append(i)
                a.append(np.maximum(at - place[which] - slack, first[r]))
                b.append(np.minimum(at - place[which] + self.size[i] + slack, first[r + 1]))
        row, item, a, b = (np.concatenate(x) for x in (row, item, a, b))
        order = np.lexsort((a, item, row))
        row, item, a, b = row[order], item[order], a[order], b[order]
        if not len(row):
            return row, item, a, b
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        shift = np.cumsum(new) * (len(w) + 1)
        reach = np.maximum.accumulate(b + shift)
        new[1:] |= a[1:] + shift[1:] > reach[:-1]
        f = np.flatnonzero(new)
        return row[f], item[f], a[f], (reach - shift)[np.append(f[1:], len(row)) - 1]

    def possible(self, w: np.ndarray, item: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Stretches that hold enough of their item's words for the score."""
        order = np.argsort(w, kind="stable")
        uniq, rank = np.unique(w, return_inverse=True)
        places = rank[order] * (len(w) + 1) + order  # by word, then by place
        out = []
        for k in range(0, len(item), 1 << 12):
            z = slice(k, k + (1 << 12))
            many = self.size[item[z]]
            who = np.repeat(np.arange(len(many)), many)
            own = self.words[np.repeat(self.first[item[z]] - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum())]
            r = np.minimum(np.searchsorted(uniq, own), len(uniq) - 1)
            from_, to = r * (len(w) + 1) + a[z][who], r * (len(w) + 1) + b[z][who]
            j = np.minimum(np.searchsorted(places, from_), len(places) - 1)
            there = (uniq[r] == own) & (places[j] >= from_) & (places[j] < to)
            out.append(MATCH * np.bincount(who, there, len(many)) >= self.score[item[z]])
        return np.concatenate(out)

    def matches(self, w: np.ndarray, first: np.ndarray) -> list[tuple[int, int, float, int]]:
        """(row, item, score, end word in the row) of each item found in each row."""
        row, item, a, b = self.stretches(w, first)
        if not len(row):
            return []
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        for k in np.flatnonzero(self.possible(w, item, a, b)).tolist():
            r, i, s, e = int(row[k]), int(item[k]), int(a[k]), int(b[k])
            words = self.words[self.first[i] : self.first[i + 1]]
            score, end = align(words, w[s:e])
            if score >= self.score[i]:
                got = (score / (MATCH * len(words)), -int(s + end - first[r]), -i)
                key = r, int(self.name[i])
                found[key] = max(found.get(key, got), got)
        return [(r, -got[2], got[0], -got[1]) for (r, _), got in sorted(found.items())]


def _blocks(bench: DataFrame, item: str, text: str, threshold: float) -> Iterator[Items]:
    """The items in blocks of bounded size, items of one id together; only one block is on the driver at a time."""
    ids, texts, size = [], [], 0
    for r in bench.select(F.col(item).alias("i"), F.col(text).alias("t")).where(F.col("t").isNotNull()).orderBy("i", "t").toLocalIterator():
        if size >= BLOCK_BYTES and r["i"] != ids[-1]:
            yield Items(ids, texts, threshold)
            ids, texts, size = [], [], 0
        ids.append(r["i"])
        texts.append(r["t"])
        size += len(r["t"].encode())
    if ids:
        yield Items(ids, texts, threshold)


def _count(texts: DataFrame, items: Items) -> None:
    """Counts the documents that hold each n-gram of a block of items, over the whole corpus, and chooses the seeds: two numbers for each n-gram of the block reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(len(k), np.int64) for k in items.keys]
        for b in batches:
            for _, _, data, off in C.text_blocks(b, "_t"):
                w, first = word_hashes(data, off)
                for n in (1, 2):
                    got = [k * len(off) + np.searchsorted(first, at, "right") for k, at in items.hits(w, first, n)]
                    once = np.unique(np.concatenate(got)) // len(off) if got else np.zeros(0, np.int64)
                    np.add.at(total[n - 1], once, 1)
        for n in (1, 2):
            k = np.flatnonzero(total[n - 1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), n, np.int32)), pa.array(k), pa.array(total[n - 1][k])], ["n", "k", "df"])

    got = C.arrow(texts.select("_t"), run, "n int, k long, df long").groupBy("n", "k").agg(F.sum("df").alias("df")).toArrow()
    n, k, df = (got.column(x).to_numpy() for x in ("n", "k", "df"))
    counts = [np.zeros(len(keys), np.int64) for keys in items.keys]
    for i in (0, 1):
        counts[i][k[n == i + 1]] = df[n == i + 1]
    items.choose(counts)


def find_leaks(docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(key, item, score, end_word): each test item found in each document; score is the share of a perfect copy's."""
    kind, item_kind = docs.schema[key].dataType, bench.schema[item].dataType
    texts = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t"))
    schema = f"_k {kind.simpleString()}, _i {item_kind.simpleString()}, score double, end_word long"
    id_type = to_arrow_type(item_kind)
    out = None
    for items in _blocks(bench, item, item_text, threshold):
        _count(texts, items)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for i, j, data, off in C.text_blocks(b, "_t"):
                    got = items.matches(*word_hashes(data, off))
                    if got:
                        r = pa.array([g[0] for g in got])
                        ids = pa.array([items.ids[g[1]] for g in got], id_type)
                        yield pa.RecordBatch.from_arrays([b.column(0)[i:j].take(r), ids, pa.array([g[2] for g in got]), pa.array([g[3] for g in got], pa.int64())], ["_k", "_i", "score", "end_word"])

        part = C.arrow(texts, run, schema)
        out = part if out is None else out.unionAll(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], schema)
    return out.withColumnsRenamed({"_k": key, "_i": item})


def drop_leaks(docs: DataFrame, bench: DataFrame, threshold: float = THRESHOLD, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents in which no test item is found, with all their columns. Each row is judged by its own text, without a join; null and empty texts stay."""
    out, place, before = docs, docs.columns.index(text), None
    for items in _blocks(bench, item, item_text, threshold):
        if before is not None:  # one block of items at a time in a task
            out = C.save(out, "leaks-kept")
        before = items
        _count(docs.select(F.col(text).alias("_t")), items)

        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for b in batches:
                keep = np.ones(b.num_rows, bool)
                for i, _, data, off in C.text_blocks(b, place):
                    for r, *_ in items.matches(*word_hashes(data, off)):
                        keep[i + r] = False
                yield b.filter(pa.array(keep))

        out = C.arrow(out, run, docs.schema)
    return out
