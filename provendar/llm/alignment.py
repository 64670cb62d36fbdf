"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Both tokenizers see a space and the text. A token's end is an event (document,
byte offset, tokenizer, id). Events of both are united, sent to their document's
partition, sorted by offset there and swept by a machine whose state is the
document's open group, its counters and its running hash:

* where A and B tokens both end, a group closes: the tokens since the last such place;
* at every offset where any token ends, one A token and one B token have covered the bytes before it: a link.

Events travel as runs: a row holds the ids of the consecutive tokens of one
tokenizer from an offset on, whose ends follow from the ids' lengths; so a row
stands for thousands of events, and sorting rows by offset sorts the events. The
machine works off a window of documents (or a part of a long one) with array operations.

How often an id pair is linked in the whole corpus is a grouped sum over the
windows' different pairs; the counts go back to the windows by a join, so no
document's links are shuffled. Only the highest count per B id is broadcast (a row
per id of B's vocabulary).

Defined cases: a null or empty text, or one whose ids of either tokenizer do
not give its bytes back (U+2581 and the second tokenizer), has no tokens: zeros
and an empty digest. Rows are documents, whatever their key: repeated rows count
each, null keys stay. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import vocab

#: Events of a window of the sweep.
WINDOW = 2 << 20
#: Bytes of text whose events stand in one row at most (a long text has several rows).
RUN = 1 << 16
#: Stretches that a worker remembers for each of the two tokenizers.
CACHE = 500_000
A, B = 0, 1


@lru_cache(maxsize=1)
def _zstd():
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


def _zip(x: np.ndarray) -> bytes:
    return _zstd()[0].compress(np.ascontiguousarray(x))


def _unzip(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(_zstd()[1].decompress(b), kind)


class Table:
    """What the sweep knows of a tokenizer: the bytes each id stands for, and its decimal name."""

    def __init__(self, size: np.ndarray):
        self.size, self.n = size, len(size)
        self.wide = np.uint16 if self.n <= 1 << 16 else np.uint32
        names = [str(i).encode() for i in range(self.n)]
        w = len(names[-1])
        self.long = np.array([len(x) + 1 for x in names], np.int8)
        self.name = np.frombuffer(b"".join(b"\0" + x.ljust(w, b"\0") for x in names), np.uint8).reshape(self.n, w + 1)


def _codecs(raw_a: bytes, raw_b: bytes):
    a, b = vocab.memory(raw_a, vocab.ByteLevel, True), vocab.memory(raw_b, vocab.Pieces)
    a.limit = b.limit = CACHE
    return a, b


def token_events(docs: DataFrame, model_a: str = vocab.BYTE_LEVEL, model_b: str = vocab.PIECES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """End events of both tokenizers, as runs: (doc, key, at, side, ids, last). doc numbers the rows of docs. A text that has no tokens has one empty run a side."""
    raw_a, raw_b = vocab.read(model_a), vocab.read(model_b)
    kind = docs.schema[key].dataType.simpleString()
    names = ["doc", "key", "at", "side", "ids", "last"]
    empty = _zip(np.zeros(0, np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides = _codecs(raw_a, raw_b)
        for batch in batches:
            text = batch.column(2)
            for i, j in C.blocks(C.utf8(text)[1], vocab.PART):
                data, off = vocab.led_by_space(*C.utf8(text.slice(i, j - i)))
                rows = []  # (row, offset, side, ids, last)
                valid = np.ones(j - i, bool)
                for side, memory in enumerate(sides):
                    offset = 0
                    for f, e, ids, at, good, more in memory.parts(data, off):
                        valid[f:e] &= good
                        for k in range(e - f):
                            x = ids[at[k] : at[k + 1]]
                            cut = [0, len(x)]
                            if len(x) > RUN // 4:
                                ends = np.cumsum(memory.size[x])
                                cut[1:1] = np.unique(np.searchsorted(ends, np.arange(RUN, int(ends[-1]), RUN))).tolist()
                            for s, t in zip(cut, cut[1:], strict=False):
                                if t > s or not t:
                                    rows.append((f + k, offset + (int(ends[s - 1]) if s else 0), side, _zip(x[s:t]), not more and t == len(x)))
                        offset = offset + int(memory.size[ids].sum()) if more else 0
                if not valid.all():
                    none = np.flatnonzero(~valid).tolist()
                    rows = [r for r in rows if valid[r[0]]] + [(k, 0, side, empty, True) for k in none for side in (A, B)]
                part = batch.slice(i, j - i)
                row = pa.array([r[0] for r in rows], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), *(pa.array([r[c] for r in rows], t) for c, t in ((1, pa.int64()), (2, pa.int8()), (3, pa.binary()), (4, pa.bool_())))], names)

    rows = docs.select(F.monotonically_increasing_id().alias("_u"), F.col(key).alias("_k"), F.col(text).alias("_t"))
    return C.arrow(rows, run, f"doc long, key {kind}, at long, side tinyint, ids binary, last boolean")


class Sweep:
    """The machine: takes the runs of documents in order, gives their groups and links.

    What it holds between windows is the open document: its counters, its hash, and the tokens after the last common end.
    """

    def __init__(self, a: Table, b: Table):
        self.tables = (a, b)
        self.none = (np.zeros(0, a.wide), np.zeros(0, b.wide))
        self.open = self.none
        self.counts = np.zeros(4, np.int64)  # A tokens, B tokens, groups, links of the open document
        self.sha, self.begun = hashlib.sha256(), False

    def _spell(self, ids, groups) -> tuple[np.ndarray, np.ndarray]:
        """All groups' digest text, each id led by its mark, and where each group ends in it. groups: per group its number of A and of B tokens."""
        na, nb = groups
        ca, cb = np.cumsum(na), np.cumsum(nb)
        total, w = len(ids[A]) + len(ids[B]), max(t.name.shape[1] for t in self.tables)
        text, size = np.zeros((total, w), np.uint8), np.zeros(total, np.int64)
        place_a = np.arange(len(ids[A])) + np.repeat(cb - nb, na)
        place_b = np.arange(len(ids[B])) + np.repeat(ca, nb)
        for t, x, place, first, mark in ((self.tables[A], ids[A], place_a, ca - na, b";"), (self.tables[B], ids[B], place_b, cb - nb, b"|")):
            text[place, : t.name.shape[1]] = t.name[x]
            text[place, 0] = 44
            text[place[first], 0] = mark[0]
            size[place] = t.long[x]
        ends = np.cumsum(size)[ca + cb - 1] if len(na) else np.zeros(0, np.int64)
        flat = text.ravel()
        return flat[flat != 0], ends

    def window(self, docs: list, runs: tuple[list, list], closed: bool):
        """docs: (doc, key) of the window's documents in order; runs: per side one array of ids a document. closed: the last document ends here.

        Returns (for each document: doc, key, counts and digest or None, whether this is all of it; links' document, links' pair code).
        """
        begun = self.begun
        if begun:
            for s in (A, B):
                runs[s][0] = np.concatenate([self.open[s], runs[s][0]])
        n = [np.array([len(x) for x in r], np.int64) for r in runs]
        ids = [np.concatenate(r) if r else self.none[s] for s, r in enumerate(runs)]
        ends = [np.cumsum(t.size[x]) for t, x in zip(self.tables, ids, strict=True)]
        top = int(max([e[-1] for e in ends if len(e)], default=0))
        marks = [np.zeros(top + 1, np.uint8) for _ in (A, B)]
        for m, e in zip(marks, ends, strict=True):
            m[e] = 1
        both = np.flatnonzero(marks[A] & marks[B])
        self.open = self.none
        if not closed:  # what follows the last common end waits
            upto = int(both[-1]) if len(both) else 0
            keep = [int(np.searchsorted(e, upto, "right")) for e in ends]
            before = [int(k[:-1].sum()) for k in n]
            if any(k < b for k, b in zip(keep, before, strict=True)):
                raise ValueError("a document's tokenizers disagree on its length")
            self.open = tuple(x[k:].copy() for x, k in zip(ids, keep, strict=True))
            for s in (A, B):
                n[s][-1] -= len(ids[s]) - keep[s]
                ids[s], ends[s] = ids[s][: keep[s]], ends[s][: keep[s]]
                marks[s] = marks[s][: upto + 1]
        # the last token of each group, and the links: at every end, the tokens that cover the bytes before it
        cover = [np.cumsum(m, dtype=np.int32) for m in marks]
        groups = [np.diff(c[both], prepend=0) for c in cover]
        at = np.flatnonzero(marks[A] | marks[B])
        a, b = (ids[s][cover[s][at] - marks[s][at]] for s in (A, B))
        pairs = a.astype(np.int64) * self.tables[B].n + b
        text, spelled = self._spell(ids, groups)
        last = np.concatenate([[0], ends[A]])[np.cumsum(n[A])]  # where each document ends
        g, k = np.searchsorted(both, last, "right"), np.searchsorted(at, last, "right")
        n_groups, n_links = np.diff(g, prepend=0), np.diff(k, prepend=0)
        cut = np.concatenate([[0], spelled])[g]
        out = []
        for r, (doc, key) in enumerate(docs):
            whole = not (r == 0 and begun)
            if whole:
                self.counts[:] = 0
                self.sha, self.begun = hashlib.sha256(), False
            self.counts += (n[A][r], n[B][r], n_groups[r], n_links[r])
            s, e = int(cut[r - 1]) if r else 0, int(cut[r])
            if e > s:
                self.sha.update(text[s + (not self.counts[2] - n_groups[r]) : e].data)
            done = closed or r < len(docs) - 1
            if done and any(len(x) for x in self.open if r == len(docs) - 1):
                raise ValueError("a document's tokenizers disagree on its length")
            out.append((doc, key, (*self.counts.tolist(), self.sha.hexdigest() if self.counts[0] else "") if done else None, whole and done))
        self.begun = not closed
        return out, np.repeat(np.arange(len(docs)), n_links), pairs


_PARTS = "kind tinyint, win long, code long, n long, doc long, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, whole boolean, codes binary, times binary"
_NAMES = [x.split()[0] for x in _PARTS.split(", ")]


def _sweep(events: DataFrame, sizes: tuple[np.ndarray, np.ndarray], kind: str) -> DataFrame:
    """Rows of kind 0: a window's different pairs and their links; of kind 1: (a part of) a document and its different pairs."""

    def emit(found, doc_of, pairs, win: int):
        bits = np.int64(max(1, int(pairs.max()).bit_length() if len(pairs) else 1))
        both = np.sort(doc_of << bits | pairs)
        new = np.flatnonzero(np.append(True, both[1:] != both[:-1])) if len(both) else np.zeros(0, np.int64)
        times = np.diff(np.append(new, len(both)))
        owner, code = both[new] >> bits, both[new] & (np.int64(1) << bits) - 1
        if len(code):
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.append(True, np.diff(code[order]) != 0))
            cols = {"code": pa.array(code[order][first]), "n": pa.array(np.add.reduceat(times[order], first))}
            yield _batch(len(first), kind=0, win=win, **cols)
        cut = np.searchsorted(owner, np.arange(len(found) + 1))
        cells = {"codes": [], "times": []}
        for r in range(len(found)):
            s, e = cut[r], cut[r + 1]
            cells["codes"].append(_zip(np.diff(code[s:e], prepend=0)))
            cells["times"].append(_zip(times[s:e].astype(np.uint32)))
        sums = [f[2] or (None,) * 5 for f in found]
        cols = {c: [x[k] for x in sums] for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links", "groups_sha256"))}
        yield _batch(len(found), kind=1, win=win, doc=[f[0] for f in found], key=[f[1] for f in found], whole=[f[3] for f in found], **cols, **cells)

    def _batch(rows: int, **cols) -> pa.RecordBatch:
        arrays = []
        for c in _NAMES:
            x, t = cols.get(c), types[c]
            arrays.append(pa.nulls(rows, t) if x is None else x.cast(t) if isinstance(x, pa.Array) else pa.array(x if isinstance(x, list) else [x] * rows, t))
        return pa.RecordBatch.from_arrays(arrays, _NAMES)

    types = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = tuple(Table(s) for s in sizes)
        sweep, win = Sweep(*tables), TaskContext.get().partitionId() << 32
        docs: list = []
        runs: tuple[list, list] = ([], [])
        held, closed = 0, True

        def flush(done: bool):
            nonlocal docs, runs, held, win
            ids = tuple([np.concatenate(x) if len(x) != 1 else x[0] for x in [y or [sweep.none[s]] for y in runs[s]]] for s in (A, B))
            yield from emit(*sweep.window(docs, ids, done), win)
            docs, runs, held, win = [] if done else [docs[-1]], ([], []) if done else ([[]], [[]]), 0, win + 1

        for batch in batches:
            if not types:
                for f in ("kind tinyint", "win long", "code long", "n long", "doc long", "n_a long", "n_b long", "n_groups long", "n_links long"):
                    types[f.split()[0]] = pa.int8() if f.endswith("tinyint") else pa.int64()
                types.update(key=batch.schema.field(1).type, groups_sha256=pa.string(), whole=pa.bool_(), codes=pa.binary(), times=pa.binary())
            number, side, last = batch.column(0).to_pylist(), batch.column(3).to_pylist(), batch.column(5).to_pylist()
            keys, ids = batch.column(1).to_pylist(), batch.column(4).to_pylist()
            for r in range(batch.num_rows):
                if held >= WINDOW:
                    yield from flush(closed)
                if not docs or docs[-1][0] != number[r]:
                    docs.append((number[r], keys[r]))
                    runs[A].append([])
                    runs[B].append([])
                    ended = [False, False]
                x = _unzip(ids[r], tables[side[r]].wide)
                runs[side[r]][-1].append(x)
                held += len(x)
                ended[side[r]] |= last[r]
                closed = all(ended)
        if docs:
            yield from flush(True)

    return C.arrow(events, run, _PARTS.format(kind=kind))


def align(docs: DataFrame, model_a: str = vocab.BYTE_LEVEL, model_b: str = vocab.PIECES, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(a row per document: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256; the links' id pairs: a, b, n, best).

    n_best counts the links whose pair is linked most often among the pairs of its B id, count_sum adds the pairs' counts.
    """
    kind = docs.schema[key].dataType.simpleString()
    sizes = tuple(np.array([len(x) for x in m.bytes], np.int64) for m in (vocab.ByteLevel(vocab.read(model_a), True), vocab.Pieces(vocab.read(model_b))))
    n_b = len(sizes[B])
    events = token_events(docs, model_a, model_b, key, text)
    sorted_events = events.repartition(C.shuffle_parts(docs.sparkSession), "doc").sortWithinPartitions("doc", "at", "side")
    parts = C.save(_sweep(sorted_events, sizes, kind), "aligned")

    per_window = parts.where("kind = 0").select("win", "code", "n")
    totals = per_window.groupBy("code").agg(F.sum("n").alias("total"))
    highest = totals.groupBy((F.col("code") % n_b).alias("b")).agg(F.max("total").alias("highest"))
    pairs = totals.join(F.broadcast(highest), F.col("code") % n_b == F.col("b")).select("code", "total", (F.col("total") == F.col("highest")).alias("best"))
    answers = per_window.select("win", "code").join(pairs, "code")
    cells = ["doc", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "whole", "codes", "times"]
    blank = [F.lit(None).cast(parts.schema[c].dataType).alias(c) for c in cells]
    to_score = answers.select(F.lit(0).cast("tinyint").alias("kind"), "win", "code", "total", "best", *blank).unionAll(parts.where("kind = 1").select("kind", "win", "code", F.col("n").alias("total"), F.lit(None).cast("boolean").alias("best"), *cells))
    scored = _score(to_score.repartition(C.shuffle_parts(docs.sparkSession), "win").sortWithinPartitions("win", "kind", "code"), kind)
    sums = [F.max(c).alias(c) for c in ("key", "n_a", "n_b", "n_groups", "n_links")] + [F.sum(c).alias(c) for c in ("n_best", "count_sum")] + [F.max("groups_sha256").alias("groups_sha256")]
    long = scored.where("not whole").groupBy("doc").agg(*sums).drop("doc")
    rows = scored.where("whole").select(*long.columns).unionAll(long).withColumnRenamed("key", key)
    links = pairs.select(F.expr(f"code div {n_b}").cast("int").alias("a"), (F.col("code") % n_b).cast("int").alias("b"), F.col("total").alias("n"), "best")
    return rows, links


def _score(rows: DataFrame, kind: str) -> DataFrame:
    """Each window's pair counts come first, then its documents."""
    names = ["doc", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "whole", "n_best", "count_sum"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        win, counts = None, None
        fresh: list = []
        for b in batches:
            kinds, wins = np.asarray(b.column(0)), np.asarray(b.column(1))
            cut = [0, *(np.flatnonzero((np.diff(kinds) != 0) | (np.diff(wins) != 0)) + 1).tolist(), len(kinds)]
            for s, e in zip(cut, cut[1:], strict=False):
                if e == s:
                    continue
                if wins[s] != win:
                    win, counts, fresh = wins[s], None, []
                part = b.slice(s, e - s)
                if kinds[s] == 0:
                    fresh.append((np.asarray(part.column(2)), np.asarray(part.column(3)), part.column(4).to_numpy(zero_copy_only=False)))
                    continue
                if counts is None:
                    counts = tuple(np.concatenate([f[k] for f in fresh]) for k in range(3)) if fresh else (np.zeros(0, np.int64),) * 3
                    fresh = []
                sums = np.zeros((2, e - s), np.int64)
                codes, times = part.column(13).to_pylist(), part.column(14).to_pylist()
                for r in range(e - s):
                    code = np.cumsum(_unzip(codes[r], np.int64))
                    if len(code):
                        at, n = np.searchsorted(counts[0], code), _unzip(times[r], np.uint32).astype(np.int64)
                        sums[:, r] = n[counts[2][at].astype(bool)].sum(), (n * counts[1][at]).sum()
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(5, 13)), pa.array(sums[0]), pa.array(sums[1])], names)

    return C.arrow(rows, run, f"doc long, key {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, whole boolean, n_best long, count_sum long")
