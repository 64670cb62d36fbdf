"""Approximate nearest neighbours by block matrix join.

Vectors are rounded to int8 codes with a scale each and cut into blocks by a
hash; a block is one row of packed ids, codes, scales and magnitude sums - an
eighth of the vectors' doubles. Query blocks of QUERY_ROWS meet strips of
candidate blocks (an equi-join on explicit numbers). A tile multiplies the
codes - as float32 numbers, in which such products are exact - and turns the
sums into lower and upper bounds of the inner product. Along a strip each query
keeps its k best lower bounds; a pair survives where its upper bound reaches
the k-th of them. Survivors meet per query, are held against the k-th lower
bound over all strips, fetch the original vectors and are recomputed in double
precision; heaps merge them to the k best.

As only pairs that provably are not among the k best are dropped, the result
equals the exact search.

Bound: with x = sx*X + ex and y = sy*Y + ey, |ex| <= sx/2 per component,
|<x,y> - sx*sy*<X,Y>| <= sx/2 * |y|_1 + sy/2 * |x|_1 + d*sx*sy/4.

Equal vectors tie for every query, so of each different vector only the k + 1
rows with the smallest ids can be among the k best (one may be the query's
own); the others leave before any product, and a vector in a third of all rows
costs no more than k + 1.

Defined cases: vectors that are null, zero, of another length than the most
frequent one (of equals the smaller), or with a null or non-finite component
take no part, neither as queries nor as candidates. Equal scores go to the
smaller id. Repeated ids are separate candidates, but a query never meets its
own id, and a repeated query id is asked once, with the smallest of its
vectors. Fewer candidates than k: all of them. Empty table: empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Vectors in a candidate and in a query block, candidate blocks in a strip.
BLOCK_ROWS, QUERY_ROWS, STRIP = 4096, 16384, 8
K = 20
#: Components whose products float32 adds up exactly: 127 * 127 * 1024 < 2**24.
EXACT = 1024
PACKED = "ids binary, hash binary, copy binary, codes binary, scale binary, mass binary"


def _clean(vectors: DataFrame, id_col: str, vec: str) -> DataFrame:
    good = F.col("_v").isNotNull() & (F.size("_v") > 0) & ~F.exists("_v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("_v", lambda x: x != 0)
    return vectors.select(F.col(id_col).cast("long").alias("_id"), F.col(vec).cast("array<double>").alias("_v")).where(F.col("_id").isNotNull() & good)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale per row, sum of magnitudes per row."""
    scale = np.maximum(np.abs(x).max(1), np.finfo(np.float64).tiny) / 127
    return np.rint(x / scale[:, None]).astype(np.int8), scale, np.abs(x).sum(1)


def _pack(rows: DataFrame, blocks: int, dim: int) -> DataFrame:
    """(block, packed columns) of rows (_id, _h, _n, _v): one row per block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for b in batches:
            block = b.column(0).to_numpy()
            cols = [b.column(i).to_numpy() for i in (1, 2, 3)] + list(quantise(b.column(4).flatten().to_numpy().reshape(-1, dim)))
            for k in np.unique(block):
                held.setdefault(int(k), []).append([c[block == k] for c in cols])
        for k, parts in held.items():
            cols = [np.concatenate([p[i] for p in parts]) for i in range(6)]
            order = np.lexsort((cols[2], cols[1], cols[0]))
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), *(pa.array([c[order].tobytes()], pa.binary()) for c in cols)], ["block", "ids", "hash", "copy", "codes", "scale", "mass"])

    cut = rows.select(F.pmod(F.xxhash64("_id", "_h", "_n"), F.lit(blocks)).alias("block"), "_id", "_h", "_n", "_v")
    return C.arrow(cut.repartition(blocks, "block"), pack, "block long, " + PACKED)


def exact(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products in double precision, added in component order."""
    out = np.zeros(len(q))
    for d in range(q.shape[1]):
        out += q[:, d] * c[:, d]
    return out


def bounds(x: tuple[np.ndarray, ...], y: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two sides (codes, scale, mass)."""
    (xc, xs, xm), (yc, ys, ym) = x, y
    near = np.zeros((len(xs), len(ys)))
    for d in range(0, xc.shape[1], EXACT):
        near += xc[:, d : d + EXACT].astype(np.float32) @ yc[:, d : d + EXACT].astype(np.float32).T
    near *= xs[:, None] * ys[None, :]
    # 1.001 and the relative term also cover the rounding of the bound itself and of scores near overflow
    err = 1.001 * (xs[:, None] / 2 * ym[None, :] + ys[None, :] / 2 * xm[:, None] + xc.shape[1] / 4 * xs[:, None] * ys[None, :]) + 1e-12 * np.abs(near)
    return near - err, near + err


class Strip:
    """A block of queries on its way along candidate blocks: the k best lower bounds of each query so far."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray, scale: np.ndarray, mass: np.ndarray, k: int):
        self.ids, self.side, self.best = ids, (codes, scale, mass), np.full((len(ids), k), -np.inf)

    def meet(self, ids: np.ndarray, side: tuple[np.ndarray, ...], step: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(query, candidate, lower, upper bound) of the pairs that can be among the k best, as row numbers."""
        k = self.best.shape[1]
        for i in range(0, len(self.ids), step):
            z = slice(i, i + step)
            low, high = bounds(tuple(x[z] for x in self.side), side)
            own = self.ids[z, None] == ids[None, :]
            low[own] = high[own] = -np.inf
            top = np.partition(low, low.shape[1] - k, 1)[:, -k:] if low.shape[1] > k else low
            both = np.concatenate([self.best[z], top], 1)
            self.best[z] = np.partition(both, both.shape[1] - k, 1)[:, -k:]
            a, b = np.nonzero((high >= self.best[z].min(1)[:, None]) & ~own)
            yield i + a, b, low[a, b], high[a, b]


def _blobs(b: pa.RecordBatch, at: int, row: int, dim: int):
    """(ids, hash, copy, (codes, scale, mass)) of a packed block."""
    raw = [b.column(at + i)[row].as_buffer() for i in range(6)]
    ids, h = (np.frombuffer(x, np.int64) for x in raw[:2])
    return ids, h, np.frombuffer(raw[2], np.int32), (np.frombuffer(raw[3], np.int8).reshape(-1, dim), np.frombuffer(raw[4], np.float64), np.frombuffer(raw[5], np.float64))


def nearest(vectors: DataFrame, k: int = K, every: int = 20, id_col: str = "vec_id", vec: str = "embedding", block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest by inner product of every row whose id is divisible by `every`."""
    spark = vectors.sparkSession
    good = _clean(vectors, id_col, vec)
    sizes = good.groupBy(F.size("_v").alias("d")).agg(F.count("*").alias("n"), F.count_if(F.col("_id") % every == 0).alias("q")).orderBy(F.desc("n"), "d").limit(1).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], schema)
    dim, n, asked = sizes[0]["d"], sizes[0]["n"], sizes[0]["q"]
    good = good.where(F.size("_v") == dim).withColumn("_h", F.xxhash64("_v"))
    copy = F.row_number().over(Window.partitionBy("_h", "_v").orderBy("_id"))
    cand = C.save(good.withColumn("_n", copy).where(F.col("_n") <= k + 1), "near-vectors")
    query = C.save(good.where(F.col("_id") % every == 0).groupBy("_id").agg(F.min(F.struct("_v", "_h")).alias("_q")).select("_id", "_q._h", F.lit(0).alias("_n"), "_q._v"), "near-queries")
    cb, qb = -(-n // block_rows), max(1, -(-asked // query_rows))
    number = lambda many: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(many - 1).cast("long")))
    names = [x.split()[0] for x in PACKED.split(", ")]
    # every query block visits every strip of candidate blocks: numbers on both sides, joined on equality and sorted by it
    left = _pack(query, qb, dim).select(F.col("block").alias("qb"), number(-(-cb // STRIP)).alias("strip"), *[F.col(c).alias(f"q_{c}") for c in names])
    right = _pack(cand, cb, dim).select(number(qb).alias("qb"), F.floor(F.col("block") / STRIP).alias("strip"), *names)
    tiles = left.hint("merge").join(right, ["qb", "strip"]).select("qb", *[f"q_{c}" for c in names], *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, strip = None, None
        for b in batches:
            for row, block in enumerate(b.column(0).to_pylist()):
                if block != now:
                    ids, _, _, side = _blobs(b, 1, row, dim)
                    now, strip = block, Strip(ids, *side, k)
                cid, ch, cn, side = _blobs(b, 7, row, dim)
                for a, c, low, high in strip.meet(cid, side):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in (strip.ids[a], cid[c], ch[c], cn[c], low, high)], ["query_id", "_id", "_h", "_n", "low", "high"])

    found = C.arrow(tiles, run, "query_id long, _id long, _h long, _n int, low double, high double")

    def prune(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by query, the greatest lower bounds first
        now, seen, kth = None, 0, -np.inf
        for b in batches:
            q, low, high = (b.column(i).to_numpy() for i in (0, 4, 5))
            keep = np.zeros(len(q), bool)
            edge = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]])) if len(q) else []
            for s, e in zip(edge, [*edge[1:], len(q)], strict=True):
                if q[s] != now:
                    now, seen, kth = q[s], 0, -np.inf
                if seen < k <= seen + e - s:
                    kth = low[s + k - 1 - seen]
                seen += e - s
                keep[s:e] = high[s:e] >= kth
            if keep.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in b.columns[:4]], ["query_id", "_id", "_h", "_n"])

    left_over = C.arrow(found.repartition("query_id").sortWithinPartitions("query_id", F.desc("low")), prune, "query_id long, _id long, _h long, _n int")
    both = left_over.join(cand, ["_id", "_h", "_n"]).join(query.select(F.col("_id").alias("query_id"), F.col("_v").alias("_w")), "query_id").select("query_id", "_id", "_w", "_v")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by query; a heap keeps the k best of each
        now, heap = None, []

        def close(out: list) -> None:
            out += [(now, r + 1, v, s) for r, (s, v) in enumerate(sorted(((s, -m) for s, m in heap), key=lambda x: (-x[0], x[1])))]

        for b in batches:
            out: list[tuple] = []
            score = exact(*(b.column(i).flatten().to_numpy().reshape(-1, dim) for i in (2, 3)))
            for q, v, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), score.tolist(), strict=True):
                if q != now:
                    close(out)
                    now, heap = q, []
                (heapq.heappush if len(heap) < k else heapq.heappushpop)(heap, (s, -v))
            yield _ranked(out)
        out = []
        close(out)
        yield _ranked(out)

    return C.arrow(both.repartition("query_id").sortWithinPartitions("query_id"), merge, schema)


def _ranked(rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows, strict=True) if rows else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.float64()), strict=True)], ["query_id", "rank", "vec_id", "score"])
