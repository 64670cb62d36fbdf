"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Training takes a bounded sample of labelled texts (SAMPLE_ROWS, by id hash, of at most SAMPLE_TEXT_BYTES each).
For each hashed n-gram the log ratio of its smoothed document frequencies in
toxic and other texts is taken; a logistic regression is then fitted on the
n-gram frequencies of a text multiplied by those ratios. Folding ratios into
weights leaves one number per n-gram, so a text's score is the mean weight of
its n-grams, found over the whole text with one gather and one running sum. A
text of more than two blocks is read in overlapping windows; its sums are the same.

Defined cases: a null or empty text, or one shorter than the smallest n-gram,
has no features and scores as the intercept alone. Without labels of both
classes every score is the share of label 1 (0.5 with no label). Repeated ids
are scored row by row; an empty table gives an empty result; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C

ORDERS = (3, 4, 5)
BITS = 18
SAMPLE_ROWS = 2400
#: Smoothing of the document counts, L2 penalty, steps of the fit, and the factor that brings frequencies near 1.
ALPHA, L2, STEPS, SCALE = 1.0, 1e-4, 100, 100.0


def code_points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased (A-Z) code points of UTF-8 bytes, and the rows' offsets in them."""
    chars = np.frombuffer(C.LOWER[data].tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return chars, lead[off]


def windows(data: np.ndarray, step: int, ahead: int) -> Iterator[tuple[np.ndarray, int]]:
    """(bytes, bytes of its own) of windows over one text, cut between characters; each reaches `ahead` characters into the next."""

    def whole(at: int) -> int:
        while at < len(data) and data[at] & 0xC0 == 0x80:
            at += 1
        return min(at, len(data))

    at = 0
    while at < len(data):
        to = whole(at + step)
        yield data[at : whole(to + 4 * ahead)], to - at
        at = to


def grams(chars: np.ndarray, off: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: hashed n-gram by start position, and which starts keep inside their row."""
    c = chars.astype(np.uint64)
    left = np.repeat(off[1:], np.diff(off)) - np.arange(len(c))
    h = np.zeros(len(c), np.uint64)
    for n in range(1, max(ORDERS) + 1):
        h = h * np.uint64(0x100000001B3)
        h[: max(len(c) - n + 1, 0)] += c[n - 1 :] + np.uint64(1)
        if n in ORDERS:
            yield ((h * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int32), left >= n


@dataclass
class Model:
    weights: np.ndarray  # per n-gram, float32
    bias: float

    def sums(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row the sum of its n-grams' weights and its characters. Sums of integers: the same wherever a text stands in a block."""
        if len(off) == 2 and len(data) > 2 * C.BLOCK_BYTES:
            total = chars = 0
            for part, own in windows(data, C.BLOCK_BYTES, max(ORDERS) - 1):
                run, at = self._running(part, np.array([0, own, len(part)]), np.array([0, len(part)]))
                total, chars = total + run[at[1]], chars + at[1]
            return np.array([total]), np.array([chars])
        run, at = self._running(data, off, off)
        return run[at[1:]] - run[at[:-1]], np.diff(at)

    def _running(self, data: np.ndarray, marks: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of the weights by start position, and the marks as character positions."""
        chars, at = code_points(data, np.concatenate([marks, off]))
        marks, off = at[: len(marks)], at[len(marks) :]
        run = np.zeros(len(chars) + 1)
        for idx, ok in grams(chars, off):
            run[1:] += np.where(ok, self.weights[idx], 0)
        np.cumsum(np.rint(run * 2.0**24).astype(np.int64), out=(acc := np.zeros(len(run), np.int64)))
        return acc, marks

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        total, chars = self.sums(data, off)
        z = self.bias + SCALE * (total / 2.0**24) / np.maximum(chars - min(ORDERS) + 1, 1)
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[str], y: np.ndarray, prior: float) -> Model:
    """prior: share of label 1 among all training labels; the sample itself may be balanced."""
    if len(set(y.tolist())) < 2:
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(p / (1 - p))))
    rows, cols, vals = [], [], []
    for k, t in enumerate(texts):
        data = np.frombuffer(t.encode(), np.uint8)
        chars, at = code_points(data, np.array([0, len(data)]))
        got = [idx[ok] for idx, ok in grams(chars, at)]
        u, n = np.unique(np.concatenate(got), return_counts=True) if got else (np.zeros(0, np.int32), np.zeros(0))
        rows.append(np.full(len(u), k, np.int32))
        cols.append(u.astype(np.int32))
        vals.append((SCALE * n / max(1, len(chars) - min(ORDERS) + 1)).astype(np.float32))
    row, col, val = np.concatenate(rows), np.concatenate(cols), np.concatenate(vals)
    del rows, cols, vals
    pos = ALPHA + np.bincount(col[y[row] == 1], minlength=1 << BITS)
    neg = ALPHA + np.bincount(col[y[row] == 0], minlength=1 << BITS)
    ratio = (np.log(pos / (ALPHA + y.sum())) - np.log(neg / (ALPHA + (1 - y).sum()))).astype(np.float32)
    val *= ratio[col]
    order = np.argsort(col, kind="stable")
    start = np.searchsorted(col[order], np.arange(1 << BITS))
    used = np.unique(col)
    starts, by_row, by_val = start[used], row[order], val[order]
    del order, start
    edges = np.searchsorted(row, np.arange(len(y)))
    w, b, m, v = np.ones(1 << BITS, np.float32) * 0.1, 0.0, np.zeros(1 << BITS, np.float32), np.zeros(1 << BITS, np.float32)
    has = np.diff(np.append(edges, len(row))) > 0
    for step in range(1, STEPS + 1):
        z = np.full(len(y), b)
        z[has] += np.add.reduceat(val * w[col], edges[has]).astype(np.float64)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        d = ((p - y) / len(y)).astype(np.float32)
        g = L2 * w
        g[used] += np.add.reduceat(by_val * d[by_row], starts)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        b -= 2.0 * float(d.sum())
    share = float(y.mean())
    shift = np.log(prior / (1 - prior)) - np.log(share / (1 - share)) if 0 < prior < 1 else 0.0
    return Model((w * ratio).astype(np.float32), b + float(shift))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS, seed: int = 11) -> Model:
    counts = {r["y"]: r["n"] for r in labels.where(C.trainable() & F.col(label).isin(0, 1)).groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    sample = C.labelled_sample(docs, labels, label, rows, seed)
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    return fit(list(sample["text"]), sample["_y"].to_numpy(np.int64), prior)


def apply_scores(docs: DataFrame, model, threshold: float, key: str = "doc_id", text: str = "text", limit: int = C.BLOCK_BYTES) -> DataFrame:
    """(key, score, predicted) for every row; model has scores(bytes, offsets)."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, off in C.text_blocks(b, "_t", limit):
                s = model.scores(data, off)
                yield pa.RecordBatch.from_arrays([b.column(0)[i:j], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], ["_k", "score", "predicted"])

    out = C.arrow(docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")), run, f"_k {kind}, score double, predicted int")
    return out.withColumnRenamed("_k", key)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    return apply_scores(docs, train(docs, labels), threshold)
