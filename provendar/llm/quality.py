"""Quality: a byte-level convolutional network in numpy.

Each byte is embedded (EMBED numbers, learned). Filters of WIDTH bytes move
over the text in steps of STRIDE; responses (rectified) are max-pooled within
overlapping chunks of two half-chunks, and the chunks cover the whole text.
Per filter, the greatest and the mean chunk value go into one logistic unit.
Texts are padded with zero bytes to whole half-chunks, and beyond their end
for the last filter positions.

Scores come from the network with embeddings and filters rounded to 8 bits:
all products and sums are then whole numbers that float32 holds exactly, so a
score depends on the text alone, not on the block it stands in. A text of more
than two blocks is read in windows, with the last half-chunk carried over.

Training: stochastic gradient steps (Adam) on a bounded sample of labelled
texts (SAMPLE_ROWS, by id hash, of at most SAMPLE_TEXT_BYTES each), gradients worked out by hand; only the
positions that won a pooling carry a gradient, so a step is cheap.

Defined cases: a null or empty text is one half-chunk of padding. Without
labels of both classes every score is the share of label 1 (0.5 with none).
Repeated ids are scored row by row; an empty table gives an empty result;
extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .toxicity import apply_scores

EMBED, FILTERS, STRIDE, TAPS = 8, 24, 4, 2
WIDTH = STRIDE * TAPS
#: Filter positions in a half-chunk; a chunk is two neighbouring half-chunks: 256 bytes, overlapping by 128.
HALF = 32
#: Embeddings and filters are rounded to whole numbers up to this: sums stay far below 2**24.
LEVELS = 127
SAMPLE_ROWS, EPOCHS, BATCH, RATE, DECAY = 3000, 6, 32, 4e-3, 1e-4


@dataclass
class Net:
    emb: np.ndarray
    conv: np.ndarray  # TAPS x (STRIDE*EMBED) x FILTERS
    bias: np.ndarray
    out: np.ndarray  # 2*FILTERS
    out_bias: float = 0.0
    shift: float = field(default=0.0)

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        return self.rounded.scores(data, off)

    @cached_property
    def rounded(self) -> Rounded:
        """The network that scores: call it once training is over."""
        unit = max(float(np.abs(self.emb).max()), 1e-12) / LEVELS
        units = np.maximum(np.abs(self.conv).max((0, 1)), 1e-12) / LEVELS
        whole = lambda x: np.rint(x).astype(np.float32)
        bias = np.clip(whole(self.bias / (unit * units)), -(1 << 22), 1 << 22)
        return Rounded(whole(self.emb / unit), whole(self.conv / units), bias, (unit * units).astype(np.float64), self.out.astype(np.float64), float(self.out_bias) + self.shift)

    def forward(self, data: np.ndarray, off: np.ndarray, train: bool = False):
        size = np.diff(off)
        halves = np.maximum(1, -(-size // (HALF * STRIDE)))
        at = np.concatenate([[0], np.cumsum(halves)])
        buf = np.zeros((at[-1] * HALF + TAPS - 1) * STRIDE, np.uint8)
        buf[np.repeat(at[:-1] * HALF * STRIDE - off[:-1], size) + np.arange(len(data))] = data
        a = self.emb[buf].reshape(-1, STRIDE * EMBED)
        n = at[-1] * HALF
        r = a[:n] @ self.conv[0]
        for t in range(1, TAPS):
            x = a[t : t + n] @ self.conv[t]
            # what would reach into the next text meets padding: the step at n
            x[(at[1:, None] * HALF - np.arange(1, t + 1)).ravel()] = a[n] @ self.conv[t]
            r += x
        r = r.reshape(-1, HALF, FILTERS)
        top = r.argmax(1) if train else None
        h = r.max(1) + self.bias
        np.maximum(h, 0, out=h)
        # chunk k is halves k and k + 1 of one text; a text of one half is its own chunk
        last = np.zeros(len(h), bool)
        last[at[1:] - 1] = True
        nxt = np.vstack([h[1:], h[-1:]])
        nxt[last] = h[last]
        chunk = np.maximum(h, nxt)
        whole = ~last
        whole[at[:-1][halves == 1]] = True
        count = np.add.reduceat(whole.astype(np.float32), at[:-1])[:, None]
        chunk[~whole] = 0
        mx = np.maximum.reduceat(chunk, at[:-1])
        mean = np.add.reduceat(chunk, at[:-1]) / count
        z = np.hstack([mx, mean]) @ self.out + self.out_bias
        return z.astype(np.float64), (buf, a, at, h, nxt, chunk, whole, count, mx, mean, top)


@dataclass
class Rounded:
    """The network in whole numbers; unit turns a filter's response into its size."""

    emb: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    unit: np.ndarray
    out: np.ndarray
    out_bias: float

    def halves(self, buf: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Greatest responses per half-chunk and filter. buf: half-chunks and TAPS - 1 further steps; at ends (step numbers) texts end, and what follows counts as padding."""
        a = self.emb[buf].reshape(-1, STRIDE * EMBED)
        n = len(a) - (TAPS - 1)
        none = np.tile(self.emb[0], STRIDE)
        r = a[:n] @ self.conv[0]
        for t in range(1, TAPS):
            x = a[t : t + n] @ self.conv[t]
            x[(ends[:, None] - np.arange(1, t + 1)).ravel()] = none @ self.conv[t]
            r += x
        return np.maximum(r.reshape(-1, HALF, FILTERS).max(1) + self.bias, 0)

    def pooled(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row and filter the greatest and the summed chunk value, and per row the number of chunks."""
        if len(off) == 2 and len(data) > 2 * C.BLOCK_BYTES:
            return self._long(data)
        size = np.diff(off)
        count = np.maximum(1, -(-size // (HALF * STRIDE)))
        at = np.concatenate([[0], np.cumsum(count)])
        buf = np.zeros((at[-1] * HALF + TAPS - 1) * STRIDE, np.uint8)
        buf[np.repeat(at[:-1] * HALF * STRIDE - off[:-1], size) + np.arange(len(data))] = data
        h = self.halves(buf, at[1:] * HALF)
        # chunk k is halves k and k + 1 of one text; a text of one half is its own chunk
        chunk = h.copy()
        np.maximum(chunk[:-1], h[1:], out=chunk[:-1])
        last = at[1:] - 1
        chunk[last] = np.where((count == 1)[:, None], h[last], 0)
        return np.maximum.reduceat(chunk, at[:-1]), np.add.reduceat(chunk.astype(np.float64), at[:-1]), np.maximum(count - 1, 1)

    def _long(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        width = HALF * STRIDE
        most, total, chunks, before = np.zeros(FILTERS, np.float32), np.zeros(FILTERS), 0, None
        step = C.BLOCK_BYTES // width * width
        for at in range(0, len(data), step):
            n = -(-min(step, len(data) - at) // width) * width
            buf = np.zeros(n + (TAPS - 1) * STRIDE, np.uint8)
            own = data[at : at + len(buf)]
            buf[: len(own)] = own
            ends = np.array([n // STRIDE]) if at + step >= len(data) else np.zeros(0, np.int64)
            h = self.halves(buf, ends)
            if before is not None:
                h = np.vstack([before, h])
            chunk = np.maximum(h[:-1], h[1:])
            if len(chunk):
                most, total, chunks = np.maximum(most, chunk.max(0)), total + chunk.sum(0, dtype=np.float64), chunks + len(chunk)
            before = h[-1:]
        return most[None], total[None], np.array([chunks])

    def scores(self, data: np.ndarray, off: np.ndarray) -> np.ndarray:
        most, total, chunks = self.pooled(data, off)
        z = np.full(len(chunks), self.out_bias)
        for k in range(FILTERS):  # one after the other: the same sum for a text in any block
            z += most[:, k] * self.unit[k] * self.out[k]
            z += total[:, k] / chunks * self.unit[k] * self.out[FILTERS + k]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _gradient(net: Net, data: np.ndarray, off: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    z, (buf, a, at, h, nxt, chunk, whole, count, mx, mean, top) = net.forward(data, off, True)
    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
    d = ((p - y) / len(y)).astype(np.float32)
    feats = np.hstack([mx, mean])
    g_out, g_ob = feats.T @ d, d.sum()
    doc = np.repeat(np.arange(len(y)), np.diff(at))
    g_max, g_mean = d[:, None] * net.out[:FILTERS], d[:, None] * net.out[FILTERS:]
    won = (chunk == mx[doc]) & whole[:, None]
    share = won / np.maximum(1, np.add.reduceat(won.astype(np.float32), at[:-1]))[doc]
    g_chunk = share * g_max[doc] + whole[:, None] * (g_mean / count)[doc]
    g_h = np.where(h >= nxt, g_chunk, 0)
    g_h[1:] += np.where(h >= nxt, 0, g_chunk)[:-1]
    g_h = np.where(h > 0, g_h, 0).astype(np.float32)
    pos = top + (np.arange(len(h)) * HALF)[:, None]
    ends = at[1:][doc][:, None] * HALF
    g_conv, g_emb = np.zeros_like(net.conv), np.zeros_like(net.emb)
    bytes_at = buf.reshape(-1, STRIDE)
    for t in range(TAPS):
        step = np.where(pos + t < ends, pos + t, at[-1] * HALF)
        x = a[step]  # halves x filters x (STRIDE*EMBED)
        g_conv[t] = np.einsum("hfe,hf->ef", x, g_h, optimize=True)
        g_a = (g_h[:, :, None] * net.conv[t].T[None]).reshape(-1, EMBED)
        idx = bytes_at[step].reshape(-1)
        for e in range(EMBED):
            g_emb[:, e] += np.bincount(idx, g_a[:, e], 256)
    return [g_emb, g_conv, g_h.sum(0), g_out, np.array([g_ob])]


def fit(texts: list[str], y: np.ndarray, prior: float, seed: int = 5) -> Net:
    rng = np.random.default_rng(seed)
    net = Net(rng.normal(0, 0.5, (256, EMBED)).astype(np.float32), rng.normal(0, (STRIDE * TAPS * EMBED) ** -0.5, (TAPS, STRIDE * EMBED, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32))
    p = min(max(prior, 1e-6), 1 - 1e-6)
    if len(set(y.tolist())) < 2:
        net.out[:] = 0
        net.out_bias = float(np.log(p / (1 - p)))
        return net
    net.emb[0] = 0
    raw = [np.frombuffer(t.encode(), np.uint8) for t in texts]
    params = [net.emb, net.conv, net.bias, net.out, np.zeros(1)]
    m, v = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params]
    step, steps = 0, EPOCHS * -(-len(raw) // BATCH)
    for _ in range(EPOCHS):
        order = rng.permutation(len(raw))
        for i in range(0, len(order), BATCH):
            some = order[i : i + BATCH]
            off = np.concatenate([[0], np.cumsum([len(raw[k]) for k in some])])
            grads = _gradient(net, np.concatenate([raw[k] for k in some]), off, y[some])
            step += 1
            rate = RATE * (1 - step / (steps + 1))
            for k, (x, g) in enumerate(zip(params, grads, strict=True)):
                g = g + DECAY * x
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                x -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(x.dtype)
            net.out_bias = float(params[4][0])
    share = float(y.mean())
    net.shift = float(np.log(p / (1 - p)) - np.log(share / (1 - share)))
    return net


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS, seed: int = 17) -> Net:
    counts = {r["y"]: r["n"] for r in labels.where(C.trainable() & F.col(label).isin(0, 1)).groupBy(F.col(label).alias("y")).agg(F.count("*").alias("n")).collect()}
    sample = C.labelled_sample(docs, labels, label, rows, seed)
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    return fit(list(sample["text"]), sample["_y"].to_numpy(np.int64), prior)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, score, predicted) for every document."""
    return apply_scores(docs, train(docs, labels), threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of docs whose text scores at least threshold, with all their columns, in one pass. Null and empty texts are judged by their score like all others."""
    net = train(docs, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [net.scores(data, off) >= threshold for _, _, data, off in C.text_blocks(b, text)]
            if ok:
                yield b.filter(pa.array(np.concatenate(ok)))

    return C.arrow(docs, run, docs.schema)
