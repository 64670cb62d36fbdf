"""Suffix-array removal of repeated passages.

A byte goes if it is covered by a WINDOW-byte string that also starts earlier
(in a document with a smaller id, or earlier in the same document). What is
kept is the first occurrence of everything.

Sharding. Equal strings must meet in one shard. Each window is given to its
anchor, the GRAM-byte string inside it with the least hash (the first of
equals), so equal windows have equal anchors at equal places. The windows of
one anchor form a run, about 40 of them, and their bytes an island. Anchors
that occur once in the corpus cannot be in a repeated window; only the islands
of the others go on. A shard is a set of anchor hashes. Of identical islands
only the first owner can keep anything: tasks already leave out all but their own
first before anything is sent, and the shard leaves out the rest, so a passage
in a third of all rows stays small. Identical here means two independent 64-bit
hashes of all bytes, the place of the anchor and the anchor's own hash; the
bytes of such islands are not compared. Anchors that a sample shows to be frequent
enough to burden one task (say, inside a very common line) do not gather their
islands; their windows are islands of their own, sent by the hash of all
WINDOW bytes. The sample only steers this; results don't depend on it.

What need not be sorted. No two windows of one island are equal (they hold the
anchor at different places), so an anchor with one different island is done. A
window holds SIDE bytes more on one side of its anchor at least; so an island
stays only if its anchor with SIDE bytes before it, or with SIDE bytes behind,
occurs in another different island of that anchor (told by one byte of hash
each, so some stay for nothing; none is lost).

Sorting. The other islands of a shard, parted by a byte that UTF-8 never
uses, go through the external induced sorting of suffix_sort, in lots of about
SORT_BYTES that keep anchors whole and arrive in anchor order through Spark's own
spilling sort, so a shard may be far larger than memory. A lot that one anchor
makes larger is sorted within SORT_LIMIT bytes of memory: the sorter's queues,
names and strings go to files on every level of its recursion. Where the common prefix of neighbours reaches WINDOW,
windows are equal: each such group has one first occurrence, and all others are
removed.

Row identity: documents are ordered by id. If ids repeat or are null, rows are
first ordered by (id, text), nulls first; fully equal rows count as one
document and share its result. A null text is empty. Texts shorter than WINDOW
lose nothing. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from .suffix_sort import sort_suffixes

WINDOW, GRAM = 100, 24
#: Of a window, one side of its anchor holds at least so many bytes.
SIDE = (WINDOW - GRAM) // 2
_PER = WINDOW - GRAM + 1  # places of a gram in a window
_U = np.uint64
#: One island: its anchor's name, its own two names, where it lies, how many windows it has, and what stands on either side of the anchor.
ISLAND = np.dtype([("anchor", "<u4"), ("top", "u1"), ("name", "<u8"), ("other", "<u8"), ("doc", "<i8"), ("start", "<u4"), ("count", "u1"), ("left", "u1"), ("right", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("start", "<u4"), ("end", "<u4")])
#: Bytes of islands sorted at once, and bytes of memory that the sorter's queues and arrays may take.
SORT_BYTES, SORT_LIMIT = 1 << 20, 128 << 20
#: Bytes of text whose islands a shard holds.
SHARD_BYTES = 32 << 20
#: Islands of a task that are gathered before equal ones are left out and the rest is sent.
HELD = 200_000
#: Documents in the sample that finds burdensome anchors, and the least count that tells.
SAMPLE_DOCS, SAMPLE_LEAST = 5000, 5


def islands(data: np.ndarray, off: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor hash, two island hashes, row, start in the row, windows, left and right tag) of all islands of a block; hot: sorted anchors to take apart."""
    n = len(data)
    none = *(np.zeros(0, _U) for _ in range(3)), *(np.zeros(0, np.int64) for _ in range(3)), *(np.zeros(0, np.uint8) for _ in range(2))
    if n < WINDOW:
        return none
    p, p2 = C.prefix_hash(data), C.prefix_hash(data, C.OTHER)
    down = C.powers(n + 1)[1]
    grams = C.mix((p[GRAM:] - p[:-GRAM]) * down[: n - GRAM + 1])
    bits = _U(int(n).bit_length())
    low = (_U(1) << bits) - _U(1)
    # hash in the high bits, place in the low ones: the minimum is the first of equals
    key = (grams & ~low) | np.arange(len(grams), dtype=_U)
    pad = -len(key) % _PER
    rows = np.concatenate([key, np.full(pad, ~_U(0))]).reshape(-1, _PER)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    m = n - WINDOW + 1
    at = (np.minimum(back[:m], ahead[_PER - 1 : _PER - 1 + m]) & low).astype(np.int64)
    ok = np.repeat(off[1:], np.diff(off))[:m] - np.arange(m) >= WINDOW
    s = np.flatnonzero(ok)
    if not len(s):
        return none
    a = at[s]
    new = np.ones(len(s), bool)
    new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1] + 1)
    first = np.flatnonzero(new)
    start, count = s[first], np.diff(np.append(first, len(s)))
    place = a[first]
    anchor = grams[place]

    def body(x: np.ndarray, y: np.ndarray, p: np.ndarray = p) -> np.ndarray:
        return C.mix((p[y] - p[x]) * down[x] + (y - x).astype(_U))

    # the place of the anchor is part of the names
    end = start + count + WINDOW - 1
    name, other = (C.mix(body(start, end, q) + (place - start).astype(_U)) for q in (p, p2))
    tag = lambda x, y, inside: np.where(inside, body(np.maximum(x, 0), np.minimum(y, n)) % _U(255) + _U(1), 0).astype(np.uint8)
    left = tag(place - SIDE, place + GRAM, place - start >= SIDE)
    right = tag(place, place + GRAM + SIDE, end - place - GRAM >= SIDE)
    if len(hot):
        many = np.isin(anchor, hot)
        n_of = count[many]
        one = np.repeat(start[many] - np.concatenate([[0], np.cumsum(n_of)[:-1]]), n_of) + np.arange(n_of.sum()) if many.any() else start[many]
        whole, none = body(one, one + WINDOW), np.zeros(len(one), np.uint8)
        anchor, name, other = np.concatenate([anchor[~many], C.mix(whole)]), np.concatenate([name[~many], whole]), np.concatenate([other[~many], body(one, one + WINDOW, p2)])
        left, right = np.concatenate([left[~many], none]), np.concatenate([right[~many], none])
        start, count = np.concatenate([start[~many], one]), np.concatenate([count[~many], np.ones(len(one), np.int64)])
    row = np.searchsorted(off, start, "right") - 1
    return anchor, name, other, row, start - off[row], count, left, right


def island_blocks(batch: pa.RecordBatch, hot: np.ndarray) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """(first row, islands) of the blocks of a batch. A long text is read in windows: an island across their border becomes two of one anchor."""
    for i, _, data, off in C.text_blocks(batch, "_t"):
        if len(off) == 2 and len(data) > 2 * C.BLOCK_BYTES:
            for at in range(0, len(data) - WINDOW + 1, C.BLOCK_BYTES):
                part = data[at : at + C.BLOCK_BYTES + WINDOW - 1]
                anchor, name, other, row, start, *rest = islands(part, np.array([0, len(part)]), hot)
                yield i, (anchor, name, other, row, start + at, *rest)
        else:
            yield i, islands(data, off, hot)


def hot_anchors(rows: DataFrame, total: int, parts: int) -> np.ndarray:
    """Anchors that hold over a quarter of a task's fair share of islands in a sample of the rows (total of them): at most 4 * parts."""
    some = rows.sample(min(1.0, max(0.005, SAMPLE_DOCS / max(total, 1))), seed=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, found in island_blocks(b, np.zeros(0, _U)):
                h, n = np.unique(found[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["h", "n"])

    counts = C.arrow(some, run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    counts = C.save(counts, "repeats-sample", True)
    all_of = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    got = counts.where(F.col("n") >= max(SAMPLE_LEAST, all_of / (4 * parts))).select("h").toPandas()
    C.drop(counts)
    return np.sort(got["h"].to_numpy(np.int64).view(_U))


def _anchor(x: np.ndarray) -> np.ndarray:
    return x["anchor"].astype(_U) | (x["top"].astype(_U) << _U(32))


def _split_owners(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first owner of each different island, removed spans of all other owners)."""
    x = x[np.lexsort((x["start"], x["doc"], x["other"], x["name"], _anchor(x)))]
    head = np.ones(len(x), bool)
    head[1:] = (x["name"][1:] != x["name"][:-1]) | (x["other"][1:] != x["other"][:-1]) | (x["anchor"][1:] != x["anchor"][:-1]) | (x["top"][1:] != x["top"][:-1])
    rest = x[~head]
    out = np.empty(len(rest), SPAN)
    out["doc"], out["start"] = rest["doc"], rest["start"]
    out["end"] = rest["start"] + rest["count"].astype(np.uint32) + (WINDOW - 1)
    return x[head], out


def _open(first: np.ndarray) -> np.ndarray:
    """Which different islands (by anchor) may share a window with another one of their anchor."""
    anchor = _anchor(first)
    out = np.zeros(len(first), bool)
    for side in ("left", "right"):
        some = np.flatnonzero(first[side])
        if not len(some):
            continue
        key = (anchor[some] << _U(8)) | first[side][some]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        out[some[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]] = True
    return out


def _tagged(kind: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array(np.full(b.num_rows, kind, np.int32)), *b.columns], ["kind", "part", "blob"])


def _find(docs: DataFrame, parts: int, hot: np.ndarray) -> DataFrame:
    """Packed islands sent by anchor (kind 0), and packed spans that are removed whatever comes (kind 1, part by document)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans, held, size = C.Packer(parts, SPAN), [], 0

        def send():
            first, rest = _split_owners(np.concatenate(held))
            box = C.Packer(parts, ISLAND)
            box.held, box.size = [(first, (C.mix(_anchor(first)) % _U(parts)).astype(np.int32))], first.nbytes
            yield from _tagged(0, box.flush())
            yield from _tagged(1, spans.add(rest, _part_of(rest["doc"], parts)))

        for b in batches:
            ids = b.column(0).to_numpy()
            for i, (g, name, other, row, start, count, left, right) in island_blocks(b, hot):
                rec = np.empty(len(g), ISLAND)
                rec["anchor"], rec["top"] = (g & _U(0xFFFFFFFF)).astype(np.uint32), ((g >> _U(32)) & _U(0xFF)).astype(np.uint8)
                rec["name"], rec["other"], rec["doc"], rec["start"], rec["count"], rec["left"], rec["right"] = name, other, ids[i + row], start, count, left, right
                held.append(rec)
                size += len(rec)
                if size >= HELD:
                    yield from send()
                    held, size = [], 0
        if held:
            yield from send()
        yield from _tagged(1, spans.flush())

    return C.arrow(docs, run, "kind int, " + C.Packer.schema)


def _repeated(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leaves the different islands that may share a window (anchor, doc, start, count: their bytes are wanted) and spans (part, blob)."""
        names = ["part", "anchor", "doc", "start", "count", "blob"]
        got = []

        def spans(part: pa.Array, blob: pa.Array) -> pa.RecordBatch:
            none = [pa.nulls(len(part), t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32())]
            return pa.RecordBatch.from_arrays([part, *none, blob], names)

        for b in batches:
            kind = b.column(0).to_numpy()
            if (kind == 1).any():
                keep = b.filter(pa.array(kind == 1))
                yield spans(keep.column(1), keep.column(2))
            got += [np.frombuffer(x.as_buffer(), ISLAND) for x in b.filter(pa.array(kind == 0)).column(2)]
        if not got:
            return
        got = np.concatenate(got)
        anchor = _anchor(got)
        order = np.argsort(anchor, kind="stable")
        anchor = anchor[order]
        same = anchor[1:] == anchor[:-1]
        got = got[order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]]
        if not len(got):
            return
        first, rest = _split_owners(got)
        for b in C.Packer(parts, SPAN).add_all(rest, _part_of(rest["doc"], parts)):
            yield spans(b.column(0), b.column(1))
        first = first[_open(first)]
        anchor = _anchor(first).view(np.int64)
        part = (C.mix(anchor.view(_U)) % _U(parts)).astype(np.int32)
        step = 1 << 15
        for k in range(0, len(first), step):
            f = first[k : k + step]
            cols = [part[k : k + step], anchor[k : k + step], f["doc"].copy(), f["start"].astype(np.int64), f["count"].astype(np.int32)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.nulls(len(f), pa.binary())], names)

    return run


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts the wanted islands out of whole texts."""
    for b in batches:
        data, off = C.utf8(b.column(1))
        lists = b.column(2)
        items, at = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        part, anchor, start, count = (items.field(k) for k in range(4))
        doc = np.repeat(np.arange(b.num_rows), np.diff(at))
        begin, size = off[doc] + start.to_numpy(), count.to_numpy() + (WINDOW - 1)
        for k in range(0, len(doc), 1 << 16):
            z = slice(k, k + (1 << 16))
            bodies = pa.array([data[x : x + y].tobytes() for x, y in zip(begin[z].tolist(), size[z].tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part[z], anchor[z], b.column(0).take(pa.array(doc[z])), start[z], count[z], bodies], ["part", "anchor", "doc", "start", "count", "body"])


def _judge(part_rows: list[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
    """Spans removed from the first owners of the islands of some shards: sorts their bytes and groups equal windows."""
    doc, start, count, bodies = part_rows
    size = count + WINDOW  # windows + 99 bytes + the parting byte
    at = np.concatenate([[0], np.cumsum(size)])
    text = np.frombuffer(b"\xff".join(bodies) + b"\xff", np.uint8)
    # islands by first owner: windows of an equal group then compare by (island order, offset)
    near = np.repeat((count + at[:-1]).astype(np.int32), size) - np.arange(len(text), dtype=np.int32)  # > 0 where a whole window starts
    island = np.repeat(np.arange(len(count), dtype=np.int32), size)
    removed = np.zeros(len(text), bool)
    held_pos, held_lcp = [], []

    def close(pos: np.ndarray, lcp: np.ndarray) -> None:
        """Whole groups of windows (a group starts where the common prefix is short)."""
        ok = near[pos] > 0
        pos, new = pos[ok], (lcp < WINDOW)[ok]
        if not len(pos):
            return
        group = np.cumsum(new)
        k = island[pos]
        d, s = doc[k], start[k] + pos - at[k]
        order = np.lexsort((s, d, group))
        g = group[order]
        later = np.zeros(len(g), bool)
        later[1:] = g[1:] == g[:-1]
        removed[pos[order[later]]] = True

    total = 0
    for pos, lcp in sort_suffixes(text, WINDOW, SORT_LIMIT):
        held_pos.append(pos)
        held_lcp.append(lcp)
        total += len(pos)
        if total >= 1 << 20:
            p, c = np.concatenate(held_pos), np.concatenate(held_lcp)
            cut = np.flatnonzero(c < WINDOW)
            cut = int(cut[-1]) if len(cut) else 0
            close(p[:cut], c[:cut])
            held_pos, held_lcp, total = [p[cut:]], [c[cut:]], len(p) - cut
    if held_pos:
        close(np.concatenate(held_pos), np.concatenate(held_lcp))
    on = np.flatnonzero(removed)
    if len(on):
        new = np.ones(len(on), bool)
        new[1:] = (on[1:] != on[:-1] + 1) | (island[on[1:]] != island[on[:-1]])
        f = np.flatnonzero(new)
        a, z = on[f], on[np.append(f[1:], len(on)) - 1]
        k = island[a]
        out = np.empty(len(a), SPAN)
        out["doc"], out["start"], out["end"] = doc[k], start[k] + a - at[k], start[k] + z - at[k] + WINDOW
        yield out


def _sort_shard(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The islands of a shard come in anchor order and are sorted in lots; output is packed spans by document."""
        box = C.Packer(parts, SPAN)
        lot: list[tuple] = []
        size, now = 0, None

        def sort():
            for spans in _judge([np.concatenate([x[k] for x in lot]) for k in range(3)] + [[y for x in lot for y in x[3]]]):
                yield from box.add(spans, _part_of(spans["doc"], parts))

        for b in batches:
            anchor = b.column(1).to_numpy()
            cols = b.column(2).to_numpy(), b.column(3).to_numpy(), b.column(4).to_numpy().astype(np.int64), b.column(5).to_pylist()
            cut = np.flatnonzero(np.concatenate([[now is None or anchor[0] != now], anchor[1:] != anchor[:-1]])) if len(anchor) else []
            now = anchor[-1] if len(anchor) else now
            last = 0
            for k in [*cut, len(anchor)]:
                if k > last:
                    lot.append((cols[0][last:k], cols[1][last:k], cols[2][last:k], cols[3][last:k]))
                    size += int(cols[2][last:k].sum()) + WINDOW * int(k - last)
                    last = k
                if size >= SORT_BYTES and k < len(anchor):
                    yield from sort()
                    lot, size = [], 0
        if lot:
            yield from sort()
        yield from box.flush()

    return run


def _part_of(doc: np.ndarray, parts: int) -> np.ndarray:
    return (C.mix(np.ascontiguousarray(doc).view(_U)) % _U(parts)).astype(np.int32)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document the maximal removed runs: (doc, spans as packed uint32 pairs, bytes removed, runs)."""
    got = C.unpack(batches, SPAN)
    if not len(got):
        return
    got = got[np.lexsort((got["start"], got["doc"]))]
    doc, s, e = got["doc"].copy(), got["start"].astype(np.int64), got["end"].astype(np.int64)
    which = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    shift = which * (1 << 33)
    reach = np.maximum.accumulate(e + shift)
    new = np.ones(len(doc), bool)
    new[1:] = s[1:] + shift[1:] > reach[:-1]  # runs that touch are one
    f = np.flatnonzero(new)
    a, z = s[f], (reach - shift)[np.append(f[1:], len(doc)) - 1]
    d = doc[f]
    first = np.flatnonzero(np.concatenate([[True], d[1:] != d[:-1]]))
    ends = np.append(first[1:], len(d))
    pairs = np.stack([a, z], 1).astype(np.uint32)
    lost = np.add.reduceat(z - a, first)
    step = 1 << 14
    for k in range(0, len(first), step):
        f, e = first[k : k + step], ends[k : k + step]
        packed = [pairs[x:y].tobytes() for x, y in zip(f.tolist(), e.tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(d[f]), pa.array(packed, pa.binary()), pa.array(lost[k : k + step]), pa.array((e - f).astype(np.int64))], ["_k", "spans", "n_removed", "n_spans"])


def _keyed(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame | None]:
    """(_k long, _t) with unique ids in document order; and, where ids repeat or are null, how rows map to them."""
    rows = docs.select(F.col(key).cast("long").alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    odd = rows.groupBy("_k").agg(F.count("*").alias("n")).where("n > 1 or _k is null")
    if not odd.limit(1).count():
        return rows, None
    names = C.save(rows.distinct().orderBy("_k", "_t").withColumn("_n", F.monotonically_increasing_id()), "repeats-rows")
    return names.select(F.col("_n").alias("_k"), "_t"), names


def removed_spans(rows: DataFrame) -> DataFrame:
    """(_k, spans, n_removed, n_spans) for the documents of rows (_k, _t; unique ids) that lose something."""
    spark = rows.sparkSession
    long = rows.where(F.octet_length("_t") >= WINDOW)
    total, size = long.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("_t").cast("long")), F.lit(0))).first()
    # a shard holds the islands of SHARD_BYTES of text (about as many bytes themselves)
    parts = max(C.shuffle_parts(spark), -(-size // SHARD_BYTES))
    sent = C.exchange(_find(long, parts, hot_anchors(long, total, parts)), parts)
    found = C.save(C.arrow(sent, _repeated(parts), "part int, anchor long, doc long, start long, count int, blob binary"), "repeats-islands")
    wanted = found.where("doc is not null")
    asked = wanted.groupBy(F.col("doc").alias("_k")).agg(F.collect_list(F.struct("part", "anchor", "start", "count")).alias("wanted"))
    ids = C.save(wanted.select(F.col("doc").alias("_k")).distinct(), "repeats-ids", True)
    cut = C.semi_join(long, ids, "_k").join(asked, "_k").select("_k", "_t", "wanted")
    cut = C.arrow(cut, _fetch, "part int, anchor long, doc long, start long, count int, body binary")
    shards = C.exchange(cut, parts).sortWithinPartitions("anchor", "doc", "start")
    spans = C.arrow(shards, _sort_shard(parts), C.Packer.schema).unionAll(found.where("doc is null").select("part", "blob"))
    spans = C.exchange(spans, parts)
    out = C.save(C.arrow(spans, _merge, "_k long, spans binary, n_removed long, n_spans long"), "repeats-spans", True)
    C.drop(found, ids)
    return out


def _left(texts: pa.Array, spans: pa.Array) -> Iterator[bytes]:
    """Each text's bytes without its spans (null: none)."""
    data, off = C.utf8(texts)
    for i, x in enumerate(spans):
        own = data[off[i] : off[i + 1]]
        if x.is_valid:
            keep = np.ones(len(own), bool)
            for s, e in np.frombuffer(x.as_buffer(), np.uint32).reshape(-1, 2).tolist():
                keep[s:e] = False
            own = own[keep]
        yield own.tobytes()


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each text, as bytes."""
    for b in batches:
        kept = list(_left(b.column(1), b.column(2)))
        off = C.utf8(b.column(1))[1]
        sums = [hashlib.sha256(x).hexdigest() for x in kept]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), b.column(3), b.column(4), pa.array(sums), pa.array(kept, pa.binary())], ["_k", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", keep_text: bool = False) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept_sha256[, kept: binary]) for every row.

    Cutting may part a character; what is left is bytes, not always valid UTF-8.
    """
    rows, names = _keyed(docs, key, text)
    spans = removed_spans(rows)
    zero = F.lit(0).cast("long")
    few = C.few(spans)
    some = C.semi_join(rows, spans.select("_k"), "_k").join(spans, "_k") if few else rows.join(spans, "_k", "left")
    some = some.select("_k", "_t", "spans", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"))
    some = C.arrow(some, _cut, "_k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    # where few texts lose something the others stay where they are; else all meet their spans in one join
    rest = C.semi_join(rows, spans.select("_k"), "_k", anti=True) if few else rows.limit(0)
    rest = rest.select("_k", F.octet_length("_t").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.sha2("_t", 256).alias("kept_sha256"), F.encode("_t", "UTF-8").alias("kept"))
    out = some.unionAll(rest)
    if not keep_text:
        out = out.drop("kept")
    if names is not None:
        out = out.withColumnRenamed("_k", "_n").join(names, "_n").drop("_n")
        rows = docs.select(F.col(key).cast("long").alias("_k2"), F.coalesce(F.col(text), F.lit("")).alias("_t2"))
        out = rows.join(out, F.col("_k2").eqNullSafe(F.col("_k")) & (F.col("_t2") == F.col("_t"))).drop("_k2", "_t2", "_t")
    return out.withColumnRenamed("_k", key)


def cut_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with repeated passages cut out of the text, all other columns as they are (length: set to the characters left).

    A character of which only a part is left goes. Texts that lose nothing pass unchanged, nulls too; a text may
    become empty, its row stays. Columns may have any names. Repeated ids cost a sort of the whole table by id and text.
    """
    rows, names = _keyed(docs, key, text)
    k, cuts, by_id, by_text = C.fresh(docs, "_k", "_spans", "_id", "_text")
    spans = removed_spans(rows).select(F.col("_k").alias(k), F.col("spans").alias(cuts))
    if names is None:
        named = docs.withColumn(k, F.col(key).cast("long"))
    else:
        by = names.select(F.col("_k").alias(by_id), F.col("_t").alias(by_text), F.col("_n").alias(k))
        named = docs.join(by, F.col(key).cast("long").eqNullSafe(F.col(by_id)) & (F.coalesce(F.col(text), F.lit("")) == F.col(by_text))).drop(by_id, by_text)
    few = C.few(spans)
    rest = C.semi_join(named, spans.select(k), k, anti=True) if few else named.limit(0)
    some = (C.semi_join(named, spans.select(k), k).join(spans, k) if few else named.join(spans, k, "left")).select(*C.cols(named.columns), cuts)
    place = some.columns.index(text)
    counted = docs.columns.index(length) if length in docs.columns else None

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left = _left(b.column(place), b.column(b.num_columns - 1))
            out = [x.decode("utf-8", "ignore") if here else None for x, here in zip(left, b.column(place).is_valid().to_pylist(), strict=True)]
            cols = list(b.columns)[:-1]
            cols[place] = pa.array(out, cols[place].type)
            if counted is not None:  # of the texts that lost something
                lost = b.column(b.num_columns - 1).is_valid().to_pylist()
                cols[counted] = pa.array([len(t) if x else old for t, x, old in zip(out, lost, cols[counted].to_pylist(), strict=True)], cols[counted].type)
            yield pa.RecordBatch.from_arrays(cols, b.schema.names[:-1])

    some = C.arrow(some, cut, named.schema)
    return rest.select(*C.cols(docs.columns)).unionAll(some.select(*C.cols(docs.columns)))
