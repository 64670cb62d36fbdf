"""Shared pieces of the corpus operators: scratch tables, Arrow text blocks, vectorised hashing.

Everything that runs on executors works on Arrow batches: the UTF-8 bytes of a
text column are viewed as one numpy array plus offsets, so no Python string is
made for a document unless an operator needs one. Kernels see blocks of about
BLOCK_BYTES; a longer text stands alone in its block and is worked off in
windows of that size with carried state, so what a kernel needs beyond the text
itself does not grow with it, and the result is that of the whole text.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text handled at once by the vectorised kernels (a longer document forms a block alone and is read in windows).
BLOCK_BYTES = 1 << 18
#: Bytes aimed at in an Arrow batch between the JVM and Python, where the session leaves Spark's default.
BATCH_BYTES = 8 << 20
#: Rows up to which an id list may be broadcast (some 60 MB of the driver, which collects and builds the table); beyond it the join shuffles.
BROADCAST_ROWS = 500_000
#: Characters of a plan's text that the driver keeps for each write of a scratch table: it holds the last 1000 of them, and Spark sets no limit.
PLAN_TEXT = 4096
#: Contract: rows whose crc32(doc_id as text) is divisible by this are held out of training.
HELD_OUT_MOD = 5

U64 = np.uint64
_MIX1, _MIX2 = U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --------------------------------------------------------------------------- scratch tables


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that the cluster names in spark.checkpoint.dir. A local default only where all runs in this one process."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    master = spark.sparkContext.master or ""
    if not root and (not master.startswith("local") or "cluster" in master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return (root or "/tmp/checkpoints/provendar").rstrip("/")


@contextlib.contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def save(df: DataFrame, what: str, small: bool = False) -> DataFrame:
    """Cuts lineage: writes df as Parquet under the shared folder and reads it back. Its shuffle files go at once.

    small: tables of ids or links, a hundredth of the text or less, go to a sixteenth of the usual number of files.
    """
    spark = df.sparkSession
    if small:
        df = df.coalesce(max(6, shuffle_parts(spark) // 16))
    path = f"{scratch_root(spark)}/{what}-{uuid.uuid4().hex}"
    with _setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"), _setting(spark, "spark.sql.maxPlanStringLength", str(PLAN_TEXT)):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch_path = path
    return out


def drop(*frames: DataFrame) -> None:
    """Deletes tables that save() wrote, once nothing reads them any more."""
    for df in frames:
        path = getattr(df, "_scratch_path", None)
        if path:
            jvm = df.sparkSession._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def few(ids: DataFrame) -> bool:
    """Whether a table of ids is small enough to be broadcast."""
    return ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def semi_join(big: DataFrame, ids: DataFrame, key: str, anti: bool = False) -> DataFrame:
    """Rows of big whose key is (anti: is not) in ids, distinct. The id list is broadcast only when counted to be small."""
    return big.join(F.broadcast(ids) if few(ids) else ids, key, "left_anti" if anti else "left_semi")


def salted_join(many: DataFrame, one: DataFrame, key: str, spread: str, salts: int = 32, how: str = "inner") -> DataFrame:
    """many joined (how: inner or left) with one (a row per key) on key; a key with very many rows is dealt over `salts` tasks by the column spread."""
    left = many.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
    right = one.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return left.join(right, [key, "_salt"], how).drop("_salt")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """names, changed where df has a column of that name (in any case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def cols(names) -> list:
    """Columns by their plain names, dots and all."""
    return [F.col("`" + n.replace("`", "``") + "`") for n in names]


# --------------------------------------------------------------------------- Python on executors


def relieve() -> None:
    """Gives memory that a task no longer needs back to the system: workers stay and would keep their largest task's."""
    _powers.cache_clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


BATCH_KEY, BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def arrow(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(f, schema) with smaller batches than Spark's default, and workers that give memory back after each task."""
    spark = df.sparkSession
    if spark.conf.get(BATCH_KEY) == BATCH_DEFAULT:  # a session's own value stays
        spark.conf.set(BATCH_KEY, str(BATCH_BYTES))

    names = None
    if any("." in c for c in df.columns):  # mapInArrow takes such names for paths; rows travel under plain ones
        names = [f.name for f in schema.fields]
        plain, taken = [], {c.lower() for c in df.columns}
        for c in df.columns:
            n = c.replace(".", "_")
            while n != c and n.lower() in taken:
                n += "_"
            taken.add(n.lower())
            plain.append(n)
        df = df.toDF(*plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in f(batches):
                yield b if names is None else b.rename_columns(names)
        finally:
            relieve()

    return df.mapInArrow(run, schema)


# --------------------------------------------------------------------------- hold-out rule


def held_out(doc_id="doc_id"):
    """crc32(doc_id as text) mod 5 = 0; false for a null id, which is never learnt from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_MOD == 0, F.lit(False))


def trainable(doc_id="doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % HELD_OUT_MOD != 0, F.lit(False))


#: Longer texts are not learnt from (they are scored whole like all others): rows times this bounds what the driver gets.
SAMPLE_TEXT_BYTES = 32 << 10


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, seed: int):
    """At most `rows` labelled training texts (the documented bound) of at most SAMPLE_TEXT_BYTES each, half of them per class where possible.

    Chosen by the smallest hash of (seed, doc_id), so the choice depends only on
    the ids. Only ids are ranked; texts are fetched for the chosen ids alone.
    """
    lab = labels.where(trainable() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    lab = lab.withColumn("_h", F.xxhash64(F.lit(seed), "doc_id"))
    ids = None
    for y in (0, 1):
        part = lab.where(F.col("_y") == y).orderBy("_h", "doc_id").limit(rows // 2)
        ids = part if ids is None else ids.unionAll(part)
    texts = docs.select("doc_id", "text").where(trainable() & (F.octet_length("text") <= SAMPLE_TEXT_BYTES))
    got = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.first("_y").alias("_y"))
    return got.select("doc_id", "text", "_y").toPandas().sort_values("doc_id").reset_index(drop=True)


# --------------------------------------------------------------------------- Arrow text


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null has length 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if pa.types.is_large_string(col.type):
        kind = np.int64
    else:
        col, kind = col.cast(pa.string()), np.int32
    n = len(col)
    bufs = col.buffers()
    if n == 0 or bufs[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(bufs[1], kind)[col.offset : col.offset + n + 1].astype(np.int64)
    return np.frombuffer(bufs[2], np.uint8)[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes; a longer row stands alone."""
    n, i = len(off) - 1, 0
    while i < n:
        j = int(np.searchsorted(off, off[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_blocks(batch: pa.RecordBatch, column: str | int = "text", limit: int = BLOCK_BYTES):
    """Yields (first row, last row, bytes, offsets of the rows from 0). column: its name or place."""
    data, off = utf8(batch.column(batch.schema.get_field_index(column) if isinstance(column, str) else column))
    for i, j in blocks(off, limit):
        yield i, j, data[off[i] : off[j]], off[i : j + 1] - off[i]


# --------------------------------------------------------------------------- hashing

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: The white space that ends a word: \x20 and \x09-\x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

#: Everything but ASCII letters and digits and bytes of longer characters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False

_R = 0x9E3779B97F4A7C13  # odd, 3 mod 8: consecutive powers differ in all but two low bits
_RINV = pow(_R, -1, 1 << 64)
_T, OTHER = np.random.default_rng(20240229).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= _MIX1
    x ^= x >> U64(27)
    x *= _MIX2
    x ^= x >> U64(31)
    return x


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    a, b = np.full(n, _R, U64), np.full(n, _RINV, U64)
    a[0] = b[0] = 1
    return np.cumprod(a, dtype=U64), np.cumprod(b, dtype=U64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(BLOCK_BYTES * 2, 1 << int(n).bit_length()))


def prefix_hash(data: np.ndarray, table: np.ndarray = _T) -> np.ndarray:
    """P with P[e] - P[s] the polynomial hash of data[s:e], times the power of s. table: the bytes' numbers (OTHER gives an independent hash)."""
    p = np.zeros(len(data) + 1, U64)
    np.cumsum(table[data] * powers(len(data) + 1)[0][: len(data)], out=p[1:])
    return p


def span_hash(p: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of data[s:e], equal for equal bytes wherever they stand."""
    return mix((p[e] - p[s]) * powers(len(p))[1][s] + (e - s).astype(U64))


def words(data: np.ndarray, off: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (by default [^\\x20\\x09-\\x0D]+) and, for each row, the index of its first word (n + 1 entries)."""
    ink = ~space[data]
    first = ink.copy()
    first[1:] &= ~ink[:-1]
    last = ink.copy()
    last[:-1] &= ~ink[1:]
    at = off[1:-1]
    at = at[(at > 0) & (at < len(data))]
    first[at] = ink[at]  # a row never goes on in the next
    last[at - 1] = ink[at - 1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    return s, e, np.searchsorted(s, off)


def hash_words(data: np.ndarray, off: np.ndarray, fold: Callable[[np.ndarray], np.ndarray], space: np.ndarray = SPACE, step: int = BLOCK_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the folded words of all rows, and each row's first word (n + 1 entries).

    fold maps bytes to as many bytes; it may look at the byte before, if that is 0xC3. A row of more than two steps
    is read in windows: a word that goes on in the next window is carried as its polynomial and its length.
    """
    if len(data) <= 2 * step:
        low = fold(data)
        s, e, first = words(low, off, space)
        return span_hash(prefix_hash(low), s, e), first
    if len(off) > 2:
        parts = [hash_words(data[off[i] : off[j]], off[i : j + 1] - off[i], fold, space, step) for i, j in blocks(off, step)]
        counts = np.concatenate([np.diff(f) for _, f in parts])
        return np.concatenate([w for w, _ in parts]), np.concatenate([[0], np.cumsum(counts)])
    out, at, held, size = [], 0, 0, 0
    while at < len(data):
        to = min(at + step, len(data))
        while to < len(data) and data[to - 1] == 0xC3:
            to += 1
        low = fold(data[at:to])
        s, e, _ = words(low, np.array([0, len(low)]), space)
        p, down = prefix_hash(low), powers(len(low) + 1)[1]
        value, length = (p[e] - p[s]) * down[s], e - s
        joins = bool(size and len(s) and s[0] == 0)
        if joins:  # the first word began earlier
            value[0] = U64(held + pow(_R, size, 1 << 64) * int(value[0]) & (1 << 64) - 1)
            length[0] += size
        elif size:
            value, length = np.append(U64(held), value), np.append(size, length)
        held = size = 0
        if len(s) and e[-1] == len(low) and to < len(data):
            held, size = int(value[-1]), int(length[-1])
            value, length = value[:-1], length[:-1]
        out.append(mix(value + length.astype(U64)))
        at = to
    if size:
        out.append(mix(np.array([held + size & (1 << 64) - 1], U64)))
    w = np.concatenate(out)
    return w, np.array([0, len(w)])


# --------------------------------------------------------------------------- packed exchange


def pack(pid: np.ndarray, rec: np.ndarray, parts: int) -> Iterator[tuple[int, bytes]]:
    """Groups fixed-width records by target part: one (part, bytes) for each part present."""
    order = np.argsort(pid, kind="stable")
    cut = np.searchsorted(pid[order], np.arange(parts + 1))
    rec = rec[order]
    for k in range(parts):
        if cut[k + 1] > cut[k]:
            yield k, rec[cut[k] : cut[k + 1]].tobytes()


class Packer:
    """Collects records per part and hands out Arrow batches (part int, blob binary) of bounded size."""

    schema = "part int, blob binary"

    def __init__(self, parts: int, dtype: np.dtype, limit: int = 16 << 20):
        self.parts, self.dtype, self.limit, self.held, self.size = parts, dtype, limit, [], 0

    def add(self, rec: np.ndarray, pid: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.held.append((rec, pid))
        self.size += rec.nbytes
        if self.size >= self.limit:
            yield from self.flush()

    def add_all(self, rec: np.ndarray, pid: np.ndarray) -> Iterator[pa.RecordBatch]:
        yield from self.add(rec, pid)
        yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            rec, pid = (np.concatenate([x[k] for x in self.held]) for k in (0, 1))
            self.held, self.size = [], 0
            got = list(pack(pid, rec, self.parts))
            if got:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.int32()), pa.array([b for _, b in got], pa.binary())], ["part", "blob"])


def unpack(batches: Iterator[pa.RecordBatch], dtype: np.dtype) -> np.ndarray:
    """All records that reached this task."""
    got = [np.frombuffer(x.as_buffer(), dtype) for b in batches for x in b.column(b.schema.get_field_index("blob"))]
    return np.concatenate(got) if got else np.zeros(0, dtype)


def exchange(df: DataFrame, parts: int) -> DataFrame:
    """Sends packed records to their parts: part k is partition k."""
    return df.repartitionById(parts, F.col("part"))
