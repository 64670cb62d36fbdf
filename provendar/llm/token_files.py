"""Token-ID files: documents in ascending id order as one stream of token ids, written as coded stretches and read back.

write_tokens() cuts the corpus into ranges of the key with about equal numbers
of rows; each range is one file, its name and rows in key order. A file's row is
a stretch: whole documents of about STRETCH ids, coded by range_coder in
independently reset, checksummed blocks, and beside it the documents' keys, their
numbers of ids and the ids of the range before it. Files are Parquet around the
stretches, so that Spark's committer decides which attempt of a lost task counts.

read_tokens() decodes every block, tests its checksum and gives each document's
ids; digest() only their count, place and checksum.

Defined cases: a null or empty text has the end id alone; a null key comes
first; rows of one key come in the order of their texts' hash (equal texts have
equal ids, so their order cannot be told); one key with very many rows is cut
into several ranges; extra columns are ignored; an empty table gives no rows.
A document's ids, like its text, stand in one row; beyond that, writing holds one
stretch and reading LANES blocks.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common as C
from . import range_coder, vocab

#: The id that ends a document.
END = 2
#: Ids after which a stretch ends with the document: as many as are decoded side by side.
STRETCH = range_coder.BLOCK * range_coder.LANES


def write_tokens(docs: DataFrame, path: str, model: str = vocab.BYTE_LEVEL, key: str = "doc_id", text: str = "text", end: int = END) -> None:
    """Writes the ids of every text (add_special_tokens off, then `end`) under path, in ascending order of key."""
    raw, kind = vocab.read(model), docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).withColumns({"_h": F.xxhash64("_t"), "_u": F.monotonically_increasing_id()})
    parts = C.shuffle_parts(docs.sparkSession)
    placed = rows.repartitionByRange(parts, "_k", "_h", "_u").sortWithinPartitions("_k", "_h", "_u").select("_k", "_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, part, before, seq = vocab.memory(raw, vocab.ByteLevel, False), TaskContext.get().partitionId(), 0, 0
        keys: list[pa.Array] = []
        sizes: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0

        def stretch():
            nonlocal keys, sizes, ids, held, before, seq
            k, n, x = pa.concat_arrays(keys), np.concatenate(sizes), np.concatenate(ids)
            keys, sizes, ids = [], [], []
            one = lambda a: pa.ListArray.from_arrays(pa.array([0, len(a)], pa.int32()), a)
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([before], pa.int64()), one(k), one(pa.array(n)), pa.array([range_coder.encode(x)], pa.binary())], ["part", "seq", "before", "keys", "sizes", "ids"])
            before, seq, held = before + len(x), seq + 1, 0

        for b in batches:
            data, off = C.utf8(b.column(1))
            open_ids: list[np.ndarray] = []
            for i, j, got, at, _, more in memory.parts(data, off):
                if more or open_ids:  # a long text comes in parts
                    open_ids.append(got)
                    if more:
                        continue
                    got, at, open_ids = np.concatenate(open_ids), np.array([0, sum(map(len, open_ids))]), []
                n = np.diff(at) + 1
                every = np.full(len(got) + len(n), end, memory.wide if end < 1 << 16 else np.uint32)
                inside = np.ones(len(every), bool)
                inside[np.cumsum(n) - 1] = False
                every[inside] = got
                keys.append(b.column(0).slice(i, j - i))
                sizes.append(n)
                ids.append(every)
                held += len(every)
                if held >= STRETCH // 4 * 3:
                    yield from stretch()
        if keys:
            yield from stretch()

    C.arrow(placed, run, f"part int, seq int, before long, keys array<{kind}>, sizes array<long>, ids binary").write.option("compression", "none").parquet(path)


def _starts(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The written stretches, and for each range the ids of all ranges before it (a row per range, so it is broadcast)."""
    files = spark.read.parquet(path)
    last = files.groupBy("part").agg(F.max(F.col("before") + F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    return files, last.select(F.col("part").alias("_part"), F.coalesce(before, F.lit(0)).cast("long").alias("_before"))


def _read(spark: SparkSession, path: str, key: str, ids: bool) -> DataFrame:
    files, starts = _starts(spark, path)
    kind = files.schema["keys"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                keys, sizes = b.column(2)[r].values, np.asarray(b.column(3)[r].values)
                part, at = b.column(0)[r].as_py(), b.column(1)[r].as_py()
                doc, crc, got, kept = 0, 0, 0, []
                for x in range_coder.decode(b.column(4)[r].as_buffer()):
                    pos, first, sums, lists = 0, doc, [], []
                    while pos < len(x):
                        take = min(len(x) - pos, int(sizes[doc]) - got)
                        crc = zlib.crc32(x[pos : pos + take].data, crc)
                        if ids:
                            kept.append(x[pos : pos + take])
                        pos, got = pos + take, got + take
                        if got == sizes[doc]:
                            sums.append(crc)
                            if ids:
                                lists.append(np.concatenate(kept).astype(np.int64))
                            doc, crc, got, kept = doc + 1, 0, 0, []
                    n = sizes[first:doc]
                    ends = np.cumsum(n)
                    cols = [keys.slice(first, doc - first), pa.array(np.full(doc - first, part, np.int32)), pa.array(at + ends - n), pa.array(n), pa.array(sums, pa.int64())]
                    at += int(n.sum())
                    if ids:
                        flat = np.concatenate(lists) if lists else np.zeros(0, np.int64)
                        cols.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat)))
                    if doc > first:
                        yield pa.RecordBatch.from_arrays(cols, ["_k", "_part", "_at", "n_tokens", "ids_crc32", *(["token_ids"] if ids else [])])

    out = C.arrow(files.select("part", "before", "keys", "sizes", "ids"), run, f"_k {kind}, _part int, _at long, n_tokens long, ids_crc32 long" + (", token_ids array<long>" if ids else ""))
    joined = out.join(F.broadcast(starts), "_part")
    return joined.select(F.col("_k").alias(key), (F.col("_before") + F.col("_at")).alias("start"), "n_tokens", "ids_crc32", *(["token_ids"] if ids else []))


def read_tokens(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32, token_ids) of every document under path; start counts the ids of all documents before it."""
    return _read(spark, path, key, True)


def digest(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """As read_tokens, without the ids."""
    return _read(spark, path, key, False)


def round_trip(docs: DataFrame, model: str = vocab.BYTE_LEVEL, key: str = "doc_id") -> DataFrame:
    """Writes the files under the shared folder and gives the digest read back from them."""
    spark = docs.sparkSession
    path = f"{C.scratch_root(spark)}/token-ids-{uuid.uuid4().hex}"
    write_tokens(docs, path, model, key)
    return digest(spark, path, key)
