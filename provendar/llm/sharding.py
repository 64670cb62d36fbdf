"""Sharding by proportional stratified interleaving.

Rows of each source are ranked in a seeded shuffle, all rows are sorted by
their fractional rank (rank - 1/2) / (rows of the source), and the sorted
sequence is cut into equal runs. So row counts differ by at most one (law
`rows`), and every shard has the corpus mixture: of a source with n rows, each
of the shards holds n / shards rows to within two.

Both rankings are made of two parts, so that no task ever sees a whole source:
rows fall into hash buckets (for the first) or rank buckets (for the second),
bucket counts are summed first (in blocks, for the same reason), and a row's
rank is the rows of earlier buckets plus its number inside its own bucket. A
source with a third of all rows therefore spreads over as many tasks as its
buckets. Rows that are equal in all that counts are ranked once, with their
number, and dealt out again in chunks.

Groups of equal texts: law `rows` fixes the counts, so it cannot keep a group
in one shard (a group may be larger than a shard). Copies are shuffled like
all other rows of their source and spread over the shards in proportion.

Defined cases: a null source is a stratum of its own, a null text has size 8
and the checksum of the empty text, repeated rows and ids each take their own
slot, an empty table gives an empty result, extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common as C

#: Rows aimed at in a bucket of either ranking, buckets whose counts are summed at once, copies that one task deals out.
BUCKET_ROWS, BLOCK_BUCKETS, CHUNK = 512, 4096, 10_000


def _before(counts: DataFrame, bucket: str, n: str, of: list[str]) -> DataFrame:
    """counts (of, bucket, n) with _before: the rows of earlier buckets of the same `of`, summed in blocks."""
    block = F.floor(F.col(bucket) / BLOCK_BUCKETS)
    counts = counts.withColumn("_blk", block)
    inside = F.sum(n).over(Window.partitionBy(*of, "_blk").orderBy(bucket)) - F.col(n)
    blocks = counts.groupBy(*of, "_blk").agg(F.sum(n).alias("_m"))
    blocks = blocks.withColumn("_start", F.sum("_m").over(Window.partitionBy(*of).orderBy("_blk")) - F.col("_m"))
    return counts.withColumn("_in", inside).join(blocks, [*of, "_blk"]).select(*of, bucket, (F.col("_in") + F.col("_start")).alias("_before"))


def _dealt(rows: DataFrame, most: int) -> DataFrame:
    """Each row _m times, with _i from 0; a row with very many copies is dealt out by many tasks."""
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    if most <= 1:
        return rows.withColumn("_i", F.lit(0).cast("long"))
    few = rows.where(F.col("_m") <= CHUNK).withColumn("_i", upto(F.col("_m")))
    if most <= CHUNK:
        return few
    many = rows.where(F.col("_m") > CHUNK).withColumn("_c", upto(F.ceil(F.col("_m") / CHUNK))).repartition("_k", "_s", "_c")
    many = many.withColumn("_i", upto(F.least(F.lit(CHUNK).cast("long"), F.col("_m") - F.col("_c") * CHUNK))).withColumn("_i", F.col("_c") * CHUNK + F.col("_i"))
    return few.unionByName(many.drop("_c"))


def _share(a: Column, b: Column, parts: int) -> Column:
    """floor(a * parts / b) for 0 <= a < b."""
    return F.least(F.floor(a * F.lit(parts) / b), F.lit(parts - 1).cast("long"))


def interleave(docs: DataFrame, shards: int = 24, seed: int = 20240607, text: str = "text", source: str = "source", key: str = "doc_id") -> DataFrame:
    """(key, size, text_crc32, law, shard, slot, grown_shard) for every row."""
    rows = docs.select(
        F.col(key).alias("_k"),
        F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n")).alias("_s"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 8).alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
    )
    rows = rows.groupBy("_k", "_s", "size", "text_crc32").agg(F.count("*").alias("_m")).withColumn("_h", F.xxhash64(F.lit(seed), "_k", "text_crc32"))
    rows = C.save(rows, "sharding-rows")  # texts are read once; what follows needs some forty bytes a row
    total, most = rows.agg(F.coalesce(F.sum("_m"), F.lit(0)), F.coalesce(F.max("_m"), F.lit(1))).first()
    parts = max(1, -(-total // BUCKET_ROWS))
    # order of the seeded shuffle: hash bucket first, then the hash itself
    rows = rows.withColumn("_b", F.pmod("_h", F.lit(parts)))
    at = rows.groupBy("_s", "_b").agg(F.sum("_m").alias("_n"))
    all_of = at.groupBy("_s").agg(F.sum("_n").alias("_all"))
    inside = F.sum("_m").over(Window.partitionBy("_s", "_b").orderBy("_h", "_k", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_m")
    rows = rows.withColumn("_r", inside).join(_before(at, "_b", "_n", ["_s"]), ["_s", "_b"]).withColumn("_r", F.col("_r") + F.col("_before") + 1).drop("_b", "_before", "_h")
    # fractional rank as an exact fraction (2r - 1) / 2n; buckets of equal width on it
    rows = _dealt(rows, most).withColumn("_r", F.col("_r") + F.col("_i")).drop("_i", "_m").join(all_of, "_s")
    rows = rows.withColumn("_f", (2 * F.col("_r") - 1) / (2 * F.col("_all"))).withColumn("_g", _share(2 * F.col("_r") - 1, 2 * F.col("_all"), parts)).drop("_all")
    runs = rows.groupBy("_g").agg(F.count("*").alias("_n"))
    # one row per bucket: at most rows / BUCKET_ROWS of them
    place = F.row_number().over(Window.partitionBy("_g").orderBy("_f", "_s", "_r"))
    rows = rows.withColumn("_p", place).join(_before(runs.withColumn("_one", F.lit(1)), "_g", "_n", ["_one"]), "_g").withColumn("_p", F.col("_p") + F.col("_before") - 1)
    # integer arithmetic throughout: shard = p * shards div total
    rows = rows.withColumn("shard", F.expr(f"cast((_p * {shards}L) div {max(total, 1)}L as int)"))
    first = F.expr(f"(shard * {max(total, 1)}L + {shards - 1}L) div {shards}L")
    return rows.select(F.col("_k").alias(key), "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("_p") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
