"""Order-free digests of tables, so that two versions are compared where they differ and nowhere else.

A table's rows are dealt into cells (its partition columns and a bucket of its key's hash). A cell's digest is the number
of its rows and two sums of their hashes: the same for the same rows in any order or partitioning. Digests are worked out
once, when a version is written. Comparing versions reads the digests first; cells that agree need no look at their rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import records

#: Buckets of the key's hash in each group of rows.
BUCKETS = 256


def bucket(keys: list[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(df: DataFrame, keys: list[str], payload: list[str], by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """(by, bucket, n, sum1, sum2): a grouped sum with partial sums, a row per cell."""
    row = [F.to_json(F.struct(*payload), {"ignoreNullFields": "false"})] if any("<" in df.schema[c].dataType.simpleString() for c in payload) else [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in payload]
    one, two = F.xxhash64(*keys, *row), F.xxhash64(F.lit(7), *row, *keys)
    return df.groupBy(*by, bucket(keys, buckets).alias("bucket")).agg(F.count("*").alias("n"), F.sum(one.cast("decimal(38,0)")).alias("sum1"), F.sum(two.cast("decimal(38,0)")).alias("sum2"))


def differing(before: DataFrame, after: DataFrame, by: list[str]) -> DataFrame:
    """(by, bucket) of the cells whose digests differ."""
    cell = [*by, "bucket"]
    a = before.select(*cell, F.struct("n", "sum1", "sum2").alias("_a"))
    b = after.select(*cell, F.struct("n", "sum1", "sum2").alias("_b"))
    return a.join(b, cell, "full_outer").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*cell)


def changes(before: DataFrame, after: DataFrame, cells: DataFrame, keys: list[str], payload: list[str], by: list[str], buckets: int = BUCKETS) -> DataFrame:
    """records.diff without the rows that stayed the same, over differing cells alone.

    cells: what `differing` gave; at most `buckets` rows per value of `by`, which are few (partitions). Values of `by` that
    occur in no cell are left out as a condition, so partitions and row groups without a change are not read.
    """
    if not (found := cells.distinct().collect()):
        return records.diff(before, after, keys, payload).limit(0)
    some = cells.sparkSession.createDataFrame(found, cells.schema)
    only = reduce(lambda x, y: x & y, [F.col(c).isin(*sorted({r[c] for r in found}, key=str)) for c in by]) if by else F.lit(True)
    part = lambda df: df.where(only).withColumn("bucket", bucket(keys, buckets)).join(F.broadcast(some), [*by, "bucket"], "left_semi").drop("bucket")
    return records.diff(part(before), part(after), keys, payload).where("status <> 'same'")
