"""Exact medians by rank selection: no group's values are gathered or sorted by one task beyond a bound."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Different values of a group that one task may order, and buckets that a larger group is cut into.
ORDERED = 1 << 16


def _same(a: DataFrame, b: DataFrame, keys: list[str]):
    """Join condition on keys, nulls equal; b's keys carry the prefix `_b_`."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[f"_b_{k}"]) for k in keys])


def _join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    other = b.select(*[F.col(k).alias(f"_b_{k}") for k in keys], *[c for c in b.columns if c not in keys])
    return a.join(other, _same(a, other, keys)).drop(*[f"_b_{k}" for k in keys])


def _scale(v: Column) -> Column:
    """Rises with v, evenly in its order of magnitude on either side of 0 (746: no logarithm of a double is below -745)."""
    return F.coalesce(F.signum(v) * (F.log(F.abs(v)) + 746), F.lit(0.0))


def medians(rows: DataFrame, keys: list[str], value: str, save, limit: int = ORDERED) -> DataFrame:
    """(keys, median, n, low, high) of the values that are not null; a group of an even number has the mean of its two middle values.

    Values are counted first, so repeated values travel once. A group with up to `limit` different values is ordered by
    one task. Of a larger one only a histogram is made: `limit` buckets between its least and greatest value, by order of magnitude
    first and of equal width once these are near each other, whose counts tell which bucket holds the wanted rank; that bucket is looked at in the same way, until it is small.
    """
    v = save(rows.where(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count("*").alias("_c")))
    groups = v.groupBy(*keys).agg(F.sum("_c").alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    ranks = groups.select(*keys, F.posexplode(F.array(F.expr("(n - 1) div 2"), F.expr("n div 2"))).alias("_which", "_rank"))
    by = [*keys, "_which"]
    todo, found = _join(v, ranks, keys), []
    upto = F.sum("_c").over(Window.partitionBy(*by).orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def pick(df: DataFrame) -> DataFrame:
        """The row of each group whose counts reach the rank; _before: the count of all rows before it."""
        return df.withColumn("_before", upto - F.col("_c")).where((F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_c")))

    while True:
        size = todo.groupBy(*by).agg(F.count("*").alias("_d"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        sized = save(_join(todo, size, by))
        small = (F.col("_d") <= limit) | (F.col("_lo") == F.col("_hi"))
        found.append(pick(sized.where(small).withColumn("_at", F.col("_v"))).select(*by, "_v"))
        large = sized.where(~small)
        if not large.limit(1).count():
            break
        lo, hi = F.col("_lo"), F.col("_hi")
        near = (F.signum(lo) * F.signum(hi) > 0) & (F.greatest(F.abs(lo), F.abs(hi)) <= F.least(F.abs(lo), F.abs(hi)) * 4)
        even = (F.col("_v") / 2 - lo / 2) / (hi / 2 - lo / 2)
        part = F.when(near, even).otherwise((_scale(F.col("_v")) - _scale(lo)) / (_scale(hi) - _scale(lo)))
        cut = large.withColumn("_at", F.floor(part * (limit - 1)))
        counts = cut.groupBy(*by, "_at", "_rank").agg(F.sum("_c").alias("_c"))
        chosen = pick(counts).select(*by, "_at", (F.col("_rank") - F.col("_before")).alias("_left"))
        todo = _join(cut.drop("_d", "_lo", "_hi", "_rank"), chosen, [*by, "_at"]).withColumnRenamed("_left", "_rank").drop("_at")
    both = reduce(lambda x, y: x.unionAll(y), found).groupBy(*keys).agg(F.sum(F.col("_v") * 0.5).alias("median"))
    return _join(groups, both, keys).select(*keys, "median", "n", "low", "high")
