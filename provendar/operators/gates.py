"""Gates: conditions that must hold, or the build stops. Each is one distributed job whose result is at most a few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class ContractError(ValueError):
    """A table broke its contract."""


class Watch:
    """Counters of a table and conditions on its rows, worked out in the pass that writes it: no job of their own.

    Write `df` instead of the table, then ask for counts(). A row that breaks a condition stops it there.
    """

    def __init__(self, table: DataFrame, counters: dict[str, Column], conditions: dict[str, Column] | None = None):
        self.conditions = dict(conditions or {})
        self._seen = Observation()
        broken = [F.count_if(~F.coalesce(c, F.lit(False))).alias(f"!{k}") for k, c in self.conditions.items()]
        self.df = table.observe(self._seen, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in counters.items()], *broken)

    def counts(self) -> dict[str, int]:
        got = self._seen.get
        if bad := {k: got[f"!{k}"] for k in self.conditions if got[f"!{k}"]}:
            raise ContractError(", ".join(f"{k}: {n} rows" for k, n in bad.items()))
        return {k: v for k, v in got.items() if not k.startswith("!")}


def none_left(df: DataFrame, what: str, examples: int = 5) -> None:
    """df must be empty."""
    got = df.limit(examples).collect()
    if got:
        raise ContractError(f"{what}: {[tuple(r) for r in got]}")


def unique(df: DataFrame, keys: list[str], what: str) -> None:
    none_left(df.groupBy(*keys).count().where("count > 1"), f"{what}: repeated key")


def unknown(df: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of df that dim does not hold."""
    return df.select(*keys).distinct().join(dim.select(*keys), keys, "left_anti")


def covered(df: DataFrame, dim: DataFrame, keys: list[str], what: str) -> None:
    """Every key of df must be in dim."""
    none_left(unknown(df, dim, keys), f"{what}: unknown key")


def holds(df: DataFrame, condition: Column, what: str) -> None:
    none_left(df.where(~F.coalesce(condition, F.lit(False))), what)


#: Rows up to which a dimension is broadcast: its table is built in the driver.
FEW = 500_000


def lookup(dim: DataFrame, few: int | None = None) -> DataFrame:
    """dim for a join with a larger table: broadcast if it has at most `few` rows (one small job counts them). Otherwise neither side is, however small Spark takes it for."""
    few = FEW if few is None else few
    return F.broadcast(dim) if dim.limit(few + 1).count() <= few else dim.hint("merge")


def lookup_join(df: DataFrame, dim: DataFrame, keys: list[str], what: str, check: bool = True) -> DataFrame:
    """Left join of a small dimension; a miss is fatal."""
    if check:
        covered(df, dim, keys, what)
    return df.join(dim, keys, "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, limit: int | None = 6) -> DataFrame:
    """Distinct keys of child without a parent, smallest first."""
    keys = child.select(F.col(child_key).alias("orphan")).where("orphan is not null").distinct()
    out = keys.join(parent.select(F.col(parent_key).alias("orphan")), "orphan", "left_anti").orderBy("orphan")
    return out.limit(limit) if limit else out


#: Rounds that peel off nodes without a parent or without a child, before paths are looked for.
PEELED = 8


def cycles(edges: DataFrame, save, parent: str = "parent", child: str = "child") -> DataFrame:
    """Nodes that reach themselves.

    A node without a parent or without a child lies on no cycle: such nodes go with their edges, some rounds long, which takes
    most of a graph that is nearly free of cycles. Among the edges that stay, reachable pairs are doubled in length, without repeats,
    until nothing is new: as many rounds as the longest path has doublings. save cuts the lineage of each round.
    """
    reach = save(edges.select(F.col(parent).alias("p"), F.col(child).alias("c")).where("p is not null and c is not null").distinct())
    n = reach.count()
    for _ in range(PEELED):
        inner = reach.join(reach.select(F.col("c").alias("p")).distinct(), "p", "left_semi").join(reach.select(F.col("p").alias("c")).distinct(), "c", "left_semi")
        reach = save(inner.select("p", "c"))
        if (m := reach.count()) in (n, 0):
            break
        n = m
    n = reach.count()
    while n:
        far = reach.select(F.col("p"), F.col("c").alias("m")).join(reach.select(F.col("p").alias("m"), F.col("c")), "m").select("p", "c")
        nxt = save(reach.unionAll(far).distinct())
        if (m := nxt.count()) == n:
            break
        reach, n = nxt, m
    return reach.where("p = c").select(F.col("p").alias("node"))
