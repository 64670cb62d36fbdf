"""Joins between versions and identities of records: ledger, links, derivation, diff, level fallback."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import scalar as S
from . import ranks


def level_fallback(df: DataFrame, mapping: DataFrame, codes: list[str], out: str = "food_group") -> DataFrame:
    """The mapped group of the deepest level that has one. codes: columns from the deepest level (3) up to 1; mapping: level, code, food_group."""
    got = []
    for level, code in zip(("3", "2", "1"), codes, strict=True):
        part = mapping.where(F.col("level") == level).select(F.col("code").alias(code), F.col("food_group").alias(f"_g{level}"))
        df = df.join(F.broadcast(part), code, "left")
        got.append(f"_g{level}")
    return df.withColumn(out, F.coalesce(*got)).drop(*got)


def reassign(values: DataFrame, links: DataFrame) -> DataFrame:
    """Moves values of absorbed concepts to their survivor, one hop. links: absorbed, survivor, status; only automatic and adjudicated ones count."""
    used = links.where(F.col("status").isin("automatic", "adjudicated")).select(F.col("absorbed").alias("concept_id"), "survivor")
    return values.join(used, "concept_id", "left").withColumn("concept_id", F.coalesce("survivor", "concept_id")).select(values.columns)


def tombstones(links: DataFrame) -> DataFrame:
    used = links.where(F.col("status").isin("automatic", "adjudicated"))
    return used.select(F.col("absorbed").alias("tombstone_id"), F.col("survivor").alias("successor_id"), F.lit("identity_link_f3").alias("reason"))


def ledger_upsert(ledger: DataFrame, foods: DataFrame) -> DataFrame:
    """(source_id, food_code, concept_id, seed_hash, state): state is same, drift (the seed changed, the id stays), new or gone."""
    old = ledger.select("source_id", "food_code", F.col("concept_id").alias("_id"), F.col("seed_hash").alias("_h"))
    both = old.join(foods.select("source_id", "food_code", "concept_id", "seed_hash"), ["source_id", "food_code"], "full_outer")
    state = F.when(F.col("_id").isNull(), "new").when(F.col("seed_hash").isNull(), "gone").when(F.col("_h") == F.col("seed_hash"), "same").otherwise("drift")
    return both.select("source_id", "food_code", F.coalesce("_id", "concept_id").alias("concept_id"), F.coalesce("seed_hash", "_h").alias("seed_hash"), state.alias("state"))


def diff(before: DataFrame, after: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """keys, status (added, removed, changed, same), and before_/after_ of the payload, compared null-safely."""
    a = before.select(*keys, *[F.col(c).alias(f"before_{c}") for c in payload], F.lit(1).alias("_a"))
    b = after.select(*keys, *[F.col(c).alias(f"after_{c}") for c in payload], F.lit(1).alias("_b"))
    same = None
    for c in payload:
        eq = F.col(f"before_{c}").eqNullSafe(F.col(f"after_{c}"))
        same = eq if same is None else same & eq
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(same, "same").otherwise("changed")
    return a.join(b, keys, "full_outer").withColumn("status", status).drop("_a", "_b")


def diff_samples(changes: DataFrame, keys: list[str], limit: int = 20) -> DataFrame:
    """The first `limit` rows of each changed status in key order (a report). Rows are ranked inside hash buckets first, so no task sees a whole status."""
    rank = lambda by: F.row_number().over(Window.partitionBy("status", *by).orderBy(*keys))
    some = changes.where("status <> 'same'").withColumn("_b", F.pmod(F.xxhash64(*keys), F.lit(256))).withColumn("sample", rank(["_b"])).where(F.col("sample") <= limit)
    return some.withColumn("sample", rank([])).where(F.col("sample") <= limit).drop("_b")


def derive_volume(values: DataFrame, concepts: DataFrame, densities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(derived values per 100 ml, derivation rows) for measured per-100-g values of groups with a density.

    A cell that already has a per-100-ml value is left alone; of several source values the one with the
    smallest record id (then source and value) is derived.
    """
    have = values.where(F.col("basis") == K.PER_100ML).select("concept_id", "nutrient_id").distinct()
    base = values.where((F.col("basis") == K.PER_100G) & (F.col("value_type") == "measured") & F.col("value").isNotNull())
    base = base.join(concepts.select("concept_id", "food_group"), "concept_id").join(F.broadcast(densities.select("food_group", "density_g_per_ml")), "food_group")
    base = base.join(have, ["concept_id", "nutrient_id"], "left_anti")
    first = F.row_number().over(Window.partitionBy("concept_id", "nutrient_id").orderBy("source_record_id", "source_id", "value"))
    base = base.withColumn("_r", first).where("_r = 1")
    seed = F.concat_ws("|", F.lit("derivation"), F.col("source_id"), F.lit("volume"), F.concat(F.col("source_record_id"), F.lit(":100ml")))
    base = base.withColumn("derivation_id", F.concat(F.lit(K.ID_PREFIX), S.stable_id(seed)))
    derived = base.withColumn("value", S.per_volume(F.col("value"), F.col("density_g_per_ml"))).withColumn("basis", F.lit(K.PER_100ML)).withColumn("value_type", F.lit("calculated"))
    if "acquisition_type" in values.columns:
        derived = derived.withColumn("acquisition_type", F.lit("calculated"))
    chain = base.select("derivation_id", F.lit("value_per_100g * density").alias("formula"), F.col("source_record_id").alias("inputs"), F.to_json(F.struct(F.col("density_g_per_ml").alias("density"))).alias("factors"))
    return derived.select([c for c in values.columns if c != "derivation_id"] + ["derivation_id"]), chain


def append_derived(values: DataFrame, derived: DataFrame) -> DataFrame:
    return values.unionByName(derived, allowMissingColumns=True)


def median_factors(rows: DataFrame, keys: list[str], value: str, save, scale: float = 100.0) -> DataFrame:
    """Median, count, minimum and maximum per key, divided by scale."""
    m = ranks.medians(rows, keys, value, save)
    return m.select(*keys, F.round(F.col("median") / scale, 4).alias("factor"), "n", (F.col("low") / scale).alias("low"), (F.col("high") / scale).alias("high"))
