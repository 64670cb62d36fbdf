"""Read queries over the read model and the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as K
from .search import SearchError, chain_of


def first_locale(model: DataFrame, locale: str, keys: list[str], chains: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows of the first locale of the chain that has any, per key (no keys: overall)."""
    chain = chain_of(locale, chains)
    some = model.where(F.col("locale").isin(*chain)).withColumn("_hop", F.array_position(F.array(*map(F.lit, chain)), F.col("locale")))
    best = some.groupBy(*keys).agg(F.min("_hop").alias("_hop"))
    out = some.join(F.broadcast(best), "_hop", "left_semi") if not keys else some.join(best, [*keys, "_hop"], "left_semi")
    return out.select(model.columns)


def foods_for_nutrient(model: DataFrame, nutrient_id: str, locale: str, limit: int = 20, food_group: str | None = None) -> DataFrame:
    """The foods richest in a nutrient: value falling, then concept."""
    if not 1 <= limit <= 100:
        raise SearchError("limit must be from 1 to 100")
    rows = model.where((F.col("nutrient_id") == nutrient_id) & F.col("value").isNotNull())
    if food_group is not None:
        rows = rows.where(F.col("food_group") == food_group)
    return first_locale(rows, locale, []).orderBy(F.desc("value"), "concept_id").limit(limit)


def food_values(model: DataFrame, concept_id, locale: str) -> DataFrame:
    """All preferred values of a food in the first locale of the chain that has any."""
    return first_locale(model.where((F.col("concept_id") == concept_id) & F.col("value").isNotNull()), locale, ["concept_id"])


def coverage_by_source(values: DataFrame, groups: tuple[str, ...] = ()) -> DataFrame:
    """Foods, nutrients and values per source (and group)."""
    return values.groupBy("source_id", *groups).agg(F.count_distinct("concept_id").alias("n_foods"), F.count_distinct("nutrient_id").alias("n_nutrients"), F.count("*").alias("n_values"))


def summary(values: DataFrame, concepts: DataFrame) -> DataFrame:
    """One row of totals."""
    a = values.agg(F.count("*").alias("n_values"), F.count_distinct("nutrient_id").alias("n_nutrients"), F.count_distinct("source_id").alias("n_sources"))
    b = concepts.agg(F.count("*").alias("n_concepts"))
    return a.join(b)


def not_measured(coverage: DataFrame, values: DataFrame, keys: list[str]) -> DataFrame:
    """Keys the coverage promises but no value has."""
    return coverage.select(*keys).distinct().join(values.select(*keys).distinct(), keys, "left_anti")


def composition(items: DataFrame, model: DataFrame) -> DataFrame:
    """Totals of a recipe (concept_id, grams): sum of value * grams / 100 per nutrient, missing values as 0."""
    both = items.join(model, "concept_id", "left")
    return both.where("nutrient_id is not null").groupBy("nutrient_id").agg(F.sum(F.coalesce("value", F.lit(0.0)) * F.col("grams") / 100).alias("total"))


def spread(values: DataFrame, keys: list[str]) -> DataFrame:
    """Keys whose least value is under 0.7 of the greatest (at least two values)."""
    s = values.where("value is not null").groupBy(*keys).agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    return s.where((F.col("n") > 1) & (F.try_divide("low", "high") < K.LITE_DIVERGENCE_RATIO))


def lite(model: DataFrame, nutrients: list[str], locale: str = "en") -> DataFrame:
    return model.where(F.col("nutrient_id").isin(*nutrients) & (F.col("locale") == locale))


def values_by_source(values: DataFrame, nutrients: DataFrame, sources: DataFrame, concept_id=None) -> DataFrame:
    """Every value with its nutrient's name and its source's name, version and licence (of one concept, if named)."""
    some = values if concept_id is None else values.where(F.col("concept_id") == concept_id)
    named = some.join(nutrients.select(F.col("tagname").alias("nutrient_id"), "name_en"), "nutrient_id")
    return named.join(sources.select("source_id", F.col("name").alias("source_name"), "version", "license_id"), "source_id")


def food_matrix(model: DataFrame, nutrients: DataFrame, locale: str, concept_id=None, chains: dict[str, list[str]] | None = None) -> DataFrame:
    """Preferred values, nulls included, in the first locale that has any for the concept: the locale itself, then the value locales' own order; with the nutrients' names."""
    chains = K.VALUE_CHAINS if chains is None else chains
    chain = {locale: [*chains.get(locale, K.CHAINS.get(locale, []))]} | {x: [] for x in chains.get(locale, K.CHAINS.get(locale, []))}
    some = model if concept_id is None else model.where(F.col("concept_id") == concept_id)
    return first_locale(some, locale, ["concept_id"], chain).join(nutrients.select(F.col("tagname").alias("nutrient_id"), "name_en"), "nutrient_id")


def client_values(model: DataFrame, concept_id=None) -> DataFrame:
    """Preferred values, nulls included, in the first of the client's locales that has any for the concept."""
    first, *rest = K.CLIENT_LOCALES
    some = model if concept_id is None else model.where(F.col("concept_id") == concept_id)
    return first_locale(some, first, ["concept_id"], {first: rest} | {x: [] for x in rest})


def coverage_of_concepts(values: DataFrame, nutrients: DataFrame, sources: DataFrame) -> DataFrame:
    """Per concept and source: nutrients covered, and how many there are."""
    total = nutrients.agg(F.count("*").alias("n_total"))
    n = values.groupBy("concept_id", "source_id").agg(F.count_distinct("nutrient_id").alias("n_covered"))
    return n.join(sources.select("source_id", F.col("name").alias("source_name"), "version"), "source_id").join(total)


def food_groups(concepts: DataFrame, groups: DataFrame) -> DataFrame:
    """The groups that concepts are in, with their names."""
    return concepts.select("food_group").distinct().join(groups.select(F.col("id").alias("food_group"), "name_pt", "name_en"), "food_group").orderBy("food_group")


def nutrient_catalog(nutrients: DataFrame) -> DataFrame:
    return nutrients.select("tagname", "name_en", "unit").orderBy("tagname")
