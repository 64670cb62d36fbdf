"""The build: contract tables of all sources -> canonical tables -> derived values -> labels -> read model -> artifact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import scalar as S
from ..operators import gates, labels, records, selection

VALUE = (
    "concept_id nutrient_id value unit value_type acquisition_type source_id source_record_id source_nutrient_code n_samples standard_deviation "
    "min_value max_value analytical_method confidence_code derivation_id basis below_loq_threshold"
).split()


def concept_id(source_id, food_code):
    """The id of a source's food."""
    return S.entity_id(F.lit("concept"), source_id, F.lit("food"), food_code)


def transform(tables: dict[str, DataFrame], mapping: DataFrame, groups: DataFrame, ledger: DataFrame | None = None, check: bool = True) -> dict[str, DataFrame]:
    """Canonical tables from the contract tables of all sources (each with source_id).

    mapping: source_id, nutrient_code, tagname, factor, unit, energy_method, is_default; groups: source_id, level, code,
    food_group. Missing cells make no row but stay visible through `coverage`. Measures are converted by factor.
    """
    food, value = tables["food"], tables["value"]
    if check:
        gates.covered(value, mapping, ["source_id", "nutrient_code"], "values: nutrient mapping")
        number = F.col("factor").cast("double")
        gates.holds(mapping, (number > 0) & ~F.isnan(number), "a factor is not positive")
    path = S.string_map(F.col("group_path"))
    food = food.select("*", *[F.try_element_at(path, F.lit(k)).alias(f"_c{k}") for k in ("3", "2", "1")])
    for k in ("3", "2", "1"):
        part = groups.where(F.col("level") == k).select("source_id", F.col("code").alias(f"_c{k}"), F.col("food_group").alias(f"_g{k}"))
        food = food.join(F.broadcast(part), ["source_id", f"_c{k}"], "left")
    food = food.withColumn("food_group", F.coalesce("_g3", "_g2", "_g1"))
    if check:
        gates.holds(food, F.col("food_group").isNotNull(), "a food has no group")
    seed = F.concat_ws("|", F.lit("concept"), "source_id", F.lit("food"), "food_code")
    food = food.withColumn("concept_id", concept_id(F.col("source_id"), F.col("food_code"))).withColumn("seed_hash", F.sha2(seed, 256))
    new_ledger = records.ledger_upsert(ledger, food) if ledger is not None else food.select("source_id", "food_code", "concept_id", "seed_hash", F.lit("new").alias("state"))
    if check and ledger is not None:
        both = ledger.select("source_id", "food_code", F.col("concept_id").alias("_old")).join(food, ["source_id", "food_code"])
        gates.none_left(both.where("_old <> concept_id").select("source_id", "food_code"), "a registered id changed")
    food_record = S.entity_id("source_record", F.col("source_id"), "food", F.col("food_code"))
    cell_record = S.entity_id("source_record", F.col("source_id"), "value", F.concat_ws(":", "food_code", "nutrient_code"))
    m = mapping.select("source_id", "nutrient_code", "tagname", F.col("factor").cast("double").alias("_f"), "unit", F.nullif("energy_method", F.lit("-")).alias("analytical_method"))
    cell = value.where("value_kind <> 'missing'").join(F.broadcast(m), ["source_id", "nutrient_code"]).join(food.select("source_id", "food_code", "concept_id"), ["source_id", "food_code"])
    scaled = lambda c: S.convert(F.col(c), F.col("_f"))
    values = cell.select(
        "concept_id", F.col("tagname").alias("nutrient_id"), scaled("value").alias("value"), "unit", S.lookup(K.KIND_TO_TYPE, F.col("value_kind")).alias("value_type"), F.lit("declared").alias("acquisition_type"), "source_id",
        cell_record.alias("source_record_id"), F.col("nutrient_code").alias("source_nutrient_code"), F.lit(None).cast("double").alias("n_samples"), F.lit(None).cast("double").alias("standard_deviation"),
        scaled("min_value").alias("min_value"), scaled("max_value").alias("max_value"), "analytical_method", "confidence_code", F.lit(None).cast("string").alias("derivation_id"), "basis", scaled("threshold").alias("below_loq_threshold"),
    )
    record = food.select(food_record.alias("source_record_id"), "source_id", F.lit("food").alias("kind"), F.col("food_code").alias("ref"), "record")
    record = record.unionAll(cell.select(cell_record.alias("source_record_id"), "source_id", F.lit("value").alias("kind"), F.concat_ws(":", "food_code", "nutrient_code").alias("ref"), cell["record"]))
    return {
        "concept": food.select("concept_id", F.lit("food").alias("kind"), "food_group"),
        "concept_link": food.select("concept_id", food_record.alias("source_record_id"), F.lit("source").alias("status")),
        "source_record": record,
        "value": values.select(*VALUE),
        "coverage": tables["constituent"].join(F.broadcast(m.select("source_id", "nutrient_code", "tagname")), ["source_id", "nutrient_code"]).select("source_id", F.col("tagname").alias("nutrient_id")),
        "name": food.select("concept_id", food_record.alias("source_record_id"), F.explode(S.string_map(F.col("names"))).alias("locale", "text")),
        "ledger": new_ledger,
    }


def counts(value: DataFrame, mapping: DataFrame) -> DataFrame:
    """Per source: cells by kind and conversions (a factor other than 1)."""
    both = value.join(F.broadcast(mapping.select("source_id", "nutrient_code", F.col("factor").cast("double").alias("_f"))), ["source_id", "nutrient_code"], "left")
    kinds = [F.count_if(F.col("value_kind") == k).alias(n) for k, n in (("number", "measured"), ("trace", "trace"), ("below_loq", "below_loq"), ("missing", "not_measured"))]
    return both.groupBy("source_id").agg(*kinds, F.count_if((F.col("_f") != 1) & (F.col("value_kind") != "missing")).alias("conversions"))


def link(canonical: dict[str, DataFrame], links: DataFrame, check: bool = True) -> dict[str, DataFrame]:
    """Applies identity links (absorbed, survivor, status): values move one hop, absorbed concepts stay as tombstones."""
    if check:
        ids = canonical["concept"].select("concept_id")
        gates.covered(links.select(F.col("survivor").alias("concept_id")), ids, ["concept_id"], "links: survivor")
        gates.covered(links.select(F.col("absorbed").alias("concept_id")), ids, ["concept_id"], "links: absorbed")
        gates.unique(links, ["absorbed"], "links")
        gates.none_left(links.alias("a").join(links.alias("b"), F.col("a.survivor") == F.col("b.absorbed")).select("a.survivor"), "a survivor is itself absorbed")
    return canonical | {"value": records.reassign(canonical["value"], links), "tombstone": records.tombstones(links)}


def derive(canonical: dict[str, DataFrame], densities: DataFrame, portions: DataFrame | None = None, check: bool = True) -> dict[str, DataFrame]:
    """Adds calculated values and their derivations, and the density and portion tables they rest on."""
    if check and portions is not None:
        gates.covered(portions, canonical["concept"].select("concept_id"), ["concept_id"], "portions: concept")
    derived, chain = records.derive_volume(canonical["value"], canonical["concept"], densities)
    old = canonical.get("derivation")
    out = canonical | {"value": records.append_derived(canonical["value"], derived), "derivation": chain if old is None else old.unionByName(chain), "density": densities}
    return out if portions is None else out | {"portion": portions}


def label_table(names: DataFrame, glossary: DataFrame, reviewed: DataFrame | None = None, curated: DataFrame | None = None, divergent: DataFrame | None = None) -> DataFrame:
    """Labels of concepts and nutrients: reviewed, native, official (glossary), curated and divergent branches, earlier ones first."""
    native = labels.first_names(names.withColumnRenamed("concept_id", "ref"), ["ref", "locale"], "text", "source_record_id")
    native = native.select(F.lit("concept").alias("ref_kind"), "ref", "locale", F.lit("native").alias("status"), "text")
    official = glossary.select(F.lit("nutrient").alias("ref_kind"), F.col("tagname").alias("ref"), "locale", "status", F.col("label").alias("text"))
    extra = [x for x in (curated, divergent) if x is not None]
    branches = ([reviewed] if reviewed is not None else []) + [native, official, *extra]
    return labels.union_branches(branches)


def read_model(canonical: dict[str, DataFrame], label: DataFrame, rules: DataFrame, default_codes: DataFrame | None = None, overrides: DataFrame | None = None) -> DataFrame:
    """The read model; default_codes (source_id, source_nutrient_code) keep one code per nutrient and source."""
    values = canonical["value"]
    if default_codes is not None:
        values = values.join(F.broadcast(default_codes), ["source_id", "source_nutrient_code"], "left_semi")
    return selection.read_model(values, canonical["concept"], labels.preferred(label), rules, overrides)
