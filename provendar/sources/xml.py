"""Source A: five XML files of flat records, read with Spark's XML reader under an all-string schema (codes keep leading zeros)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import gates

FOOD = ["alim_code", "alim_nom_fr", "alim_nom_eng", "alim_nom_sci", "alim_grp_code", "alim_ssgrp_code", "alim_ssssgrp_code", "facteur_Jones"]
LEVELS = ("grp", "ssgrp", "ssssgrp")
GROUP = [f"alim_{level}_{c}" for level in LEVELS for c in ("code", "nom_fr", "nom_eng")]
CELL = ["alim_code", "const_code", "teneur", "min", "max", "code_confiance", "source_code"]
CONFIDENCE = ("A", "B", "C", "D")


def records(spark: SparkSession, path: str, tag: str, columns: list[str]) -> DataFrame:
    """One row per element `tag`: its children's text, trimmed, empty ones null."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    raw = spark.read.format("xml").option("rowTag", tag).option("ignoreSurroundingSpaces", True).option("mode", "FAILFAST").schema(schema).load(path)
    return raw.select(*[F.nullif(F.trim(F.col(c)), F.lit("")).alias(c) for c in columns])


def foods(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    df = records(spark, path, "ALIM", FOOD)
    if check:
        gates.holds(df, F.col("alim_code").isNotNull() & F.col("alim_nom_fr").isNotNull() & F.col("alim_grp_code").isNotNull(), "a food lacks a required cell")
        gates.unique(df, ["alim_code"], "foods")
        gates.holds(df, F.col("facteur_Jones").isNull() | S.decimal(F.col("facteur_Jones")).isNotNull(), "a factor is not a number")
    return df


def groups(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """(level 1..3, code, name) of the three levels; all-zero placeholders go; one name per code."""
    df = records(spark, path, "ALIM_GRP", GROUP)
    parts = [df.select(F.lit(str(k + 1)).alias("level"), F.col(f"alim_{level}_code").alias("code"), F.col(f"alim_{level}_nom_fr").alias("name")) for k, level in enumerate(LEVELS)]
    out = reduce(lambda a, b: a.unionAll(b), parts).where(F.col("code").isNotNull() & ~F.col("code").rlike("^0+$"))
    out = out.groupBy("level", "code").agg(F.min("name").alias("name"), F.count_distinct("name").alias("n"))
    if check:
        gates.none_left(out.where("n > 1"), "a group has several names")
    return out.drop("n")


def constituents(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """(nutrient_code, name, unit): the unit stands in the name."""
    df = records(spark, path, "CONST", ["const_code", "const_nom_fr"])
    out = df.select(F.col("const_code").alias("nutrient_code"), F.col("const_nom_fr").alias("name"), S.unit_of(F.col("const_nom_fr")).alias("unit"))
    if check:
        gates.holds(out, F.col("unit").isNotNull(), "a constituent has no unit")
        gates.unique(out, ["nutrient_code"], "constituents")
    return out


def citations(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    df = records(spark, path, "SOURCES", ["source_code", "ref_citation"])
    if check:
        gates.unique(df, ["source_code"], "citations")
    return df


def cells(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Typed composition cells: food_code, nutrient_code, value, value_kind, threshold, min_value, max_value, confidence_code, source_code, basis, record."""
    raw = records(spark, path, "COMPO", CELL)
    cell = S.parse_cell(F.coalesce("teneur", F.lit("-")), F.concat_ws("/", "alim_code", "const_code"))
    out = raw.select(
        F.col("alim_code").alias("food_code"), F.col("const_code").alias("nutrient_code"), cell.alias("c"), S.parse_bound(F.col("min")).alias("min_value"), S.parse_bound(F.col("max")).alias("max_value"),
        F.col("code_confiance").alias("confidence_code"), "source_code", S.canonical_json(CELL).alias("record"),
    )
    below = F.col("c.kind") == "below_loq"
    out = out.select(
        "food_code", "nutrient_code", F.when(~below, F.col("c.value")).alias("value"), F.col("c.kind").alias("value_kind"), F.when(below, F.col("c.value")).alias("threshold"),
        "min_value", "max_value", "confidence_code", "source_code", F.lit("per_100g_edible").alias("basis"), "record",
    )
    if check:
        gates.unique(out, ["food_code", "nutrient_code"], "cells")
        gates.holds(out, F.col("confidence_code").isNull() | F.col("confidence_code").isin(*CONFIDENCE), "unknown confidence code")
    return out


def extract(spark: SparkSession, folder: str, names: dict[str, str]) -> dict[str, DataFrame]:
    """The four contract tables of source A. names: alim, grp, const, compo, sources -> file name."""
    at = {k: f"{folder}/{v}" for k, v in names.items()}
    f, g, c, v, s = foods(spark, at["alim"]), groups(spark, at["grp"]), constituents(spark, at["const"]), cells(spark, at["compo"]), citations(spark, at["sources"])
    gates.covered(v, f.select(F.col("alim_code").alias("food_code")), ["food_code"], "cells: food")
    gates.covered(v, c, ["nutrient_code"], "cells: constituent")
    gates.covered(v.where("source_code is not null"), s, ["source_code"], "cells: citation")
    gates.covered(f.select(F.lit("1").alias("level"), F.col("alim_grp_code").alias("code")), g, ["level", "code"], "foods: group")
    food = f.select(
        F.col("alim_code").alias("food_code"), F.col("alim_nom_fr").alias("name"), F.to_json(F.struct(F.col("alim_nom_eng").alias("en"), F.col("alim_nom_fr").alias("fr"))).alias("names"),
        F.to_json(F.struct(F.col("alim_grp_code").alias("1"), F.col("alim_ssgrp_code").alias("2"), F.col("alim_ssssgrp_code").alias("3"))).alias("group_path"), S.canonical_json(FOOD).alias("record"),
    )
    return {"food": food, "food_group": g, "constituent": c, "value": v.drop("source_code")}
