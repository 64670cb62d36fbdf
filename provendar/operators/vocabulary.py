"""Checks of the hand-kept vocabulary and of release rules. Each returns offenders as (check, ref); no rows means it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed as K
from . import gates

TAG = "^[A-Z][A-Z0-9_]*$"


def _bad(df: DataFrame, check: str, ref: str, condition: Column) -> DataFrame:
    return df.where(F.coalesce(condition, F.lit(True))).select(F.lit(check).alias("check"), F.col(ref).cast("string").alias("ref"))


def vocabulary(nutrients: DataFrame, groups: DataFrame, units: DataFrame, relations: DataFrame, value_types: DataFrame, save) -> DataFrame:
    """nutrients: tagname, group, unit; groups: group; units: unit; relations: parent, child; value_types: id, is_absence.

    Tags well-formed and unique; groups, units and both ends of relations known; no relation to itself, twice, or in a
    circle; the energy tags and the required absence types are there, and absence is true or false.
    """
    wanted = lambda df, values, name: df.sparkSession.createDataFrame([(v,) for v in values], f"{name} string").join(df, name, "left_anti")
    tags = nutrients.select("tagname")
    twice = nutrients.groupBy("tagname").count().where("count > 1")
    ends = relations.select(F.explode(F.array("parent", "child")).alias("tagname")).distinct()
    pair = F.concat_ws(">", "parent", "child").alias("pair")
    repeated = relations.groupBy("parent", "child").count().where("count > 1").select(pair)
    parts = [
        _bad(nutrients, "tag_form", "tagname", ~F.col("tagname").rlike(TAG)),
        twice.select(F.lit("tag_unique").alias("check"), F.col("tagname").alias("ref")),
        _bad(nutrients.join(groups.select("group"), "group", "left_anti"), "group_known", "tagname", F.lit(True)),
        _bad(nutrients.join(units.select("unit"), "unit", "left_anti"), "unit_known", "tagname", F.lit(True)),
        _bad(ends.join(tags, "tagname", "left_anti"), "relation_known", "tagname", F.lit(True)),
        _bad(relations.where("parent = child"), "relation_self", "parent", F.lit(True)),
        _bad(repeated, "relation_twice", "pair", F.lit(True)),
        _bad(gates.cycles(relations, save), "relation_cycle", "node", F.lit(True)),
        _bad(wanted(nutrients, K.ENERGY_TAGS, "tagname"), "energy_tag", "tagname", F.lit(True)),
        _bad(wanted(value_types.where("is_absence = 'true'"), K.ABSENCE_TYPES, "id"), "absence_type", "id", F.lit(True)),
        _bad(value_types, "absence_flag", "id", ~F.col("is_absence").isin("true", "false")),
    ]
    return reduce(lambda a, b: a.unionAll(b), parts)


def licences(sources: DataFrame, allowed: DataFrame, profile: str) -> DataFrame:
    """Sources (source_id, license_id) whose licence the profile (profile, license_id) does not allow."""
    ok = allowed.where(F.col("profile") == profile).select("license_id")
    return sources.join(F.broadcast(ok), "license_id", "left_anti").select(F.lit("licence").alias("check"), F.col("source_id").alias("ref"))


def acquisition(values: DataFrame, types: DataFrame) -> DataFrame:
    """Values without an acquisition type, or with an unknown one."""
    known = values.join(F.broadcast(types.select("acquisition_type")), "acquisition_type", "left_anti")
    return known.select(F.lit("acquisition").alias("check"), F.col("source_record_id").alias("ref"))


def matcher(evaluation: DataFrame, precision: float = 0.98, recall: float = 0.90) -> DataFrame:
    """The evaluation row, if it misses the required precision or recall."""
    return evaluation.where((F.col("precision") < precision) | (F.col("recall") < recall)).select(F.lit("matcher").alias("check"), F.format_string("%.4f/%.4f", "precision", "recall").alias("ref"))
