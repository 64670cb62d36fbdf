"""The read facade over an artifact: every answer is a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import search, views
from .plans import artifact


class Engine:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.tables = spark, folder, artifact.open_artifact(spark, folder)

    def __enter__(self) -> Engine:
        return self

    def __exit__(self, *_) -> None:
        self.tables = {}

    def search(self, query: str, locale: str, limit: int = 20, kind: str | None = None, food_group: str | None = None) -> DataFrame:
        t = self.tables
        index = search.Index(**{field: t[name] for name, field in search.INDEX_TABLES.items()})
        found = search.search(t["label"], query, locale, limit, kind, t.get("concept"), food_group, index)
        return search.display_labels(found, t["label"], locale)

    def food_values(self, concept_id: str, locale: str) -> DataFrame:
        return views.food_values(self.tables["mv_food_value"], concept_id, locale)

    def foods_for_nutrient(self, nutrient_id: str, locale: str, limit: int = 20, food_group: str | None = None) -> DataFrame:
        return views.foods_for_nutrient(self.tables["mv_food_value"], nutrient_id, locale, limit, food_group)

    def provenance(self, source_record_id: str) -> DataFrame:
        """The record with its source."""
        record = self.tables["source_record"].where(F.col("source_record_id") == source_record_id)
        if "source" not in self.tables:
            return record
        source = self.tables["source"]
        return record.join(F.broadcast(source.select("source_id", *[F.col(c).alias(f"source_{c}") for c in source.columns if c != "source_id"])), "source_id", "left")  # a row per registered source

    def nutrients(self) -> DataFrame:
        """The nutrients, by group and tag."""
        return self.tables["nutrient"].orderBy("group", "tagname")

    def metadata(self) -> DataFrame:
        """When, by what and as which profile the artifact was built: (key, value)."""
        return self.tables["build_metadata"].orderBy("key")

    def coverage(self) -> DataFrame:
        return views.coverage_by_source(self.tables["value"])

    def composition(self, items: DataFrame, locale: str) -> DataFrame:
        return views.composition(items, views.first_locale(self.tables["mv_food_value"], locale, ["concept_id"]))

    def available_locales(self) -> DataFrame:
        return self.tables["mv_food_value"].select("locale").distinct().orderBy("locale")

    def food_groups(self) -> DataFrame:
        return self.tables["concept"].select("food_group").distinct().orderBy("food_group")

    def diff(self, other: Engine) -> DataFrame:
        return artifact.diff(self.tables["mv_food_value"], other.tables["mv_food_value"])

    def changes(self, other: Engine) -> DataFrame:
        """What diff() gives but for the rows that stayed the same; parts whose digests agree are not read."""
        return artifact.changes(self.spark, self.folder, other.folder)
