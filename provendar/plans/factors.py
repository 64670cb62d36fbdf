"""Retention factors from a caret-delimited table: method by keyword, median per nutrient and method."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..operators import records
from ..sources import tables
from .store import Scratch


def retention(spark: SparkSession, path: str, columns: list[str], codes: DataFrame, text: str = "description", code: str = "nutrient_code", value: str = "factor") -> DataFrame:
    """(nutrient, method, factor, n, low, high). codes: nutrient_code -> nutrient; rows without a method or a known code are left out."""
    rows = tables.caret(spark, path, columns).withColumn("method", S.classify_method(F.col(text))).where("method is not null")
    named = rows.join(F.broadcast(codes), code).select("nutrient", "method", F.col(value).cast("double").alias("_v"))
    return records.median_factors(named, ["nutrient", "method"], "_v", Scratch(spark).save)
