"""Labels in several locales: branches with precedence, first names, status shares and the gates on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..functions import text as T
from . import gates

COLUMNS = ["ref_kind", "ref", "locale", "status", "text"]


def first_names(names: DataFrame, keys: list[str], text: str, order: str) -> DataFrame:
    """The first non-empty text per key in the given order; of equals the smallest text."""
    full = names.where(F.col(text).isNotNull() & (F.trim(text) != ""))
    return full.groupBy(*keys).agg(F.min(F.struct(order, text)).alias("_w")).select(*keys, f"_w.{text}", f"_w.{order}")


def union_branches(branches: list[DataFrame]) -> DataFrame:
    """All branches, with their place as `branch` and the folded text; earlier branches take precedence (see preferred)."""
    out = None
    for k, b in enumerate(branches):
        part = b.select(*COLUMNS).withColumn("branch", F.lit(k))
        out = part if out is None else out.unionByName(part)
    return out.withColumn("text_normalized", T.normalize_label(F.col("text")))


def preferred(labels: DataFrame) -> DataFrame:
    """One label per (ref_kind, ref, locale): the earliest branch, then the smallest text."""
    w = Window.partitionBy("ref_kind", "ref", "locale").orderBy("branch", "text")
    return labels.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def status_share(labels: DataFrame) -> DataFrame:
    """Per locale: labels, labels with an accepted status, and their share."""
    ok = F.count_if(F.col("status").isin(*K.LABEL_OK))
    return labels.groupBy("locale").agg(F.count("*").alias("n"), ok.alias("n_ok")).withColumn("share", F.try_divide("n_ok", "n"))


def status_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("locale", "status").agg(F.count("*").alias("n"))


def review_queue(candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(approved rows as curated labels, counts per locale and decision) of a queue (ref_kind, ref, locale, label, candidate_status); any other status stops it."""
    gates.holds(candidates, F.col("candidate_status").isin("approved", "rejected"), "unknown candidate_status")
    approved = candidates.where("candidate_status = 'approved'").select("ref_kind", "ref", "locale", F.lit("curated").alias("status"), F.col("label").alias("text"))
    return approved, candidates.groupBy("locale", "candidate_status").agg(F.count("*").alias("n"))


def gate_findings(labels: DataFrame, tags: DataFrame, locales: list[str], divergent: DataFrame, glossary: DataFrame | None = None) -> DataFrame:
    """What the label gates object to: (gate, locale, ref). Unreviewed machine translations; tags missing in a locale
    (divergent ones need no generic pt); shares under 0.95; divergent refs with a generic pt or without both variants;
    divergent texts (columns pt-PT, pt-BR, if there) that differ from the glossary (tagname, locale, label)."""
    bad = labels.where("status = 'mt_unreviewed'").select(F.lit("unreviewed").alias("gate"), "locale", "ref")
    wanted = tags.select(F.col("tagname").alias("ref")).withColumn("locale", F.explode(F.array(*map(F.lit, locales))))
    wanted = wanted.join(divergent.select("ref", F.lit("pt").alias("locale")), ["ref", "locale"], "left_anti")
    missing = wanted.join(labels.select("ref", "locale"), ["ref", "locale"], "left_anti").select(F.lit("missing").alias("gate"), "locale", "ref")
    low = status_share(labels).where("share < 0.95").select(F.lit("share").alias("gate"), "locale", F.lit(None).cast("string").alias("ref"))
    own = labels.join(divergent.select("ref"), "ref", "left_semi")
    generic = own.where("locale = 'pt'").select(F.lit("divergent_generic").alias("gate"), "locale", "ref")
    pairs = divergent.select("ref").withColumn("locale", F.explode(F.array(F.lit("pt-PT"), F.lit("pt-BR"))))
    variant = pairs.join(own.select("ref", "locale"), ["ref", "locale"], "left_anti").select(F.lit("divergent_variant").alias("gate"), "locale", "ref")
    out = bad.unionByName(missing).unionByName(low).unionByName(generic).unionByName(variant)
    if glossary is not None:
        own = divergent.select("ref", F.explode(F.map_from_arrays(F.array(F.lit("pt-PT"), F.lit("pt-BR")), F.array("`pt-PT`", "`pt-BR`"))).alias("locale", "text"))
        told = own.join(glossary.select(F.col("tagname").alias("ref"), "locale", "label"), ["ref", "locale"], "left").where(~F.col("text").eqNullSafe(F.col("label")))
        out = out.unionByName(told.select(F.lit("divergent_text").alias("gate"), "locale", "ref"))
    return out
