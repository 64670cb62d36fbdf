"""The artifact: Parquet tables with search indexes and a manifest; reports, exports and comparison of versions."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import VERSION
from ..functions import fixed as K
from ..functions import scalar as S
from ..operators import digests, gates, records, search, views

MODEL_KEYS = ["concept_id", "nutrient_id", "locale", "basis"]
SCHEMA_VERSION = "1"
#: The order in which each table is written; other tables go by their columns.
ORDER = {
    "mv_food_value": ["locale", "concept_id", "nutrient_id", "basis"], "label": ["ref_kind", "ref", "locale", "branch", "text"], "concept": ["concept_id"], "value": ["concept_id", "nutrient_id", "basis", "source_id", "source_record_id"],
    "source_record": ["source_record_id"], "concept_link": ["concept_id", "source_record_id"], "derivation": ["derivation_id"], "tombstone": ["tombstone_id"], "density": ["food_group"], "portion": ["concept_id", "measure"],
}


def in_order(df: DataFrame, name: str) -> DataFrame:
    """df in the total order of its table: range-partitioned, so no task sees more than its share, and the same files' rows for the same data."""
    sortable = [c for c, t in df.dtypes if not t.startswith("map")]
    first = [c for c in ORDER.get(name, []) if c in df.columns]
    return df.orderBy(*first, *[c for c in sortable if c not in first])


def build_metadata(spark: SparkSession, profile: str, built_at: str | None = None) -> DataFrame:
    """(key, value): when, by what and as which profile the artifact was built. The only part of an artifact that depends on the time."""
    now = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX") if built_at is None else F.lit(built_at)
    rows = {"built_at": now, "engine_version": F.lit(VERSION), "spark_version": F.lit(spark.version), "schema_version": F.lit(SCHEMA_VERSION), "profile": F.lit(profile)}
    return spark.range(1).select(F.explode(F.map_from_arrays(F.array(*map(F.lit, rows)), F.array(*rows.values()))).alias("key", "value"))


def write(tables: dict[str, DataFrame], folder: str, profile: str = "full", lite_nutrients: list[str] | None = None, built_at: str | None = None) -> dict[str, int]:
    """Writes mv_food_value (by locale), label, its trigram and word indexes, the given tables and build_metadata, each in its order; returns row counts.

    The lite profile keeps the listed nutrients and locale en in the read model and empties value and source_record.
    """
    if profile not in ("full", "lite", "extended"):
        raise gates.ContractError(f"unknown profile {profile}")
    out = dict(tables)
    if profile == "lite":
        out["mv_food_value"] = views.lite(out["mv_food_value"], lite_nutrients or [])
        out |= {k: out[k].limit(0) for k in ("value", "source_record") if k in out}
    label = out["label"]
    if "label_id" not in label.columns:
        key = F.concat_ws("|", "ref_kind", "ref", "locale", F.col("branch").cast("string"), "text")
        label = out["label"] = label.withColumn("label_id", F.xxhash64(key))
    counts = {}
    spark = label.sparkSession
    out["build_metadata"] = build_metadata(spark, profile, built_at)
    for name, df in out.items():
        w = in_order(df, name).write.mode("overwrite")
        (w.partitionBy("locale") if name == "mv_food_value" else w).parquet(f"{folder}/{name}")
    model = spark.read.parquet(f"{folder}/mv_food_value")
    digests.digests(model, MODEL_KEYS, _payload(model), ["locale"]).coalesce(1).write.mode("overwrite").parquet(f"{folder}/_digests")  # a few hundred rows a locale
    saved = spark.read.parquet(f"{folder}/label")
    search.write_index(saved, folder)
    for name in (*out, *search.INDEX_TABLES):
        counts[name] = spark.read.parquet(f"{folder}/{name}").count()
    manifest = json.dumps({"profile": profile, "rows": counts}, sort_keys=True)
    spark.createDataFrame([(manifest,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/_manifest")
    return counts


def checks(tables: dict[str, DataFrame]) -> DataFrame:
    """(check, orphan): keys without a parent among the canonical tables, acquisition types missing."""
    pairs = (("value", "concept_id", "concept", "concept_id"), ("mv_food_value", "concept_id", "concept", "concept_id"), ("value", "source_record_id", "source_record", "source_record_id"), ("concept_link", "concept_id", "concept", "concept_id"), ("concept_link", "source_record_id", "source_record", "source_record_id"), ("tombstone", "successor_id", "concept", "concept_id"), ("value", "derivation_id", "derivation", "derivation_id"))
    out = None
    for child, key, parent, parent_key in pairs:
        if child in tables and parent in tables:
            part = gates.orphans(tables[child], tables[parent], key, parent_key).select(F.lit(f"{child}.{key}").alias("check"), F.col("orphan").cast("string").alias("orphan"))
            out = part if out is None else out.unionAll(part)
    if "label" in tables and "nutrient" in tables:
        own = tables["label"].where("ref_kind = 'nutrient'")
        part = gates.orphans(own, tables["nutrient"], "ref", "tagname").select(F.lit("label.ref").alias("check"), F.col("orphan").cast("string").alias("orphan"))
        out = part if out is None else out.unionAll(part)
    if "value" in tables:
        bad = tables["value"].where("acquisition_type is null").select(F.lit("value.acquisition_type").alias("check"), F.col("source_record_id").alias("orphan")).limit(6)
        out = bad if out is None else out.unionAll(bad)
    return out


def diff(before: DataFrame, after: DataFrame, payload: list[str] | None = None) -> DataFrame:
    """Changes between two read models on (concept, nutrient, locale, basis)."""
    return records.diff(before, after, MODEL_KEYS, payload or ["value", "unit", "value_type", "source_id"])


def _payload(model: DataFrame) -> list[str]:
    return [c for c in ("value", "unit", "value_type", "source_id") if c in model.columns]


def changes(spark: SparkSession, before: str, after: str) -> DataFrame:
    """Added, removed and changed rows of the read models of two artifact folders. Locales and buckets whose digests agree are not read."""
    a, b = (spark.read.parquet(f"{x}/mv_food_value") for x in (before, after))
    cells = digests.differing(*(spark.read.parquet(f"{x}/_digests") for x in (before, after)), ["locale"])
    return digests.changes(a, b, cells, MODEL_KEYS, _payload(a), ["locale"])


def jsonl(df: DataFrame, folder: str) -> None:
    """One JSON object per row, sorted by the first column and then the rest."""
    df.orderBy(*df.columns).select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(folder)


def json_ld(concepts: DataFrame, label: DataFrame, model: DataFrame, tombstones: DataFrame | None = None) -> DataFrame:
    """(concept_id, node): JSON-LD nodes with ordered labels and observations and the successor of a tombstone."""
    names = label.where("ref_kind = 'concept'").groupBy(F.col("ref").alias("concept_id")).agg(F.array_sort(F.collect_set(F.struct(F.col("locale").alias("@language"), F.col("text").alias("@value")))).alias("label"))
    obs = model.where("value is not null").groupBy("concept_id").agg(F.array_sort(F.collect_set(F.struct("nutrient_id", "basis", "value", "unit", "source_id"))).alias("observation"))
    out = concepts.join(names, "concept_id", "left").join(obs, "concept_id", "left")
    if tombstones is not None:
        out = out.join(tombstones.select(F.col("tombstone_id").alias("concept_id"), "successor_id"), "concept_id", "left")
    else:
        out = out.withColumn("successor_id", F.lit(None).cast("string"))
    node = F.struct(F.col("concept_id").alias("@id"), F.col("food_group").alias("group"), "label", "observation", F.col("successor_id").alias("replacedBy"))
    return out.select("concept_id", F.to_json(node).alias("node"))


def report_html(findings: DataFrame, title: str = "Quality report") -> str:
    """The findings (a few rows) as an HTML page."""
    safe = findings.select("check", "severity", "n", F.transform("examples", S.html_escape).alias("examples")).collect()
    rows = "".join(f"<tr class='{r['severity']}'><td>{r['check']}</td><td>{r['severity']}</td><td>{r['n']}</td><td>{'<br>'.join(r['examples'])}</td></tr>" for r in safe)
    return f"<!doctype html><title>{title}</title><h1>{title}</h1><table><tr><th>check<th>severity<th>count<th>examples</tr>{rows}</table>"


def report_json(findings: DataFrame, built_at: str, artifact: str | None = None) -> str:
    """The findings (a few rows) and their counts by severity as JSON."""
    rows = [r.asDict() for r in findings.collect()]
    counts = {s: sum(r["severity"] == s for r in rows) for s in K.SEVERITY_RANK}
    return json.dumps({"schema": "qa-1", "artifact": artifact, "generated_at": built_at, "counts": counts, "findings": rows}, indent=2, ensure_ascii=False)


def dictionary(tables: dict[str, DataFrame]) -> str:
    """A Markdown data dictionary: tables, rows, columns and types."""
    parts = []
    for name in sorted(tables):
        df = tables[name]
        parts.append(f"## {name}\n\n{df.count()} rows\n\n| column | type |\n|---|---|\n" + "".join(f"| {c} | {t} |\n" for c, t in df.dtypes))
    return "\n".join(parts)


def attributions(entries: list[dict]) -> str:
    """What each source of a registry asks of those who use it, as Markdown."""
    if not entries:
        raise gates.ContractError("the registry has no sources")
    yes = lambda e, k: str(bool(e.get(k, False))).lower()
    parts = ["# Attributions\n"]
    for e in sorted(entries, key=lambda e: e["id"]):
        lines = [
            f"## {e.get('name', e['id'])} (`{e['id']}`)\n", f"- Version: {e.get('version', '-')}", f"- Homepage: {e.get('url', '-')}", f"- Licence: `{e.get('license_id', '-')}` ({e.get('license_url', '-')})",
            f"- Attribution required: {yes(e, 'attribution_required')}", f"- Commercial use allowed: {yes(e, 'commercial_use')}", f"- Share-alike: {yes(e, 'share_alike')}",
            f"- Profiles: {', '.join(e.get('artifacts', [])) or '-'}", f"- Pinned files: {', '.join(f['name'] for f in e.get('files', [])) or '-'}", f"\n> {e.get('attribution', '')}\n",
        ]
        parts.append("\n".join(lines))
    return "\n".join(parts)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, sha256): all files under folder, by their path inside it, hashed on the executors."""
    base = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    root = base.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(base).toUri().getPath().rstrip("/") + "/"
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    path = F.regexp_replace("path", "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    return read.select(F.regexp_replace(path, F.lit("^" + re.escape(root)), F.lit("")).alias("file"), F.sha2("content", 256).alias("sha256"))


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(file, sha256) of a release, in order: what SHA256SUMS says."""
    return _files(spark, folder).orderBy("file")


def release_manifest(spark: SparkSession, folder: str, entries: list[dict], profile: str) -> str:
    """Deterministic JSON: the profile, the files with their hashes, and the sources with their terms. Signing is left to the release process."""
    keys = ("id", "name", "version", "license_id", "license_url", "attribution_required", "attribution", "share_alike", "commercial_use")
    sources = [{k: e.get(k) for k in keys} | {"artifacts": sorted(e.get("artifacts", [])), "files": sorted(e.get("files", []), key=lambda f: f["name"])} for e in sorted(entries, key=lambda e: e["id"])]
    files = {r["file"]: r["sha256"] for r in checksums(spark, folder).toLocalIterator()}
    return json.dumps({"schema": "release-1", "engine_version": VERSION, "profile": profile, "files": files, "sources": sources}, indent=2, ensure_ascii=False, sort_keys=True)


def fingerprint(spark: SparkSession, folder: str, parameters: dict | None = None) -> str:
    """One hash of all files under folder (paths inside it and contents, hashed on the executors), the parameters and the engine's version: the key of a cached stage."""
    # order-free: sums of hash slices, one row to the driver
    parts = _files(spark, folder).select(F.sha2(F.concat_ws("|", "file", "sha256"), 256).alias("x")).select(*[F.conv(F.substring("x", 1 + 12 * k, 12), 16, 10).cast("decimal(38,0)").alias(f"p{k}") for k in range(5)])
    got = parts.agg(F.count("*"), *[F.sum(f"p{k}") for k in range(5)]).first()
    return hashlib.sha256(json.dumps([VERSION, [str(x) for x in got], parameters or {}], sort_keys=True).encode()).hexdigest()


class StageCache:
    """Outputs of stages under <root>/<stage>/<fingerprint>/, tables of Parquet. What is in it never changes."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def has(self, stage: str, key: str) -> bool:
        fs, p = self._fs(f"{self.root}/{stage}/{key}/_done")
        return fs.exists(p)

    def populate(self, stage: str, key: str, tables: dict[str, DataFrame]) -> None:
        """Stores a stage's tables, unless they are there. The mark comes last, so a broken attempt is not taken for a result."""
        if self.has(stage, key):
            return
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{self.root}/{stage}/{key}/{name}")
        self.spark.createDataFrame([(n,) for n in sorted(tables)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.root}/{stage}/{key}/_done")

    def refresh(self, stage: str, key: str) -> dict[str, DataFrame]:
        """The tables of a stored stage."""
        if not self.has(stage, key):
            raise gates.ContractError(f"stage {stage} is not stored for {key}")
        names = [r["value"] for r in self.spark.read.text(f"{self.root}/{stage}/{key}/_done").collect()]
        return {n: self.spark.read.parquet(f"{self.root}/{stage}/{key}/{n}") for n in names}

    def run(self, stage: str, key: str, work) -> dict[str, DataFrame]:
        """The stored tables, or those of work(), stored."""
        if not self.has(stage, key):
            self.populate(stage, key, work())
        return self.refresh(stage, key)


def open_artifact(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    names = json.loads(spark.read.text(f"{folder}/_manifest").first()["value"])["rows"]
    return {n: spark.read.parquet(f"{folder}/{n}") for n in names}
