"""The build as stages over one folder: raw files and configuration in, contract, canonical tables and an artifact out.

    <root>/config   registry.toml, locales.toml, nutrients.csv, value_types.csv, units.csv, nutrient_groups.csv, relations.csv,
                    mapping.csv, group_mapping.csv, rules.csv, glossary.csv, terms.csv, links.csv, densities.csv, portions.csv, licences.csv
    <root>/raw      what each source delivers
    <root>/work     contract/<table>/source_id=<id>, canonical, derived, label, model - each stage reads what the one before wrote
    <root>/out      the artifact, its reports and its manifest
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..operators import gates, labels, matching, quality, vocabulary
from ..sources import tables, xlsx, xml
from . import artifact, build
from .store import Scratch

MAPPING = ["source_id", "nutrient_code", "tagname", "factor", "unit", "energy_method", "is_default"]
CANONICAL = ("concept", "concept_link", "source_record", "value", "coverage", "name", "ledger", "tombstone")


class Workspace:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    # ---- files

    def _path(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def has(self, *parts: str) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path(*parts))
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).exists(p)

    def config(self, name: str, columns: list[str], may_be_empty: tuple[str, ...] = ()) -> DataFrame:
        return tables.dimension(self.spark, self._path("config", f"{name}.csv"), columns, may_be_empty)

    def save(self, stage: str, frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Writes a stage's tables. Rows are counted, and the conditions on values tested, while they are written; the counts go to work/<stage>/_counts."""
        counts = {}
        for name, df in frames.items():
            types = {f"value_type:{t}": F.count_if(F.col("value_type") == t) for t in K.TYPE_RANK} if "value_type" in df.columns else {}
            known = {"a value has no type": F.col("value_type").isNotNull(), "a value has no source": F.col("source_id").isNotNull()} if name == "value" else {}
            watch = gates.Watch(artifact.in_order(df, name), types, known)
            watch.df.write.mode("overwrite").parquet(self._path("work", stage, name))
            counts[name] = watch.counts()
        rows = [(n, k, v) for n, c in counts.items() for k, v in c.items()]
        self.spark.createDataFrame(rows, "name string, counter string, n long").coalesce(1).write.mode("overwrite").json(self._path("work", stage, "_counts"))
        return {n: self.load(stage, n) for n in frames}

    def load(self, stage: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self._path("work", stage, name))

    def loaded(self, stage: str, names) -> dict[str, DataFrame]:
        return {n: self.load(stage, n) for n in names if self.has("work", stage, n)}

    # ---- stages

    def check_vocabulary(self) -> DataFrame:
        c = self.config
        return vocabulary.vocabulary(c("nutrients", ["tagname", "group", "name_en", "unit"]), c("nutrient_groups", ["group"]), c("units", ["unit"]), c("relations", ["parent", "child"]), c("value_types", ["id", "is_absence"]), Scratch(self.spark).save)

    def verify_sources(self) -> DataFrame:
        """Raw files whose hash is not the pinned one."""
        pinned = tables.pinned_files(self.spark, self._path("config", "registry.toml"))
        return tables.verify_checksums(self.spark, self._path("raw"), pinned).where("not ok")

    def extract_xml(self, source_id: str, names: dict[str, str]) -> None:
        tables.write_contract(xml.extract(self.spark, self._path("raw", source_id), names), self._path("work", "contract"), source_id)

    def extract_xlsx(self, source_id: str, file: str, data_sheet: str, components_sheet: str) -> None:
        tables.write_contract(xlsx.extract(self.spark, self._path("raw", source_id, file), data_sheet, components_sheet), self._path("work", "contract"), source_id)

    def contract(self) -> dict[str, DataFrame]:
        known = tables.registry(self.spark, self._path("config", "registry.toml")).select("source_id")
        return {n: tables.contract_table(self.spark, self._path("work", "contract"), n, known) for n in tables.CONTRACT}

    def links(self) -> DataFrame | None:
        """Adjudicated identity as (absorbed, survivor, status): the concept of a linked food that is not the survivor is absorbed by it."""
        if not self.has("config", "links.csv"):
            return None
        rows = self.config("links", ["concept_id", "source", "source_code", "status"]).where(F.col("status").isin("automatic", "adjudicated"))
        own = build.concept_id(F.col("source"), F.col("source_code"))
        return rows.select(own.alias("absorbed"), F.col("concept_id").alias("survivor"), "status").where("absorbed <> survivor")

    def transform(self) -> dict[str, DataFrame]:
        groups = self.config("group_mapping", ["source_id", "level", "code", "food_group"])
        ledger = self.load("canonical", "ledger") if self.has("work", "canonical", "ledger") else None
        if ledger is not None:  # the old ledger is read while the new one is written
            ledger = Scratch(self.spark).save(ledger.where("state <> 'gone'").drop("state"))
        out = build.transform(self.contract(), self.config("mapping", MAPPING), groups, ledger)
        links = self.links()
        return self.save("canonical", out if links is None else build.link(out, links))

    def queue(self, name: str, columns: list[str]) -> DataFrame:
        return self.config(name, columns) if self.has("config", f"{name}.csv") else self.spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns))

    def match(self, left: str, right: str, left_names: dict[str, str], right_names: dict[str, str]) -> DataFrame:
        """Proposed links between two sources, adjudicated rows of links.csv kept, written to work/links as CSV for review."""
        store, t = Scratch(self.spark), self.contract()
        terms = matching.dictionary(self.spark.read.option("header", True).option("comment", "#").csv(self._path("config", "terms.csv")).withColumn("row", F.monotonically_increasing_id()), ("pt", "fr", "en"))
        canonical = self.loaded("canonical", ("concept", "concept_link", "source_record", "value"))
        code = canonical["concept_link"].join(canonical["source_record"].where("kind = 'food'"), "source_record_id").select("concept_id", F.col("source_id").alias("_s"), F.col("ref").alias("id")).join(canonical["concept"], "concept_id")

        def side(source: str, names: dict[str, str]) -> tuple[DataFrame, DataFrame]:
            own = code.where(F.col("_s") == source)
            text = F.from_json("names", "map<string,string>")
            food = t["food"].where(F.col("source_id") == source).select(F.col("food_code").alias("id"), *[F.try_element_at(text, F.lit(c)).alias(f"name_{lang}") for lang, c in names.items()])
            values = quality.measured(canonical["value"]).where(F.col("source_id") == source).join(own.select("concept_id", "id"), "concept_id").groupBy("id", "nutrient_id").agg(F.max(F.struct("source_record_id", "value")).alias("_w")).select("id", "nutrient_id", F.col("_w.value").alias("value"))
            return food.join(own.select("id", "food_group"), "id"), values

        (a, x), (b, y) = side(left, left_names), side(right, right_names)
        found = self.save("match", {"sides": self.spark.createDataFrame([(left, right)], "left string, right string"), "proposal": matching.match_foods(a, b, terms, x, y, {k: f"name_{k}" for k in left_names}, {k: f"name_{k}" for k in right_names}, store.save, prune=True)})["proposal"]
        old = self.config("links", ["concept_id", "source", "source_code", "status"]).toDF("concept_id", "side", "code", "status") if self.has("config", "links.csv") else None
        old = None if old is None else old.withColumn("side", F.when(F.col("side") == left, "left").otherwise("right"))
        rows = matching.links(found, left, right, store.save, old)
        out = store.save(rows.select("concept_id", F.when(F.col("side") == "left", left).otherwise(right).alias("source"), F.col("code").alias("source_code"), "status"))
        tables.write_csv(out, self._path("work", "links"), ["concept_id", "source", "source_code", "status"])
        return out

    def review(self, decisions: DataFrame) -> DataFrame:
        """Applies decisions (left_code, right_code, decision, justification) to the proposed links. The result becomes config/links.csv, which the next build reads."""
        left = self.load("match", "sides").first()["left"]
        links = self.spark.read.option("header", True).csv(self._path("work", "links"))
        names = links.select("source", F.when(F.col("source") == left, "left").otherwise("right").alias("side")).distinct()
        sided = links.join(F.broadcast(names), "source").select("concept_id", "side", F.col("source_code").alias("code"), "status")  # two sources
        done = Scratch(self.spark).save(matching.apply_decisions(sided, decisions).join(F.broadcast(names), "side").select("concept_id", "source", F.col("code").alias("source_code"), "status"))
        for folder in (("work", "links"), ("config", "links.csv")):
            tables.write_csv(done, self._path(*folder), ["concept_id", "source", "source_code", "status"])
        return done

    def evaluate(self, precision: float = 0.98, recall: float = 0.90) -> DataFrame:
        """The last match against config/golden_links.csv (left_code, right_code, label, evidence); too low a precision or recall stops it."""
        golden = self.config("golden_links", ["left_code", "right_code", "label", "evidence"])
        gates.holds(golden, F.lower("label").isin("true", "false"), "a label is neither true nor false")
        truth = golden.select(F.col("left_code").alias("left_id"), F.col("right_code").alias("right_id"), (F.lower("label") == "true").alias("label"))
        store = Scratch(self.spark)
        out = store.save(matching.evaluate(truth, self.load("match", "proposal"), store.save))
        gates.none_left(vocabulary.matcher(out, precision, recall), "matcher")
        return out

    def review_labels(self) -> DataFrame:
        """Counts of the queue config/label_queue.csv; approved labels go to config/reviewed.csv, where they replace earlier ones."""
        approved, told = labels.review_queue(self.config("label_queue", ["ref_kind", "ref", "locale", "label", "candidate_status"]))
        key, store = ["ref_kind", "ref", "locale"], Scratch(self.spark)
        new = approved.select(*key, F.col("text").alias("label"))
        gates.unique(new, key, "approved labels")
        rows = store.save(self.queue("reviewed", [*key, "label"]).join(new, key, "left_anti").unionByName(new))
        tables.write_csv(rows, self._path("config", "reviewed.csv"), key)
        return told

    def derive(self) -> dict[str, DataFrame]:
        c = self.loaded("canonical", CANONICAL)
        portions = tables.portions(self.spark, self._path("config", "portions.csv")) if self.has("config", "portions.csv") else None
        out = build.derive(c, tables.densities(self.spark, self._path("config", "densities.csv")), portions)
        return self.save("derived", {k: out[k] for k in ("value", "derivation", "density", "portion") if k in out})

    def canonical(self) -> dict[str, DataFrame]:
        return self.loaded("canonical", CANONICAL) | self.loaded("derived", ("value", "derivation", "density", "portion"))

    def label(self) -> DataFrame:
        """The label table; what the gates object to stops it."""
        active, _ = tables.locales(self.spark, self._path("config", "locales.toml"))
        nutrients = self.config("nutrients", ["tagname", "group", "name_en", "unit"])
        official = nutrients.select("tagname", F.lit("en").alias("locale"), F.lit("official").alias("status"), F.col("name_en").alias("label"))
        glossary = self.config("glossary", ["tagname", "locale", "label"]).select("tagname", "locale", F.lit("curated").alias("status"), "label") if self.has("config", "glossary.csv") else official.limit(0)
        names = self.load("canonical", "name").where(F.col("locale").isin(*active))
        kind = F.when(F.col("ref_kind") == "food", "concept").otherwise(F.col("ref_kind")).alias("ref_kind")
        reviewed = self.queue("reviewed", ["ref_kind", "ref", "locale", "label"]).select(kind, "ref", "locale", F.lit("curated").alias("status"), F.col("label").alias("text"))
        apart = self.config("divergences", ["ref_kind", "ref", "pt-PT", "pt-BR"], ("pt-PT", "pt-BR")) if self.has("config", "divergences.csv") else self.queue("divergences", ["ref_kind", "ref", "pt-PT", "pt-BR"])
        apart = apart.select(kind, "ref", "`pt-PT`", "`pt-BR`").where("`pt-PT` <> '' and `pt-BR` <> ''")
        food, tag = (apart.where(F.col("ref_kind") == k).drop("ref_kind") for k in ("concept", "nutrient"))
        gates.covered(food.select(F.col("ref").alias("concept_id")), self.load("canonical", "concept").select("concept_id"), ["concept_id"], "divergences: concept")
        plain = lambda df, ref, of: df.join(of.select(F.col("ref").alias(ref), F.lit("pt").alias("locale")), [ref, "locale"], "left_anti")  # noqa: E731  variants forbid the generic label
        variant = food.select(F.lit("concept").alias("ref_kind"), "ref", F.explode(F.map_from_arrays(F.array(F.lit("pt-PT"), F.lit("pt-BR")), F.array("`pt-PT`", "`pt-BR`"))).alias("locale", "text"))
        variant = variant.where(F.col("locale").isin(*active)).withColumn("status", F.lit("curated"))
        told = plain(glossary, "tagname", tag)
        out = self.save("label", {"label": build.label_table(plain(names, "concept_id", food), official.unionByName(told), reviewed, variant)})["label"]
        needed = [x for x in active if x == "en" or self.has("config", "glossary.csv")]
        gates.none_left(labels.gate_findings(out.where("ref_kind = 'nutrient'"), nutrients, needed, tag, glossary if tag.limit(1).count() else None), "labels")
        return out

    def model(self) -> DataFrame:
        rules = self.config("rules", ["locale", "food_group", "nutrient", "source_order"])
        gates.unique(rules, ["locale", "food_group", "nutrient"], "rules")
        codes = self.config("mapping", MAPPING).where("is_default = '1'").select("source_id", F.col("nutrient_code").alias("source_nutrient_code"))
        overrides = None
        if self.has("config", "overrides.csv"):
            overrides = self.config("overrides", ["concept_id", "nutrient_id", "basis", "value", "unit", "justification"])
            gates.holds(overrides, F.expr("try_cast(value as double)").isNotNull(), "an override is not a number")
            gates.unique(overrides, ["concept_id", "nutrient_id", "basis"], "overrides")
            gates.covered(overrides, self.load("canonical", "concept"), ["concept_id"], "overrides: concept")
        out = build.read_model(self.canonical(), self.load("label", "label"), rules, codes, overrides)
        return self.save("model", {"mv_food_value": out})["mv_food_value"]

    def findings(self) -> DataFrame:
        c = self.canonical()
        nutrients = self.config("nutrients", ["tagname", "group", "name_en", "unit"])
        kcal = quality.measured(c["value"]).where("nutrient_id = 'ENERC_KCAL' and analytical_method is not null").groupBy("concept_id", "source_id").agg(F.max(F.struct("source_record_id", "value")).alias("_w")).select("concept_id", "source_id", F.col("_w.value").alias("kcal"))
        return quality.findings(quality.suite(c["value"], c["concept"], nutrients.select(F.col("tagname").alias("nutrient_id"), "unit"), kcal))

    def package(self, profile: str = "core", lite_nutrients: list[str] | None = None, built_at: str | None = None) -> dict[str, int]:
        """Writes the artifact after the licence, acquisition and structure gates."""
        sources = tables.registry(self.spark, self._path("config", "registry.toml"))
        if self.has("config", "licences.csv"):
            gates.none_left(vocabulary.licences(sources, self.config("licences", ["profile", "license_id"]), profile), "licences")
        nutrients = self.config("nutrients", ["tagname", "group", "name_en", "unit"])
        t = self.canonical() | {"label": self.load("label", "label"), "mv_food_value": self.load("model", "mv_food_value"), "source": sources, "nutrient": nutrients}
        t = {k: v for k, v in t.items() if k not in ("name", "ledger")}
        gates.none_left(artifact.checks(t), "structure")
        return artifact.write(t, self._path("out", profile), {"core": "full"}.get(profile, profile), lite_nutrients, built_at)

    def release(self, profile: str = "core") -> str:
        entries = tables.registry_entries(tables.toml(self.spark, self._path("config", "registry.toml")))
        text = artifact.release_manifest(self.spark, self._path("out", profile), entries, profile)
        Scratch(self.spark).spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(self._path("out", f"{profile}.manifest"))
        return text

    def build(self, profile: str = "core", built_at: str | None = None, full: bool = False) -> dict[str, int]:
        """Everything after extraction: gates, canonical tables, derived values, labels, read model, artifact, quality, manifest. Errors of the suite stop it.

        A stage whose inputs (contract tables, configuration, earlier stages) are those of an earlier build takes its tables from work/cache; full works all of them out again.
        """
        gates.none_left(self.check_vocabulary(), "vocabulary")
        if self.has("config", "unmapped"):
            gates.none_left(tables.unmapped(self.spark, self._path("config", "unmapped")), "unmapped")
        cache, key = artifact.StageCache(self.spark, self._path("work", "cache")), None
        if not full:
            key = artifact.fingerprint(self.spark, self._path("config"), {"contract": artifact.fingerprint(self.spark, self._path("work", "contract"))})
        for stage, work in (("canonical", self.transform), ("derived", self.derive), ("label", self.label), ("model", self.model)):
            if key and cache.has(stage, key):
                self.save(stage, cache.refresh(stage, key))
                continue
            made = work()
            if key:
                cache.populate(stage, key, made if isinstance(made, dict) else {{"label": "label", "model": "mv_food_value"}[stage]: made})
        found = self.findings()
        gates.none_left(found.where("severity = 'error'"), "quality")
        counts = self.package(profile, list(K.GRAM_NUTRIENTS), built_at)
        self.release(profile)
        return counts

    def verify_release(self, profile: str = "core") -> DataFrame:
        """(file, expected, sha256) of files that are not as the manifest says: changed, missing or unknown."""
        told = json.loads("\n".join(r["value"] for r in self.spark.read.text(self._path("out", f"{profile}.manifest")).collect()))["files"]
        want = self.spark.createDataFrame(sorted(told.items()), "file string, expected string")
        both = want.join(artifact.checksums(self.spark, self._path("out", profile)), "file", "full_outer")
        return both.where(~F.col("expected").eqNullSafe(F.col("sha256")))
