"""Dimension files, delimited text, registries, contract tables and checksums."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import fixed as K
from ..operators import gates, search

CONTRACT = ("food", "food_group", "constituent", "value")


def _lines(spark: SparkSession, path: str) -> list[str]:
    return [r["value"] for r in spark.read.text(path).collect()]  # configuration files: a few kilobytes


def dimension(spark: SparkSession, path: str, columns: list[str], may_be_empty: tuple[str, ...] = ()) -> DataFrame:
    """A CSV dimension: lines starting with # (also indented) are comments, the header must be exactly `columns`, no cell may be empty, no row may be longer."""
    lines = spark.read.text(path).where(~F.ltrim("value").startswith("#") & (F.trim("value") != ""))
    text = lines.select(F.col("value"))
    rows = text.select(F.from_csv("value", ", ".join([*(f"`{c}` string" for c in columns), "`_more` string"]), {"mode": "PERMISSIVE"}).alias("r")).select("r.*")
    head = rows.where(F.concat_ws(",", *[F.col(f"`{c}`") for c in columns]) == ",".join(columns))
    if head.count() != 1:
        raise gates.ContractError(f"{path}: the header must be {','.join(columns)}")
    body = rows.where(F.concat_ws(",", *[F.col(f"`{c}`") for c in columns]) != ",".join(columns))
    gates.none_left(body.where("_more is not null"), f"{path}: a row has too many fields")
    full = [c for c in columns if c not in may_be_empty]
    empty = None
    for c in full:
        bad = F.col(c).isNull() | (F.trim(F.col(c)) == "")
        empty = bad if empty is None else empty | bad
    if empty is not None:
        gates.none_left(body.where(empty), f"{path}: empty cell")
    return body.select(*[F.trim(F.col(c)).alias(c) for c in columns])


def caret(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Caret-delimited text with tilde quotes; every line must have exactly the given fields."""
    raw = spark.read.text(path).where(F.trim("value") != "")
    parts = F.split("value", r"\^")
    gates.none_left(raw.where(F.size(parts) != len(columns)), f"{path}: wrong number of fields")
    return raw.select(*[F.regexp_replace(F.trim(parts[k]), "^~|~$", "").alias(c) for k, c in enumerate(columns)])


def toml(spark: SparkSession, path: str) -> dict:
    return tomllib.loads("\n".join(_lines(spark, path)))


def registry_entries(data: dict) -> list[dict]:
    """Sources of a TOML registry ([[source]] or [source.<id>]), checked: hashes, files or a single file, profiles, licences that may not be distributed."""
    found = data.get("source", data.get("sources", {}))
    rows = list(found) if isinstance(found, list) else [{"id": k, **v} for k, v in found.items()]
    for r in rows:
        files, profiles = r.get("files", []), r.get("artifacts", r.get("profiles", []))
        for sha in [f.get("sha256", "") for f in files] + ([r["sha256"]] if "sha256" in r else []):
            if len(sha) != 64 or set(sha.lower()) - set("0123456789abcdef"):
                raise gates.ContractError(f"{r['id']}: bad sha256")
        if files and ("sha256" in r or "filename" in r):
            raise gates.ContractError(f"{r['id']}: either files or a single file")
        if files and not all(f.get("name") for f in files):
            raise gates.ContractError(f"{r['id']}: a file has no name")
        if unknown := sorted(set(profiles) - set(K.PROFILES)):
            raise gates.ContractError(f"{r['id']}: unknown profiles {unknown}")
        if r.get("license_id", "").lower().startswith("odbl") and profiles:
            raise gates.ContractError(f"{r['id']}: its licence keeps it out of every profile")
    return rows


def registry(spark: SparkSession, path: str) -> DataFrame:
    """One row per source: source_id, name, version, license_id, license_url, url, attribution."""
    rows = registry_entries(toml(spark, path))
    cols = ("id", "name", "version", "license_id", "license_url", "url", "attribution")
    return spark.createDataFrame([tuple(str(r[c]) if c in r else None for c in cols) for r in rows], ", ".join(f"{'source_id' if c == 'id' else c} string" for c in cols))


def pinned_files(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, file, sha256) of all files the registry pins."""
    rows = [(r["id"], f["name"], f["sha256"].lower()) for r in registry_entries(toml(spark, path)) for f in r.get("files", [])]
    return spark.createDataFrame(rows, "source_id string, file string, sha256 string")


def locales(spark: SparkSession, path: str) -> tuple[list[str], dict[str, list[str]]]:
    """(active locales, fallback chains) of a TOML file; unknown hops and direct cycles stop it."""
    data = toml(spark, path)
    chains = {k: list(v.get("fallback", [])) for k, v in data.get("locale", {}).items()}
    for locale in [*chains, *data.get("active", [])]:
        search.chain_of(locale, chains)
    return list(data.get("active", chains)), chains


def factors(spark: SparkSession, path: str, columns: list[str], keys: list[str], numbers: list[str]) -> DataFrame:
    """A table of factors: unique keys, numeric factors, and evidence (the last column) in every row."""
    rows = dimension(spark, path, columns)
    gates.unique(rows, keys, path)
    number = lambda c: F.expr(f"try_cast(`{c}` as double)")
    for c in numbers:
        gates.holds(rows, number(c).isNotNull(), f"{path}: {c} is not a number")
    return rows.select(*[number(c).alias(c) if c in numbers else F.col(c) for c in columns])


def densities(spark: SparkSession, path: str) -> DataFrame:
    return factors(spark, path, ["food_group", "density_g_per_ml", "evidence"], ["food_group"], ["density_g_per_ml"])


def portions(spark: SparkSession, path: str) -> DataFrame:
    return factors(spark, path, ["concept_id", "measure", "grams", "evidence"], ["concept_id", "measure"], ["grams"])


def write_csv(df: DataFrame, folder: str, order: list[str]) -> None:
    """One CSV file with a header, sorted, lines ended by a line feed: for links, ledgers and decisions, which people read."""
    df.orderBy(*order).coalesce(1).write.mode("overwrite").option("lineSep", "\n").option("emptyValue", "").csv(folder, header=True)


def unmapped(spark: SparkSession, folder: str) -> DataFrame:
    """(file): what lies in the folder of things still to be mapped, besides README.md and hidden files; none may be left."""
    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"))
    return files.where(~F.col("file").startswith(".") & (F.col("file") != "README.md"))


def contract_table(spark: SparkSession, folder: str, name: str, known: DataFrame | None = None) -> DataFrame:
    """One contract table of all sources, folder/<source_id=...>/; every source must be registered."""
    df = spark.read.option("basePath", f"{folder}/{name}").parquet(f"{folder}/{name}")
    if known is not None:
        gates.covered(df, known, ["source_id"], name)
    return df


def write_contract(tables: dict[str, DataFrame], folder: str, source_id: str) -> None:
    if set(tables) != set(CONTRACT):
        raise gates.ContractError(f"{source_id}: the contract is {CONTRACT}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}/source_id={source_id}")


def verify_checksums(spark: SparkSession, folder: str, expected: DataFrame) -> DataFrame:
    """(source_id, file, expected, sha256, ok) of the files under folder/<source_id>/ against expected (source_id, file, sha256); file is the path inside its source's folder."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    root = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(p).toString()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    inner = F.substring("path", len(root) + 2, 1 << 20)
    got = files.select(F.substring_index(inner, "/", 1).alias("source_id"), F.regexp_extract(inner, "^[^/]*/(.*)$", 1).alias("file"), F.sha2("content", 256).alias("sha256"))
    return expected.withColumnRenamed("sha256", "expected").join(got, ["source_id", "file"], "left").withColumn("ok", F.coalesce(F.col("sha256") == F.col("expected"), F.lit(False)))
