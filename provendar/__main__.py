"""Command line: build stages over a workspace folder, read commands over an artifact, and the registered queries.

    python -m provendar build WORKSPACE [--profile core]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from . import queries
from .engine import Engine
from .operators import gates, matching
from .plans import artifact
from .plans.workspace import Workspace
from .shipping import ship
from .sources import tables

READ = {"search": ("artifact", "query", "locale"), "food-values": ("artifact", "concept", "locale"), "foods": ("artifact", "nutrient", "locale"), "diff": ("artifact", "other"), "docs": ("artifact",), "export": ("artifact", "table", "folder"), "query": ("name", "sf_dir")}
BUILD = {
    "vocab": ("workspace",), "verify": ("workspace",), "extract-xml": ("workspace", "source", "files"), "extract-xlsx": ("workspace", "source", "file", "data_sheet", "components_sheet"), "transform": ("workspace",), "link": ("workspace", "left", "right"),
    "review": ("workspace", "decisions"), "evaluate": ("workspace",), "review-labels": ("workspace",), "verify-release": ("workspace",), "derive": ("workspace",), "labels": ("workspace",), "merge": ("workspace",), "qa": ("workspace",), "package": ("workspace",), "release": ("workspace",), "attributions": ("workspace",), "build": ("workspace",),
}


def read(spark: SparkSession, a: argparse.Namespace) -> DataFrame | str | None:
    if a.command == "query":
        return queries.queries()[a.name](spark, a.sf_dir)
    e = Engine(spark, a.artifact)
    if a.command == "search":
        return e.search(a.query, a.locale, a.limit)
    if a.command == "food-values":
        return e.food_values(a.concept, a.locale)
    if a.command == "foods":
        return e.foods_for_nutrient(a.nutrient, a.locale, a.limit)
    if a.command == "diff":
        return e.changes(Engine(spark, a.other))
    if a.command == "docs":
        return artifact.dictionary(e.tables)
    artifact.jsonl(e.tables[a.table], a.folder)
    return None


def work(spark: SparkSession, a: argparse.Namespace) -> DataFrame | str | None:
    w = Workspace(spark, a.workspace)
    if a.command == "vocab":
        return w.check_vocabulary()
    if a.command == "verify":
        return w.verify_sources()
    if a.command == "extract-xml":  # files: alim=a.xml,grp=b.xml,...
        w.extract_xml(a.source, dict(x.split("=", 1) for x in a.files.split(",")))
    elif a.command == "extract-xlsx":
        w.extract_xlsx(a.source, a.file, a.data_sheet, a.components_sheet)
    elif a.command == "link":
        return w.match(a.left, a.right, {"pt": "pt"}, {"fr": "fr", "en": "en"})
    elif a.command == "review":
        return w.review(spark.read.option("header", True).csv(a.decisions))
    elif a.command == "evaluate":
        return w.evaluate()
    elif a.command == "review-labels":
        return w.review_labels()
    elif a.command == "verify-release":
        return w.verify_release(a.profile)
    elif a.command == "qa":
        found = w.findings()
        gates.none_left(found.where("severity = 'error'"), "quality")
        return found
    elif a.command == "package":
        return str(w.package(a.profile))
    elif a.command == "release":
        return w.release(a.profile)
    elif a.command == "attributions":
        return artifact.attributions(tables.registry_entries(tables.toml(spark, w._path("config", "registry.toml"))))
    elif a.command == "build":
        return str(w.build(a.profile, full=a.full))
    else:
        {"transform": w.transform, "derive": w.derive, "labels": w.label, "merge": w.model}[a.command]()
    return None


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="provendar")
    sub = p.add_subparsers(dest="command", required=True)
    for name, args in (READ | BUILD).items():
        s = sub.add_parser(name)
        for a in args:
            s.add_argument(a)
        s.add_argument("--limit", type=int, default=20)
        s.add_argument("--profile", default="core")
        s.add_argument("--full", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("provendar").getOrCreate()
    ship(spark)
    out = (read if a.command in READ else work)(spark, a)
    if isinstance(out, str):
        print(out)
    elif out is not None:
        out.show(a.limit, truncate=80)


if __name__ == "__main__":
    main()
