"""Raw files of both source kinds through the whole build to an artifact and back."""

import zipfile

import pytest
from pyspark.sql import functions as F

from provendar.engine import Engine
from provendar.operators import gates
from provendar.plans import artifact, build
from provendar.sources import tables, xlsx, xml

FILES = {
    "alim": "<T><ALIM><alim_code> 7100 </alim_code><alim_nom_fr> Lait </alim_nom_fr><alim_nom_eng>Milk</alim_nom_eng><alim_nom_sci missing=' '/><alim_grp_code>01</alim_grp_code><alim_ssgrp_code>0101</alim_ssgrp_code><alim_ssssgrp_code>000000</alim_ssssgrp_code><facteur_Jones>6,38</facteur_Jones></ALIM><ALIM><alim_code>7101</alim_code><alim_nom_fr>Pain</alim_nom_fr><alim_nom_eng>Bread</alim_nom_eng><alim_grp_code>02</alim_grp_code></ALIM></T>",
    "grp": "<T><ALIM_GRP><alim_grp_code>01</alim_grp_code><alim_grp_nom_fr>laits</alim_grp_nom_fr><alim_ssgrp_code>0101</alim_ssgrp_code><alim_ssgrp_nom_fr>laits frais</alim_ssgrp_nom_fr><alim_ssssgrp_code>000000</alim_ssssgrp_code><alim_ssssgrp_nom_fr>-</alim_ssssgrp_nom_fr></ALIM_GRP><ALIM_GRP><alim_grp_code>02</alim_grp_code><alim_grp_nom_fr>pains</alim_grp_nom_fr></ALIM_GRP></T>",
    "const": "<T><CONST><const_code>400</const_code><const_nom_fr>Eau (g/100 g)</const_nom_fr></CONST><CONST><const_code>328</const_code><const_nom_fr>Energie (kcal/100 g)</const_nom_fr></CONST></T>",
    "compo": "<T><COMPO><alim_code>7100</alim_code><const_code>400</const_code><teneur> 41,3 </teneur><min missing=' '/><max>44</max><code_confiance>A</code_confiance><source_code>1</source_code></COMPO><COMPO><alim_code>7100</alim_code><const_code>328</const_code><teneur>&lt; 2,5</teneur></COMPO><COMPO><alim_code>7101</alim_code><const_code>400</const_code><teneur>-</teneur></COMPO><COMPO><alim_code>7101</alim_code><const_code>328</const_code><teneur>traces</teneur></COMPO></T>",
    "sources": "<T><SOURCES><source_code>1</source_code><ref_citation/></SOURCES></T>",
}


@pytest.fixture(scope="module")
def raw_a(tmp_path_factory):
    d = tmp_path_factory.mktemp("a")
    for k, v in FILES.items():
        (d / f"{k}.xml").write_text(f'<?xml version="1.0" encoding="UTF-8"?>\n{v}')
    return d


def workbook(path, sheets):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as z:
        rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml" Type="x"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")
        for k, rows in enumerate(sheets.values(), 1):
            out = ""
            for r, row in enumerate(rows, 1):
                cells = "".join(f'<c r="{chr(65 + c)}{r}" ' + (f'><v>{v}</v></c>' if isinstance(v, (int, float)) else f't="inlineStr"><is><t>{v}</t></is></c>') for c, v in enumerate(row) if v is not None)
                out += f'<row r="{r}">{cells}</row>'
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {main}><sheetData>{out}</sheetData></worksheet>")


@pytest.fixture(scope="module")
def raw_b(tmp_path_factory):
    p = tmp_path_factory.mktemp("b") / "b.xlsx"
    workbook(p, {"data": [["group"], ["Cod", "Nome do  alimento".replace("  ", " "), "Nivel 1", "Nivel 2", "Nivel 3", "Energia\n[kcal] ", "α-tocoferol [mg]"], ["100", "Leite", "Lacteos", "x", "y", 60, None], ["200", "Vinho", "Bebidas alcoólicas", "x", "y", 0, 0.5]], "comp": [["Energia [kcal]"], ["alfa-tocoferol [mg]"], ["legend"]]})
    return p


NAMES = {k: f"{k}.xml" for k in FILES}


def test_source_a(spark, raw_a):
    t = xml.extract(spark, str(raw_a), NAMES)
    got = {(r.food_code, r.nutrient_code): (r.value, r.value_kind, r.threshold, r.max_value) for r in t["value"].collect()}
    assert got == {("7100", "400"): (41.3, "number", None, 44.0), ("7100", "328"): (None, "below_loq", 2.5, None), ("7101", "400"): (None, "missing", None, None), ("7101", "328"): (None, "trace", None, None)}
    assert {(r.level, r.code, r.name) for r in t["food_group"].collect()} == {("1", "01", "laits"), ("2", "0101", "laits frais"), ("1", "02", "pains")}
    assert {r.nutrient_code: r.unit for r in t["constituent"].collect()} == {"400": "g", "328": "kcal"}


def test_source_a_fails_high(spark, raw_a, tmp_path):
    for k, v in FILES.items():
        (tmp_path / f"{k}.xml").write_text(v)
    (tmp_path / "compo.xml").write_text(FILES["compo"].replace("traces", "a lot"))
    with pytest.raises(Exception, match="unexpected cell"):
        xml.cells(spark, str(tmp_path / "compo.xml"), check=False).collect()
    (tmp_path / "compo.xml").write_text(FILES["compo"].replace("<alim_code>7101</alim_code>", "<alim_code>9</alim_code>"))
    with pytest.raises(gates.ContractError, match="food"):
        xml.extract(spark, str(tmp_path), NAMES)


def test_source_b(spark, raw_b):
    t = xlsx.extract(spark, str(raw_b), "data", "comp")
    got = {(r.food_code, r.nutrient_code): (r.value, r.value_kind, r.basis) for r in t["value"].collect()}
    assert got == {("100", "energia_kcal"): (60.0, "number", "per_100g_edible"), ("100", "a_tocoferol_mg"): (None, "missing", "per_100g_edible"), ("200", "energia_kcal"): (0.0, "number", "per_100ml"), ("200", "a_tocoferol_mg"): (0.5, "number", "per_100ml")}
    assert xlsx.column_index("A") == 0 and xlsx.column_index("AA") == 26


def test_dimension_files(spark, tmp_path):
    (tmp_path / "d.csv").write_text("# note\n  # another\ntag,unit\nFAT,g\nASH,g\n")
    assert tables.dimension(spark, str(tmp_path / "d.csv"), ["tag", "unit"]).count() == 2
    (tmp_path / "e.csv").write_text("tag,unit\nFAT,\n")
    with pytest.raises(gates.ContractError, match="empty"):
        tables.dimension(spark, str(tmp_path / "e.csv"), ["tag", "unit"])
    (tmp_path / "f.csv").write_text("tag,unit\nFAT,g,more\n")
    with pytest.raises(gates.ContractError, match="too many"):
        tables.dimension(spark, str(tmp_path / "f.csv"), ["tag", "unit"])
    with pytest.raises(gates.ContractError, match="header"):
        tables.dimension(spark, str(tmp_path / "d.csv"), ["tag", "name"])
    (tmp_path / "r.txt").write_text("~1~^~a b~\n~2~^~c~\n")
    assert [tuple(r) for r in tables.caret(spark, str(tmp_path / "r.txt"), ["k", "v"]).collect()] == [("1", "a b"), ("2", "c")]


def test_build_to_artifact(spark, raw_a, raw_b, tmp_path):
    a, b = xml.extract(spark, str(raw_a), NAMES), xlsx.extract(spark, str(raw_b), "data", "comp")
    both = {k: a[k].withColumn("source_id", F.lit("a")).unionByName(b[k].withColumn("source_id", F.lit("b"))) for k in tables.CONTRACT}
    mapping = spark.createDataFrame([("a", "400", "WATER", "1", "g", "-", "1"), ("a", "328", "ENERC", "1", "kcal", "reg", "1"), ("b", "energia_kcal", "ENERC", "1", "kcal", "-", "1"), ("b", "a_tocoferol_mg", "VITE", "1000", "ug", "-", "1")], "source_id string, nutrient_code string, tagname string, factor string, unit string, energy_method string, is_default string")
    groups = spark.createDataFrame([("a", "1", "01", "dairy"), ("a", "1", "02", "bread"), ("b", "1", "Lacteos", "dairy"), ("b", "1", "Bebidas alcoólicas", "drinks")], "source_id string, level string, code string, food_group string")
    c = build.transform(both, mapping, groups)
    assert c["value"].count() == 6 and c["concept"].count() == 4
    assert {r.source_id: (r.measured, r.not_measured, r.conversions) for r in build.counts(both["value"], mapping).collect()} == {"a": (1, 1, 0), "b": (3, 1, 1)}
    again = build.transform(both, mapping, groups, c["ledger"])
    assert {r.state for r in again["ledger"].collect()} == {"same"}
    ids = {r.ref: r.concept_id for r in c["source_record"].where("kind = 'food'").join(c["concept_link"], "source_record_id").collect()}
    links = spark.createDataFrame([(ids["100"], ids["7100"], "automatic")], "absorbed string, survivor string, status string")
    c = build.link(c, links)
    c = build.derive(c, spark.createDataFrame([("dairy", 1.03)], "food_group string, density_g_per_ml double"))
    vol = c["value"].where("basis = 'per_100ml' and value_type = 'calculated'").collect()
    assert {(r.concept_id, r.nutrient_id): r.value for r in vol} == {(ids["7100"], "WATER"): 41.3 * 1.03, (ids["7100"], "ENERC"): 60 * 1.03}
    glossary = spark.createDataFrame([("WATER", "en", "reviewed", "Water")], "tagname string, locale string, status string, label string")
    label = build.label_table(c["name"], glossary)
    rules = spark.createDataFrame([("en", "*", "*", "a>b"), ("fr", "*", "*", "a>b"), ("pt", "*", "*", "b>a")], "locale string, food_group string, nutrient string, source_order string")
    model = build.read_model(c, label, rules)
    folder = str(tmp_path / "art")
    n = artifact.write({"mv_food_value": model, "label": label, **{k: c[k] for k in ("value", "concept", "source_record", "derivation", "tombstone", "concept_link")}}, folder)
    assert n["value"] == 8
    with Engine(spark, folder) as e:
        assert [(r.ref, r.display) for r in e.search("mil", "es").collect()] == [(ids["7100"], "Milk")]
        top = e.foods_for_nutrient("ENERC", "en").collect()
        assert top[0].concept_id == ids["7100"] and top[0].value == 60 * 1.03
        assert {r.nutrient_id for r in e.food_values(ids["7100"], "en").collect()} == {"WATER", "ENERC"}
        assert e.diff(e).where("status <> 'same'").count() == 0
        assert artifact.checks(e.tables).count() == 0
        assert {r[0] for r in e.available_locales().collect()} == {"en", "fr", "pt"}
    assert artifact.fingerprint(spark, folder) == artifact.fingerprint(spark, folder) != artifact.fingerprint(spark, folder, {"p": 1})
    nodes = artifact.json_ld(c["concept"], label, model, c["tombstone"]).collect()
    assert len(nodes) == 4 and any('"replacedBy"' in r.node for r in nodes)
    artifact.jsonl(c["concept"], str(tmp_path / "x"))
    assert spark.read.text(str(tmp_path / "x")).count() == 4


def test_workspace_from_raw_files_to_release(spark, raw_a, raw_b, tmp_path):
    """Every stage of the build over files, twice: ids stay, and all but the time is the same."""
    import json
    import shutil

    from provendar.__main__ import READ, work
    from provendar.plans.workspace import Workspace

    (tmp_path / "config").mkdir()
    shutil.copytree(raw_a, tmp_path / "raw" / "a")
    (tmp_path / "raw" / "b").mkdir()
    shutil.copy(raw_b, tmp_path / "raw" / "b" / "b.xlsx")
    entry = lambda k: f'[sources.{k}]\nname = "Source {k}"\nversion = "1"\nlicense_id = "free"\nartifacts = ["core"]\n'
    files = {
        "registry.toml": entry("a") + entry("b"), "locales.toml": 'active = ["en", "fr"]\n[locale.en]\nfallback = []\n[locale.fr]\nfallback = []\n',
        "nutrients.csv": "tagname,group,name_en,unit\nWATER,m,Water,g\nENERC_KCAL,m,Energy,kcal\nENERC_KJ,m,Energy kJ,kJ\nVITE,m,Vitamin E,ug\n", "nutrient_groups.csv": "group\nm\n", "units.csv": "unit\ng\nkcal\nkJ\nug\n", "relations.csv": "parent,child\nENERC_KCAL,ENERC_KJ\n",
        "value_types.csv": "id,is_absence\n" + "".join(f"{x},true\n" for x in ("not_measured", "not_detected", "below_loq", "trace", "not_applicable", "assumed_zero")),
        "mapping.csv": "source_id,nutrient_code,tagname,factor,unit,energy_method,is_default\na,400,WATER,1,g,-,1\na,328,ENERC_KCAL,1,kcal,-,1\nb,energia_kcal,ENERC_KCAL,1,kcal,-,1\nb,a_tocoferol_mg,VITE,1000,ug,-,1\n",
        "group_mapping.csv": "source_id,level,code,food_group\na,1,01,dairy\na,1,02,bread\nb,1,Lacteos,dairy\nb,1,Bebidas alcoólicas,drinks\n",
        "rules.csv": "locale,food_group,nutrient,source_order\nen,*,*,a>b\nfr,*,*,a>b\npt,*,*,b>a\n", "densities.csv": "food_group,density_g_per_ml,evidence\ndairy,1.03,x\n", "glossary.csv": "tagname,locale,label\nWATER,fr,Eau\nENERC_KCAL,fr,Énergie\nENERC_KJ,fr,Énergie kJ\nVITE,fr,Vitamine E\n",
        "licences.csv": "profile,license_id\ncore,free\n", "terms.csv": "term,pt,fr,en\n# note,,,\nmilk,leite,lait,milk\n",
    }
    for name, text in files.items():
        (tmp_path / "config" / name).write_text(text)
    w = Workspace(spark, str(tmp_path))
    w.extract_xml("a", NAMES)
    w.extract_xlsx("b", "b.xlsx", "data", "comp")
    counts = w.build("core", "2000-01-01T00:00:00Z")
    assert counts["concept"] == 4 and counts["nutrient"] == 4 and counts["density"] == 1
    found = {(r.source, r.source_code): (r.concept_id, r.status) for r in w.match("b", "a", {"pt": "pt"}, {"fr": "fr", "en": "en"}).collect()}
    assert found[("b", "100")][1] == found[("a", "7100")][1] == "automatic" and found[("b", "100")][0] == found[("a", "7100")][0]
    queue = spark.createDataFrame([(found[("b", "100")][0], "a", "7100", "review"), (found[("b", "100")][0], "b", "100", "review")], "concept_id string, source string, source_code string, status string")
    (tmp_path / "config" / "golden_links.csv").write_text("left_code,right_code,label,evidence\n100,7100,true,seen\n200,7100,false,seen\n")
    judged = work(spark, type("A", (), {"command": "evaluate", "workspace": str(tmp_path)})()).first()
    assert (judged.precision, judged.recall, judged.auto_finals) == (1.0, 1.0, 1)
    (tmp_path / "config" / "golden_links.csv").write_text("left_code,right_code,label,evidence\n100,7100,false,seen\n")
    with pytest.raises(gates.ContractError, match="matcher"):
        w.evaluate()
    tables.write_csv(queue, str(tmp_path / "work" / "links"), ["source"])
    (tmp_path / "dec.csv").write_text("left_code,right_code,decision,justification\n100,7100,accepted,same food\n")
    done = work(spark, type("A", (), {"command": "review", "workspace": str(tmp_path), "decisions": str(tmp_path / "dec.csv")})())
    assert {(r.source, r.source_code, r.status) for r in done.collect()} == {("b", "100", "adjudicated"), ("a", "7100", "adjudicated")}
    survivor = found[("b", "100")][0]
    kept = {r.concept_id: r.ref for r in w.load("canonical", "concept_link").join(w.load("canonical", "source_record"), "source_record_id").collect()}
    other = next(c for c, ref in kept.items() if ref == "200")
    (tmp_path / "config" / "overrides.csv").write_text(f"concept_id,nutrient_id,basis,value,unit,justification\n{survivor},WATER,per_100g_edible,12.5,g,weighed again\n")
    (tmp_path / "config" / "label_queue.csv").write_text(f"ref_kind,ref,locale,label,candidate_status\nfood,{survivor},en,Fresh milk,approved\nfood,{survivor},fr,Lait frais,rejected\n")
    assert {(r.locale, r.candidate_status) for r in w.review_labels().collect()} == {("en", "approved"), ("fr", "rejected")}
    before = {r.concept_id for r in w.load("canonical", "concept").collect()}
    w.build("core", "2000-01-01T00:00:00Z")
    assert {r.concept_id for r in w.load("canonical", "concept").collect()} == before
    assert {r.state for r in w.load("canonical", "ledger").collect()} == {"same"}
    assert {r.successor_id for r in w.load("canonical", "tombstone").collect()} == {survivor}
    assert survivor in {r.concept_id for r in w.load("canonical", "value").where("source_id = 'a'").collect()} & {r.concept_id for r in w.load("canonical", "value").where("source_id = 'b'").collect()}
    milk = w.load("model", "mv_food_value").where(f"concept_id = '{survivor}' and nutrient_id = 'WATER' and locale = 'en'").first()
    assert (milk.value, milk.override_justification, milk.label) == (12.5, "weighed again", "Fresh milk") and other
    stored = sorted(str(p) for p in (tmp_path / "work" / "cache").rglob("*.parquet"))
    w.build("core", "2000-01-01T00:00:00Z")  # nothing changed: all stages come from the cache, and it stays as it is
    assert sorted(str(p) for p in (tmp_path / "work" / "cache").rglob("*.parquet")) == stored and len({p.name for p in (tmp_path / "work" / "cache" / "model").iterdir()}) == 2
    assert w.load("model", "mv_food_value").where("override_justification is not null").count() >= 1
    assert w.verify_release().collect() == []
    with Engine(spark, str(tmp_path / "out" / "core")) as e:
        assert e.nutrients().count() == 4 and e.provenance(milk.source_record_id).first()["source_name"].startswith("Source")
        assert {r.display for r in e.search("lait", "fr").collect()} == {"Lait"}
        assert {r.key for r in e.tables["build_metadata"].collect()} >= {"built_at", "profile", "engine_version"}
    assert json.loads(w.release())["profile"] == "core" and "search" in READ
    part = next((tmp_path / "out" / "core" / "concept").glob("*.parquet"))
    part.write_bytes(part.read_bytes() + b"x")
    (part.parent / f".{part.name}.crc").unlink(missing_ok=True)
    assert [r.file for r in w.verify_release().collect()] == [f"concept/{part.name}"]
    (tmp_path / "config" / "licences.csv").write_text("profile,license_id\ncore,other\n")
    with pytest.raises(gates.ContractError, match="licences"):
        w.package()


def test_a_workbook_as_a_data_source(spark, tmp_path):
    """Several partitions of any size give the cells of the whole; a row that spans a border is read once."""
    import random

    from provendar.queries_build import workbook_bytes

    rng = random.Random(2)
    word = lambda: rng.choice(["a&lt;b", "é ñ", "x" * rng.randrange(1, 40), None, 7, 2.5])
    rows = [[word() for _ in range(rng.randrange(0, 9))] for _ in range(700)]
    path = tmp_path / "w.xlsx"
    path.write_bytes(workbook_bytes({"one": rows, "empty": [], "two": [["only"]]}))
    spark.dataSource.register(xlsx.WorkbookSource)
    want = sorted(xlsx.sheet_cells(path.read_bytes()))
    assert len(want) > 1500
    for split in (1 << 23, 5000, 333):
        df = spark.read.format("workbook").option("split", split).load(f"file://{path}")
        assert sorted(tuple(r) for r in df.collect()) == want
        assert split > 5000 or df.rdd.getNumPartitions() > 10
