"""Registered queries of the readers, the build, the gates, the sinks and the read facade.

Inputs that no table holds - XML, a workbook, registries, delimited text - are written from the tables to scratch first,
so each query covers whole tables and has SQL over them. As raw source A, suppliers are foods (region and nation are their
group levels), regions are constituents and nations are citations; as raw source B, nations are the rows of a workbook.
"""

from __future__ import annotations

import io
import json
import zipfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .engine import Engine
from .functions import fixed as K
from .functions import scalar as S
from .functions import text as T
from .operators import gates, labels, matching, quality, records, search, selection, views, vocabulary
from .plans import artifact, build, factors
from .plans.store import Scratch
from .queries import CELL_SQL, FOOD_COLUMNS, FOOD_SQL, LABEL_SQL, _branches, cells, doc_labels, food_profile, foods, query, table
from .sources import tables, xlsx, xml

# --------------------------------------------------------------------------- raw source A


def _suppliers(spark, d) -> DataFrame:
    s, n, r = (table(spark, d, x) for x in ("supplier", "nation", "region"))
    return s.join(n, s.s_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)


def _element(tag: str, parts: dict[str, str]) -> DataFrame:
    """An XML element per row; a null part is left out."""
    inner = ", ".join(f"coalesce(concat('<{k}>', {v}, '</{k}>'), '')" for k, v in parts.items())
    return F.expr(f"concat('<{tag}>', {inner}, '</{tag}>')").alias("value")


CODE = "format_string('%04d', s_suppkey)"
CELL_TEXT = "case (s_suppkey + r_regionkey) % 5 when 0 then '-' when 1 then 'traces' when 2 then concat('&lt; ', r_regionkey + 1, ',5') when 3 then concat(' ', replace(format_string('%.2f', s_acctbal), '.', ','), ' ') else '12.5e-1' end"


def _raw_a(spark, d, store: Scratch, only: str | None = None) -> dict[str, str]:
    """Writes the five XML files (or one of them); name -> path."""
    sup, reg, nat = _suppliers(spark, d), table(spark, d, "region"), table(spark, d, "nation")
    cross = table(spark, d, "supplier").withColumn("r_regionkey", F.explode(F.sequence(F.lit(0), F.lit(4)))).withColumn("r_regionkey", F.col("r_regionkey").cast("long"))
    files = {
        "alim": lambda: sup.select(_element("ALIM", {"alim_code": f"concat(' ', {CODE}, ' ')", "alim_nom_fr": "s_name", "alim_nom_eng": "concat('en ', s_name)", "alim_nom_sci": "case when s_suppkey % 2 = 0 then concat('sci ', s_suppkey) else ' ' end", "alim_grp_code": "concat('1', r_regionkey)", "alim_ssgrp_code": "format_string('2%03d', n_nationkey)", "alim_ssssgrp_code": "'000000'", "facteur_Jones": "case when s_suppkey % 3 = 0 then '6,25' end"})),
        "grp": lambda: nat.join(reg, nat.n_regionkey == reg.r_regionkey).select(_element("ALIM_GRP", {"alim_grp_code": "concat('1', r_regionkey)", "alim_grp_nom_fr": "r_name", "alim_ssgrp_code": "format_string('2%03d', n_nationkey)", "alim_ssgrp_nom_fr": "n_name", "alim_ssssgrp_code": "'000000'", "alim_ssssgrp_nom_fr": "'-'"})),
        "const": lambda: reg.select(_element("CONST", {"const_code": "concat('c', r_regionkey)", "const_nom_fr": "concat(r_name, ' (', element_at(array('g', 'mg', 'µg', 'kcal', 'kJ'), cast(r_regionkey as int) + 1), '/100 g)')"})),
        "compo": lambda: cross.select(_element("COMPO", {"alim_code": CODE, "const_code": "concat('c', r_regionkey)", "teneur": CELL_TEXT, "min": "case when s_suppkey % 4 = 0 then '0,5' else ' ' end", "max": "case when s_suppkey % 4 < 2 then '9.75' end", "code_confiance": "element_at(array('A', 'B', 'C', 'D'), cast(s_suppkey % 4 as int) + 1)", "source_code": "s_nationkey"})),
        "sources": lambda: nat.select(_element("SOURCES", {"source_code": "n_nationkey", "ref_citation": "n_name"})),
    }
    return {k: store.lines(f"{k}.xml", f(), ["<T>"], ["</T>"]) for k, f in files.items() if only in (None, k)}


SUP_SQL = "sup AS (SELECT *, printf('%04d', s_suppkey) AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"
RAW_CELL_SQL = f"""{SUP_SQL}, raw AS (SELECT s_suppkey, code, r.r_regionkey AS k, s_acctbal, s_nationkey, (s_suppkey + r.r_regionkey) % 5 AS c FROM sup, region r),
cell AS (
  SELECT code AS food_code, 'c' || k AS nutrient_code, CASE c WHEN 3 THEN round(s_acctbal, 2) WHEN 4 THEN 1.25 END AS value,
         CASE c WHEN 0 THEN 'missing' WHEN 1 THEN 'trace' WHEN 2 THEN 'below_loq' ELSE 'number' END AS value_kind, CASE WHEN c = 2 THEN k + 1.5 END AS threshold,
         CASE WHEN s_suppkey % 4 = 0 THEN 0.5 END AS min_value, CASE WHEN s_suppkey % 4 < 2 THEN 9.75 END AS max_value, substr('ABCD', (s_suppkey % 4)::INT + 1, 1) AS confidence_code, s_nationkey::VARCHAR AS source_code FROM raw)"""


@query(f"WITH {SUP_SQL} SELECT code AS alim_code, s_name AS alim_nom_fr, 'en ' || s_name AS alim_nom_eng, CASE WHEN s_suppkey % 2 = 0 THEN 'sci ' || s_suppkey END AS alim_nom_sci, '1' || r_regionkey AS alim_grp_code, printf('2%03d', n_nationkey) AS alim_ssgrp_code, CASE WHEN s_suppkey % 3 = 0 THEN '6,25' END AS facteur_Jones FROM sup")
def q_xml_foods(spark, d):
    return xml.foods(spark, _raw_a(spark, d, Scratch(spark), "alim")["alim"]).drop("alim_ssssgrp_code")


@query("SELECT '1' AS level, '1' || r_regionkey AS code, r_name AS name FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT '2', printf('2%03d', n_nationkey), n_name FROM nation")
def q_xml_groups(spark, d):
    return xml.groups(spark, _raw_a(spark, d, Scratch(spark), "grp")["grp"])


@query("SELECT 'c' || r_regionkey AS nutrient_code, r_name || ' (' || ['g', 'mg', 'µg', 'kcal', 'kJ'][r_regionkey + 1] || '/100 g)' AS name, ['g', 'mg', 'ug', 'kcal', 'kj'][r_regionkey + 1] AS unit FROM region")
def q_xml_constituents(spark, d):
    return xml.constituents(spark, _raw_a(spark, d, Scratch(spark), "const")["const"])


@query("SELECT n_nationkey::VARCHAR AS source_code, n_name AS ref_citation FROM nation")
def q_xml_citations(spark, d):
    return xml.citations(spark, _raw_a(spark, d, Scratch(spark), "sources")["sources"])


@query(f"WITH {RAW_CELL_SQL} SELECT *, 'per_100g_edible' AS basis FROM cell")
def q_xml_cells(spark, d):
    return xml.cells(spark, _raw_a(spark, d, Scratch(spark), "compo")["compo"]).drop("record")


@query("""SELECT 'food' AS name, count(*) AS n FROM supplier UNION ALL SELECT 'food_group', (SELECT count(DISTINCT n_regionkey) FROM nation) + (SELECT count(*) FROM nation)
UNION ALL SELECT 'constituent', count(*) FROM region UNION ALL SELECT 'value', count(*) FROM supplier, region""")
def q_extract_contract(spark, d):
    store = Scratch(spark)
    _raw_a(spark, d, store)
    t = xml.extract(spark, store.root, {k: f"{k}.xml" for k in ("alim", "grp", "const", "compo", "sources")})
    parts = [t[n].agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in tables.CONTRACT]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])


# --------------------------------------------------------------------------- raw source B

HEADERS = ("Energia\n[kcal] ", "α-tocoferol [mg]", "Água  [g]")
KEYS = ("energia_kcal", "a_tocoferol_mg", "agua_g")


def _workbook(spark, d, store: Scratch) -> str:
    """Writes nations (a table of fixed size) as a workbook with a data sheet and a sheet of components; a far column is out of the alphabet."""
    rows = [["nations"], ["Cod", "Nome do alimento", "Nivel 1", "Nivel 2", "Nivel 3", *HEADERS]]
    for r in table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).orderBy("n_nationkey").collect():
        k = r["n_nationkey"]
        rows.append([f"{k:03d}", f" {r['n_name']}  x ", "Bebidas alcoólicas" if k % 4 == 0 else r["r_name"], "l2", "l3", k * 1.5, None if k % 3 == 0 else -k, k])
    sheets = {"data": rows, "components": [["legend"], ["Energia [kcal]"], ["alfa-tocoferol [mg]"], ["Água [g]"]], "far": [[None] * 27 + ["AB"]]}
    return store.put("b.xlsx", workbook_bytes(sheets))


def _letters(k: int) -> str:
    return (chr(64 + k // 26) if k >= 26 else "") + chr(65 + k % 26)


def workbook_bytes(sheets: dict[str, list[list]]) -> bytes:
    """A small workbook: texts go to the shared strings, numbers stay in their cells."""
    main, rel = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"', "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    shared: dict[str, int] = {}
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{n}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="r{k}" Target="worksheets/s{k}.xml" Type="x"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")
        for k, rows in enumerate(sheets.values(), 1):
            out = []
            for r, row in enumerate(rows, 1):
                held = [(f"{_letters(c)}{r}", v) for c, v in enumerate(row) if v is not None]
                out.append(f'<row r="{r}">' + "".join(f'<c r="{at}"><v>{v}</v></c>' if isinstance(v, (int, float)) else f'<c r="{at}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>' for at, v in held) + "</row>")
            z.writestr(f"xl/worksheets/s{k}.xml", f"<worksheet {main}><sheetData>{''.join(out)}</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f"<sst {main}>" + "".join(f'<si><t xml:space="preserve">{v}</t></si>' for v in shared) + "</sst>")
    return buf.getvalue()


BOOK_SQL = "nat AS (SELECT n_nationkey AS k, n_name, r_name, CASE WHEN n_nationkey % 4 = 0 THEN 'Bebidas alcoólicas' ELSE r_name END AS level1 FROM nation JOIN region ON n_regionkey = r_regionkey)"


@query(f"WITH {BOOK_SQL} SELECT 'data' AS sheet, (k + 3)::INT AS row, 0 AS col, printf('%03d', k) AS text FROM nat UNION ALL SELECT 'data', (k + 3)::INT, 7, k::VARCHAR FROM nat UNION ALL SELECT 'far', 1, 27, 'AB'")
def q_workbook_cells(spark, d):
    c = xlsx.read_workbook(spark, _workbook(spark, d, Scratch(spark)))
    return c.where("sheet = 'far' or sheet = 'data' and row > 2 and col in (0, 7)")


@query("""WITH p AS (SELECT *, row_number() OVER (ORDER BY p_partkey)::INT AS r FROM part)
SELECT 'parts' AS sheet, r AS row, 0 AS col, 'P' || p_partkey AS text FROM p UNION ALL SELECT 'parts', r, 1, p_name FROM p UNION ALL SELECT 'parts', r, 3, p_size::VARCHAR FROM p WHERE p_size % 2 = 0""")
def q_workbook_source(spark, d):
    """The parts as a workbook, read in stretches of 32 KB, or in 64 larger ones (each passes over what is before it)."""
    rows = table(spark, d, "part").select("p_partkey", F.concat(F.lit("P"), "p_partkey").alias("id"), "p_name", F.lit(None).cast("string").alias("none"), F.when(F.col("p_size") % 2 == 0, F.col("p_size")).alias("size"))
    path = Scratch(spark).path("parts.xlsx")
    size = xlsx.write_workbook(rows, "p_partkey", path, "parts")
    spark.dataSource.register(xlsx.WorkbookSource)
    return spark.read.format("workbook").option("split", max(32 << 10, size // 64)).load(path)


@query(f"""WITH {BOOK_SQL}, h(header, c) AS (VALUES ('Energia [kcal]', 0), ('α-tocoferol [mg]', 1), ('Água [g]', 2))
SELECT printf('%03d', k) AS food_code, n_name || ' x' AS name, level1, 'l2' AS level2, 'l3' AS level3, header, CASE c WHEN 0 THEN k * 1.5 WHEN 1 THEN CASE WHEN k % 3 <> 0 THEN -k END ELSE k END::DOUBLE AS value FROM nat, h""")
def q_workbook_long(spark, d):
    long = xlsx.long_table(xlsx.read_workbook(spark, _workbook(spark, d, Scratch(spark))), "data")
    return long.withColumn("value", S.native_number(F.col("text"))).drop("text")


@query(f"""WITH {BOOK_SQL} SELECT 'energia_kcal' AS nutrient_code, 'Energia [kcal]' AS name, count(*) AS filled FROM nat UNION ALL
SELECT 'a_tocoferol_mg', 'alfa-tocoferol [mg]', count(*) FILTER (k % 3 <> 0) FROM nat UNION ALL SELECT 'agua_g', 'Água [g]', count(*) FROM nat""")
def q_workbook_components(spark, d):
    """The components, and how many foods have a value of each."""
    path = _workbook(spark, d, Scratch(spark))
    filled = xlsx.extract(spark, path, "data", "components")["value"].where("value is not null").groupBy("nutrient_code").agg(F.count("*").alias("filled"))
    return xlsx.component_keys(xlsx.read_workbook(spark, path), "components").join(filled, "nutrient_code").select("nutrient_code", "name", "filled")


@query(f"""WITH {BOOK_SQL}, h(nutrient_code, c) AS (VALUES ('energia_kcal', 0), ('a_tocoferol_mg', 1), ('agua_g', 2)),
v AS (SELECT printf('%03d', k) AS food_code, nutrient_code, CASE c WHEN 0 THEN k * 1.5 WHEN 1 THEN CASE WHEN k % 3 <> 0 THEN -k END ELSE k END::DOUBLE AS value, k FROM nat, h)
SELECT food_code, nutrient_code, value, CASE WHEN value IS NULL THEN 'missing' ELSE 'number' END AS value_kind, CASE WHEN k % 4 = 0 THEN 'per_100ml' ELSE 'per_100g_edible' END AS basis FROM v""")
def q_workbook_extract(spark, d):
    t = xlsx.extract(spark, _workbook(spark, d, Scratch(spark)), "data", "components")
    return t["value"].select("food_code", "nutrient_code", "value", "value_kind", "basis")


# --------------------------------------------------------------------------- dimension files, registries, contract tables


@query("SELECT n_nationkey::VARCHAR AS id, n_name || ', x' AS name FROM nation")
def q_csv_dimension(spark, d):
    rows = table(spark, d, "nation").select(F.concat(F.col("n_nationkey"), F.lit(',"'), F.col("n_name"), F.lit(', x"')).alias("value"))
    return tables.dimension(spark, Scratch(spark).lines("d.csv", rows, ["# a note", "id,name", "   # another, with, commas"]), ["id", "name"])


def _registry(spark, d) -> tuple[str, list[dict]]:
    """A registry of the regions as sources."""
    rows = table(spark, d, "region").select(F.expr("""concat_ws('\\n', concat('[sources.s', r_regionkey, ']'), concat('name = "', r_name, '"'), concat('version = "', 2000 + r_regionkey, '"'), 'license_id = "free-1"', 'url = "https://example.org"',
        'artifacts = ["core"]', concat('[[sources.s', r_regionkey, '.files]]'), concat('name = "f', r_regionkey, '"'), concat('sha256 = "', sha2(r_name, 256), '"'))""").alias("value"))
    path = Scratch(spark).lines("registry.toml", rows, ["schema_version = 1"])
    return path, tables.registry_entries(tables.toml(spark, path))


@query("SELECT 's' || r_regionkey AS source_id, r_name AS name, (2000 + r_regionkey)::VARCHAR AS version, 'free-1' AS license_id FROM region")
def q_registry_sources(spark, d):
    return tables.registry(spark, _registry(spark, d)[0]).select("source_id", "name", "version", "license_id")


@query("SELECT 's' || r_regionkey AS source_id, CASE WHEN r_regionkey < 3 THEN 'data.csv' ELSE 'in/data.csv' END AS file, sha256(r_name) AS sha256, CASE WHEN r_regionkey = 3 THEN sha256('other') ELSE sha256(r_name) END AS expected, r_regionkey <> 3 AS ok FROM region")
def q_checksum_verify(spark, d):
    """Files of sources that use the same names, against the registry's pinned hashes; one of them is pinned wrongly."""
    store, path = Scratch(spark), _registry(spark, d)[0]
    for r in table(spark, d, "region").collect():
        store.put(f"files/s{r['r_regionkey']}/{'' if r['r_regionkey'] < 3 else 'in/'}data.csv", r["r_name"].encode())
    name = F.when(F.col("source_id") < "s3", "data.csv").otherwise("in/data.csv")
    pinned = tables.pinned_files(spark, path).withColumn("file", name).withColumn("sha256", F.when(F.col("source_id") == "s3", F.sha2(F.lit("other"), 256)).otherwise(F.col("sha256")))
    return tables.verify_checksums(spark, store.path("files"), pinned).select("source_id", "file", "sha256", "expected", "ok")


CHAIN_SQL = "chain(locale, hop, pos) AS (VALUES " + ", ".join(str((x, hop, k)) for x in K.CHAINS for k, hop in enumerate([x, *K.CHAINS[x]])) + ")"


@query(f"WITH {CHAIN_SQL} SELECT doc_id, hop, pos FROM documents JOIN chain ON locale = lang")
def q_locale_chains(spark, d):
    """The fallbacks of each document's language, by a file of chains."""
    text = "active = " + json.dumps(list(K.CHAINS)) + "\n" + "\n".join(f"[locale.{k}]\nfallback = {json.dumps(v)}" for k, v in K.CHAINS.items())
    active, chains = tables.locales(spark, Scratch(spark).put("locales.toml", text.encode()))
    docs = table(spark, d, "documents").select("doc_id", F.col("lang").alias("locale"))
    return docs.join(F.broadcast(search.chain_table(spark, active, chains)), "locale").select("doc_id", "hop", "pos")  # a few rows a locale


@query("SELECT p_partkey::VARCHAR AS id, p_name AS name, p_size::VARCHAR AS size FROM part")
def q_caret_records(spark, d):
    rows = table(spark, d, "part").select(F.expr("concat('~', p_partkey, '~^~', p_name, '~^', p_size)").alias("value"))
    return tables.caret(spark, Scratch(spark).lines("r.txt", rows), ["id", "name", "size"])


RETENTION = ("ROASTED", "Boiled in water", "raw", "MICROWAVED", "Simmr, roasted")


@query(f"""WITH t AS (SELECT n_regionkey AS r, p_size AS v, {RETENTION!r}[(p_partkey % 5)::INT + 1] AS d FROM part JOIN nation ON p_partkey % 25 = n_nationkey),
m AS (SELECT r, v, CASE WHEN contains(upper(d), 'MICROWAVE') THEN 'microwaved' WHEN contains(upper(d), 'BOIL') THEN 'boiled' WHEN contains(upper(d), 'SIMMR') THEN 'simmered' WHEN contains(upper(d), 'ROAST') THEN 'roasted' END AS method FROM t)
SELECT 'n' || r AS nutrient, method, round(median(v) / 100, 4) AS factor, count(*) AS n, min(v) / 100 AS low, max(v) / 100 AS high FROM m WHERE method IS NOT NULL GROUP BY ALL""".replace("('ROASTED'", "['ROASTED'").replace("roasted')[(", "roasted'][("))
def q_retention_factors(spark, d):
    text = F.element_at(F.array(*map(F.lit, RETENTION)), (F.col("p_partkey") % 5 + 1).cast("int"))
    rows = table(spark, d, "part").join(table(spark, d, "nation"), F.col("p_partkey") % 25 == F.col("n_nationkey")).select(F.concat(F.lit("~"), F.col("p_partkey"), F.lit("~^~"), text, F.lit("~^"), F.col("n_regionkey"), F.lit("^"), F.col("p_size")).alias("value"))
    codes = table(spark, d, "region").select(F.col("r_regionkey").cast("string").alias("nutrient_code"), F.concat(F.lit("n"), F.col("r_regionkey")).alias("nutrient"))
    return factors.retention(spark, Scratch(spark).lines("retention.txt", rows), ["id", "description", "nutrient_code", "factor"], codes)


@query("SELECT 's' || (n_regionkey % 2) AS source_id, count(*) AS n, sum(n_nationkey) AS total FROM nation GROUP BY ALL")
def q_contract_union(spark, d):
    folder, nat = Scratch(spark).path("contract"), table(spark, d, "nation")
    for k in (0, 1):
        own = nat.where(F.col("n_regionkey") % 2 == k).select(F.col("n_nationkey").alias("value"))
        tables.write_contract({n: own for n in tables.CONTRACT}, folder, f"s{k}")
    known = spark.createDataFrame([("s0",), ("s1",), ("s2",)], "source_id string")
    return tables.contract_table(spark, folder, "value", known).groupBy("source_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


@query("SELECT 'g' || n_regionkey AS food_group, (100 + n_regionkey) / 100 AS density_g_per_ml, 'e' || n_regionkey AS evidence FROM nation GROUP BY ALL")
def q_factor_table(spark, d):
    rows = table(spark, d, "nation").select(F.expr("concat('g', n_regionkey, ',', (100 + n_regionkey) / 100, ',e', n_regionkey)").alias("value")).distinct()
    return tables.densities(spark, Scratch(spark).lines("densities.csv", rows, ["# factors", "food_group,density_g_per_ml,evidence"]))


# --------------------------------------------------------------------------- transform and derive

ID_PARTS = "'nfx_' || " + " || ".join(["substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', ((('0x' || substr(h, 1, 2))::BIGINT >> {s}) & 31)::INT + 1, 1)".format(s=s) for s in (5, 0)] + ["substr('0123456789ABCDEFGHJKMNPQRSTVWXYZ', ((('0x' || substr(h, {a}, 5))::BIGINT >> {s}) & 31)::INT + 1, 1)".format(a=3 + 5 * k, s=s) for k in range(6) for s in (15, 10, 5, 0)])


def id_sql(seed: str) -> str:
    return f"(SELECT {ID_PARTS} FROM (SELECT substr(sha256('nfx_:' || {seed}), 1, 32) AS h))"


FACTORS = (1.0, 1000.0, 0.5, 1.0, 2.0)


def _contract(spark, d) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(contract tables, nutrient mapping, group mapping) of source A without the files between."""
    sup = _suppliers(spark, d).withColumn("food_code", F.expr(CODE))
    a = F.lit("a").alias("source_id")
    path = F.to_json(F.struct(F.concat(F.lit("1"), "r_regionkey").alias("1"), F.expr("format_string('2%03d', n_nationkey)").alias("2"), F.lit("x").alias("3")))
    food = sup.select(a, "food_code", F.col("s_name").alias("name"), F.to_json(F.struct(F.concat(F.lit("en "), "s_name").alias("en"), F.col("s_name").alias("fr"))).alias("names"), path.alias("group_path"), F.lit("{}").alias("record"))
    grid = sup.select("food_code", "s_suppkey", "s_acctbal", "s_nationkey").withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4))))
    c = (F.col("s_suppkey") + F.col("k")) % 5
    value = grid.select(
        a, "food_code", F.concat(F.lit("c"), "k").alias("nutrient_code"), F.when(c == 3, F.round("s_acctbal", 2)).when(c == 4, 1.25).alias("value"), F.when(c == 0, "missing").when(c == 1, "trace").when(c == 2, "below_loq").otherwise("number").alias("value_kind"),
        F.when(c == 2, F.col("k") + 1.5).alias("threshold"), F.when(F.col("s_suppkey") % 4 == 0, 0.5).alias("min_value"), F.when(F.col("s_suppkey") % 4 < 2, 9.75).alias("max_value"), F.lit("A").alias("confidence_code"), F.lit(K.PER_100G).alias("basis"), F.lit("{}").alias("record"),
    )
    reg = table(spark, d, "region")
    constituent = reg.select(a, F.concat(F.lit("c"), "r_regionkey").alias("nutrient_code"), F.col("r_name").alias("name"), F.lit("g").alias("unit"))
    mapping = spark.createDataFrame([("a", f"c{k}", f"T{k}", str(x), "g", "-", "1") for k, x in enumerate(FACTORS)], "source_id string, nutrient_code string, tagname string, factor string, unit string, energy_method string, is_default string")
    one = reg.select(a, F.lit("1").alias("level"), F.concat(F.lit("1"), "r_regionkey").alias("code"), F.col("r_name").alias("food_group"))
    two = table(spark, d, "nation").where("n_nationkey % 2 = 0").select(a, F.lit("2").alias("level"), F.expr("format_string('2%03d', n_nationkey)").alias("code"), F.col("n_name").alias("food_group"))
    return {"food": food, "food_group": one, "constituent": constituent, "value": value}, mapping, one.unionAll(two)


FACTOR_SQL = "CASE k " + " ".join(f"WHEN {k} THEN {x}" for k, x in enumerate(FACTORS)) + " END"
TRANSFORM_SQL = f"""{SUP_SQL}, raw AS (SELECT s_suppkey, code, r.r_regionkey AS k, s_acctbal, (s_suppkey + r.r_regionkey) % 5 AS c, {FACTOR_SQL.replace(' k ', ' r.r_regionkey ')} AS f FROM sup, region r),
canon AS (
  SELECT {id_sql("'concept|a|food|' || code")} AS concept_id, 'T' || k AS nutrient_id, CASE c WHEN 3 THEN round(s_acctbal, 2) WHEN 4 THEN 1.25 END * f AS value, CASE c WHEN 1 THEN 'trace' WHEN 2 THEN 'below_loq' ELSE 'measured' END AS value_type,
         {id_sql("'source_record|a|value|' || code || ':c' || k")} AS source_record_id, CASE WHEN s_suppkey % 4 = 0 THEN 0.5 END * f AS min_value, CASE WHEN s_suppkey % 4 < 2 THEN 9.75 END * f AS max_value, CASE WHEN c = 2 THEN k + 1.5 END * f AS below_loq_threshold, k, code
  FROM raw WHERE c <> 0),
grp AS (SELECT {id_sql("'concept|a|food|' || code")} AS concept_id, CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE r_name END AS food_group FROM sup)"""


@query(f"WITH {TRANSFORM_SQL} SELECT concept_id, nutrient_id, value, value_type, source_record_id, min_value, max_value, below_loq_threshold FROM canon")
def q_transform_values(spark, d):
    c = build.transform(*_contract(spark, d))
    return c["value"].select("concept_id", "nutrient_id", "value", "value_type", "source_record_id", "min_value", "max_value", "below_loq_threshold")


@query(f"WITH {TRANSFORM_SQL} SELECT concept_id, food_group FROM grp")
def q_level_fallback(spark, d):
    """The group of the deepest level that has one: half of the nations have their own, all others take their region's."""
    return build.transform(*_contract(spark, d))["concept"].select("concept_id", "food_group")


@query(f"""WITH {RAW_CELL_SQL}, m AS (SELECT value_kind, {FACTOR_SQL.replace(' k ', ' substr(nutrient_code, 2)::INT ')} AS f FROM cell)
SELECT 'a' AS source_id, count(*) FILTER (value_kind = 'number') AS measured, count(*) FILTER (value_kind = 'trace') AS trace, count(*) FILTER (value_kind = 'below_loq') AS below_loq, count(*) FILTER (value_kind = 'missing') AS not_measured, count(*) FILTER (f <> 1 AND value_kind <> 'missing') AS conversions FROM m""")
def q_transform_counts(spark, d):
    t, mapping, _ = _contract(spark, d)
    return build.counts(t["value"], mapping)


@query(f"""WITH {CELL_SQL} SELECT 'rows' AS counter, count(*) AS n FROM cell UNION ALL SELECT 'measured', count(*) FROM cell WHERE value_type = 'measured' UNION ALL
SELECT 'trace', count(*) FROM cell WHERE value_type = 'trace' UNION ALL SELECT 'below_loq', count(*) FROM cell WHERE value_type = 'below_loq' UNION ALL SELECT 'sources', count(DISTINCT source_id) FROM cell""")
def q_observed_counters(spark, d):
    """Counters of the cells, taken while they are written, and read back from where the build keeps them."""
    store, kinds = Scratch(spark), ("measured", "trace", "below_loq")
    watch = gates.Watch(cells(spark, d), {k: F.count_if(F.col("value_type") == k) for k in kinds} | {"sources": F.size(F.collect_set("source_id")).cast("long")}, {"no source": F.col("source_id").isNotNull()})
    watch.df.write.parquet(store.path("cells"))
    return spark.read.json(store.put("counts.json", "\n".join(json.dumps({"counter": k, "n": v}) for k, v in watch.counts().items()).encode()), "counter string, n long")


@query(f"""WITH {TRANSFORM_SQL}, dens(food_group, x) AS (VALUES ('ASIA', 1.1), ('NATION_2', 0.9)), m AS (SELECT c.*, x FROM canon c JOIN grp USING (concept_id) JOIN dens USING (food_group) WHERE value_type = 'measured')
SELECT concept_id, nutrient_id, basis, value, derivation_id IS NOT NULL AS derived FROM (
  SELECT concept_id, nutrient_id, 'per_100g_edible' AS basis, value, NULL AS derivation_id FROM canon UNION ALL SELECT concept_id, nutrient_id, 'per_100ml', value * x, 'd' FROM m)""")
def q_derived_values(spark, d):
    """Old values and derived ones in one table, with the tables the derivations rest on."""
    c = build.derive(build.transform(*_contract(spark, d)), spark.createDataFrame([("ASIA", 1.1), ("NATION_2", 0.9)], "food_group string, density_g_per_ml double"))
    return c["value"].select("concept_id", "nutrient_id", "basis", "value", F.col("derivation_id").isNotNull().alias("derived"))


@query(f"""WITH {TRANSFORM_SQL}, dens(food_group, x) AS (VALUES ('ASIA', 1.1), ('NATION_2', 0.9)), m AS (SELECT c.*, x FROM canon c JOIN grp USING (concept_id) JOIN dens USING (food_group) WHERE value_type = 'measured')
SELECT {id_sql("'derivation|a|volume|' || source_record_id || ':100ml'")} AS derivation_id, source_record_id AS inputs, x::DOUBLE AS density FROM m UNION ALL SELECT 'old', 'x', 0.5::DOUBLE""")
def q_derivation_chain(spark, d):
    old = spark.createDataFrame([("old", "f", "x", '{"density":0.5}')], "derivation_id string, formula string, inputs string, factors string")
    c = build.derive(build.transform(*_contract(spark, d)) | {"derivation": old}, spark.createDataFrame([("ASIA", 1.1), ("NATION_2", 0.9)], "food_group string, density_g_per_ml double"))
    return c["derivation"].select("derivation_id", "inputs", F.get_json_object("factors", "$.density").cast("double").alias("density"))


@query(f"WITH {RAW_CELL_SQL} SELECT DISTINCT food_code, source_code FROM cell WHERE source_code::INT % 3 = 0")
def q_unknown_keys(spark, d):
    """Keys of the cells that a dimension (here: two thirds of the nations, with every food) does not hold."""
    sup = table(spark, d, "supplier").select(F.expr(CODE).alias("food_code"), F.col("s_nationkey").cast("string").alias("source_code"))
    known = sup.where("source_code % 3 <> 0")
    cell = sup.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4))))
    return gates.unknown(cell, known, ["food_code", "source_code"])


# --------------------------------------------------------------------------- scalar functions


@query(r"""SELECT p_partkey, trim(regexp_replace('  ' || p_name || chr(10) || chr(9) || ' x', '\s+', ' ', 'g')) AS collapsed,
       ['kcal', 'kj', 'ug', NULL][(p_partkey % 4)::INT + 1] AS unit, 'a_' || replace(p_name, ' ', '_') || '_c' AS ascii_key,
       '&lt;b&gt; ' || p_name || ' &amp; x' AS escaped, CASE p_partkey % 3 WHEN 0 THEN 'roasted' WHEN 1 THEN 'fried' END AS method FROM part""")
def q_scalar_text(spark, d):
    p, n, k = table(spark, d, "part"), F.col("p_name"), F.col("p_partkey")
    unit = F.element_at(F.array(*map(F.lit, ("kcal", "kJ", "µg", "IU"))), (k % 4 + 1).cast("int"))
    method = F.element_at(F.array(*map(F.lit, ("Baked, roasted later", "sauteed", "raw"))), (k % 3 + 1).cast("int"))
    return p.select(
        "p_partkey", S.collapse_space(F.concat(F.lit("  "), n, F.lit("\n\t x"))).alias("collapsed"), S.unit_of(F.concat(n, F.lit(" ("), unit, F.lit("/100 g)"))).alias("unit"),
        S.ascii_key(F.concat(F.lit("α-"), n, F.lit(" (Ç)"))).alias("ascii_key"), S.html_escape(F.concat(F.lit("<b> "), n, F.lit(" & x"))).alias("escaped"), S.classify_method(method).alias("method"),
    )


@query(r"""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_size + 0.5 END AS bound, CASE WHEN p_partkey % 3 <> 0 THEN p_retailprice END AS native, p_retailprice * p_size AS converted,
       p_retailprice * 0.8 * 1.25 AS cooked, CASE WHEN p_size = 0 THEN 0 ELSE abs(p_size - 25) / greatest(p_size, 25) END AS difference, CASE WHEN p_partkey % 4 < 2 THEN (p_partkey % 4)::INT + 1 ELSE 3 END AS place FROM part""")
def q_scalar_numbers(spark, d):
    k, size, price = F.col("p_partkey"), F.col("p_size"), F.col("p_retailprice")
    source = F.element_at(F.array(*map(F.lit, ("a", "b", "c", "d"))), (k % 4 + 1).cast("int"))
    return table(spark, d, "part").select(
        "p_partkey", S.parse_bound(F.when(k % 2 == 0, F.concat(size, F.lit(",5"))).otherwise("")).alias("bound"), S.native_number(F.when(k % 3 != 0, price.cast("string")).otherwise(" ")).alias("native"), S.convert(price, size.cast("double")).alias("converted"),
        S.cooked(price, F.lit(0.8), F.lit(1.25)).alias("cooked"), S.relative_difference(size.cast("double"), F.lit(25.0)).alias("difference"), S.rank_in(F.array(F.lit("a"), F.lit("b")), source).alias("place"),
    )


@query("""SELECT p_partkey, '{"brand":' || CASE WHEN p_partkey % 2 = 0 THEN 'null' ELSE '"' || p_brand || '"' END || ',"key":' || p_partkey || ',"name":"' || p_name || ' é"}' AS record FROM part""")
def q_canonical_json(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.concat("p_name", F.lit(" é")).alias("name"), F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") % 2 != 0, F.col("p_brand")).alias("brand"))
    return p.select("p_partkey", S.canonical_json(["name", "key", "brand"]).alias("record"))


ODD = {"brânză și țuică": "branza si tuica", "Ｆｕｌｌ ﬁne": "full fine", "ΆΈ ένα": "αε ενα", "Đà Nẵng": "đa nang", "Straße œuf": "strasse oeuf", "½ cup": "1⁄2 cup"}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{k}', '{v}')" for k, v in ODD.items()) + ") v(text, folded) UNION ALL SELECT 'É' || p_name || p_partkey, 'e' || p_name || p_partkey FROM part")
def q_fold_any_script(spark, d):
    rows = spark.createDataFrame([(k,) for k in ODD], "text string").unionAll(table(spark, d, "part").select(F.concat(F.lit("É"), "p_name", "p_partkey")))
    return rows.select("text", T.normalize_label(F.col("text")).alias("folded"))


# --------------------------------------------------------------------------- search and labels


@query(f"""WITH {LABEL_SQL}, h AS (SELECT label_id, locale, row_number() OVER (ORDER BY label_id) AS k FROM label JOIN documents ON doc_id = label_id WHERE locale = 'en' AND source = (SELECT min(source) FROM documents) AND (contains(lower(label.text), 'her') OR contains(norm, 'her')))
SELECT label_id, locale FROM h WHERE k <= 30""")
def q_search_facet(spark, d):
    docs = table(spark, d, "documents")
    groups = docs.select(F.col("doc_id").cast("string").alias("concept_id"), F.col("source").alias("food_group"))
    first = docs.agg(F.min("source")).first()[0]
    return search.search(doc_labels(spark, d), "her", "en", 30, "food", groups, first).select("label_id", "locale")


@query("SELECT 'nation' AS kind, n_nationkey::VARCHAR AS ref, CASE WHEN n_nationkey % 3 = 0 THEN 'pt ' || n_name WHEN n_nationkey % 3 = 1 THEN 'en ' || n_name END AS display FROM nation")
def q_display_labels(spark, d):
    """Labels through the chain pt-PT, pt, en: a third of the nations have one in pt, a third in en only, the others in de."""
    n = table(spark, d, "nation").select(F.lit("nation").alias("ref_kind"), F.col("n_nationkey").cast("string").alias("ref"), "n_name", (F.col("n_nationkey") % 3).alias("m"))
    row = lambda locale, cond: n.where(cond).select("ref_kind", "ref", F.lit(locale).alias("locale"), F.concat(F.lit(f"{locale} "), "n_name").alias("text"))
    have = row("pt", "m = 0").unionAll(row("en", "m < 2")).unionAll(row("de", "true"))
    return search.display_labels(n.select("ref_kind", "ref"), have, "pt-PT").select(F.col("ref_kind").alias("kind"), "ref", "display")


@query("""WITH l AS (SELECT n_nationkey AS id, lower(n_name) AS t FROM nation), g AS (SELECT id, substr(t, i, 3) AS gram FROM l, generate_series(1, length(t) - 2) s(i))
SELECT DISTINCT id AS label_id, gram FROM g""")
def q_trigram_index(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("label_id"), F.lit("en").alias("locale"), F.col("n_name").alias("text"), T.normalize_label(F.col("n_name")).alias("text_normalized"))
    return search.trigram_index(n).select("label_id", "gram")


@query(f"WITH {LABEL_SQL} SELECT label_id, locale, word, count(*) AS tf FROM (SELECT label_id, locale, unnest(regexp_extract_all(norm, '[\\p{{L}}\\p{{N}}]+')) AS word FROM label) GROUP BY ALL")
def q_word_index(spark, d):
    return search.word_index(doc_labels(spark, d))


BRANCH_SQL = """b AS (
  SELECT lang AS locale, 'curated' AS status FROM documents JOIN labels USING (doc_id) WHERE quality = 1 UNION ALL
  SELECT lang, 'native' FROM documents WHERE n_chars < 2000 UNION ALL SELECT lang, 'mt_unreviewed' FROM documents)"""


@query(f"WITH {BRANCH_SQL} SELECT locale, status, count(*) AS n FROM b GROUP BY ALL")
def q_label_status_counts(spark, d):
    return labels.status_counts(_branches(spark, d))


NAME_SQL = """lab(ref, locale, status, text) AS (
  SELECT 'T' || n_nationkey, 'en', 'official', n_name FROM nation UNION ALL SELECT 'T' || n_nationkey, 'pt', CASE WHEN n_nationkey % 2 = 0 THEN 'curated' ELSE 'mt_unreviewed' END, n_name FROM nation WHERE n_nationkey <> 5 UNION ALL
  SELECT 'T' || n_nationkey, 'pt-PT', 'curated', n_name FROM nation WHERE n_nationkey % 4 = 0)"""


@query(f"""WITH {NAME_SQL}, div AS (SELECT 'T' || n_nationkey AS ref, n_name FROM nation WHERE n_nationkey % 4 = 0)
SELECT 'unreviewed' AS gate, locale, ref FROM lab WHERE status = 'mt_unreviewed' UNION ALL
SELECT 'missing', l.locale, 'T' || n_nationkey FROM nation, (VALUES ('en'), ('pt')) l(locale) WHERE NOT (l.locale = 'pt' AND n_nationkey % 4 = 0) AND NOT EXISTS (SELECT 1 FROM lab WHERE lab.ref = 'T' || n_nationkey AND lab.locale = l.locale) UNION ALL
SELECT 'share', locale, NULL FROM lab GROUP BY locale HAVING avg(CASE WHEN status IN ('native', 'official', 'curated') THEN 1 ELSE 0 END) < 0.95 UNION ALL
SELECT 'divergent_generic', 'pt', ref FROM lab JOIN div USING (ref) WHERE locale = 'pt' UNION ALL SELECT 'divergent_variant', 'pt-BR', ref FROM div UNION ALL SELECT 'divergent_text', 'pt-BR', ref FROM div""")
def q_label_gates(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("T"), "n_nationkey").alias("ref"), F.col("n_name").alias("text"), F.col("n_nationkey").alias("k"))
    row = lambda df, locale, status: df.select(F.lit("nutrient").alias("ref_kind"), "ref", F.lit(locale).alias("locale"), status.alias("status"), "text")
    lab = row(n, "en", F.lit("official")).unionAll(row(n.where("k <> 5"), "pt", F.when(F.col("k") % 2 == 0, "curated").otherwise("mt_unreviewed"))).unionAll(row(n.where("k % 4 = 0"), "pt-PT", F.lit("curated")))
    div = n.where("k % 4 = 0").select("ref", F.col("text").alias("pt-PT"), F.concat("text", F.lit("!")).alias("pt-BR"))
    glossary = n.select(F.col("ref").alias("tagname"), F.explode(F.array(F.lit("pt-PT"), F.lit("pt-BR"))).alias("locale"), F.col("text").alias("label"))
    return labels.gate_findings(lab, n.select(F.col("ref").alias("tagname")), ["en", "pt"], div, glossary)


@query("SELECT 'nation' AS ref_kind, n_nationkey::VARCHAR AS ref, 'pt' AS locale, 'curated' AS status, n_name AS text FROM nation WHERE n_nationkey % 3 <> 0")
def q_label_review(spark, d):
    queue = table(spark, d, "nation").select(F.lit("nation").alias("ref_kind"), F.col("n_nationkey").cast("string").alias("ref"), F.lit("pt").alias("locale"), F.col("n_name").alias("label"), F.when(F.col("n_nationkey") % 3 == 0, "rejected").otherwise("approved").alias("candidate_status"))
    return labels.review_queue(queue)[0]


@query("SELECT r_name AS ref, string_agg(n_name, '|' ORDER BY n_name) AS names, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
def q_label_lists(spark, d):
    """Lists of labels by group, in order."""
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy(F.col("r_name").alias("ref")).agg(F.array_join(F.array_sort(F.collect_list("n_name")), "|").alias("names"), F.count("*").alias("n"))


# --------------------------------------------------------------------------- the matcher

DICTIONARY = [(1, "ring", "ring|rings", "anneau", "ring"), (2, "small", "small|tiny", "petit", "small"), (3, "small_ring", "small ring", "", ""), (4, "# a note", "x", "x", "x"), (5, "gadget", "ring|a", "", "gizmo"), (6, "", "lost", "", "")]


def _dictionary(spark) -> DataFrame:
    return matching.dictionary(spark.createDataFrame(DICTIONARY, "row int, term string, pt string, fr string, en string"), ("pt", "fr", "en"))


@query("""WITH r AS (SELECT p_partkey AS row, CASE WHEN p_size % 9 = 0 THEN '# note' ELSE p_type END AS term, p_name AS pt, p_type || '|' || p_name || '|x' AS fr, '' AS en FROM part),
l AS (SELECT row, term, 'pt' AS lang, string_split(pt, '|') AS cells FROM r UNION ALL SELECT row, term, 'fr', string_split(fr, '|') FROM r),
c AS (SELECT row, term, lang, array_to_string(regexp_extract_all(lower(unnest(cells)), '[a-z0-9]+'), ' ') AS key, generate_subscripts(cells, 1) AS place FROM l WHERE term NOT LIKE '#%')
SELECT lang, key, nullif(arg_max(CASE WHEN length(key) >= 2 THEN term ELSE '~' END, row * 100 + place), '~') AS term FROM c WHERE key <> '' GROUP BY ALL""")
def q_term_dictionary(spark, d):
    """The parts as a curated table: a term a row, its name and type as synonyms; a key of one letter names no term, the last row of a key holds."""
    p = table(spark, d, "part")
    rows = p.select(F.col("p_partkey").alias("row"), F.when(F.col("p_size") % 9 == 0, "# note").otherwise(F.col("p_type")).alias("term"), F.col("p_name").alias("pt"), F.concat_ws("|", "p_type", "p_name", F.lit("x")).alias("fr"), F.lit("").alias("en"))
    return matching.dictionary(rows, ("pt", "fr", "en")).select("lang", "key", "term")


@query("""WITH RECURSIVE w AS (SELECT p_partkey, string_split(p_name || ' ring tiny small ring', ' ') AS t FROM part),
scan(p_partkey, t, i, found) AS (
  SELECT p_partkey, t, 1, NULL::VARCHAR FROM w
  UNION ALL
  SELECT p_partkey, t, CASE WHEN t[i] = 'small' AND t[i + 1] = 'ring' THEN i + 2 ELSE i + 1 END,
         CASE WHEN t[i] = 'small' AND t[i + 1] = 'ring' THEN 'small_ring' WHEN t[i] IN ('ring') THEN 'gadget' WHEN t[i] = 'rings' THEN 'ring' WHEN t[i] IN ('small', 'tiny') THEN 'small' END
  FROM scan WHERE i <= len(t))
SELECT p_partkey, string_agg(DISTINCT found, '|' ORDER BY found) AS terms FROM scan WHERE found IS NOT NULL GROUP BY ALL""")
def q_term_scan(spark, d):
    """Dictionary terms of names, the longest phrase first."""
    keys = _dictionary(spark).where("lang = 'pt'")
    rows = table(spark, d, "part").select(F.col("p_partkey").alias("id"), T.words_exact(F.concat("p_name", F.lit(" ring tiny small ring"))).alias("w"))
    return matching.phrase_terms(rows, "w", keys).select(F.col("id").alias("p_partkey"), F.array_join("terms", "|").alias("terms"))


@query()
def q_phrase_join(spark, d):
    """Terms of doubled part names, by a dictionary made of the parts' own names and first words: a test holds it against a plain scan."""
    p = table(spark, d, "part")
    whole = p.where("p_partkey % 3 <> 0").groupBy(F.col("p_name").alias("key")).agg(F.max_by("p_brand", "p_partkey").alias("term"))
    first = p.where("p_size % 2 = 0").groupBy(F.substring_index("p_name", " ", 1).alias("key")).agg(F.min("p_type").alias("term"))
    rows = p.select(F.col("p_partkey").alias("id"), F.split(F.concat_ws(" ", "p_name", "p_name"), " ").alias("w"))
    return matching.phrase_terms(rows, "w", whole.unionAll(first)).select(F.col("id").alias("p_partkey"), F.array_join("terms", "|").alias("terms"))


SIGN_SQL = """a AS (SELECT p_partkey AS id, string_split(p_name, ' ') AS w, p_size FROM part WHERE p_partkey % 2 = 0), b AS (SELECT p_partkey AS id, string_split(p_name, ' ') AS w, p_size FROM part WHERE p_partkey % 2 = 1),
j AS (SELECT a.id AS left_id, b.id AS right_id, a.w AS x, b.w AS y, a.p_size AS m, b.p_size AS n FROM a JOIN b ON b.id = a.id + 1)"""


@query(f"""WITH {SIGN_SQL}, s AS (
  SELECT *, len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) AS jaccard, list_filter(list_distinct(x), lambda w: w NOT IN ('small', 'red')) AS dx, list_filter(list_distinct(y), lambda w: w NOT IN ('small', 'red')) AS dy FROM j)
SELECT left_id, right_id, 0.55 * jaccard + 0.25 * 0.75 + 0.2 * CASE WHEN m = n THEN 1 ELSE 0 END AS score, array_to_string(list_sort(dx), '|') AS own,
       len(list_filter(x, lambda w: NOT list_contains(y, w) AND w NOT IN ('red', 'large', 'raw', 'green', 'white', 'light'))) + len(dx) > 0 AND len(list_filter(y, lambda w: NOT list_contains(x, w) AND w NOT IN ('large', 'raw', 'light'))) + len(dy) > 0 AS conflict, m <> n AS numbers,
       CASE WHEN left_id % 10 = 0 OR 0.55 * jaccard + 0.25 * 0.75 + 0.2 * CASE WHEN m = n THEN 1 ELSE 0 END < 0.5 THEN NULL WHEN m <> n THEN 'review' WHEN 0.55 * jaccard + 0.25 * 0.75 + 0.2 >= 0.84 THEN 'automatic' ELSE 'review' END AS status FROM s""")
def q_match_signals(spark, d):
    """Score, distinctive words, both conflicts and the status of neighbouring parts (sizes as the numbers in their names)."""
    p = table(spark, d, "part").select(F.col("p_partkey").alias("id"), S.words_of(F.col("p_name")).alias("w"), "p_size", F.concat_ws(" ", "p_name", "p_size").alias("name"))
    a, b = p.where("id % 2 = 0").toDF("left_id", "x", "m", "na"), p.where("id % 2 = 1").toDF("right_id", "y", "n", "nb")
    j = a.join(b, F.col("right_id") == F.col("left_id") + 1)
    explained = F.array(F.lit("small"), F.lit("red"))
    dx, dy = matching.distinctive_words(F.col("x"), explained), matching.distinctive_words(F.col("y"), explained)
    j = j.withColumn("score", matching.score(F.col("x"), F.col("y"), F.lit(0.75), F.col("m") == F.col("n"))).withColumn("conflict", matching.distinctive_conflict(F.col("x"), F.col("y"), dx, dy)).withColumn("numbers", matching.numeric_conflict(F.col("na"), F.col("nb")))
    return j.select("left_id", "right_id", "score", F.array_join(F.array_sort(dx), "|").alias("own"), "conflict", "numbers", matching.status(F.col("score"), F.lit(0.75), F.col("left_id") % 10 == 0, F.col("numbers"), F.lit(False)).alias("status"))


def _foods_to_match(spark, d) -> tuple[DataFrame, ...]:
    """Parts as foods of two sources: on the right under reordered names, a fifth of them under another name, with a core value that disagrees here and there."""
    k, n = F.col("p_partkey"), F.col("p_name")
    p = table(spark, d, "part")
    left = p.select(k.cast("string").alias("id"), F.col("p_type").alias("food_group"), F.concat_ws(" ", n, F.concat(F.lit("ser"), k)).alias("pt"))
    other = F.when(k % 5 == 0, F.lit("odd thing")).when(k % 11 == 0, F.concat(F.lit("no 7 "), n)).otherwise(n)
    right = p.select((k + 1).cast("string").alias("id"), F.col("p_type").alias("food_group"), F.concat_ws(" ", F.concat(F.lit("ser"), k), other).alias("fr"), F.when(k % 2 == 0, n).alias("en"))
    values = lambda key, times: p.select(key.cast("string").alias("id"), F.expr(f"stack(3, 'FAT', p_size * {times}, 'WATER', p_retailprice * {times}, 'PROCNT', 1D) as (nutrient_id, value)"))
    words = [(i, w, w, w, w) for i, w in enumerate(("plate", "rod", "small", "gear", "gizmo", "anvil", "hot", "old", "widget", "large", "red", "ring", "bolt", "blue", "cold", "new"))]
    terms = matching.dictionary(spark.createDataFrame(words, "row int, term string, pt string, fr string, en string"), ("pt", "fr", "en"))
    return left, right, terms, values(k, "1D"), values(k + 1, "case when p_partkey % 7 = 0 then 9D else 1D end")


@query()
def q_match_foods(spark, d):
    """The matcher as a whole, down to its links: no SQL (name similarity); tests hold it against plain loops."""
    store = Scratch(spark)
    a, b, terms, x, y = _foods_to_match(spark, d)
    found = store.save(matching.propose(a, b, terms, x, y, {"pt": "pt"}, {"fr": "fr", "en": "en"}, store.save))
    return matching.links(found, "a", "b", store.save)


LINK_SQL = """link(concept_id, side, code, status) AS (
  SELECT 'x' || n_regionkey, 'left', n_nationkey::VARCHAR, 'review' FROM nation WHERE n_nationkey % 3 = 0 UNION ALL
  SELECT 'x' || n_regionkey, 'right', n_nationkey::VARCHAR, 'review' FROM nation WHERE n_nationkey % 3 = 1 UNION ALL
  SELECT 'x' || n_regionkey, 'left', n_nationkey::VARCHAR, 'automatic' FROM nation WHERE n_nationkey % 3 = 2),
pair AS (SELECT a.concept_id, a.code AS left_code, b.code AS right_code FROM link a JOIN link b USING (concept_id) WHERE a.status = 'review' AND b.status = 'review' AND a.side = 'left' AND b.side = 'right')"""


def _links(spark, d) -> DataFrame:
    m = F.col("n_nationkey") % 3
    return table(spark, d, "nation").select(F.concat(F.lit("x"), "n_regionkey").alias("concept_id"), F.when(m == 1, "right").otherwise("left").alias("side"), F.col("n_nationkey").cast("string").alias("code"), F.when(m == 2, "automatic").otherwise("review").alias("status"))


@query(f"WITH {LINK_SQL} SELECT * FROM pair")
def q_review_pairs(spark, d):
    return matching.review_pairs(_links(spark, d))


@query(f"""WITH {LINK_SQL}, dec AS (SELECT *, CASE WHEN (left_code::INT + right_code::INT) % 2 = 0 THEN 'accepted' ELSE 'rejected' END AS decision FROM pair WHERE (left_code::INT + right_code::INT) % 5 <> 0),
j AS (SELECT p.*, decision FROM pair p LEFT JOIN dec USING (concept_id, left_code, right_code)),
r AS (SELECT concept_id, 'left' AS side, left_code AS code, decision FROM j UNION ALL SELECT concept_id, 'right', right_code, decision FROM j),
done AS (SELECT concept_id, side, code FROM r GROUP BY ALL HAVING bool_and(decision IS NOT NULL))
SELECT * FROM link l WHERE status <> 'review' OR NOT EXISTS (SELECT 1 FROM done x WHERE x.concept_id = l.concept_id AND x.side = l.side AND x.code = l.code)
UNION ALL SELECT DISTINCT concept_id, side, code, 'adjudicated' FROM r WHERE decision = 'accepted'""")
def q_review_decisions(spark, d):
    """Some of the pairs under review are decided; rows stay until all their pairs are."""
    store, links = Scratch(spark), _links(spark, d)
    total = F.col("left_code").cast("int") + F.col("right_code").cast("int")
    dec = store.save(matching.review_pairs(links).where(total % 5 != 0).select("left_code", "right_code", F.when(total % 2 == 0, "accepted").otherwise("rejected").alias("decision"), F.lit("seen").alias("justification")))
    return matching.apply_decisions(links, dec)


# --------------------------------------------------------------------------- quality and gates

AMINO_SQL = "(" + " + ".join(f"PROCNT / 18 * {1 + (k % 3 - 1) / 10}" for k in range(18)) + ")"


@query(f"WITH {FOOD_SQL} SELECT concept_id || '|' || source_id AS ref, CASE WHEN PROCNT = 0 THEN 0 ELSE round({AMINO_SQL} * f / PROCNT, 6) END AS metric FROM (SELECT *, CASE WHEN WATER > 25 THEN 1.2 ELSE 1 END AS f FROM food) WHERE PROCNT = 0 OR {AMINO_SQL} * f / PROCNT NOT BETWEEN 0.85 AND 1.15")
def q_amino_acids(spark, d):
    """Amino acids against protein: over half of the foods hold a fifth too much, some have no protein."""
    p = food_profile(spark, d).withColumn("f", F.when(F.col("WATER") > 25, 1.2).otherwise(1.0))
    p = p.withColumns({n: F.col("PROCNT") / 18 * F.lit(1 + (k % 3 - 1) / 10) * F.col("f") for k, n in enumerate(K.AMINO_ACIDS)})
    return quality.amino_acids(p).select("ref", F.round("metric", 6).alias("metric"))


@query(f"""WITH {CELL_SQL}, v AS (SELECT concept_id, source_id, source_record_id, CASE nutrient_id WHEN 'QTY' THEN 'FAT' WHEN 'PRICE' THEN 'WATER' ELSE nutrient_id END AS nutrient_id, CASE WHEN nutrient_id = 'DISC' THEN -value ELSE value END AS value FROM cell WHERE value IS NOT NULL)
SELECT 'negative' AS "check", 'error' AS severity, count(*) AS n FROM v WHERE value < 0 UNION ALL SELECT 'over_100g', 'error', count(*) FROM v WHERE nutrient_id IN ('FAT', 'WATER') AND value > 100 UNION ALL SELECT 'unit', 'error', count(*) FROM v WHERE nutrient_id IN ('DISC', 'TAX')""")
def q_domain_findings(spark, d):
    """Negative values, more than 100 g in 100 g, and units the vocabulary does not give."""
    v = cells(spark, d).where("value is not null").withColumn("value", F.when(F.col("nutrient_id") == "DISC", -F.col("value")).otherwise(F.col("value"))).withColumn("nutrient_id", S.lookup_or_self({"QTY": "FAT", "PRICE": "WATER"}, F.col("nutrient_id"))).withColumn("unit", F.lit("g"))
    units = spark.createDataFrame([("FAT", "g"), ("WATER", "g"), ("DISC", "mg")], "nutrient_id string, unit string")
    return quality.findings(quality.domain(v, units)).select("check", "severity", "n")


SUITE_SQL = f"""{FOOD_SQL}, o(c, s) AS (
  SELECT 'proximates', 'warning' FROM food WHERE (WATER + PROCNT + FAT + CHOAVL + FIBTG + ASH + ALC) NOT BETWEEN 97 AND 103 UNION ALL
  SELECT 'energy', 'warning' FROM food WHERE abs(kcal - (4 * PROCNT + 9 * FAT + 4 * CHOAVL + 2 * FIBTG + 7 * ALC)) > 5 AND kcal <> 0 AND abs(kcal - (4 * PROCNT + 9 * FAT + 4 * CHOAVL + 2 * FIBTG + 7 * ALC)) / abs(kcal) > 0.05 UNION ALL
  SELECT 'fatty_acids', 'warning' FROM food WHERE FASAT + FAMS > FAT * 1.02 UNION ALL SELECT 'sugars_parts', 'warning' FROM food WHERE GLUS + FRUS > SUGAR * 1.02 UNION ALL SELECT 'sugars_total', 'warning' FROM food WHERE SUGAR > CHOAVL * 1.02 UNION ALL
  SELECT 'salt', 'warning' FROM food WHERE CASE WHEN NA * 2.5 = 0 THEN 0 ELSE abs(NACL - NA * 2.5) / (NA * 2.5) END > 0.1 UNION ALL SELECT 'vitamin_a', 'warning' FROM food WHERE VITA_RAE < RETOL * 0.95 UNION ALL
  SELECT 'amino_acids', 'warning' FROM food WHERE PROCNT = 0 UNION ALL SELECT 'unit', 'error' FROM food, (VALUES ('VITA_RAE'), ('RETOL')) n(nutrient))"""


def _suite(spark, d) -> DataFrame:
    v = foods(spark, d).withColumn("value_type", F.lit("measured")).withColumn("basis", F.lit(K.PER_100G))
    kcal = v.where("nutrient_id = 'WATER'").select("concept_id", "source_id", (F.col("value") * 6).alias("kcal"))
    names = spark.createDataFrame([(n,) for n in FOOD_COLUMNS], "nutrient_id string").select("nutrient_id", F.when(F.col("nutrient_id").isin("VITA_RAE", "RETOL"), "ug").otherwise("g").alias("unit"))
    groups = v.select("concept_id", F.col("concept_id").alias("food_group")).distinct()
    return quality.suite(v, groups, names, kcal, Scratch(spark).save)


@query(f"WITH {SUITE_SQL} SELECT c AS \"check\", s AS severity, count(*) AS n FROM o GROUP BY ALL")
def q_quality_suite(spark, d):
    """All checks over line items as foods."""
    return quality.findings(_suite(spark, d)).select("check", "severity", "n")


@query(f"WITH {SUITE_SQL} SELECT s AS severity, count(DISTINCT c) AS n FROM o GROUP BY ALL")
def q_severity_counts(spark, d):
    return quality.severity_counts(quality.findings(_suite(spark, d)))


@query(f"WITH {SUITE_SQL}, n AS (SELECT c AS \"check\", s AS severity, count(*) AS n FROM o GROUP BY ALL) SELECT r AS report, n.* FROM n, (VALUES ('json'), ('html')) v(r)")
def q_quality_reports(spark, d):
    """The findings of the suite, written as JSON and as HTML and read back from both."""
    store = Scratch(spark)
    found = store.save(quality.findings(_suite(spark, d)))
    told = spark.read.option("multiLine", True).json(store.put("report.json", artifact.report_json(found, "now").encode()))
    one = told.select(F.explode("findings").alias("f")).select(F.lit("json").alias("report"), "f.check", "f.severity", "f.n")
    page = spark.read.option("lineSep", "</tr>").text(store.put("report.html", artifact.report_html(found).encode()))
    cell = lambda k: F.regexp_extract("value", r"<tr class='(\w+)'><td>([^<]*)</td><td>[^<]*</td><td>(\d+)</td>", k)
    return one.unionAll(page.where(cell(1) != "").select(F.lit("html"), cell(2), cell(1), cell(3).cast("long")))


@query("""WITH RECURSIVE n AS (SELECT CASE WHEN p_partkey % 40 = 0 THEN 'bad ' || p_partkey ELSE 'T' || (p_partkey - (p_partkey % 30 = 2)::INT) END AS tagname, p_type AS g, p_brand AS u FROM part),
r AS (SELECT 'T' || p_partkey AS parent, 'T' || (p_partkey * 7 + p_size) % 211 AS child FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'T' || p_partkey, 'T' || (p_partkey * 7 + p_size) % 211 FROM part WHERE p_partkey % 33 = 0),
e AS (SELECT DISTINCT parent AS p, child AS c FROM r),
w(start, node) AS (SELECT p, c FROM e UNION SELECT w.start, e.c FROM w JOIN e ON w.node = e.p)
SELECT 'tag_form' AS "check", tagname AS ref FROM n WHERE tagname LIKE 'bad%' UNION ALL SELECT 'tag_unique', tagname FROM n GROUP BY tagname HAVING count(*) > 1 UNION ALL
SELECT 'group_known', tagname FROM n WHERE g = (SELECT min(p_type) FROM part) UNION ALL SELECT 'unit_known', tagname FROM n WHERE u = (SELECT max(p_brand) FROM part) UNION ALL
SELECT 'relation_known', x FROM (SELECT DISTINCT unnest([parent, child]) AS x FROM r) WHERE x NOT IN (SELECT tagname FROM n) UNION ALL SELECT 'relation_self', parent FROM r WHERE parent = child UNION ALL
SELECT 'relation_twice', parent || '>' || child FROM r GROUP BY parent, child HAVING count(*) > 1 UNION ALL SELECT DISTINCT 'relation_cycle', start FROM w WHERE start = node UNION ALL
SELECT 'energy_tag', unnest(['ENERC_KJ', 'ENERC_KCAL']) UNION ALL SELECT 'absence_type', unnest(['not_measured', 'not_detected', 'below_loq', 'trace', 'not_applicable', 'assumed_zero']) UNION ALL
SELECT 'absence_flag', n_name FROM nation WHERE n_nationkey % 5 = 4""")
def q_vocabulary_findings(spark, d):
    """The parts as a vocabulary: each rule is broken by some of them."""
    p, n = table(spark, d, "part"), table(spark, d, "nation")
    k, key = F.col("p_partkey"), lambda x: F.concat(F.lit("T"), x.cast("string"))
    tags = p.select(F.when(k % 40 == 0, F.concat(F.lit("bad "), k)).otherwise(key(k - (k % 30 == 2).cast("long"))).alias("tagname"), F.col("p_type").alias("group"), F.col("p_brand").alias("unit"))
    edge = p.select(key(k).alias("parent"), key((k * 7 + F.col("p_size")) % 211).alias("child"), k.alias("k"))
    relations = edge.where("k % 3 = 0").unionAll(edge.where("k % 33 = 0")).drop("k")
    known = lambda c, edge: p.select(c).distinct().join(F.broadcast(p.agg(edge(c).alias("_e"))), F.col(c) != F.col("_e")).drop("_e")  # noqa: E731  one row
    groups, units = known("p_type", F.min).toDF("group"), known("p_brand", F.max).toDF("unit")
    kinds = n.select(F.col("n_name").alias("id"), F.when(F.col("n_nationkey") % 5 == 4, "maybe").when(F.col("n_nationkey") % 2 == 0, "true").otherwise("false").alias("is_absence"))
    return vocabulary.vocabulary(tags, groups, units, relations, kinds, Scratch(spark).save)


@query("SELECT 'licence' AS \"check\", n_name AS ref FROM nation WHERE n_regionkey IN (1, 3)")
def q_licence_gate(spark, d):
    src = table(spark, d, "nation").select(F.col("n_name").alias("source_id"), F.concat(F.lit("l"), "n_regionkey").alias("license_id"))
    ok = spark.createDataFrame([("core", "l0"), ("core", "l2"), ("core", "l4"), ("lite", "l1")], "profile string, license_id string")
    return vocabulary.licences(src, ok, "core")


@query("SELECT 'acquisition' AS \"check\", s_name AS ref FROM supplier WHERE s_suppkey % 3 <> 0")
def q_acquisition_gate(spark, d):
    v = table(spark, d, "supplier").select(F.col("s_name").alias("source_record_id"), F.when(F.col("s_suppkey") % 3 == 0, "declared").when(F.col("s_suppkey") % 3 == 1, "odd").alias("acquisition_type"))
    return vocabulary.acquisition(v, spark.createDataFrame([("declared",)], "acquisition_type string"))


@query("""WITH o AS (SELECT o_orderkey, o_custkey FROM orders), c AS (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0),
a AS (SELECT DISTINCT o_custkey::VARCHAR AS orphan, o_custkey AS k FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM c)), r AS (SELECT orphan, row_number() OVER (ORDER BY k) AS n FROM a)
SELECT 'value.concept_id' AS "check", orphan FROM r WHERE n <= 6 UNION ALL SELECT 'label.ref', 'T9'""")
def q_structure_checks(spark, d):
    value = table(spark, d, "orders").select(F.col("o_custkey").alias("concept_id"), F.lit("declared").alias("acquisition_type"), F.col("o_orderkey").cast("string").alias("source_record_id"))
    concept = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("concept_id"))
    label = spark.createDataFrame([("nutrient", "T1"), ("nutrient", "T9"), ("concept", "T8")], "ref_kind string, ref string")
    return artifact.checks({"value": value, "concept": concept, "label": label, "nutrient": spark.createDataFrame([("T1",)], "tagname string")})


@query("SELECT r_name || '.csv' AS file FROM region")
def q_unmapped_files(spark, d):
    store = Scratch(spark)
    for name in ("README.md", ".hidden", *(f"{r['r_name']}.csv" for r in table(spark, d, "region").collect())):
        store.put(f"unmapped/{name}", b"x")
    return tables.unmapped(spark, store.path("unmapped"))


@query("SELECT 'matcher' AS \"check\", printf('%.4f/%.4f', avg(CASE WHEN l_tax < 0.07 THEN 1 ELSE 0 END), 0.95) AS ref FROM lineitem HAVING avg(CASE WHEN l_tax < 0.07 THEN 1 ELSE 0 END) < 0.98")
def q_matcher_gate(spark, d):
    e = table(spark, d, "lineitem").agg(F.avg((F.col("l_tax") < 0.07).cast("double")).alias("precision")).withColumn("recall", F.lit(0.95))
    return vocabulary.matcher(e)


# --------------------------------------------------------------------------- views


def _named(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(values, nutrients, sources): cells with the nutrients' and the regions' own tables."""
    nutrients = spark.createDataFrame([("QTY", "quantity", "u"), ("PRICE", "price", "u"), ("TAX", "tax", "u")], "tagname string, name_en string, unit string")
    sources = table(spark, d, "region").select(F.col("r_name").alias("source_id"), F.concat(F.lit("Source "), "r_name").alias("name"), F.col("r_regionkey").cast("string").alias("version"), F.lit("free").alias("license_id"))
    return cells(spark, d), nutrients, sources


@query(f"WITH {CELL_SQL}, n(nutrient_id, name_en) AS (VALUES ('QTY', 'quantity'), ('PRICE', 'price'), ('TAX', 'tax')) SELECT nutrient_id, name_en, value, value_type, source_id, 'Source ' || source_id AS source_name, r_regionkey::VARCHAR AS version, source_record_id FROM cell JOIN n USING (nutrient_id) JOIN region ON r_name = source_id WHERE concept_id = '7'")
def q_values_by_source(spark, d):
    return views.values_by_source(*_named(spark, d), "7").select("nutrient_id", "name_en", "value", "value_type", "source_id", "source_name", "version", "source_record_id")


@query(f"WITH {CELL_SQL} SELECT concept_id, source_id, count(DISTINCT nutrient_id) AS n_covered, 3::BIGINT AS n_total, 'Source ' || source_id AS source_name FROM cell WHERE value IS NOT NULL GROUP BY ALL")
def q_coverage_of_concepts(spark, d):
    v, n, s = _named(spark, d)
    return views.coverage_of_concepts(v.where("value is not null"), n, s).drop("version")


MATRIX_SQL = "m AS (SELECT n_nationkey::VARCHAR AS concept_id, l.locale, 'T' || (n_nationkey % 2) AS nutrient_id, CASE WHEN n_nationkey % 3 > 0 THEN n_nationkey + l.k END::DOUBLE AS value FROM nation, (VALUES ('fr', 1, 0), ('en', 2, 1), ('pt', 3, 2)) l(locale, k, r) WHERE n_nationkey % 4 >= l.r)"


def _matrix(spark, d) -> DataFrame:
    locale = spark.createDataFrame([("fr", 1, 0), ("en", 2, 1), ("pt", 3, 2)], "locale string, k int, r int")
    k = F.col("n_nationkey")
    both = table(spark, d, "nation").join(locale, k % 4 >= F.col("r"))
    return both.select(k.cast("string").alias("concept_id"), "locale", F.concat(F.lit("T"), k % 2).alias("nutrient_id"), F.when(k % 3 > 0, k + F.col("k")).cast("double").alias("value"))


@query(f"""WITH {MATRIX_SQL}, c(locale, hop) AS (VALUES ('pt-BR', 1), ('pt', 2), ('en', 3), ('fr', 4)), b AS (SELECT concept_id, min(hop) AS hop FROM m JOIN c USING (locale) GROUP BY ALL)
SELECT concept_id, locale, nutrient_id, value, 'name of ' || nutrient_id AS name_en FROM m JOIN c USING (locale) JOIN b USING (concept_id, hop)""")
def q_food_matrix(spark, d):
    n = spark.createDataFrame([("T0", "name of T0"), ("T1", "name of T1")], "tagname string, name_en string")
    return views.food_matrix(_matrix(spark, d), n, "pt-BR")


@query(f"""WITH {MATRIX_SQL}, c(locale, hop) AS (VALUES ('en', 1), ('fr', 2), ('pt', 3)), b AS (SELECT concept_id, min(hop) AS hop FROM m JOIN c USING (locale) GROUP BY ALL)
SELECT concept_id, locale, nutrient_id, value FROM m JOIN c USING (locale) JOIN b USING (concept_id, hop)""")
def q_client_values(spark, d):
    return views.client_values(_matrix(spark, d))


@query("SELECT 'group' AS catalog, p_type AS id, lower(p_type) AS name FROM part GROUP BY ALL UNION ALL SELECT * FROM (VALUES ('nutrient', 'PRICE', 'price'), ('nutrient', 'QTY', 'quantity'), ('nutrient', 'TAX', 'tax')) v")
def q_catalogs(spark, d):
    part = table(spark, d, "part")
    groups = part.select(F.col("p_type").alias("id"), F.lit("x").alias("name_pt"), F.lower("p_type").alias("name_en")).distinct().unionAll(spark.createDataFrame([("UNUSED", "x", "x")], "id string, name_pt string, name_en string"))
    a = views.food_groups(part.select(F.col("p_type").alias("food_group")), groups).select(F.lit("group").alias("catalog"), F.col("food_group").alias("id"), F.col("name_en").alias("name"))
    return a.unionAll(views.nutrient_catalog(_named(spark, d)[1]).select(F.lit("nutrient"), "tagname", "name_en"))


# --------------------------------------------------------------------------- artifact, sinks, release


def _small_artifact(spark, d) -> str:
    """An artifact of nations (as concepts, in two locales) with one value each; its folder."""
    folder, k = Scratch(spark).path("artifact"), F.col("n_nationkey")
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).withColumn("concept_id", k.cast("string"))
    two = n.withColumn("locale", F.explode(F.array(F.lit("en"), F.lit("fr"))))
    model = two.select("concept_id", "locale", F.col("n_name").alias("label"), F.col("r_name").alias("food_group"), F.lit("FAT").alias("nutrient_id"), (k * 1.0).alias("value"), F.lit("g").alias("unit"), F.lit("measured").alias("value_type"), F.lit("s").alias("source_id"), F.concat(F.lit("r"), k).alias("source_record_id"), F.lit(K.PER_100G).alias("basis"))
    label = labels.union_branches([two.select(F.lit("concept").alias("ref_kind"), F.col("concept_id").alias("ref"), "locale", F.lit("native").alias("status"), F.concat(F.col("locale"), F.lit(" Ñame "), F.col("n_name")).alias("text"))])
    value = n.select("concept_id", F.lit("FAT").alias("nutrient_id"), (k * 1.0).alias("value"), F.lit("s").alias("source_id"), F.concat(F.lit("r"), k).alias("source_record_id"), F.lit(K.PER_100G).alias("basis"), F.lit("declared").alias("acquisition_type"))
    record = n.select(F.concat(F.lit("r"), k).alias("source_record_id"), F.lit("s").alias("source_id"), F.lit("value").alias("kind"), F.col("n_name").alias("ref"))
    artifact.write({"mv_food_value": model, "label": label, "concept": n.select("concept_id", F.col("r_name").alias("food_group")), "value": value, "source_record": record}, folder, built_at="2000-01-01T00:00:00Z")
    return folder


@query("""WITH n AS (SELECT count(*) AS c FROM nation), t AS (SELECT l || ' ñame ' || lower(n_name) AS a, l || ' name ' || lower(n_name) AS b, l, n_nationkey FROM nation, (VALUES ('en'), ('fr')) v(l)),
g AS (SELECT DISTINCT n_nationkey, l, substr(x, i, 3) AS gram FROM (SELECT n_nationkey, l, unnest([a, b]) AS x FROM t), generate_series(1, 100) s(i) WHERE i <= length(x) - 2)
SELECT name, CASE name WHEN 'mv_food_value' THEN 2 * c WHEN 'label' THEN 2 * c WHEN 'label_trigram' THEN (SELECT count(*) FROM g) WHEN 'label_trigram_count' THEN (SELECT count(DISTINCT (l, gram)) FROM g)
  WHEN 'label_totals' THEN 2 WHEN 'label_word' THEN (SELECT sum(len(list_distinct(regexp_extract_all(b, '[a-z0-9]+')))) FROM t)::BIGINT WHEN 'build_metadata' THEN 5 ELSE c END AS n
FROM n, (VALUES ('mv_food_value'), ('label'), ('concept'), ('value'), ('source_record'), ('label_trigram'), ('label_trigram_count'), ('label_word'), ('label_totals'), ('build_metadata')) v(name)""")
def q_artifact_tables(spark, d):
    """Every table of a written artifact, with its rows."""
    parts = [df.agg(F.lit(name).alias("name"), F.count("*").alias("n")) for name, df in artifact.open_artifact(spark, _small_artifact(spark, d)).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@query("SELECT 'built_at' AS key, strftime(max(o_orderdate), '%Y-%m-%dT%H:%M:%SZ') AS value FROM orders UNION ALL SELECT * FROM (VALUES ('schema_version', '1'), ('profile', 'lite')) v(key, value)")
def q_build_metadata(spark, d):
    """The metadata of a build as of the newest order."""
    newest = table(spark, d, "orders").agg(F.date_format(F.max("o_orderdate"), "yyyy-MM-dd'T'HH:mm:ss'Z'")).first()[0]
    return artifact.build_metadata(spark, "lite", newest).where("key not in ('engine_version', 'spark_version')")


@query("""SELECT 'search' AS answer, n_nationkey::VARCHAR AS ref, 'fr Ñame ' || n_name AS value FROM nation WHERE starts_with(n_name, 'NATION_1') UNION ALL
SELECT 'values', '7', '7.0' UNION ALL (SELECT 'richest', n_nationkey::VARCHAR, n_nationkey || '.0' FROM nation WHERE n_regionkey = 2 ORDER BY n_nationkey DESC LIMIT 3) UNION ALL
SELECT 'locale', l, l FROM (VALUES ('en'), ('fr')) v(l) UNION ALL SELECT 'group', r_name, r_name FROM region WHERE r_regionkey IN (SELECT n_regionkey FROM nation) UNION ALL SELECT 'record', n_name, 'r4' FROM nation WHERE n_nationkey = 4 UNION ALL
SELECT 'total', 'FAT', '4.5'""")
def q_engine_answers(spark, d):
    """The read facade over a written artifact."""
    asia = table(spark, d, "region").where("r_regionkey = 2").first()["r_name"]
    with Engine(spark, _small_artifact(spark, d)) as e:
        items = spark.createDataFrame([("1", 50.0), ("2", 200.0)], "concept_id string, grams double")
        parts = [
            e.search("1", "fr", 100).select(F.lit("search").alias("answer"), "ref", F.col("display").alias("value")),
            e.food_values("7", "pt").select(F.lit("values"), "concept_id", F.col("value").cast("string")),
            e.foods_for_nutrient("FAT", "fr", 3, asia).select(F.lit("richest"), "concept_id", F.col("value").cast("string")),
            e.available_locales().select(F.lit("locale"), "locale", "locale"), e.food_groups().select(F.lit("group"), "food_group", "food_group"),
            e.provenance("r4").select(F.lit("record"), "ref", "source_record_id"), e.composition(items, "en").select(F.lit("total"), "nutrient_id", F.col("total").cast("string")),
        ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def _placed(df: DataFrame) -> DataFrame:
    """Rows of a read table with their place in its files."""
    from pyspark.sql import Window

    return df.withColumn("_f", F.input_file_name()).withColumn("_i", F.monotonically_increasing_id()).withColumn("place", F.row_number().over(Window.orderBy("_f", "_i"))).drop("_f", "_i")


@query("SELECT row_number() OVER (ORDER BY c_custkey::VARCHAR) AS place, c_custkey::VARCHAR AS concept_id FROM customer")
def q_sorted_write(spark, d):
    """A table written in its order, as its files hold it."""
    path = Scratch(spark).path("sorted")
    artifact.in_order(table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("concept_id")).repartition(5), "concept").write.parquet(path)
    return _placed(spark.read.parquet(path)).select(F.col("place").cast("long").alias("place"), "concept_id")


@query("""SELECT row_number() OVER (ORDER BY n_name) AS place, '{"n_name":"' || n_name || '","n_nationkey":' || n_nationkey || ',"none":null}' AS value FROM nation""")
def q_jsonl_export(spark, d):
    path = Scratch(spark).path("jsonl")
    artifact.jsonl(table(spark, d, "nation").select("n_name", "n_nationkey", F.lit(None).cast("string").alias("none")), path)
    return _placed(spark.read.text(path)).select(F.col("place").cast("long").alias("place"), "value")


@query("SELECT 0::BIGINT AS place, 'code,name' AS value UNION ALL SELECT row_number() OVER (ORDER BY n_nationkey::VARCHAR), n_nationkey || ',' || CASE WHEN n_nationkey % 2 = 0 THEN n_name ELSE '\"a, b\"' END FROM nation")
def q_csv_sink(spark, d):
    path = Scratch(spark).path("csv")
    tables.write_csv(table(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("code"), F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).otherwise("a, b").alias("name")), path, ["code"])
    return _placed(spark.read.text(path)).select((F.col("place") - 1).cast("long").alias("place"), "value")


@query("SELECT n_nationkey::VARCHAR AS concept_id, 'g' || n_regionkey AS food_group, 2::BIGINT AS n_labels, 'en ' || n_name AS first_label, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS n_observations, CASE WHEN n_nationkey = 3 THEN '1' END AS replaced_by FROM nation")
def q_json_ld(spark, d):
    n = table(spark, d, "nation").withColumn("concept_id", F.col("n_nationkey").cast("string"))
    label = n.select(F.lit("concept").alias("ref_kind"), F.col("concept_id").alias("ref"), F.explode(F.array(F.lit("fr"), F.lit("en"))).alias("locale"), "n_name").withColumn("text", F.concat_ws(" ", "locale", "n_name"))
    model = n.select("concept_id", F.lit("FAT").alias("nutrient_id"), F.lit("b").alias("basis"), F.when(F.col("n_nationkey") % 2 == 0, 1.5).alias("value"), F.lit("g").alias("unit"), F.lit("s").alias("source_id"))
    nodes = artifact.json_ld(n.select("concept_id", F.concat(F.lit("g"), "n_regionkey").alias("food_group")), label, model, spark.createDataFrame([("3", "1")], "tombstone_id string, successor_id string"))
    parsed = F.from_json("node", "`@id` string, `group` string, label array<struct<`@language`:string,`@value`:string>>, observation array<struct<value:double>>, replacedBy string")
    p = nodes.select(parsed.alias("p"))
    return p.select(F.col("p.@id").alias("concept_id"), F.col("p.group").alias("food_group"), F.size("p.label").cast("long").alias("n_labels"), F.element_at("p.label", 1)["@value"].alias("first_label"), F.greatest(F.size(F.coalesce("p.observation", F.array())), F.lit(0)).cast("long").alias("n_observations"), F.col("p.replacedBy").alias("replaced_by"))


@query("""WITH a AS (SELECT n_nationkey AS k, n_nationkey AS v FROM nation WHERE n_nationkey < 20), b AS (SELECT n_nationkey AS k, CASE WHEN n_nationkey % 3 = 0 THEN -1 ELSE n_nationkey END AS v FROM nation WHERE n_nationkey > 3),
j AS (SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' WHEN a.v = b.v THEN 'same' ELSE 'changed' END AS status FROM a FULL JOIN b ON a.k = b.k)
SELECT k, status, sample FROM (SELECT *, row_number() OVER (PARTITION BY status ORDER BY k) AS sample FROM j WHERE status <> 'same') WHERE sample <= 3""")
def q_diff_samples(spark, d):
    n = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"))
    a = n.where("k < 20").withColumn("v", F.col("k"))
    b = n.where("k > 3").withColumn("v", F.when(F.col("k") % 3 == 0, F.lit(-1).cast("long")).otherwise(F.col("k")))
    return records.diff_samples(records.diff(a, b, ["k"], ["v"]), ["k"], 3).select("k", "status", F.col("sample").cast("long").alias("sample"))


@query("""SELECT '## orders' AS line UNION ALL SELECT count(*) || ' rows' FROM orders UNION ALL SELECT '## part' UNION ALL SELECT count(*) || ' rows' FROM part UNION ALL
SELECT * FROM (VALUES ('| column | type |'), ('|---|---|'), ('| column | type |'), ('|---|---|'), ('| o_orderkey | bigint |'), ('| o_orderpriority | string |'), ('| p_name | string |'), ('| p_size | int |')) v""")
def q_data_dictionary(spark, d):
    """The dictionary of two tables as Markdown, read back."""
    text = artifact.dictionary({"orders": table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), "part": table(spark, d, "part").select("p_name", "p_size")})
    return spark.read.text(Scratch(spark).put("dictionary.md", text.encode())).where("value <> ''").withColumnRenamed("value", "line")


@query("SELECT '## ' || r_name || ' (`s' || r_regionkey || '`)' AS line FROM region UNION ALL SELECT '- Version: ' || (2000 + r_regionkey) FROM region UNION ALL SELECT '- Pinned files: f' || r_regionkey FROM region")
def q_attributions(spark, d):
    text = spark.read.text(Scratch(spark).put("attributions.md", artifact.attributions(_registry(spark, d)[1]).encode()))
    return text.where(F.col("value").rlike("^(## |- Version|- Pinned)")).withColumnRenamed("value", "line")


@query("SELECT 'source' AS part, 's' || r_regionkey AS name, sha256(r_name) AS sha256 FROM region UNION ALL SELECT 'file', 'sub/f' || r_regionkey, sha256(r_name) FROM region")
def q_release_manifest(spark, d):
    """The manifest of a folder: its files with their hashes, and the sources with their pinned ones."""
    store = Scratch(spark)
    for r in table(spark, d, "region").collect():
        store.put(f"release/sub/f{r['r_regionkey']}", r["r_name"].encode())
    text = artifact.release_manifest(spark, store.path("release"), _registry(spark, d)[1], "core")
    told = spark.read.text(store.put("core.manifest", text.encode()), wholetext=True).select(F.from_json("value", "files map<string, string>, sources array<struct<id: string, files: array<struct<sha256: string>>>>").alias("m"))
    source = told.select(F.explode("m.sources").alias("s")).select(F.lit("source").alias("part"), F.col("s.id").alias("name"), F.get(F.col("s.files.sha256"), 0).alias("sha256"))
    return source.unionAll(told.select(F.explode("m.files").alias("name", "sha256")).select(F.lit("file"), "name", "sha256"))


@query("SELECT n_nationkey, n_name FROM nation")
def q_stage_cache(spark, d):
    """A stage's output from the cache: worked out once, read ever after while its inputs stay the same."""
    store = Scratch(spark)
    raw = store.put("in/sub/raw.txt", b"content")
    key = artifact.fingerprint(spark, raw.rsplit("/sub", 1)[0], {"stage": "x"})
    cache = artifact.StageCache(spark, store.path("cache"))
    cache.run("stage", key, lambda: {"t": table(spark, d, "nation").select("n_nationkey", "n_name")})
    return cache.run("stage", key, lambda: 1 / 0)["t"]


@query(f"WITH {CELL_SQL}, w AS (SELECT concept_id, source_id, source_record_id, value FROM cell WHERE value_type = 'measured' AND nutrient_id = 'QTY' AND basis = 'per_100ml') SELECT concept_id, count(*) AS n, string_agg(source_record_id, '|' ORDER BY source_record_id, source_id) AS records FROM w GROUP BY ALL")
def q_candidate_lists(spark, d):
    """The candidates of each concept as one ordered list."""
    c = cells(spark, d).where((F.col("value_type") == "measured") & (F.col("nutrient_id") == "QTY") & (F.col("basis") == K.PER_100ML))
    return selection.candidate_lists(c, ["concept_id"]).select("concept_id", F.size("candidates").cast("long").alias("n"), F.array_join(F.transform("candidates", lambda x: x["source_record_id"]), "|").alias("records"))
