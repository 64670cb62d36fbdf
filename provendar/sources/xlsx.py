"""Source B: one workbook, as cells (sheet, row, col, text); the rest is DataFrame work.

read_workbook() fetches the file through Spark (binaryFile), so any store that Spark can read will do, and unpacks it in
one task; several workbooks are as many tasks. For large workbooks on a path that all executors mount there is a data source,
spark.read.format("workbook"): a partition is a sheet and a stretch of its unpacked bytes, whose rows are those that begin
in it; a worker reads a workbook's string table once.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StringType

from ..functions import fixed as K
from ..functions import scalar as S
from ..operators import gates

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
#: A sheet's root tag, the beginning of a row, and a whole row.
_ROOT, _BEGIN = re.compile(rb"<(\w+:)?worksheet\b[^>]*>"), re.compile(rb"<(?:\w+:)?row\b")
_ROW = re.compile(rb"<(?:\w+:)?row\b[^>]*?(?:/>|>.*?</(?:\w+:)?row>)", re.S)
#: Unpacked bytes of a sheet that one task reads.
SPLIT = 8 << 20
_PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
ALCOHOL = "Bebidas alcoólicas"
LEAD = ["food_code", "name", "level1", "level2", "level3"]


def column_index(letters: str) -> int:
    """A -> 0, Z -> 25, AA -> 26."""
    n = 0
    for c in letters:
        n = n * 26 + ord(c) - 64
    return n - 1


def column_letters(k: int) -> str:
    """0 -> A, 25 -> Z, 26 -> AA."""
    out = ""
    while k >= 0:
        k, rest = k // 26 - 1, k % 26
        out = chr(65 + rest) + out
    return out


def _strings(z: zipfile.ZipFile) -> list[str]:
    """The string table that all sheets share."""
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    found = ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si")
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in found]


def _sheets(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, file) of all sheets."""
    rels = {r.get("Id"): r.get("Target").lstrip("/") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")).iter(f"{_PACKAGE}Relationship")}
    files = [(s.get("name"), rels[s.get(f"{_REL}id")]) for s in ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")]
    return [(name, f if f.startswith("xl/") else f"xl/{f}") for name, f in files]


def _row_cells(row: ElementTree.Element, shared: list[str]) -> Iterator[tuple[int, str]]:
    """(column from 0, text) of the filled cells of a row."""
    for k, c in enumerate(row.iter(f"{_MAIN}c")):
        ref = re.match("[A-Z]+", c.get("r") or "")
        kind, v = c.get("t"), c.find(f"{_MAIN}v")
        if kind == "inlineStr":
            text = "".join(t.text or "" for t in c.iter(f"{_MAIN}t"))
        else:
            text = None if v is None else shared[int(v.text)] if kind == "s" else v.text
        if text is not None and text.strip():
            yield column_index(ref[0]) if ref else k, text


def sheet_cells(content: bytes) -> Iterator[tuple[str, int, int, str]]:
    """(sheet, row from 1, column from 0, text) of all filled cells."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = _strings(z)
        for name, file in _sheets(z):
            row_no = 0
            for _, el in ElementTree.iterparse(z.open(file)):
                if el.tag != f"{_MAIN}row":
                    continue
                row_no = int(el.get("r") or row_no + 1)
                for col, text in _row_cells(el, shared):
                    yield name, row_no, col, text
                el.clear()


@dataclass
class Stretch(InputPartition):
    """Rows of a sheet that begin in a range of its unpacked bytes."""

    path: str
    sheet: str
    file: str
    start: int
    end: int


@lru_cache(maxsize=2)
def _kept_strings(path: str, changed: float) -> list[str]:
    with zipfile.ZipFile(path) as z:
        return _strings(z)


class WorkbookSource(DataSource):
    """The cells of a workbook under a mounted path; option split: unpacked bytes of a partition."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return "sheet string, row int, col int, text string"

    def reader(self, schema) -> DataSourceReader:
        return WorkbookReader(self.options["path"].removeprefix("file://").removeprefix("file:"), int(self.options.get("split", SPLIT)))


class WorkbookReader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.path, self.split = path, split

    def partitions(self) -> list[Stretch]:
        with zipfile.ZipFile(self.path) as z:
            return [Stretch(self.path, name, file, at, at + self.split) for name, file in _sheets(z) for at in range(0, z.getinfo(file).file_size, self.split)]

    def read(self, p: Stretch) -> Iterator[tuple[str, int, int, str]]:
        shared = _kept_strings(p.path, os.path.getmtime(p.path))
        with zipfile.ZipFile(p.path) as z, z.open(p.file) as f:
            head = b""
            while not (root := _ROOT.search(head)):
                if not (more := f.read(1 << 12)):
                    return
                head += more
            f.seek(max(0, p.start - 16))  # unpacks and drops what is before; a tag may begin just before the border
            held, at = b"", max(0, p.start - 16)  # at: where held begins in the sheet
            while True:
                more = f.read(1 << 18)
                held += more
                last = 0
                for m in _ROW.finditer(held):
                    if m.end() == len(held) and more and not m[0].endswith(b">"):
                        break
                    last = m.end()
                    if at + m.start() < p.start:
                        continue
                    if at + m.start() >= p.end:
                        return
                    row = next(ElementTree.fromstring(root[0] + m[0] + b"</" + (root[1] or b"") + b"worksheet>").iter(f"{_MAIN}row"))
                    if row.get("r") is None:
                        raise ValueError(f"{p.path}: a row of {p.sheet} has no number")
                    for col, text in _row_cells(row, shared):
                        yield p.sheet, int(row.get("r")), col, text
                open_tag = _BEGIN.search(held, last)
                drop = open_tag.start() if open_tag else max(last, len(held) - 16)
                if not more or (at + drop >= p.end):
                    return
                held, at = held[drop:], at + drop


def read_workbook(spark: SparkSession, path: str) -> DataFrame:
    """(sheet, row, col, text) of one or more workbooks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0).to_pylist():
                cols = list(zip(*sheet_cells(content), strict=True)) or [(), (), (), ()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.string(), pa.int32(), pa.int32(), pa.string()), strict=True)], ["sheet", "row", "col", "text"])

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, "sheet string, row int, col int, text string")


def write_workbook(rows: DataFrame, key: str, path: str, sheet: str) -> int:
    """Writes rows (in ascending order of key, which is no cell) as the one sheet of a workbook under a mounted path; returns the sheet's bytes.

    One task sorts the rows and writes them as they come, texts inside their cells: neither it nor the driver holds them.
    """
    kinds = {c: isinstance(rows.schema[c].dataType, StringType) for c in rows.columns if c != key}
    main, rel = f'xmlns="{_MAIN[1:-1]}"', _REL[1:-1]
    file = path.removeprefix("file://").removeprefix("file:")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.makedirs(os.path.dirname(file), exist_ok=True)
        own, at, size = f"{file}.{uuid.uuid4().hex}", 0, 0
        with zipfile.ZipFile(own, "w") as z:
            z.writestr("xl/workbook.xml", f"<workbook {main} xmlns:r=\"{rel}\"><sheets><sheet name={quoteattr(sheet)} sheetId=\"1\" r:id=\"r1\"/></sheets></workbook>")
            z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{_PACKAGE[1:-1]}"><Relationship Id="r1" Target="worksheets/s1.xml" Type="x"/></Relationships>')
            with z.open("xl/worksheets/s1.xml", "w", force_zip64=True) as f:
                size += f.write(f"<worksheet {main}><sheetData>".encode())
                for b in batches:
                    out = []
                    for cells in zip(*(b.column(c).to_pylist() for c in kinds), strict=True):
                        at += 1
                        held = [(f"{column_letters(k)}{at}", text, v) for k, (text, v) in enumerate(zip(kinds.values(), cells, strict=True)) if v is not None]
                        out.append(f'<row r="{at}">' + "".join(f'<c r="{to}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' if text else f'<c r="{to}"><v>{v}</v></c>' for to, text, v in held) + "</row>")
                    size += f.write("".join(out).encode())
                size += f.write(b"</sheetData></worksheet>")
        os.replace(own, file)
        yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64())], ["size"])

    return rows.repartition(1).sortWithinPartitions(key).select(*kinds).mapInArrow(run, "size long").first()["size"]


def long_table(cells: DataFrame, sheet: str) -> DataFrame:
    """(food_code, name, level1..3, header, text): one row per food and measured column, text null where the cell is empty.

    The header row is the one whose first two cells are `Cod` and `Nome do alimento`; the sheet's few headers are a
    dimension that is broadcast.
    """
    c = cells.where(F.col("sheet") == sheet).withColumn("text", S.collapse_space(F.col("text")))
    first = c.where("col = 0 and text = 'Cod'").join(c.where("col = 1 and text = 'Nome do alimento'").select("row"), "row").agg(F.min("row").alias("top"))
    c = c.join(F.broadcast(first))
    headers = c.where(f"row = top and col >= {len(LEAD)}").select("col", F.col("text").alias("header"))
    body = c.where("row > top")
    lead = body.where(f"col < {len(LEAD)}").groupBy("row").agg(*[F.max(F.when(F.col("col") == k, F.col("text"))).alias(n) for k, n in enumerate(LEAD)]).where("food_code is not null")
    grid = lead.join(F.broadcast(headers))  # foods x measured columns: every absent cell is a row too
    return grid.join(body.select("row", "col", "text"), ["row", "col"], "left").select(*LEAD, "header", "text")


def component_keys(cells: DataFrame, sheet: str) -> DataFrame:
    """Keys of the correspondence sheet's components (rows without a unit are legend)."""
    names = cells.where((F.col("sheet") == sheet) & (F.col("col") == 0)).select(S.collapse_space(F.col("text")).alias("name"))
    return names.where(S.unit_of(F.col("name"), K.UNIT_IN_HEADER).isNotNull()).select(S.nutrient_key(F.col("name"), strict=False).alias("nutrient_code"), "name").distinct()


def extract(spark: SparkSession, path: str, data_sheet: str, components_sheet: str) -> dict[str, DataFrame]:
    """The four contract tables of source B."""
    c = read_workbook(spark, path)
    long = long_table(c, data_sheet).withColumn("nutrient_code", S.nutrient_key(F.col("header"), strict=False)).withColumn("unit", S.unit_of(F.col("header"), K.UNIT_IN_HEADER))
    gates.none_left(long.where("nutrient_code is null").select("header").distinct(), "a column has no unit")
    food = long.select(*LEAD).distinct()
    gates.unique(food, ["food_code"], "foods")
    gates.covered(long, component_keys(c, components_sheet), ["nutrient_code"], "columns: component")
    # a gate instead of raising inside the expression: filters on it may be moved before the joins that leave only measured cells
    gates.none_left(long.where(~F.col("text").rlike(K.NATIVE_NUMBER)).select("food_code", "header", "text"), "not a number")
    number = F.expr("try_cast(text as double)")
    value = long.select(
        "food_code", "nutrient_code", number.alias("value"), F.when(number.isNull(), "missing").otherwise("number").alias("value_kind"), *[F.lit(None).cast("double").alias(x) for x in ("threshold", "min_value", "max_value")],
        F.lit(None).cast("string").alias("confidence_code"), F.when(F.col("level1") == ALCOHOL, K.PER_100ML).otherwise(K.PER_100G).alias("basis"), F.to_json(F.struct("header", F.col("text").alias("raw")), {"ignoreNullFields": "false"}).alias("record"),
    )
    group = food.select(F.stack(F.lit(3), F.lit("1"), "level1", F.lit("2"), "level2", F.lit("3"), "level3").alias("level", "code")).where("code is not null").distinct().withColumn("name", F.col("code"))
    table = food.select("food_code", "name", F.to_json(F.struct(F.col("name").alias("pt"))).alias("names"), F.to_json(F.struct(F.col("level1").alias("1"), F.col("level2").alias("2"), F.col("level3").alias("3"))).alias("group_path"), S.canonical_json(LEAD).alias("record"))
    constituent = long.select("nutrient_code", F.col("header").alias("name"), "unit").distinct()
    return {"food": table, "food_group": group, "constituent": constituent, "value": value}
