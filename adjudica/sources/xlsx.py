"""Spreadsheet edge: cells of an .xlsx file as rows, and guarded copies with changed cells. Standard library only.

The container's XML is read on one executor task per file (a spreadsheet is no splittable format); everything after it
works on the cell table. ``xlsxcells`` is registered as a Python data source, ``xlsxcopy`` as a sink.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
import zipfile
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree as ET

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from adjudica.operators import grid

M = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
CELLS = "r int, c int, text string, cell_argb string, runs array<struct<text:string,argb:string>>"
Cell = tuple[int, int, str, "str | None", "list[tuple[str, str | None]] | None"]


def _n(name: str) -> str:
    return f"{{{M}}}{name}"


def place(ref: str) -> tuple[int, int]:
    """Row and column, from 1, of a cell name."""
    letters, digits = re.match(r"([A-Z]+)(\d+)$", ref).groups()
    col = 0
    for ch in letters:
        col = col * 26 + ord(ch) - 64
    return int(digits), col


def letters(col: int) -> str:
    out = ""
    while col:
        col, rest = divmod(col - 1, 26)
        out = chr(65 + rest) + out
    return out


def _color(font: ET.Element | None) -> str | None:
    c = font.find(_n("color")) if font is not None else None
    return c.get("rgb") if c is not None else None


def _rich(node: ET.Element) -> tuple[str, list | None]:
    runs = [("".join(t.text or "" for t in r.iter(_n("t"))), _color(r.find(_n("rPr")))) for r in node.findall(_n("r"))]
    if runs:
        return "".join(t for t, _ in runs), runs
    return "".join(t.text or "" for t in node.findall(_n("t"))), None


def sheet_path(z: zipfile.ZipFile) -> str:
    """The part of the first sheet."""
    book = ET.fromstring(z.read("xl/workbook.xml"))
    first = next(book.iter(_n("sheet")), None)
    if first is None:
        raise ValueError("the workbook has no worksheet")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    target = next(x.get("Target") for x in rels if x.get("Id") == first.get(f"{{{R}}}id"))
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def read_cells(path: str) -> Iterator[Cell]:
    """All cells of the first sheet that are there: formulas by their result, rich text with its runs."""
    with zipfile.ZipFile(path) as z:
        names = set(z.namelist())
        shared = [_rich(si) for si in ET.fromstring(z.read("xl/sharedStrings.xml")).findall(_n("si"))] if "xl/sharedStrings.xml" in names else []
        fonts: list[str | None] = [None]
        formats: list[int] = [0]
        if "xl/styles.xml" in names:
            styles = ET.fromstring(z.read("xl/styles.xml"))
            fonts = [_color(f) for f in styles.find(_n("fonts")) or []] or fonts
            formats = [int(x.get("fontId", 0)) for x in styles.find(_n("cellXfs")) or []] or formats
        for cell in ET.fromstring(z.read(sheet_path(z))).iter(_n("c")):
            r, c = place(cell.get("r"))
            kind, value = cell.get("t", "n"), cell.find(_n("v"))
            text, runs = (value.text or "") if value is not None else "", None
            if kind == "s" and text:
                text, runs = shared[int(text)]
            elif kind == "inlineStr":
                text, runs = _rich(cell.find(_n("is")))
            elif kind == "b":
                text = "true" if text == "1" else "false"
            yield r, c, text, fonts[formats[int(cell.get("s", 0))]], runs


class XlsxCells(DataSource):
    """spark.read.format("xlsxcells").load(path)"""

    @classmethod
    def name(cls) -> str:
        return "xlsxcells"

    def schema(self) -> str:
        return CELLS

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"])


class _Reader(DataSourceReader):
    def __init__(self, path: str) -> None:
        self.path = path

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from read_cells(self.path)


@dataclass
class Patches(WriterCommitMessage):
    """Where a task has put its changes, and how many of each action."""

    path: str
    counts: dict[str, int]


class XlsxCopy(DataSource):
    """changes(row, action, text).write.format("xlsxcopy").options(source=…, column=…).mode("append").save(target)

    Tasks put their changes in a folder beside the target, which all executors share; the copy is made once all have, and
    takes its place whole. A write that fails leaves neither a copy nor the folder.
    """

    @classmethod
    def name(cls) -> str:
        return "xlsxcopy"

    def schema(self) -> str:
        return "row int, action string, text string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Copy(self.options["source"], self.options["path"], int(self.options["column"]))


class _Copy(DataSourceWriter):
    def __init__(self, source: str, target: str, column: int) -> None:
        if source == target:
            raise ValueError("the source is never overwritten")
        self.source, self.target, self.column = source, target, column
        self.folder = f"{target}.{uuid.uuid4().hex[:8]}"

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        os.makedirs(self.folder, exist_ok=True)
        # an attempt of its own: one that is lost leaves a file that nobody names
        path, counts = f"{self.folder}/{uuid.uuid4().hex}", Counter()
        with open(path, "w", encoding="utf-8") as f:
            for r in rows:
                counts[r.action] += 1
                f.write(json.dumps([r.row, r.action, r.text or ""]) + "\n")
        return Patches(path, dict(counts))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        changes = []
        for m in messages:
            if m is not None:
                with open(m.path, encoding="utf-8") as f:
                    changes += [tuple(json.loads(line)) for line in f]
        whole = f"{self.folder}/copy"
        os.makedirs(self.folder, exist_ok=True)
        write_copy(self.source, whole, sorted((c for c in changes if c[0] is not None), key=lambda c: c[0]), self.column)
        os.replace(whole, self.target)
        shutil.rmtree(self.folder, ignore_errors=True)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


def save_copy(changes: DataFrame, source: str, target: str, column: int) -> None:
    """Write a copy of a workbook with changes(row, action, text), by tasks and a commit."""
    changes.sparkSession.dataSource.register(XlsxCopy)
    own = changes.select(F.col("row").cast("int").alias("row"), "action", F.col("text").cast("string").alias("text"))
    own.write.format("xlsxcopy").option("source", source).option("column", str(column)).mode("append").save(target)


def cells(spark: SparkSession, path: str) -> DataFrame:
    """The cell table of a file, with approved."""
    spark.dataSource.register(XlsxCells)
    df = spark.read.format("xlsxcells").load(path)
    return df.withColumn("approved", grid.approved(F.col("cell_argb"), F.col("runs")))


def column_of(table: DataFrame, header: str, fallback: int | None = None) -> int:
    """The first column whose header (row 1, trimmed, case ignored) is the given one, else the fallback."""
    from adjudica.functions.text import trim_all

    found = table.where("r = 1").where(F.lower(trim_all(F.coalesce("text", F.lit("")))) == header.strip().lower()).agg(F.min("c")).first()[0]
    if found is None and fallback is None:
        raise ValueError(f"no column is headed {header!r}")
    return found if found is not None else fallback


def workbook_rows(table: DataFrame, summary_column: int, case_column: int = 1) -> DataFrame:
    """row, case_number, existing, approved of rows 2 on that have a recognisable key."""
    from adjudica.functions import keys
    from adjudica.functions.text import trim_all

    keyed = table.where("r >= 2").where(F.col("c") == case_column).select(F.col("r").alias("row"), keys.first_key(F.col("text")).alias("case_number")).where("case_number is not null")
    own = table.where(F.col("c") == summary_column).select(F.col("r").alias("_r"), trim_all(F.coalesce("text", F.lit(""))).alias("_t"), F.col("approved").alias("_a"))
    both = keyed.join(own, F.col("row") == F.col("_r"), "left")
    existing = F.coalesce("_t", F.lit(""))
    return both.select("row", "case_number", existing.alias("existing"), (F.coalesce("_a", F.lit(False)) & (existing != "")).alias("approved"))


def write_copy(source: str, target: str, changes: list[tuple[int, str, str]], column: int) -> None:
    """Write a copy with changed cells of one column: (row, action, text); written ones get text, font and fill,
    flagged ones a fill. Styles are cloned, so cells that shared one keep theirs. The source is never the target."""
    if source == target:
        raise ValueError("the source is never overwritten")
    ET.register_namespace("", M)
    ET.register_namespace("r", R)
    with zipfile.ZipFile(source) as z:
        parts = {n: z.read(n) for n in z.namelist()}
        sheet_name = sheet_path(z)
    sheet, styles = ET.fromstring(parts[sheet_name]), ET.fromstring(parts["xl/styles.xml"])
    fonts, fills, formats = (styles.find(_n(x)) for x in ("fonts", "fills", "cellXfs"))

    def fill(argb: str) -> int:
        f = ET.SubElement(ET.SubElement(fills, _n("fill")), _n("patternFill"), {"patternType": "solid"})
        ET.SubElement(f, _n("fgColor"), {"rgb": argb})
        return len(fills) - 1

    made: dict[tuple[int, str], int] = {}
    fill_of = {"written": fill(grid.WRITTEN_FILL), "flagged": fill(grid.REVIEW_FILL)}

    def style(old: int, action: str) -> int:
        if (old, action) not in made:
            x = ET.fromstring(ET.tostring(formats[old]))
            x.set("fillId", str(fill_of[action]))
            x.set("applyFill", "1")
            if action == "written":
                font = ET.fromstring(ET.tostring(fonts[int(x.get("fontId", 0))]))
                for c in font.findall(_n("color")):
                    font.remove(c)
                ET.SubElement(font, _n("color"), {"rgb": grid.WRITTEN_FONT})
                fonts.append(font)
                x.set("fontId", str(len(fonts) - 1))
                x.set("applyFont", "1")
            formats.append(x)
            made[old, action] = len(formats) - 1
        return made[old, action]

    data = sheet.find(_n("sheetData"))
    rows = {int(r.get("r")): r for r in data.findall(_n("row"))}
    for r, action, text in changes:
        if action not in fill_of:
            continue
        row = rows.get(r)
        if row is None:
            after = sum(int(x.get("r")) < r for x in data)
            row = rows[r] = ET.Element(_n("row"), {"r": str(r)})
            data.insert(after, row)
        ref = f"{letters(column)}{r}"
        cell = next((c for c in row if c.get("r") == ref), None)
        if cell is None:
            cell = ET.Element(_n("c"), {"r": ref})
            row.insert(sum(place(c.get("r"))[1] < column for c in row), cell)
        cell.set("s", str(style(int(cell.get("s", 0)), action)))
        if action == "written":
            for child in list(cell):
                cell.remove(child)
            cell.set("t", "inlineStr")
            t = ET.SubElement(ET.SubElement(cell, _n("is")), _n("t"), {"{http://www.w3.org/XML/1998/namespace}space": "preserve"})
            t.text = text
    for x in (fonts, fills, formats):
        x.set("count", str(len(x)))
    parts[sheet_name], parts["xl/styles.xml"] = ET.tostring(sheet, xml_declaration=True, encoding="UTF-8"), ET.tostring(styles, xml_declaration=True, encoding="UTF-8")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for n, body in parts.items():
            z.writestr(n, body)


def write_workbook(path: str, table: list[list], name: str = "Sheet1") -> None:
    """A small workbook: cells are None, text, (text, argb) or a list of (text, argb) runs."""
    colours: list[str | None] = [None]
    rows = []
    for r, line in enumerate(table, 1):
        row = ET.Element(_n("row"), {"r": str(r)})
        for c, value in enumerate(line, 1):
            if value is None:
                continue
            cell = ET.SubElement(row, _n("c"), {"r": f"{letters(c)}{r}", "t": "inlineStr"})
            body = ET.SubElement(cell, _n("is"))
            if isinstance(value, list):
                for text, argb in value:
                    run = ET.SubElement(body, _n("r"))
                    if argb:
                        ET.SubElement(ET.SubElement(run, _n("rPr")), _n("color"), {"rgb": argb})
                    ET.SubElement(run, _n("t")).text = text
                continue
            text, argb = value if isinstance(value, tuple) else (value, None)
            if argb not in colours:
                colours.append(argb)
            cell.set("s", str(colours.index(argb)))
            ET.SubElement(body, _n("t")).text = str(text)
        rows.append(row)
    ET.register_namespace("", M)
    sheet = ET.Element(_n("worksheet"))
    ET.SubElement(sheet, _n("sheetData")).extend(rows)
    fonts = "".join("<font>" + (f'<color rgb="{c}"/>' if c else "") + "</font>" for c in colours)
    xfs = "".join(f'<xf fontId="{i}" fillId="0" borderId="0"/>' for i in range(len(colours)))
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>')
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{R}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{M}" xmlns:r="{R}"><sheets><sheet name="{name}" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{R}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{R}/styles" Target="styles.xml"/></Relationships>')
        z.writestr("xl/styles.xml", f'{head}<styleSheet xmlns="{M}"><fonts>{fonts}</fonts><fills><fill><patternFill patternType="none"/></fill></fills><borders><border/></borders><cellStyleXfs><xf/></cellStyleXfs><cellXfs>{xfs}</cellXfs></styleSheet>')
        z.writestr("xl/worksheets/sheet1.xml", ET.tostring(sheet, xml_declaration=True, encoding="UTF-8"))
