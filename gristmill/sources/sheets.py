"""Spreadsheet workbooks (.xlsx) as source and sink, by the open format itself: a zip of XML parts, no library needed."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.sources.tables import ILLEGAL_CONTROL, path_exists

#: Rows that a sheet may have (fixed value of the format).
MOST_ROWS = 1_048_576
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _column_number(reference: str) -> int:
    """0 for A, 26 for AA."""
    n = 0
    for letter in re.match("[A-Z]+", reference)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _column_name(number: int) -> str:
    name, n = "", number + 1
    while n:
        n, rest = divmod(n - 1, 26)
        name = chr(65 + rest) + name
    return name


def _texts(element: ElementTree.Element) -> str:
    return "".join(t.text or "" for t in element.iter(f"{_MAIN}t"))


def cells(workbook: bytes, sheet: str | None = None) -> Iterator[list[str | None]]:
    """Rows of a sheet (the first by default) as texts, as they are stored; empty cells are NULL, missing rows left out.

    A number keeps the digits it is stored with; a whole one loses a trailing ``.0``. Booleans are TRUE and FALSE.
    """
    with zipfile.ZipFile(io.BytesIO(workbook)) as parts:
        book = ElementTree.fromstring(parts.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(parts.read("xl/_rels/workbook.xml.rels"))}
        sheets = [(s.get("name"), targets[s.get(_LINK)]) for s in book.iter(f"{_MAIN}sheet")]
        found = [t for name, t in sheets if sheet is None or name == sheet]
        if not found:
            raise KeyError(sheet)
        shared = [_texts(x) for x in ElementTree.fromstring(parts.read("xl/sharedStrings.xml")).findall(f"{_MAIN}si")] if "xl/sharedStrings.xml" in parts.namelist() else []
        path = found[0].lstrip("/")
        with parts.open(path if path.startswith("xl/") else f"xl/{path}") as stream:
            for _, row in ElementTree.iterparse(stream):
                if row.tag != f"{_MAIN}row":
                    continue
                out: list[str | None] = []
                for place, cell in enumerate(row.findall(f"{_MAIN}c")):
                    at = _column_number(cell.get("r")) if cell.get("r") else place
                    out += [None] * (at + 1 - len(out))
                    kind, value = cell.get("t"), cell.find(f"{_MAIN}v")
                    if kind == "inlineStr":
                        out[at] = _texts(cell)
                    elif value is not None and value.text is not None:
                        text = value.text
                        out[at] = shared[int(text)] if kind == "s" else ("TRUE" if text == "1" else "FALSE") if kind == "b" else re.sub(r"\.0+$", "", text) if kind in (None, "n") else text
                yield [x if x != "" else None for x in out]
                row.clear()


def read_sheets(spark: SparkSession, path: str, columns: list[str], sheet: str | None = None) -> DataFrame:
    """Rows of every workbook that ``path`` matches, all text: (file_name, row_index, columns...).

    The first row of a sheet names its columns; ones that are asked for and absent are NULL, others are dropped. A
    workbook is read by one task; a missing path is an empty relation.
    """
    shape = T.StructType([T.StructField("file_name", T.StringType()), T.StructField("row_index", T.IntegerType()), *[T.StructField(c, T.StringType()) for c in columns]])
    if not path_exists(spark, path):
        return spark.createDataFrame([], shape)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                rows = cells(content, sheet)
                header = [(h or "").strip() for h in next(rows, [])]
                places = [header.index(c) if c in header else None for c in columns]
                out = []
                for index, row in enumerate(rows):
                    out.append((name.rsplit("/", 1)[-1], index, *[row[p] if p is not None and p < len(row) else None for p in places]))
                    if len(out) == 10_000:
                        yield pd.DataFrame(out, columns=shape.names)
                        out = []
                if out:
                    yield pd.DataFrame(out, columns=shape.names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, shape)


_STYLES = """<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><fonts count="2"><font/><font><b/></font></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>
<cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf fontId="1" applyFont="1"/><xf numFmtId="49" applyNumberFormat="1"/></cellXfs></styleSheet>"""


def _cell(column: int, row: int, value: object, as_text: bool, bold: bool = False) -> str:
    if value is None:
        return ""
    where = f"{_column_name(column)}{row}"
    if not as_text and isinstance(value, (int, float)) and not isinstance(value, bool):
        return f'<c r="{where}"><v>{value!r}</v></c>'
    text = escape(re.sub(ILLEGAL_CONTROL, "", str(value)))
    return f'<c r="{where}" t="inlineStr" s="{1 if bold else 2}"><is><t xml:space="preserve">{text}</t></is></c>'


def workbook_of(sheets: dict[str, DataFrame], identifiers: tuple[str, ...] = ()) -> bytes:
    """A workbook with a bold, frozen header on each sheet; ``identifiers`` and all text are stored as text, numbers as numbers.

    Rows come from the driver's iterator one partition at a time. A sheet with more rows than the format allows raises.
    """
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as parts:
        names = list(sheets)
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for k in range(1, len(names) + 1))
        parts.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
                       '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>' + kinds + "</Types>")
        relation = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        package = "http://schemas.openxmlformats.org/package/2006/relationships"
        parts.writestr("_rels/.rels", f'<Relationships xmlns="{package}"><Relationship Id="r1" Type="{relation}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n[:31], {chr(34): "&quot;"})}" sheetId="{k}" r:id="r{k}"/>' for k, n in enumerate(names, 1))
        parts.writestr("xl/workbook.xml", f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="{relation}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{k}" Type="{relation}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(names) + 1))
        parts.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{package}">{links}<Relationship Id="s" Type="{relation}/styles" Target="styles.xml"/></Relationships>')
        parts.writestr("xl/styles.xml", _STYLES)
        for k, name in enumerate(names, 1):
            df = sheets[name]
            if df.count() >= MOST_ROWS:
                raise ValueError(f"{name} has more rows than a sheet may hold")
            with parts.open(f"xl/worksheets/sheet{k}.xml", "w") as sheet:
                write = lambda text: sheet.write(text.encode())  # noqa: B023, E731
                write('<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" activePane="bottomLeft" state="frozen"/></sheetView></sheetViews><sheetData>')
                write('<row r="1">' + "".join(_cell(c, 1, h, True, True) for c, h in enumerate(df.columns)) + "</row>")
                for r, row in enumerate(df.toLocalIterator(), 2):
                    write(f'<row r="{r}">' + "".join(_cell(c, r, v, df.columns[c] in identifiers) for c, v in enumerate(row)) + "</row>")
                write("</sheetData></worksheet>")
    return out.getvalue()


def write_workbook(spark: SparkSession, path: str, sheets: dict[str, DataFrame], identifiers: tuple[str, ...] = ()) -> None:
    """``workbook_of`` at ``path`` on whichever file system it names, complete or not at all: written beside, then renamed."""
    content = workbook_of(sheets, identifiers)
    jvm = spark._jvm
    final, beside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    system = final.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(beside, True)
    stream.write(bytearray(content))
    stream.close()
    system.delete(final, False)
    system.rename(beside, final)


def level_sheets(df: DataFrame, level: str, levels: list[str], order: list[str]) -> dict[str, DataFrame]:
    """One sheet for each level, in their order, its rows by ``order``; rows of other levels are on none."""
    return {name: df.filter(F.col(level) == name).drop(level).orderBy(*order) for name in levels}
