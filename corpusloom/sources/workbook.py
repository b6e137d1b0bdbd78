"""Workbooks (.xlsx) as a Spark data source and sink, with the standard library alone.

``spark.read.format("workbook").option("sheet", "Export").schema(...).load(path)`` gives the
sheet's rows below its header and their ordinal ``_row``; all cells are text. A column that the
sheet lacks is null; a missing sheet is an error. A sheet is one partition: the format is a
compressed stream that can't be split.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType

_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def _text(node: ET.Element) -> str:
    return "".join(t.text or "" for t in node.iter(f"{_NS}t"))


def _column(ref: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_part(book: zipfile.ZipFile, sheet: str) -> str:
    """The part that holds ``sheet``."""
    links = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    for s in ET.fromstring(book.read("xl/workbook.xml")).iter(f"{_NS}sheet"):
        if s.get("name") == sheet:
            target = links[s.get(_REL)]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError(f"no sheet named {sheet!r}")


def read_rows(data: bytes, sheet: str) -> Iterator[list[str | None]]:
    """Rows of cells, read as a stream."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = [_text(si) for si in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_NS}si")]
        with book.open(sheet_part(book, sheet)) as part:
            for _, row in ET.iterparse(part):
                if row.tag != f"{_NS}row":
                    continue
                out: list[str | None] = []
                for cell in row.iter(f"{_NS}c"):
                    at = _column(cell.get("r")) if cell.get("r") else len(out)
                    out += [None] * (at + 1 - len(out))
                    value, kind = cell.find(f"{_NS}v"), cell.get("t")
                    if kind == "inlineStr":
                        out[at] = _text(cell)
                    elif value is not None and value.text is not None:
                        out[at] = shared[int(value.text)] if kind == "s" else value.text
                yield out
                row.clear()


def write_rows(header: list[str], rows: Iterable[Iterable[object]], sheet: str = "Export") -> bytes:
    """A workbook of one sheet; numbers stay numbers, null cells are left out."""

    def cell(v: object) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v!r}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    out = io.BytesIO()
    main, office = _NS[1:-1], "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/></Types>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{office}"><sheets><sheet name="{escape(sheet)}" sheetId="1" r:id="r1"/></sheets></workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{office}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>')
        with book.open("xl/worksheets/sheet1.xml", "w") as part:
            part.write(f'<worksheet xmlns="{main}"><sheetData>'.encode())
            for row in _with_header(header, rows):
                part.write(f"<row>{''.join(map(cell, row))}</row>".encode())
            part.write(b"</sheetData></worksheet>")
    return out.getvalue()


def _number(value: object) -> object:
    try:
        return float(value) if isinstance(value, str) else value
    except ValueError:
        return value


def _with_header(header: list[str], rows: Iterable[Iterable[object]]) -> Iterator[Iterable[object]]:
    yield header
    yield from rows


class _Reader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.sheet, self.names = options["path"], options.get("sheet", "Export"), [f.name for f in schema]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        with open(self.path, "rb") as f:
            rows = read_rows(f.read(), self.sheet)
        header = next(rows, [])
        at = [header.index(n) if n in header else None for n in self.names]
        for i, row in enumerate(rows):
            yield tuple(i if n == "_row" else row[k] if k is not None and k < len(row) else None for n, k in zip(self.names, at, strict=True))


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> StructType:
        with open(self.options["path"], "rb") as f:
            header = next(read_rows(f.read(), self.options.get("sheet", "Export")), [])
        return StructType([StructField(str(n), StringType()) for n in header] + [StructField("_row", LongType())])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options, schema)


def read_workbook(spark: SparkSession, path: str, *, sheet: str = "Export", names: dict[str, str] | None = None) -> DataFrame:
    """The sheet with ``_row``; ``names`` maps the header's names to those wanted."""
    spark.dataSource.register(WorkbookSource)
    df = spark.read.format("workbook").option("sheet", sheet).load(path)
    return df.withColumnsRenamed(names or {})


def write_workbook(df: DataFrame, path: str, *, sheet: str = "Export", numbers: tuple[str, ...] = ()) -> None:
    """``df`` in the order of ``_row``, which isn't written, as one workbook. Rows come to the
    driver partition by partition; a worksheet holds about a million at most. Texts of the columns
    ``numbers`` that are numbers become number cells."""
    ordered = df.orderBy("_row").drop("_row") if "_row" in df.columns else df
    at = {i for i, c in enumerate(ordered.columns) if c in numbers}
    rows = ([_number(v) if i in at else v for i, v in enumerate(r)] for r in ordered.toLocalIterator())
    data = write_rows(ordered.columns, rows, sheet)
    with open(path, "wb") as f:
        f.write(data)
