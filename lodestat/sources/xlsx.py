"""Workbooks (.xlsx) as a Spark data source: ``spark.read.format("xlsx")`` and ``df.write.format("xlsx")``.

A workbook is a zip of XML parts. Every sheet of every file is a partition of its own, read as a stream; of a file only the parts
that are needed are opened. Paths go through pyarrow's file systems, so local folders and the remote stores it knows will do.
"""

from __future__ import annotations

import datetime
import math
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyarrow import fs as pafs
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# fixed values of the file format (ECMA-376)
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PACKAGE = "{http://schemas.openxmlformats.org/package/2006/relationships}"
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
MOST_ROWS = 1_048_576

ESCAPED = re.compile(r"_x([0-9A-Fa-f]{4})_")
UNPRINTABLE = re.compile("[\x00-\x08\x0b-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path if re.match(r"\w+:", path) else f"file://{path}")


def _workbooks(path: str) -> list[str]:
    """The workbook itself, or all below a folder but hidden and temporary ones; as given to ``_open``."""
    system, inner = _open(path)
    prefix = path[: len(path.rstrip("/")) - len(inner)] if path.rstrip("/").endswith(inner) else ""
    info = system.get_file_info(inner)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == pafs.FileType.File:
        return [path]
    below = system.get_file_info(pafs.FileSelector(inner, recursive=True))
    own = [f.path for f in below if f.type == pafs.FileType.File and f.path.lower().endswith(".xlsx")]
    return sorted(prefix + f for f in own if not re.search(r"/[._~]", f[len(inner) :]))


def _unescape(text: str) -> str:
    return ESCAPED.sub(lambda m: chr(int(m[1], 16)), text)


def _text(element: ElementTree.Element) -> str:
    """All runs of a string item; phonetic hints aren't text."""
    parts = [t.text or "" for t in element.findall(f"{MAIN}t")]
    parts += [t.text or "" for run in element.findall(f"{MAIN}r") for t in run.findall(f"{MAIN}t")]
    return _unescape("".join(parts))


def is_date_format(code: str) -> bool:
    """A number format that shows a day or a time: d, m, y, h or s outside quotes, escapes and brackets (elapsed times count)."""
    bare = re.sub(r'"[^"]*"|\\.|_.|\*.', "", code.split(";")[0])
    return bool(re.search(r"\[[hms]+\]", bare, re.I)) or bool(re.search("[dmyhs]", re.sub(r"\[[^\]]*\]", "", bare), re.I)) and "general" not in bare.lower()


def to_datetime(serial: float, from_1904: bool) -> datetime.datetime | None:
    """Days since the workbook's epoch; the 1900 system counts a 29 February 1900 that never was."""
    if from_1904:
        epoch = datetime.datetime(1904, 1, 1)
    else:
        epoch = datetime.datetime(1899, 12, 31 if serial < 60 else 30)
    try:
        return epoch + datetime.timedelta(milliseconds=round(serial * 86_400_000))
    except OverflowError:
        return None


def _column(reference: str) -> int:
    at = 0
    for letter in reference:
        if not letter.isalpha():
            break
        at = at * 26 + ord(letter.upper()) - 64
    return at - 1


class Workbook:
    """An open workbook: its sheets, and the rows of one sheet as a stream of values (text, float, bool, datetime or None)."""

    def __init__(self, path: str):
        system, inner = _open(path)
        self.file = system.open_input_file(inner)
        self.zip = zipfile.ZipFile(self.file)
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        properties = book.find(f"{MAIN}workbookPr")
        self.from_1904 = properties is not None and properties.get("date1904") in ("1", "true")
        links = ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))
        targets = {r.get("Id"): r.get("Target").lstrip("/").removeprefix("xl/") for r in links.iter(f"{PACKAGE}Relationship")}
        self.sheets = {s.get("name"): f"xl/{targets[s.get(f'{REL}id')]}" for s in book.iter(f"{MAIN}sheet") if "worksheets/" in targets[s.get(f"{REL}id")]}

    def __enter__(self) -> Workbook:
        return self

    def __exit__(self, *_) -> None:
        self.zip.close()
        self.file.close()

    def _strings(self) -> list[str]:
        if "xl/sharedStrings.xml" not in self.zip.namelist():
            return []
        return [_text(item) for item in ElementTree.fromstring(self.zip.read("xl/sharedStrings.xml")).iter(f"{MAIN}si")]

    def _date_styles(self) -> set[int]:
        if "xl/styles.xml" not in self.zip.namelist():
            return set()
        styles = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
        dates = DATE_FORMATS | {int(f.get("numFmtId")) for f in styles.iter(f"{MAIN}numFmt") if is_date_format(f.get("formatCode") or "")}
        dates -= {int(f.get("numFmtId")) for f in styles.iter(f"{MAIN}numFmt") if not is_date_format(f.get("formatCode") or "")}
        cells = styles.find(f"{MAIN}cellXfs")
        return {i for i, x in enumerate(cells if cells is not None else []) if int(x.get("numFmtId") or 0) in dates}

    def rows(self, sheet: str) -> Iterator[tuple[int, dict[int, Any]]]:
        """(row number from 1, values by column from 0); empty cells and cells in error have no value."""
        strings, dates = self._strings(), self._date_styles()
        with self.zip.open(self.sheets[sheet]) as part:
            number, parents = 0, []
            for event, element in ElementTree.iterparse(part, ("start", "end")):
                if event == "start":
                    parents.append(element)
                    continue
                parents.pop()
                if element.tag != f"{MAIN}row":
                    continue
                number, at, cells = int(element.get("r") or number + 1), -1, {}
                for cell in element.iter(f"{MAIN}c"):
                    at = _column(cell.get("r")) if cell.get("r") else at + 1
                    value = self._value(cell, strings, dates)
                    if value is not None:
                        cells[at] = value
                yield number, cells
                if parents:  # rows that were read are let go
                    parents[-1].remove(element)

    def _value(self, cell: ElementTree.Element, strings: list[str], dates: set[int]) -> Any:
        kind = cell.get("t") or "n"
        if kind == "inlineStr":
            inline = cell.find(f"{MAIN}is")
            return None if inline is None else _text(inline)
        held = cell.findtext(f"{MAIN}v")
        if held is None or kind == "e":
            return None
        if kind == "s":
            return strings[int(held)]
        if kind == "str":
            return _unescape(held)
        if kind == "b":
            return held in ("1", "true")
        if kind == "d":
            return datetime.datetime.fromisoformat(held.replace("Z", ""))
        number = float(held)
        return to_datetime(number, self.from_1904) if int(cell.get("s") or 0) in dates else number


def _as_text(value: Any) -> str:
    if isinstance(value, bool):
        return str(value).lower()
    if isinstance(value, float):
        return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(" ") if value.time() != datetime.time() else value.date().isoformat()
    return value


def converted(value: Any, kind: T.DataType) -> Any:
    """The cell's value in a column of ``kind``; null where it can't be one, as other text sources have it."""
    if value is None:
        return None
    try:
        if isinstance(kind, T.StringType):
            return _as_text(value)
        if isinstance(kind, T.BooleanType):
            return value if isinstance(value, bool) else {"true": True, "false": False}.get(_as_text(value).lower())
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            when = value if isinstance(value, datetime.datetime) else datetime.datetime.fromisoformat(value) if isinstance(value, str) else None
            return when.date() if when and isinstance(kind, T.DateType) else when
        if isinstance(value, datetime.datetime):
            return None
        if isinstance(kind, T.DecimalType):
            from decimal import Decimal

            return round(Decimal(_as_text(value)), kind.scale)
        number = float(value)
        if isinstance(kind, (T.DoubleType, T.FloatType)):
            return number
        if isinstance(kind, T.IntegralType):
            return int(_as_text(value)) if isinstance(value, str) else int(number) if number.is_integer() else None
    except (ValueError, ArithmeticError):
        return None
    raise TypeError(f"a sheet has no columns of type {kind.simpleString()}")


def _kind_of(values: set[type]) -> T.DataType:
    if values == {float}:
        return T.DoubleType()
    if values == {bool}:
        return T.BooleanType()
    return T.TimestampNTZType() if values == {datetime.datetime} else T.StringType()


@dataclass
class SheetPartition(InputPartition):
    path: str
    sheet: str


@dataclass
class Layout:
    """Options: ``sheet`` (a name, a number from 0, or * for all; 0), ``skip`` (rows above the header or the data), ``header`` (true)."""

    path: str
    sheet: str
    skip: int
    header: bool

    @classmethod
    def of(cls, options: dict) -> Layout:
        return cls(options["path"], options.get("sheet", "0"), int(options.get("skip", 0)), str(options.get("header", "true")).lower() == "true")

    def sheets(self) -> list[SheetPartition]:
        found = []
        for path in _workbooks(self.path):
            with Workbook(path) as book:
                names = list(book.sheets)
            if self.sheet == "*":
                found += [SheetPartition(path, name) for name in names]
            elif self.sheet in names:
                found.append(SheetPartition(path, self.sheet))
            elif self.sheet.isdigit() and int(self.sheet) < len(names):
                found.append(SheetPartition(path, names[int(self.sheet)]))
            else:
                raise ValueError(f"{path} has no sheet {self.sheet!r}, but {names}")
        return found

    def data(self, book: Workbook, sheet: str) -> tuple[dict[str, int], Iterator[dict[int, Any]]]:
        """Columns by name (their places if there is no header) and the rows below; rows without a value are skipped."""
        rows = (cells for number, cells in book.rows(sheet) if number > self.skip and cells)
        names = {}
        if self.header:
            for at, value in sorted(next(rows, {}).items()):
                names.setdefault(_as_text(value), at)
        return names, rows


class XlsxReader(DataSourceReader):
    def __init__(self, schema: T.StructType, layout: Layout):
        self.schema, self.layout = schema, layout

    def partitions(self) -> list[InputPartition]:
        return self.layout.sheets() or [SheetPartition("", "")]

    def read(self, partition: SheetPartition) -> Iterator[tuple]:
        if not partition.path:
            return
        with Workbook(partition.path) as book:
            names, rows = self.layout.data(book, partition.sheet)
            at = [names.get(f.name) if self.layout.header else i for i, f in enumerate(self.schema.fields)]
            kinds = [f.dataType for f in self.schema.fields]
            for cells in rows:
                yield tuple(converted(cells.get(i), kind) for i, kind in zip(at, kinds, strict=True))


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
SPREADSHEET = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
# style 1 is a day with a time, style 2 a day
STYLES = (
    f'{HEAD}<styleSheet {SPREADSHEET}><numFmts count="1"><numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd hh:mm:ss.000"/></numFmts><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="164" applyNumberFormat="1"/><xf numFmtId="14" applyNumberFormat="1"/></cellXfs></styleSheet>'
)


def _cell(value: Any) -> str:
    if value is None or isinstance(value, float) and not math.isfinite(value):
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime.date):
        if value.year < 1900:  # no serial stands for it
            return _cell(value.isoformat())
        when = value.replace(tzinfo=None) if isinstance(value, datetime.datetime) else datetime.datetime(value.year, value.month, value.day)
        epoch = datetime.datetime(1899, 12, 31 if when < datetime.datetime(1900, 3, 1) else 30)
        return f'<c s="{1 if isinstance(value, datetime.datetime) else 2}"><v>{(when - epoch) / datetime.timedelta(days=1)!r}</v></c>'
    if isinstance(value, str):
        text = UNPRINTABLE.sub(lambda m: f"_x{ord(m[0]):04X}_", value)
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
    return f"<c><v>{value!r}</v></c>" if isinstance(value, (int, float)) else f"<c><v>{value}</v></c>"


class XlsxWriter(DataSourceWriter):
    """A workbook a task, of as many sheets as its rows need. Workbooks get their names when all tasks have ended well; append adds to a folder."""

    def __init__(self, schema: T.StructType, layout: Layout, overwrite: bool, most_rows: int):
        self.schema, self.layout, self.most_rows = schema, layout, most_rows
        for field in schema.fields:
            converted(0.0, field.dataType)
        system, inner = _open(layout.path)
        self.old = _workbooks(layout.path) if overwrite and system.get_file_info(inner).type == pafs.FileType.Directory else []
        system.create_dir(inner)

    def write(self, iterator: Iterator) -> Written:
        system, inner = _open(self.layout.path)
        name = f"part-{uuid.uuid4().hex}.xlsx"
        done = Written(f"{inner}/_{name}", f"{inner}/{name}")
        head = "".join(_cell(f.name) for f in self.schema.fields)
        top = f"<row>{head}</row>" if self.layout.header else ""
        sheets, row = 0, next(iterator, None)
        with system.open_output_stream(done.temporary) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as book:
            while row is not None or not sheets:
                sheets += 1
                with book.open(f"xl/worksheets/sheet{sheets}.xml", "w", force_zip64=True) as sheet:
                    sheet.write(f"{HEAD}<worksheet {SPREADSHEET}><sheetData>{top}".encode())
                    rows = int(self.layout.header)
                    while row is not None and rows < self.most_rows:
                        sheet.write(f"<row>{''.join(map(_cell, row))}</row>".encode())
                        rows, row = rows + 1, next(iterator, None)
                    sheet.write(b"</sheetData></worksheet>")
            numbers = range(1, sheets + 1)
            kind = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
            package = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'
            office = "application/vnd.openxmlformats-officedocument.spreadsheetml"
            listed = "".join(f'<sheet name="Sheet{i}" sheetId="{i}" r:id="rId{i}"/>' for i in numbers)
            book.writestr("xl/workbook.xml", f'{HEAD}<workbook {SPREADSHEET} xmlns:r="{kind}"><sheets>{listed}</sheets></workbook>')
            links = "".join(f'<Relationship Id="rId{i}" Type="{kind}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
            book.writestr("xl/_rels/workbook.xml.rels", f'{HEAD}<Relationships {package}>{links}<Relationship Id="rId0" Type="{kind}/styles" Target="styles.xml"/></Relationships>')
            book.writestr("xl/styles.xml", STYLES)
            book.writestr("_rels/.rels", f'{HEAD}<Relationships {package}><Relationship Id="rId1" Type="{kind}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
            parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{office}.worksheet+xml"/>' for i in numbers)
            parts += f'<Override PartName="/xl/workbook.xml" ContentType="{office}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{office}.styles+xml"/>'
            book.writestr(
                "[Content_Types].xml",
                f'{HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>{parts}</Types>',
            )
        return done

    def commit(self, messages: list[Written | None]) -> None:
        system, _ = _open(self.layout.path)
        for path in self.old:
            system.delete_file(_open(path)[1])
        for done in messages:
            system.move(done.temporary, done.final)

    def abort(self, messages: list[Written | None]) -> None:
        system, _ = _open(self.layout.path)
        for done in messages:
            if done is not None:
                system.delete_file(done.temporary)


class XlsxSource(DataSource):
    """Read options: see ``Layout``. Without a schema the first sheet read is gone through once: a column of numbers only is double,
    of days and times only timestamp_ntz, of truth values only boolean, any other string. With one, columns are found by name in the header (by place
    without a header); what can't be of the column's type is null. Write options: header, ``rows`` (a sheet's most)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> T.StructType:
        layout = Layout.of(self.options)
        first = next(iter(layout.sheets()), None)
        if first is None:
            raise ValueError(f"no workbook below {layout.path}")
        with Workbook(first.path) as book:
            names, rows = layout.data(book, first.sheet)
            seen: dict[int, set[type]] = {}
            for cells in rows:
                for at, value in cells.items():
                    seen.setdefault(at, set()).add(type(value))
        if not layout.header:
            names = {f"_c{i}": i for i in range(max(seen, default=-1) + 1)}
        return T.StructType([T.StructField(name, _kind_of(seen.get(at, set()))) for name, at in names.items()])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return XlsxReader(schema, Layout.of(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceWriter:
        return XlsxWriter(schema, Layout.of(self.options), overwrite, int(self.options.get("rows", MOST_ROWS)))


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    spark.dataSource.register(XlsxSource)
