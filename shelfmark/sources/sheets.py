"""Spreadsheets (.xlsx) as a Spark data source: `spark.read.format("sheets")` and `df.write.format("sheets")` after `register(spark)`.

Reading: a partition a file and sheet, and rows stream out of the zipped XML. Options: `sheet`, the name of the sheet to read (the first if not given, `*` for all), `header` (true). Without a schema all columns are
text, named by the first row of the first file. Columns are found by name, so files may order them differently; a column that a file lacks is null there.

Writing: each task streams its rows into files of up to a sheet's 1,048,575 rows below a hidden folder, and the driver moves those of successful tasks to their place when all are done, so neither failed nor repeated tasks
leave rows. `overwrite` removes the files of before only then.

Nulls are cells that aren't there, empty texts are empty cells of text, `Null` is a text. Numbers that a double can't hold are written as text. Dates and timestamps (UTC) are days since 1899-12-30, formatted as such. Characters that
XML can't hold are written as `_xHHHH_`. Formulas are read by their values; styles and merged cells are not kept. Paths are what pyarrow's file systems read, such as `file:`, `hdfs:` or `s3:`.
"""

from __future__ import annotations

import datetime as dt
import itertools
import posixpath
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from xml.etree import ElementTree as ET
from xml.sax.saxutils import escape

from pyarrow import fs as filesystems
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import BooleanType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType, TimestampType

MOST_ROWS = 1_048_575
_WHOLE, _REAL = (ByteType, ShortType, IntegerType, LongType), (FloatType, DoubleType)
# Names of the format's parts, its number formats for dates, and its first day.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_DAY_0 = dt.datetime(1899, 12, 30)
_ILLEGAL = re.compile("[\x00-\x08\x0b-\x0d\x0e-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
_HIDDEN = re.compile("_x([0-9A-Fa-f]{4})_")


def _at(path: str) -> tuple[filesystems.FileSystem, str]:
    return filesystems.FileSystem.from_uri(path if re.match(r"\w+:", path) else posixpath.abspath(path))


def _files(path: str) -> list[str]:
    """The spreadsheets at a path, in order."""
    fs, root = _at(path)
    info = fs.get_file_info(root)
    if info.type == filesystems.FileType.File:
        return [root]
    found = fs.get_file_info(filesystems.FileSelector(root, recursive=True))
    return sorted(f.path for f in found if f.is_file and f.path.lower().endswith(".xlsx") and "/_" not in f.path[len(root) :])


class _Book:
    """A spreadsheet's parts, opened for reading."""

    def __init__(self, source):
        self.zip = zipfile.ZipFile(source)
        targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        self.sheets = {s.get("name"): posixpath.normpath(posixpath.join("/xl", targets[s.get(f"{_REL}id")])).lstrip("/") for s in ET.fromstring(self.zip.read("xl/workbook.xml")).iter(f"{_MAIN}sheet")}
        names = set(self.zip.namelist())
        self.shared = list(self._texts("xl/sharedStrings.xml")) if "xl/sharedStrings.xml" in names else []
        self.dates = self._date_styles("xl/styles.xml") if "xl/styles.xml" in names else set()

    def _texts(self, part: str) -> Iterator[str]:
        with self.zip.open(part) as f:
            for _, item in ET.iterparse(f):
                if item.tag == f"{_MAIN}si":
                    yield _text(item)
                    item.clear()

    def _date_styles(self, part: str) -> set[str]:
        root = ET.fromstring(self.zip.read(part))
        own = {int(f.get("numFmtId")) for f in root.iter(f"{_MAIN}numFmt") if re.search("[dyhs]", re.sub(r'"[^"]*"|\[[^]]*\]|\\.', "", f.get("formatCode") or ""))}
        return {str(i) for cells in root.iter(f"{_MAIN}cellXfs") for i, x in enumerate(cells) if int(x.get("numFmtId") or 0) in _DATE_FORMATS | own}

    def rows(self, sheet: str) -> Iterator[dict[int, object]]:
        """The cells of each row by place; values are text, bool, datetime, or a number's text in a list of its own."""
        with self.zip.open(self.sheets[sheet]) as f:
            for _, e in ET.iterparse(f):
                if e.tag == f"{_MAIN}row":
                    cells, place = {}, -1
                    for c in e.iter(f"{_MAIN}c"):
                        place = _place(c.get("r")) if c.get("r") else place + 1
                        value = self._value(c)
                        if value is not None:
                            cells[place] = value
                    yield cells
                    e.clear()

    def _value(self, c: ET.Element) -> object:
        kind, held = c.get("t", "n"), c.find(f"{_MAIN}v")
        if kind == "inlineStr":
            return _text(c.find(f"{_MAIN}is"))
        if held is None or held.text is None:
            return "" if kind == "str" else None
        if kind == "s":
            return self.shared[int(held.text)]
        if kind == "b":
            return held.text.strip() == "1"
        if kind in ("str", "e", "d"):
            return _shown(held.text)
        if c.get("s") in self.dates:
            return _DAY_0 + dt.timedelta(microseconds=round(float(held.text) * 86_400_000_000))
        return [held.text.strip()]


def _shown(text: str) -> str:
    return _HIDDEN.sub(lambda m: chr(int(m[1], 16)), text)


def _text(item: ET.Element | None) -> str:
    """A text of one or more runs, without its reading aids."""
    if item is None:
        return ""
    runs = [t for x in item for t in ([x] if x.tag == f"{_MAIN}t" else x.findall(f"{_MAIN}t") if x.tag == f"{_MAIN}r" else [])]
    return _shown("".join(t.text or "" for t in runs))


def _place(ref: str) -> int:
    n = 0
    for letter in re.match("[A-Z]+", ref)[0]:
        n = n * 26 + ord(letter) - 64
    return n - 1


def _letters(place: int) -> str:
    out, n = "", place + 1
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _said(value: object) -> str | None:
    """A cell's value as text."""
    if isinstance(value, list):
        return value[0]
    if isinstance(value, dt.datetime):
        return value.date().isoformat() if value.time() == dt.time() else value.isoformat(" ")
    return {True: "true", False: "false"}[value] if isinstance(value, bool) else value


def _typed(value: object, kind: DataType) -> object:
    """A cell's value in a column's type; null where it isn't one."""
    if value is None:
        return None
    if isinstance(kind, StringType):
        return _said(value)
    try:
        if isinstance(kind, BooleanType):
            return value if isinstance(value, bool) else {"true": True, "false": False, "1": True, "0": False}.get((_said(value) or "").strip().lower())
        if isinstance(kind, (DateType, TimestampType)):
            when = value if isinstance(value, dt.datetime) else dt.datetime.fromisoformat(_said(value).strip())
            return when.date() if isinstance(kind, DateType) else when.replace(tzinfo=dt.UTC)
        text = str(int(value)) if isinstance(value, bool) else _said(value).strip()
        if isinstance(kind, _WHOLE):
            return int(text) if re.fullmatch(r"[-+]?\d+", text) else int(d) if (d := Decimal(text)) == int(d) else None
        return Decimal(text) if isinstance(kind, DecimalType) else float(text)
    except (ValueError, ArithmeticError, AttributeError):
        return None


@dataclass
class _Sheet(InputPartition):
    path: str
    sheet: str


class SheetReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.sheet, self.header, self.schema = options["path"], options.get("sheet"), options.get("header", "true").lower() == "true", schema

    def partitions(self) -> list[InputPartition]:
        fs, out = _at(self.path)[0], []
        for path in _files(self.path):
            if self.sheet not in (None, "*"):
                out.append(_Sheet(path, self.sheet))
                continue
            with fs.open_input_file(path) as f:
                names = list(_Book(f).sheets)
            out += [_Sheet(path, n) for n in (names if self.sheet == "*" else names[:1])]
        return out

    def read(self, partition: _Sheet) -> Iterator[tuple]:
        with _at(self.path)[0].open_input_file(partition.path) as f:
            book = _Book(f)
            if partition.sheet not in book.sheets:
                return
            rows = book.rows(partition.sheet)
            places = list(range(len(self.schema)))
            if self.header:
                named = {(_said(v) or "").strip(): i for i, v in next(rows, {}).items()}
                places = [named.get(c.name.strip(), -1) for c in self.schema]
            for cells in rows:
                yield tuple(_typed(cells.get(i), c.dataType) for i, c in zip(places, self.schema, strict=True))


class SheetWriter(DataSourceWriter):
    def __init__(self, options: dict, schema: StructType, overwrite: bool):
        self.path, self.sheet, self.schema, self.overwrite = options["path"], options.get("sheet", "Sheet1"), schema, overwrite
        self.hidden = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> WriterCommitMessage:
        fs, root = _at(self.path)
        fs.create_dir(f"{root}/{self.hidden}", recursive=True)
        rows, written = iter(iterator), []
        while (first := next(rows, None)) is not None or not written:
            name = f"part-{uuid.uuid4().hex}.xlsx"
            with fs.open_output_stream(f"{root}/{self.hidden}/{name}") as out:
                _write_book(out, self.sheet, self.schema, itertools.chain([first], itertools.islice(rows, MOST_ROWS - 1)) if first is not None else [])
            written.append(name)
        return Written(written)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _at(self.path)
        before = _files(self.path) if self.overwrite else []
        for name in [n for m in messages if m for n in m.names]:
            fs.move(f"{root}/{self.hidden}/{name}", f"{root}/{name}")
        for path in before:
            fs.delete_file(path)
        self.abort(messages)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _at(self.path)
        if fs.get_file_info(f"{root}/{self.hidden}").type != filesystems.FileType.NotFound:
            fs.delete_dir(f"{root}/{self.hidden}")


@dataclass
class Written(WriterCommitMessage):
    names: list[str]


def _cell(ref: str, value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, dt.datetime):
        value = value.astimezone(dt.UTC).replace(tzinfo=None) if value.tzinfo else value
        return f'<c r="{ref}" s="2"><v>{(value - _DAY_0) / dt.timedelta(days=1)!r}</v></c>'
    if isinstance(value, dt.date):
        return f'<c r="{ref}" s="1"><v>{(value - _DAY_0.date()).days}</v></c>'
    if isinstance(value, (int, float, Decimal)) and value == value and abs(value) != float("inf") and (not isinstance(value, (int, Decimal)) or Decimal(value) == Decimal(float(value))):
        return f'<c r="{ref}"><v>{value!r}</v></c>' if not isinstance(value, Decimal) else f'<c r="{ref}"><v>{value}</v></c>'
    text = escape(_ILLEGAL.sub(lambda m: f"_x{ord(m[0]):04X}_", str(value)))
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def _write_book(out, sheet: str, schema: StructType, rows) -> None:
    """One sheet with a header, written as it comes."""
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
    space, rel = _MAIN.strip("{}"), _REL.strip("{}")
    package = "http://schemas.openxmlformats.org/package/2006"
    kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{package}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kind}.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{space}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{package}/relationships"><Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="rId2" Type="{rel}/styles" Target="styles.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet xmlns="{space}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="3"><xf numFmtId="0"/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>',
    }
    letters = [_letters(i) for i in range(len(schema))]
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, head + text)
        with book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True) as f:
            f.write(f'{head}<worksheet xmlns="{space}"><sheetData>'.encode())
            for i, row in enumerate(itertools.chain([schema.names], rows), 1):
                f.write((f'<row r="{i}">' + "".join(_cell(f"{c}{i}", v) for c, v in zip(letters, row, strict=True)) + "</row>").encode("utf-8", "replace"))
            f.write(b"</sheetData></worksheet>")


class SheetSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> StructType:
        found = _files(self.options["path"])
        if not found:
            raise ValueError(f"{self.options['path']} has no spreadsheets")
        with _at(self.options["path"])[0].open_input_file(found[0]) as f:
            book = _Book(f)
            wanted = self.options.get("sheet")
            first = next(book.rows(wanted if wanted not in (None, "*") else next(iter(book.sheets))), {})
        header = self.options.get("header", "true").lower() == "true"
        out = StructType()
        for i in range(max(first, default=-1) + 1):
            out.add((_said(first.get(i)) or "").strip() if header and first.get(i) is not None else f"column_{i + 1}", StringType())
        return out

    def reader(self, schema: StructType) -> DataSourceReader:
        return SheetReader(dict(self.options), schema)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return SheetWriter(dict(self.options), schema, overwrite)


def register(spark: SparkSession) -> None:
    """Make the format `sheets` known to a session."""
    spark.dataSource.register(SheetSource)
