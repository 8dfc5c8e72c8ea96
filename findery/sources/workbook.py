"""Workbooks (``.xlsx``) as a Spark data source: ``spark.read.format("workbook")``.

Reading makes one partition per file and streams the sheet, so a task holds one row and the shared
strings of its file. Writing makes one workbook per partition, and further ones when a sheet is full.
All cells are text. Files are reached through Arrow file systems, so paths may be local or remote.

Options: ``sheetName`` (default ``Sheet1``; a workbook without it is read from its first sheet) and
``header`` (default true).
"""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

# Fixed values of the file format.
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PACKAGE_REL = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_MAX_SHEET_ROWS = 1_048_576
_ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")
_TO_ESCAPE = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(WorkbookSource)


def _file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _workbooks(path: str) -> list[str]:
    from pyarrow import fs

    system, base = _file_system(path)
    info = system.get_file_info(base)
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(base))
    names = sorted(f.path for f in found if f.type == fs.FileType.File and not f.base_name.startswith((".", "_")))
    old = [n for n in names if n.lower().endswith(".xls")]
    if old:
        raise ValueError(f"binary workbooks are not supported, save them as .xlsx: {old[:5]}")
    return [n for n in names if n.lower().endswith(".xlsx")]


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def _column_letters(number: int) -> str:
    letters = ""
    number += 1
    while number:
        number, rest = divmod(number - 1, 26)
        letters = chr(65 + rest) + letters
    return letters


def _unescaped(text: str) -> str:
    return _ESCAPED.sub(lambda m: chr(int(m.group(1), 16)), text)


def _rich_text(element) -> str:
    """The text of a string item: its own, or that of its runs, without phonetic hints."""
    own = element.findall(f"{_MAIN}t") + element.findall(f"{_MAIN}r/{_MAIN}t")
    return _unescaped("".join(t.text or "" for t in own))


def _number(text: str) -> str:
    value = float(text)
    if value.is_integer() and abs(value) < 1e15:
        return str(int(value))
    return repr(value).replace("e", "E")


def _cell_text(cell, shared: list[str]) -> str | None:
    formula = cell.find(f"{_MAIN}f")
    if formula is not None and formula.text:
        return formula.text
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        item = cell.find(f"{_MAIN}is")
        return None if item is None else _rich_text(item)
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return shared[int(value.text)]
    if kind == "b":
        return "TRUE" if value.text.strip() == "1" else "FALSE"
    if kind == "n":
        return _number(value.text)
    return _unescaped(value.text)


def _sheet_part(book: zipfile.ZipFile, sheet_name: str | None) -> str:
    sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).findall(f"{_MAIN}sheets/{_MAIN}sheet")
    named = [s for s in sheets if sheet_name is not None and s.get("name", "").lower() == sheet_name.lower()]
    wanted = (named or sheets)[0].get(f"{_REL}id")
    relations = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = next(r.get("Target") for r in relations.findall(f"{_PACKAGE_REL}Relationship") if r.get("Id") == wanted)
    return target.lstrip("/") if target.startswith("/") else f"xl/{target}"


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if element.tag == f"{_MAIN}si":
                strings.append(_rich_text(element))
                element.clear()
    return strings


def _sheet_rows(book: zipfile.ZipFile, sheet_name: str | None) -> Iterator[dict[int, str]]:
    """The rows that have cells, as column number to text."""
    shared = _shared_strings(book)
    with book.open(_sheet_part(book, sheet_name)) as part:
        row: dict[int, str] = {}
        place = 0
        for event, element in ElementTree.iterparse(part, events=("start", "end")):
            if event == "start":
                if element.tag == f"{_MAIN}row":
                    row, place = {}, 0
            elif element.tag == f"{_MAIN}c":
                reference = element.get("r")
                place = _column_number(reference) if reference else place
                text = _cell_text(element, shared)
                if text is not None:
                    row[place] = text
                place += 1
                element.clear()
            elif element.tag == f"{_MAIN}row":
                if row:
                    yield row
                element.clear()


def _read_sheet(path: str, sheet_name: str | None, header: bool) -> Iterator[list[str | None]]:
    """First the column names, then the rows; nothing for an empty sheet."""
    system, _ = _file_system(path)
    try:
        with system.open_input_file(path) as raw, zipfile.ZipFile(raw) as book:
            width = None
            for row in _sheet_rows(book, sheet_name):
                if width is None:
                    width = max(row) + 1
                    if header:
                        yield [row.get(i, f"_c{i}") for i in range(width)]
                        continue
                    yield [f"_c{i}" for i in range(width)]
                yield [row.get(i) for i in range(width)]
    except (OSError, KeyError, ValueError, IndexError, zipfile.BadZipFile, ElementTree.ParseError) as problem:
        raise ValueError(f"cannot read workbook {path}: {problem}") from problem


@dataclass
class _File(InputPartition):
    path: str


class WorkbookSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "workbook"

    def _settings(self) -> tuple[str, str, bool]:
        path = self.options.get("path")
        if not path:
            raise ValueError("give the folder or file to load")
        header = str(self.options.get("header", "true")).lower() == "true"
        return path, self.options.get("sheetName", "Sheet1"), header

    def schema(self) -> StructType:
        """Text columns named by the first workbook that has rows."""
        path, sheet, header = self._settings()
        for file in _workbooks(path):
            rows = _read_sheet(file, sheet, header)
            names = next(rows, None)
            rows.close()
            if names is not None:
                if len({n.lower() for n in names}) != len(names):
                    raise ValueError(f"{file} repeats a column name: {names}")
                return StructType([StructField(n, StringType()) for n in names])
        raise ValueError(f"no workbook with rows in {path}")

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(*self._settings(), width=len(schema.fields))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(*self._settings(), names=schema.fieldNames(), overwrite=overwrite)


class _Reader(DataSourceReader):
    def __init__(self, path: str, sheet: str, header: bool, width: int):
        self.path, self.sheet, self.header, self.width = path, sheet, header, width

    def partitions(self) -> list[InputPartition]:
        return [_File(f) for f in _workbooks(self.path)]

    def read(self, partition: _File) -> Iterator[tuple]:
        rows = _read_sheet(partition.path, self.sheet, self.header)
        names = next(rows, None)
        if names is not None and len(names) != self.width:
            raise ValueError(f"{partition.path} has {len(names)} columns, the first workbook {self.width}")
        for row in rows:
            yield tuple(row)


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]
    rows: int


def _cell_xml(column: int, row: int, text: str) -> str:
    safe = escape(_TO_ESCAPE.sub(lambda m: f"_x{ord(m.group()):04X}_", text))
    return f'<c r="{_column_letters(column)}{row}" t="inlineStr"><is><t xml:space="preserve">{safe}</t></is></c>'


class _Sheet:
    """One workbook file that grows row by row."""

    def __init__(self, stream, sheet_name: str):
        self.rows = 0
        self.book = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
        types = "http://schemas.openxmlformats.org/package/2006/content-types"
        sheet_type = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = {
            "[Content_Types].xml": (
                f'<Types xmlns="{types}"><Default Extension="rels" '
                'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
                f'<Override PartName="/xl/workbook.xml" ContentType="{sheet_type}.sheet.main+xml"/>'
                f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{sheet_type}.worksheet+xml"/></Types>'
            ),
            "_rels/.rels": (
                f'<Relationships xmlns="{_PACKAGE_REL[1:-1]}"><Relationship Id="rId1" '
                f'Type="{_REL[1:-1]}/officeDocument" Target="xl/workbook.xml"/></Relationships>'
            ),
            "xl/workbook.xml": (
                f'<workbook xmlns="{_MAIN[1:-1]}" xmlns:r="{_REL[1:-1]}"><sheets>'
                f'<sheet name="{escape(sheet_name, {chr(34): "&quot;"})}" sheetId="1" r:id="rId1"/></sheets></workbook>'
            ),
            "xl/_rels/workbook.xml.rels": (
                f'<Relationships xmlns="{_PACKAGE_REL[1:-1]}"><Relationship Id="rId1" '
                f'Type="{_REL[1:-1]}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>'
            ),
        }
        for name, xml in parts.items():
            self.book.writestr(name, head + xml)
        self.sheet = self.book.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self.sheet.write(f'{head}<worksheet xmlns="{_MAIN[1:-1]}"><sheetData>'.encode())

    def add(self, values) -> None:
        self.rows += 1
        cells = "".join(_cell_xml(i, self.rows, "" if v is None else str(v)) for i, v in enumerate(values))
        self.sheet.write(f'<row r="{self.rows}">{cells}</row>'.encode())

    def close(self) -> None:
        self.sheet.write(b"</sheetData></worksheet>")
        self.sheet.close()
        self.book.close()


class _Writer(DataSourceWriter):
    """Tasks write into a hidden folder; the commit moves the finished files into place."""

    def __init__(self, path: str, sheet: str, header: bool, names: list[str], overwrite: bool):
        self.path, self.sheet, self.header, self.names, self.overwrite = path, sheet, header, names, overwrite
        self.attempt = f"_writing-{uuid.uuid4().hex}"

    def write(self, iterator) -> WriterCommitMessage:
        system, base = _file_system(self.path)
        system.create_dir(f"{base}/{self.attempt}", recursive=True)
        files, total, sheet, stream = [], 0, None, None

        def finish() -> None:
            if sheet is not None:
                sheet.close()
                stream.close()

        for row in iterator:
            if sheet is None or sheet.rows == _MAX_SHEET_ROWS:
                finish()
                files.append(f"{base}/{self.attempt}/part-{uuid.uuid4().hex}.xlsx")
                stream = system.open_output_stream(files[-1])
                sheet = _Sheet(stream, self.sheet)
                if self.header:
                    sheet.add(self.names)
            sheet.add(row)
            total += 1
        finish()
        return _Written(files, total)

    def commit(self, messages) -> None:
        system, base = _file_system(self.path)
        system.create_dir(base, recursive=True)
        if self.overwrite:
            for file in _workbooks(self.path):
                system.delete_file(file)
        for message in messages:
            for file in message.files if message is not None else []:
                system.move(file, f"{base}/{file.rsplit('/', 1)[1]}")
        self._drop_attempt(system, base)

    def abort(self, messages) -> None:
        system, base = _file_system(self.path)
        self._drop_attempt(system, base)

    def _drop_attempt(self, system, base: str) -> None:
        from pyarrow import fs

        if system.get_file_info(f"{base}/{self.attempt}").type == fs.FileType.Directory:
            system.delete_dir(f"{base}/{self.attempt}")
