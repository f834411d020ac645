"""Workbooks (.xlsx) as a Spark data source: sheets as partitions, and one job that fills all sheets.

The reader makes one input partition per sheet and finds the headings below the
rows to skip. The writer's tasks leave their rows in files of their own beside
the target and report them; the commit puts the sheets together from these
files, row by row, and moves the finished workbook into place. A task that fails
leaves the target as it was, and nothing beside it.

A sheet has at most 1,048,576 rows, so what the commit reads has a bound too.
"""

from __future__ import annotations

import json
import re
import sys
import uuid
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from io import TextIOWrapper
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyarrow import fs
from pyspark import TaskContext
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

# Readers and writers run in Python workers, which need no copy of this package.
register_pickle_by_value(sys.modules[__name__])

# Fixed values of the file format.
MOST_ROWS, MOST_CHARACTERS, MOST_NAME = 1_048_576, 32_767, 31
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_SHEET_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"
_BOOK_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"

#: What a sheet reads as without a schema: physical row number, and text by heading.
ANY_SHEET = "sheet string, row int, cells map<string,string>"
_OWN = ("sheet", "row", "cells")


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path):
        return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))
    return fs.LocalFileSystem(), path


# --- reading ----------------------------------------------------------------------


def _text_of(item) -> str:
    """Text of a string item, its runs joined; readings given beside it left out."""
    found = [t.text or "" for t in item.findall(f"{{{_MAIN}}}t")]
    found += [t.text or "" for run in item.findall(f"{{{_MAIN}}}r") for t in run.findall(f"{{{_MAIN}}}t")]
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), "".join(found))


def _column(reference: str | None, following: int) -> int:
    letters = re.match("[A-Z]*", reference or "")[0]
    return reduce(lambda n, c: 26 * n + ord(c) - 64, letters, 0) - 1 if letters else following


class _Book:
    """An open workbook."""

    def __init__(self, file) -> None:
        self._zip = zipfile.ZipFile(file)
        relations = ElementTree.fromstring(self._zip.read("xl/_rels/workbook.xml.rels"))
        target = {r.get("Id"): r.get("Target") for r in relations}
        book = ElementTree.fromstring(self._zip.read("xl/workbook.xml"))
        members = {s.get("name"): target[s.get(f"{{{_OFFICE}}}id")] for s in book.iter(f"{{{_MAIN}}}sheet")}
        #: Sheet name to file inside the workbook, in the order of the sheets.
        self.sheets = {name: m[1:] if m.startswith("/") else f"xl/{m}" for name, m in members.items()}
        self._strings: list[str] | None = None

    def _shared(self, number: int) -> str:
        if self._strings is None:
            with self._zip.open("xl/sharedStrings.xml") as member:
                self._strings = [_text_of(e) for _, e in ElementTree.iterparse(member) if e.tag == f"{{{_MAIN}}}si"]
        return self._strings[number]

    def _value(self, cell) -> str | None:
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            item = cell.find(f"{{{_MAIN}}}is")
            return None if item is None else _text_of(item)
        value = cell.find(f"{{{_MAIN}}}v")
        if value is None or value.text is None or kind == "e":
            return None
        if kind == "s":
            return self._shared(int(value.text))
        return {"0": "FALSE", "1": "TRUE"}.get(value.text, value.text) if kind == "b" else value.text

    def rows(self, sheet: str) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number from 1, texts by column from 0) of every row that holds a text, one at a time."""
        if sheet not in self.sheets:
            raise ValueError(f"no sheet {sheet!r}; there are {list(self.sheets)}")
        number, above = 0, None
        with self._zip.open(self.sheets[sheet]) as member:
            for event, element in ElementTree.iterparse(member, ("start", "end")):
                if event == "start":
                    above = element if element.tag == f"{{{_MAIN}}}sheetData" else above
                elif element.tag == f"{{{_MAIN}}}row":
                    number = int(element.get("r", number + 1))
                    cells, place = {}, -1
                    for cell in element.findall(f"{{{_MAIN}}}c"):
                        place = _column(cell.get("r"), place + 1)
                        text = self._value(cell)
                        if text not in (None, ""):
                            cells[place] = text
                    if cells:
                        yield number, cells
                    above.clear()


@contextmanager
def _opened(path: str) -> Iterator[_Book]:
    files, inside = _file_system(path)
    with files.open_input_file(inside) as file:
        yield _Book(file)


@dataclass
class SheetPartition(InputPartition):
    sheet: str
    skip: int


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, path: str, skip: Mapping[str, int]) -> None:
        self.schema, self.path, self.skip = schema, path, dict(skip)

    def partitions(self) -> Sequence[InputPartition]:
        with _opened(self.path) as book:
            wanted = self.skip or dict.fromkeys(book.sheets, 0)
            if missing := [s for s in wanted if s not in book.sheets]:
                raise ValueError(f"no sheets {missing}; there are {list(book.sheets)}")
        return [SheetPartition(sheet, int(skip)) for sheet, skip in wanted.items()]

    def read(self, partition: SheetPartition) -> Iterator[tuple]:
        names = self.schema.fieldNames()
        headings: dict[int, str] | None = None
        with _opened(self.path) as book:
            for number, cells in book.rows(partition.sheet):
                if number <= partition.skip:
                    continue
                if headings is None:
                    headings = cells
                    if len(set(cells.values())) < len(cells):
                        raise ValueError(f"a heading of sheet {partition.sheet!r} occurs twice: {list(cells.values())}")
                    continue
                by_heading = {headings[c]: text for c, text in cells.items() if c in headings}
                own = {"sheet": partition.sheet, "row": number, "cells": by_heading}
                yield tuple(own[n] if n in _OWN else by_heading.get(n) for n in names)


# --- writing ----------------------------------------------------------------------


def _escaped(text: str) -> str:
    """Text of a cell: characters that the format can't hold by their number, and what looks like one."""
    if len(text) > MOST_CHARACTERS:
        raise ValueError(f"a cell holds at most {MOST_CHARACTERS} characters; this one has {len(text)}")
    marked = re.sub("_(?=x[0-9A-Fa-f]{4}_)", "_x005F_", text)
    return escape(re.sub("[\x00-\x08\x0b\x0c\x0d\x0e-\x1f\ufffe\uffff]", lambda m: f"_x{ord(m[0]):04X}_", marked))


def _letters(column: int) -> str:
    found = ""
    while column >= 0:
        column, digit = divmod(column, 26)
        found, column = chr(65 + digit) + found, column - 1
    return found


def _row(number: int, cells: Mapping[int, str | None]) -> str:
    if number > MOST_ROWS:
        raise ValueError(f"a sheet holds at most {MOST_ROWS} rows")
    texts = "".join(
        f'<c r="{_letters(c)}{number}" t="inlineStr"><is><t xml:space="preserve">{_escaped(text)}</t></is></c>'
        for c, text in sorted(cells.items())
        if text not in (None, "")
    )
    return f'<row r="{number}">{texts}</row>'


@dataclass
class _Written(WriterCommitMessage):
    """What a task left: its number, and (sheet, file) in the order of its rows."""

    part: int
    files: list[tuple[str, str]]


class _Writer(DataSourceWriter):
    def __init__(self, path: str, overwrite: bool, options: Mapping[str, str]) -> None:
        self.path, self.overwrite = path, overwrite
        #: First row of each sheet, the headings', and these; sheets stand in this order.
        self.start = {s: int(n) for s, n in json.loads(options.get("startrows", "{}")).items()}
        self.headings = json.loads(options.get("headings", "{}"))
        self.template = options.get("template")
        self.parts = f"{path.rstrip('/')}.parts-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        files, folder = _file_system(self.parts)
        files.create_dir(folder, recursive=True)
        context = TaskContext.get()
        part, attempt = (context.partitionId(), context.taskAttemptId()) if context else (0, uuid.uuid4().hex)
        written: list[tuple[str, str]] = []
        current, out = None, None
        try:
            for row in iterator:
                if row["sheet"] not in self.headings:
                    raise ValueError(f"no headings for sheet {row['sheet']!r}")
                if row["sheet"] != current:
                    if out:
                        out.close()
                    current = row["sheet"]
                    written.append((current, f"{folder}/{part}-{attempt}-{len(written)}"))
                    out = TextIOWrapper(files.open_output_stream(written[-1][1]), "utf-8")
                out.write(json.dumps(list(row["cells"])) + "\n")
        finally:
            if out:
                out.close()
        return _Written(part, written)

    def commit(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        try:
            files, target = _file_system(self.path)
            if not self.overwrite and files.get_file_info(target).type != fs.FileType.NotFound:
                raise FileExistsError(f"{self.path} is there already")
            parts = [entry for m in sorted((m for m in messages if m), key=lambda m: m.part) for entry in m.files]
            folder = _file_system(self.parts)[1]
            files.create_dir(folder, recursive=True)
            # The whole workbook is made aside and then moved, so no one sees half of it.
            with files.open_output_stream(f"{folder}/workbook") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
                if self.template:
                    with _opened(self.template) as template:
                        self._fill(book, parts, files, template)
                else:
                    self._fill(book, parts, files, None)
            files.move(f"{folder}/workbook", target)
        finally:
            self._clear()

    def abort(self, messages: Sequence[WriterCommitMessage | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        files, folder = _file_system(self.parts)
        if files.get_file_info(folder).type != fs.FileType.NotFound:
            files.delete_dir(folder)

    def _fill(self, book: zipfile.ZipFile, parts: list[tuple[str, str]], files: fs.FileSystem, template: _Book | None) -> None:
        kept = list(template.sheets) if template else []
        sheets = [*kept, *[s for s in self.headings if s not in kept]]
        for sheet in sheets:
            if not 0 < len(sheet) <= MOST_NAME or re.search(r"[\[\]:*?/\\]", sheet):
                raise ValueError(f"not a name for a sheet: {sheet!r}")
        for number, sheet in enumerate(sheets, 1):
            with book.open(f"xl/worksheets/sheet{number}.xml", "w") as member:
                put = lambda text: member.write(text.encode())  # noqa: B023, E731
                put(f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>')
                start = self.start.get(sheet, 1) if sheet in self.headings else MOST_ROWS + 1
                for at, cells in template.rows(sheet) if sheet in kept else ():
                    if at < start:
                        put(_row(at, cells))
                if sheet in self.headings:
                    put(_row(start, dict(enumerate(self.headings[sheet]))))
                    at = start
                    for own, path in parts:
                        if own == sheet:
                            with TextIOWrapper(files.open_input_stream(path), "utf-8") as lines:
                                for line in lines:
                                    at += 1
                                    put(_row(at, dict(enumerate(json.loads(line)))))
                put("</sheetData></worksheet>")
        names = {n: f'name="{escape(s, {chr(34): "&quot;"})}"' for n, s in enumerate(sheets, 1)}
        listed = "".join(f'<sheet {name} sheetId="{n}" r:id="rId{n}"/>' for n, name in names.items())
        book.writestr("xl/workbook.xml", f'{_XML}<workbook xmlns="{_MAIN}" xmlns:r="{_OFFICE}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{n}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in names)
        relations = f'{_XML}<Relationships xmlns="{_PACKAGE}/relationships">'
        book.writestr("xl/_rels/workbook.xml.rels", f"{relations}{links}</Relationships>")
        root = f'<Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/>'
        book.writestr("_rels/.rels", f"{relations}{root}</Relationships>")
        kinds = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{_SHEET_TYPE}"/>' for n in names)
        book.writestr(
            "[Content_Types].xml",
            f'{_XML}<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.'
            'openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{_BOOK_TYPE}"/>{kinds}</Types>',
        )


# --- the data source --------------------------------------------------------------


class WorkbookSource(DataSource):
    """``workbook``: options ``path``, and for reading ``skip`` (JSON: rows to skip by sheet; default all sheets, none).

    A schema picks columns by heading, beside ``sheet`` and ``row``; without one
    a row is ``ANY_SHEET``. For writing, rows are (sheet, cells), sheet by sheet;
    ``headings`` (JSON: texts by sheet), ``startRows`` (JSON: the headings' row by
    sheet, default 1) and ``template``, a workbook whose other sheets, and rows
    above the headings, are taken over as text.
    """

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return ANY_SHEET

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(schema, self.options["path"], json.loads(self.options.get("skip", "{}")))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], overwrite, {k.lower(): v for k, v in self.options.items()})


def read_sheets(spark: SparkSession, path: str, skip: Mapping[str, int] | None = None, schema: str = ANY_SHEET) -> DataFrame:
    """Sheets of a workbook, one input partition each.

    The first row below the skipped ones that holds a text gives the headings.
    Columns without a heading and rows without a text are left out; a heading that
    occurs twice, or a sheet that isn't there, is an error. Every cell is text as
    stored; blank and faulty cells are missing.
    """
    spark.dataSource.register(WorkbookSource)
    return spark.read.format("workbook").schema(schema).option("skip", json.dumps(dict(skip or {}))).load(path)


def sheet_headings(path: str, skip: Mapping[str, int]) -> dict[str, list[str]]:
    """Headings of each sheet in their order, as ``read_sheets`` finds them."""
    found = {}
    with _opened(path) as book:
        for sheet, rows in skip.items():
            cells = next((c for n, c in book.rows(sheet) if n > rows), {})
            found[sheet] = [cells[c] for c in sorted(cells)]
    return found


def write_sheets(
    sheets: Mapping[str, DataFrame],
    path: str,
    *,
    start_rows: Mapping[str, int] | None = None,
    headings: Mapping[str, Mapping[str, str]] | None = None,
    template: str | None = None,
    order: str | None = None,
) -> None:
    """All sheets of a workbook by one job; an existing file is replaced when the new one is whole.

    ``headings`` renames columns by sheet. Rows are put in order by ``order``, a
    column that isn't written, and by their cells; tasks sort and write ranges of
    them, so no sheet passes through one task.
    """
    columns = {s: [c for c in df.columns if c != order] for s, df in sheets.items()}
    names = {s: [(headings or {}).get(s, {}).get(c, c) for c in columns[s]] for s in sheets}
    place = lambda df: F.col(order).cast("long") if order in df.columns else F.lit(None).cast("long")
    rows = [
        df.select(F.lit(s).alias("sheet"), place(df).alias("at"), F.array(*[F.col(f"`{c}`").cast("string") for c in columns[s]]).alias("cells"))
        for s, df in sheets.items()
    ]
    spark = rows[0].sparkSession
    spark.dataSource.register(WorkbookSource)
    key = ["sheet", "at", "cells"]
    writer = reduce(DataFrame.unionAll, rows).repartitionByRange(*key).sortWithinPartitions(*key).select("sheet", "cells").write
    writer = writer.format("workbook").mode("overwrite").option("headings", json.dumps(names))
    if template:
        writer = writer.option("template", template)
    writer.option("startRows", json.dumps(dict(start_rows or {}))).save(path)
