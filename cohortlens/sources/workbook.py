"""Workbooks (.xlsx) as sources of sheets and of single cells.

A workbook is a zip of XML parts. Files come as rows (path, content): from any
store that Spark reads by its ``binaryFile`` source, or from a Parquet table of
such rows. A task takes a workbook at a time, reads the shared strings and then
streams the rows of one sheet, so it holds one file's bytes, its strings and one
batch of rows; different workbooks, and different sheets of one, are read by
different tasks.

Cells become text as a spreadsheet reader prints them: a whole number without
fraction digits, other numbers in their shortest form, ``True`` / ``False``, dates
and times by the cell's number format. Empty cells and error values are null.
Numbers keep their own text cell by cell: an id column with a gap does not turn
7 into 7.0.

The header is the row ``header_row`` rows below the first; rows and columns are
counted by the sheet's own numbers, so gaps count. A column that a workbook lacks
is null in its rows (S5); of columns with one name the first counts. A workbook
without the sheet makes the read fail.
"""

from __future__ import annotations

import datetime
import functools
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows that a task hands on at a time.
BATCH_ROWS = 8192
#: Bytes of a sheet that a task parses at a time.
CHUNK_BYTES = 1 << 16

# Numbers of the built-in formats that show dates or times.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])

_RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


@functools.lru_cache(1024)
def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


@functools.lru_cache(20_000)
def column_index(reference: str) -> int:
    """0-based column of a cell reference such as ``H6``."""
    n = 0
    for c in reference:
        if not "A" <= c <= "Z":
            break
        n = n * 26 + ord(c) - 64
    return n - 1


def is_date_format(code: str) -> bool:
    """Does a format code show a date or time, outside quoted text, escapes and brackets?"""
    bare = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]|_.|\*.', "", code.split(";")[0])
    return bool(re.search(r"[ymdhsYMDHS]", bare)) and "General" not in bare


def date_text(value: float, from_1904: bool) -> str:
    """A serial number as the text of its date, or of its time of day below one."""
    seconds = round(value * 86_400_000) / 1000
    if 0 <= value < 1:
        return (datetime.datetime.min + datetime.timedelta(seconds=seconds)).time().isoformat()
    if not from_1904 and value < 60:
        seconds += 86_400  # the first sixty days count from a leap day that was none
    start = datetime.datetime(1904, 1, 1) if from_1904 else datetime.datetime(1899, 12, 30)
    return str(start + datetime.timedelta(seconds=seconds))


def number_text(text: str) -> str:
    if text.isascii() and text.isdigit() and len(text) < 300:
        return str(int(text))
    value = float(text)
    if value == int(value) if abs(value) < 1e300 else False:
        return str(int(text)) if re.fullmatch(r"[+-]?[0-9]+", text) else str(int(value))
    return repr(value)


class Workbook:
    """One workbook's parts."""

    def __init__(self, content: bytes, name: str):
        self.zip, self.name = zipfile.ZipFile(io.BytesIO(content)), name
        self.from_1904 = False
        self.sheets = self._sheets()

    def _parsed(self, part: str) -> ElementTree.Element:
        with self.zip.open(part) as f:
            return ElementTree.parse(f).getroot()

    def _has(self, part: str) -> bool:
        return part in self.zip.NameToInfo

    def _sheets(self) -> dict[str, str]:
        """Part of each sheet, in the workbook's order."""
        targets = {r.get("Id"): r.get("Target") for r in self._parsed("xl/_rels/workbook.xml.rels")}
        out = {}
        for e in self._parsed("xl/workbook.xml").iter():
            if _local(e.tag) == "workbookPr":
                self.from_1904 = e.get("date1904") in ("1", "true")
            elif _local(e.tag) == "sheet":
                target = targets[e.get(_RELATION)]
                out[e.get("name")] = target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
        return out

    def strings(self) -> list[str]:
        """The shared strings; text of phonetic guides is left out."""
        out: list[str] = []
        if self._has("xl/sharedStrings.xml"):
            with self.zip.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if _local(e.tag) == "si":
                        out.append(_rich_text(e))
                        e.clear()
        return out

    def date_styles(self) -> set[int]:
        """Cell styles whose number format shows a date or time."""
        if not self._has("xl/styles.xml"):
            return set()
        root = self._parsed("xl/styles.xml")
        custom = {int(e.get("numFmtId")): is_date_format(e.get("formatCode", "")) for e in root.iter() if _local(e.tag) == "numFmt"}
        for e in root:
            if _local(e.tag) == "cellXfs":
                kinds = [int(x.get("numFmtId", "0")) for x in e]
                return {k for k, n in enumerate(kinds) if custom.get(n, n in DATE_FORMATS)}
        return set()

    def rows(self, sheet: str | int, last: int | None = None) -> Iterator[tuple[int, dict[int, str]]]:
        """(row number from 0, text of its cells by column) of a sheet, up to row ``last``."""
        names = list(self.sheets)
        if isinstance(sheet, int) and sheet < len(names):
            sheet = names[sheet]
        if sheet not in self.sheets:
            raise ValueError(f"{self.name} has no sheet {sheet!r}; it has {names}")
        strings, dates = self.strings(), self.date_styles()
        with self.zip.open(self.sheets[sheet]) as f:
            number = -1
            for e in _sheet_data(f, whole=last is None):
                if _local(e.tag) == "row":
                    number = int(e.get("r")) - 1 if e.get("r") else number + 1
                    if last is not None and number > last:
                        return
                    yield number, self._cells(e, strings, dates)

    def _cells(self, row: ElementTree.Element, strings: list[str], dates: set[int]) -> dict[int, str]:
        out, at = {}, -1
        for c in row:
            if _local(c.tag) != "c":
                continue
            place = c.get("r")
            at = column_index(place.rstrip("0123456789")) if place else at + 1
            text = self._text(c, strings, dates)
            if text is not None:
                out[at] = text
        return out

    def _text(self, c: ElementTree.Element, strings: list[str], dates: set[int]) -> str | None:
        kind = c.get("t", "n")
        if kind == "inlineStr":
            return next((_rich_text(e) for e in c if _local(e.tag) == "is"), None)
        value = None
        for e in c:
            if _local(e.tag) == "v":
                value = e.text
                break
        if value is None or kind == "e":
            return None
        if kind == "s":
            return strings[int(value)]
        if kind == "b":
            return "True" if value.strip() in ("1", "true") else "False"
        if kind == "str":
            return value
        if kind == "d":
            return str(datetime.datetime.fromisoformat(value))
        if int(c.get("s", "0")) in dates:
            return date_text(float(value), self.from_1904)
        return number_text(value)


def _sheet_data(f, whole: bool) -> Iterator[ElementTree.Element]:
    """Children of a sheet's ``sheetData``, handed on and dropped as they are complete; what comes after it is not read.

    Unless the whole sheet is wanted a child is handed on at its end, not when the next one begins, at some cost."""
    parser = ElementTree.XMLPullParser(("start",) if whole else ("start", "end"))
    root, data, closed, done = None, None, None, False
    while not done:
        chunk, wrong = f.read(CHUNK_BYTES), None
        try:
            parser.feed(chunk) if chunk else parser.close()
            for event, e in parser.read_events():
                root = e if root is None else root
                if event == "end":
                    closed = e
                elif data is None and _local(e.tag) == "sheetData":
                    data = e
        except ElementTree.ParseError as error:
            wrong = error
        if data is not None:
            done = any(e is data for e in root[:-1])
            complete = data[:] if done or not chunk or (len(data) and data[-1] is closed) else data[:-1]
            del data[: len(complete)]
            yield from complete
        if wrong is not None and not done:
            raise wrong
        done = done or not chunk


def _rich_text(e: ElementTree.Element) -> str:
    """Text of a string item: of its own and of its runs."""
    parts = []
    for x in e:
        if _local(x.tag) == "t":
            parts.append(x.text or "")
        elif _local(x.tag) == "r":
            parts += [t.text or "" for t in x if _local(t.tag) == "t"]
    return "".join(parts)


# ---------------------------------------------------------------- tables


def workbook_files(spark: SparkSession, paths: Sequence[str], stored_as: str | None = None) -> DataFrame:
    """(path, content) of workbooks: files, or rows of a ``stored_as`` (Parquet) table that has these columns."""
    reader = spark.read.format(stored_as or "binaryFile")
    return reader.load(list(paths)).select("path", "content")


def sheet_rows(files: DataFrame, sheet: str | int, names: Sequence[str], header_row: int = 0) -> DataFrame:
    """Columns ``c0``, ``c1``, ... (text of the named columns), ``_file`` and ``_pos`` (row of the sheet) of every data row."""
    wanted = list(names)

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                path = batch.column("path")[k].as_py()
                yield from _batches(path, Workbook(batch.column("content")[k].as_py(), path))

    def _batches(path: str, book: Workbook) -> Iterator[pa.RecordBatch]:
        places: list[int | None] | None = None
        held: list[tuple[int, dict[int, str]]] = []

        def batch() -> pa.RecordBatch:
            columns = [pa.array([cells.get(at) for _, cells in held], pa.string()) for at in places]
            rows = pa.array([number for number, _ in held], pa.int64())
            return pa.RecordBatch.from_arrays([*columns, pa.array([path] * len(held), pa.string()), rows], fields)

        for number, cells in book.rows(sheet):
            if number < header_row:
                continue
            if number == header_row:
                by_name = {text: at for at, text in sorted(cells.items(), reverse=True)}  # the first of a name
                places = [by_name.get(name) for name in wanted]
            elif cells:
                if places is None:
                    places = [None] * len(wanted)
                held.append((number, cells))
                if len(held) == BATCH_ROWS:
                    yield batch()
                    held = []
        if held:
            yield batch()

    fields = [*[f"c{i}" for i in range(len(wanted))], "_file", "_pos"]
    schema = ", ".join([*[f"c{i} string" for i in range(len(wanted))], "_file string", "_pos bigint"])
    return files.mapInArrow(run, schema)


def sheet_cells(files: DataFrame, sheet: str | int, row: int, col: int, header_row: int = 0) -> DataFrame:
    """(path, text) of one cell of every workbook: ``row`` data rows below the header, 0-based column; no later row is read."""
    at = header_row + 1 + row

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            found = []
            for path, content in zip(paths, batch.column("content")):
                cells = {number: cells for number, cells in Workbook(content.as_py(), path).rows(sheet, last=at) if number == at}
                found.append(cells.get(at, {}).get(col))
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string()), pa.array(found, pa.string())], ["path", "text"])

    return files.mapInArrow(run, "path string, text string")


def override_sql(text: str, null_tokens: Sequence[str] = ()) -> str:
    """A cell's text as an integer (towards zero) when it holds a finite number within 64 bits, else null."""
    tokens = ", ".join("'" + t.replace("'", "\\'") + "'" for t in null_tokens) or "NULL"
    number = f"try_cast(trim({text}) AS DOUBLE)"
    plain = rf"trim({text}) RLIKE '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$'"
    return f"CASE WHEN {text} IN ({tokens}) THEN NULL WHEN {plain} AND abs({number}) < 9.2e18D THEN CAST({number} AS BIGINT) END"
