"""The test tables as the files a user has: workbooks, and text with a preamble.

Written by Spark: every ``SLICE`` customers and their orders make one book, which is
a workbook of its own, or one part of a text file of each table.
Values take the forms that cells come in (numbers, shared, inline and formula
strings, dates' neighbours, blanks, error values), chosen by key.
"""

from __future__ import annotations

import functools
import io
import itertools
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql import arr
from . import tpch
from .tables import OVERRIDE_CELL, SHEET_COLUMNS, SHEETS, UNKNOWN_HEADER_ROW
from ..spec import TPCH_UNKNOWN_SEGMENT

#: Customers of a book.
SLICE = 200
#: Rows that the preamble takes; data starts below it and the header.
PREAMBLE = "exported list"

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
_OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"


@functools.lru_cache(1024)
def _column(at: int) -> str:
    name = ""
    at += 1
    while at:
        at, rest = divmod(at - 1, 26)
        name = chr(65 + rest) + name
    return name


class WorkbookWriter:
    """One workbook in memory; a cell is its kind's letter and its text.

    Kinds: s shared string, i inline string, f formula string, n number, b
    boolean, e error, d number shown as a date; a null cell is left out.
    """

    def __init__(self) -> None:
        self.sheets: dict[str, list[str]] = {}
        self.strings: dict[str, int] = {}

    def row(self, sheet: str, number: int, cells: list[str | None]) -> None:
        out = [f'<row r="{number + 1}">']
        for at, cell in enumerate(cells):
            if cell is None:
                continue
            kind, text, ref = cell[0], cell[1:], f"{_column(at)}{number + 1}"
            if kind == "s":
                out.append(f'<c r="{ref}" t="s"><v>{self.strings.setdefault(text, len(self.strings))}</v></c>')
            elif kind == "i":
                out.append(f'<c r="{ref}" t="inlineStr"><is><r><t xml:space="preserve">{escape(text)}</t></r></is></c>')
            elif kind == "f":
                out.append(f'<c r="{ref}" t="str"><f>T("")</f><v>{escape(text)}</v></c>')
            else:
                mark = {"n": "", "b": ' t="b"', "e": ' t="e"', "d": ' s="1"'}[kind]
                out.append(f'<c r="{ref}"{mark}><v>{escape(text)}</v></c>')
        out.append("</row>")
        self.sheets.setdefault(sheet, []).append("".join(out))

    def content(self) -> bytes:
        names = list(self.sheets)
        parts = {
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="xml" ContentType="application/xml"/>'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/></Types>',
            "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_OFFICE}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "xl/workbook.xml": f'<workbook {_MAIN} xmlns:r="{_OFFICE}"><sheets>'
            + "".join(f'<sheet name="{escape(n)}" sheetId="{k + 1}" r:id="rId{k + 1}"/>' for k, n in enumerate(names))
            + "</sheets></workbook>",
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">'
            + "".join(f'<Relationship Id="rId{k + 1}" Type="{_OFFICE}/worksheet" Target="worksheets/sheet{k + 1}.xml"/>' for k in range(len(names)))
            + "</Relationships>",
            "xl/styles.xml": f'<styleSheet {_MAIN}><cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
            "xl/sharedStrings.xml": f"<sst {_MAIN}>" + "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in self.strings) + "</sst>",
        }
        for k, n in enumerate(names):
            parts[f"xl/worksheets/sheet{k + 1}.xml"] = f"<worksheet {_MAIN}><sheetData>{''.join(self.sheets[n])}</sheetData></worksheet>"
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for part, text in parts.items():
                z.writestr(zipfile.ZipInfo(part, (2000, 1, 1, 0, 0, 0)), _HEAD + text, zipfile.ZIP_DEFLATED)
        return out.getvalue()


# ---------------------------------------------------------------- cells of the test tables


def _forms(key: str, value: str, kinds: str) -> str:
    """SQL of a cell: the value after a letter that the key chooses; null stays a blank cell."""
    return f"concat(element_at({arr(kinds)}, cast({key} % {len(kinds)} as int) + 1), {value})"


def sheet_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """(book, pos, cells) of each sheet's data rows, in the clinical encoding, one book for ``SLICE`` customers."""
    ents, events = tpch.raw_entities(spark, sf_dir, "C"), tpch.raw_events(spark, sf_dir, "C")
    book = f"cast({{}} as bigint) div {SLICE}"
    patients = ents.selectExpr(
        f"{book.format('hn')} as book", "row_idx as pos",
        f"array({_forms('row_idx', 'hn', 'nsif')}, {_forms('row_idx div 3', 'year', 'nsif')}, {_forms('row_idx', 'stage', 'sif')}) as cells",
    )
    treatments = events.selectExpr(
        f"{book.format('hn')} as book", "row_idx as pos",
        f"array({_forms('row_idx', 'hn', 'nsif')}, {_forms('row_idx div 5', 'year', 'nif')}, {_forms('row_idx', 'stage', 'si')}, {_forms('row_idx div 2', 'treatment', 'sif')}) as cells",
    )
    unknown = ents.where(F.col("stage") == TPCH_UNKNOWN_SEGMENT).selectExpr(
        f"{book.format('hn')} as book", "row_idx as pos", f"array({_forms('row_idx', 'hn', 'ns')}, {_forms('row_idx', 'year', 'ns')}) as cells"
    )
    return {"entities": patients, "events": treatments, "unknown": unknown}


#: The override cell of a book, by its number: none, text, an error, a whole number, one with a fraction, text that holds one.
OVERRIDES = (None, "snot counted", "e#N/A", "n{}", "n{}.75", "s {} ")


def workbooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(path, content) of the workbooks; odd books lack the unknown sheet's year column."""
    tables = sheet_tables(spark, sf_dir)
    rows = None
    for place, (what, table) in enumerate(tables.items()):
        some = table.select("book", F.lit(place).alias("place"), "pos", "cells")
        rows = some if rows is None else rows.unionByName(some)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "book").sortWithinPartitions("book", "place", "pos")
    sheets = [SHEETS[what] for what in tables]
    headers = [[f"s{SHEET_COLUMNS[c]}" for c in names] for names in (["hn", "year", "stage"], ["hn", "year", "stage", "treatment"], ["hn", "year"])]

    def run(batches) -> Iterator[pa.RecordBatch]:
        writer, number, last = WorkbookWriter(), [0] * len(sheets), None

        def begin(book: int) -> None:
            row, column = OVERRIDE_CELL
            override = OVERRIDES[book % len(OVERRIDES)]
            writer.row(SHEETS["override"], 0, ["stotals"])
            writer.row(SHEETS["override"], row + 1, [None] * column + [override and override.format(book + 1)])
            writer.row(SHEETS["override"], row + 2, ["n1"])
            for k, header in enumerate(headers):
                above = UNKNOWN_HEADER_ROW if k == 2 else 0
                if above:
                    writer.row(sheets[k], 0, [f"s{PREAMBLE}"])
                writer.row(sheets[k], above, header[:1] if k == 2 and book % 2 else header)
                number[k] = above + 1

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"book-{last:09d}.xlsx"]), pa.array([writer.content()], pa.binary())], ["path", "content"])

        for batch in batches:
            lists = batch.column("cells")
            texts, ends = lists.flatten().to_pylist(), itertools.accumulate(lists.value_lengths().to_pylist(), initial=0)
            for book, place, (start, end) in zip(batch.column("book").to_pylist(), batch.column("place").to_pylist(), itertools.pairwise(ends)):
                cells = texts[start:end]
                if book != last:
                    if last is not None:
                        yield done()
                    writer, last = WorkbookWriter(), book
                    begin(book)
                writer.row(sheets[place], number[place], cells[:1] if place == 2 and book % 2 else cells)
                number[place] += 1
        if last is not None:
            yield done()

    return rows.mapInArrow(run, "path string, content binary")


# ---------------------------------------------------------------- text


def write_text(spark: SparkSession, sf_dir: str, folder: str) -> dict[str, str]:
    """Each table as text files of whole books, a preamble line (the unknown one) and a header in each; returns the folders.

    A task writes one file, of a range of books, so files grow with the tables and not in number; their
    names are in order of the books, those without a number last."""
    out = {}
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for what, table in sheet_tables(spark, sf_dir).items():
        names = list(SHEET_COLUMNS.values())[: {"entities": 3, "events": 4, "unknown": 2}[what]]
        quoted = F.transform("cells", lambda c: F.coalesce(F.concat(F.lit('"'), F.substring(c, 2, 1 << 20), F.lit('"')), F.lit("")))
        lines = table.select("book", "pos", F.array_join(quoted, ",").alias("value"))
        head = [PREAMBLE] * (UNKNOWN_HEADER_ROW if what == "unknown" else 0) + [",".join(names)]
        by_book = F.col("book").asc_nulls_last()
        lines = lines.repartitionByRange(parts, by_book).sortWithinPartitions(by_book, "pos")
        # the first line of a task, hence of its file, brings the head
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        lines = lines.select(F.when(first, F.concat_ws("\n", *[F.lit(h) for h in head], "value")).otherwise(F.col("value")).alias("value"))
        path = f"{folder}/{what}"
        lines.write.option("maxRecordsPerFile", 0).text(path)
        out[what] = path
    return out
