"""Named queries of the ingestion path (S1-S5): the test tables as files, read back by the readers.

Spark writes the tables as workbooks or as text under the shared folder; the
queries read them by ``read_source`` / ``read_cell`` / ``read_inputs``, so their
rows, their order and the builds on them can be held against the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql import E
from ..model import CohortInputs
from ..session import shared_folder
from ..sources.exports import workbooks, write_text
from ..sources.tables import (
    FILE_BITS,
    OVERRIDE_CELL,
    PANDAS_NA_TOKENS,
    SHEET_COLUMNS,
    SHEETS,
    SPLIT_BITS,
    UNKNOWN_HEADER_ROW,
    TableSource,
    read_inputs,
    read_source,
    workbook_sources,
)
from ..sources.workbook import override_sql, sheet_cells, workbook_files
from ..spec import clinical_spec
from .cohort import CohortBuild

#: Size of the pieces that text files are read in here, so that a file spans several: the least, and the most.
SPLIT_BYTES, MOST_SPLIT_BYTES = 16 << 10, 8 << 20
#: Pieces of the longest file, where both sizes allow.
PIECES = 4


def _books(spark: SparkSession, sf: str) -> str:
    """The tables as workbooks, written once; the folder of their (path, content) rows."""
    path = shared_folder(spark, "workbooks")
    workbooks(spark, sf).write.parquet(path)
    return path


def workbook_inputs(spark: SparkSession, sf: str) -> CohortInputs:
    sources = workbook_sources(_books(spark, sf), container="parquet")
    sources.pop("override")  # a cell of every book; see q_workbook_override
    return read_inputs(spark, **sources)


def _sheet(spark: SparkSession, sf: str, what: str, columns: list[str]) -> DataFrame:
    """Raw rows of one sheet of all workbooks, with the rank of the book and the row of the sheet."""
    src = workbook_sources(_books(spark, sf), container="parquet")[what]
    rows = read_source(spark, src, columns)
    return rows.select(*columns, E(f"shiftright(row_idx, {FILE_BITS})", "book_rank"), E(f"row_idx & {(1 << FILE_BITS) - 1}", "sheet_row"))


def q_workbook_entities(spark, sf):
    return _sheet(spark, sf, "entities", ["hn", "year", "stage"])


def q_workbook_events(spark, sf):
    return _sheet(spark, sf, "events", ["hn", "year", "stage", "treatment"])


def q_workbook_unknown(spark, sf):
    """A preamble row above the header; every other book has no year column."""
    return _sheet(spark, sf, "unknown", ["hn", "year"])


def q_workbook_override(spark, sf):
    """The override cell of every workbook, as text and as the number that counts."""
    cells = sheet_cells(workbook_files(spark, [_books(spark, sf)], "parquet"), SHEETS["override"], *OVERRIDE_CELL)
    return cells.select(F.col("path").alias("book"), F.col("text").alias("cell"), E(override_sql("text", PANDAS_NA_TOKENS), "override"))


def q_workbook_summary(spark, sf):
    return CohortBuild(workbook_inputs(spark, sf), clinical_spec()).summary


def q_workbook_regimen_topk(spark, sf):
    """Ties go to the event read first: by workbook, then by row of the sheet."""
    return CohortBuild(workbook_inputs(spark, sf), clinical_spec()).regimens


# -- text in many splits --------------------------------------------------------------
def _text_sources(spark: SparkSession, sf: str) -> dict[str, TableSource]:
    folders = write_text(spark, sf, shared_folder(spark, "text"))

    def table(what: str, columns: list[str], header_row: int = 0) -> TableSource:
        return TableSource(folders[what], {c: SHEET_COLUMNS[c] for c in columns}, format="csv", header_row=header_row, null_tokens=PANDAS_NA_TOKENS)

    return {
        "entities": table("entities", ["hn", "year", "stage"]),
        "events": table("events", ["hn", "year", "stage", "treatment"]),
        "unknown": table("unknown", ["hn", "year"], UNKNOWN_HEADER_ROW),
    }


def _split_bytes(spark: SparkSession, folder: str) -> int:
    """Size of the pieces of a folder's files, from their listing: as the files grow so do the pieces, not only their number."""
    longest = spark.read.format("binaryFile").load(folder).agg(F.max("length")).first()[0]
    return min(max((longest or 0) // PIECES, SPLIT_BYTES), MOST_SPLIT_BYTES)


def _in_splits(spark: SparkSession, source: TableSource, name: str) -> DataFrame:
    """The source's rows read now, its files in several splits each, and written once."""
    key = "spark.sql.files.maxPartitionBytes"
    rows, before = read_source(spark, source, list(source.columns)), spark.conf.get(key)
    path = shared_folder(spark, name)
    spark.conf.set(key, _split_bytes(spark, source.path))
    try:
        rows.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.parquet(path)


def _text(spark: SparkSession, sf: str, what: str, columns: list[str]) -> DataFrame:
    return _in_splits(spark, _text_sources(spark, sf)[what], f"text-{what}").select(*columns, "row_idx")


def _with_place(rows: DataFrame, *columns: str) -> DataFrame:
    """The row's place among all, by its order key: split ranks and positions differ with the split size, their order does not."""
    ranked = rows.select(*columns, E(f"shiftright(row_idx, {SPLIT_BITS})", "split"), "row_idx")
    # rows of earlier splits, one row a split; then the place inside the split
    sizes = ranked.groupBy("split").agg(F.count("*").alias("n"))
    before = sizes.selectExpr("split", "sum(n) over (order by split) - n as before")
    inside = ranked.selectExpr(*columns, "split", "row_number() over (partition by split order by row_idx) as nth")
    return inside.join(before, "split").select(*columns, (F.col("before") + F.col("nth")).alias("place"))


def q_text_entities(spark, sf):
    return _with_place(_text(spark, sf, "entities", ["hn", "year", "stage"]), "hn", "year", "stage")


def q_text_events(spark, sf):
    return _with_place(_text(spark, sf, "events", ["hn", "year", "stage", "treatment"]), "hn", "year", "stage", "treatment")


def q_text_unknown(spark, sf):
    """S3: the preamble line and the header are no rows, in any split."""
    return _with_place(_text(spark, sf, "unknown", ["hn", "year"]), "hn", "year")


def q_text_regimen_topk(spark, sf):
    sources = _text_sources(spark, sf)
    rows = {k: _in_splits(spark, s, f"text-{k}") for k, s in sources.items()}
    return CohortBuild(CohortInputs(rows["entities"], rows["events"], rows["unknown"].drop("row_idx")), clinical_spec()).regimens


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "workbook_entities": q_workbook_entities,
    "workbook_events": q_workbook_events,
    "workbook_unknown": q_workbook_unknown,
    "workbook_override": q_workbook_override,
    "workbook_summary": q_workbook_summary,
    "workbook_regimen_topk": q_workbook_regimen_topk,
    "text_entities": q_text_entities,
    "text_events": q_text_events,
    "text_unknown": q_text_unknown,
    "text_regimen_topk": q_text_regimen_topk,
}
