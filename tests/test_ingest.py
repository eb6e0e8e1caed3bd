"""The ingestion queries' files and splits as the tables grow, and the work on a sheet."""

from __future__ import annotations

import datetime
import glob
import io
import sys
import zipfile
from xml.etree import ElementTree

import pytest

from cohortlens.plans import ingest
from cohortlens.sources import workbook
from cohortlens.sources.exports import SLICE, WorkbookWriter, write_text
from cohortlens.sources.tables import SPLIT_BITS, TableSource
from cohortlens.sources.workbook import Workbook
from cohortlens.spec import TPCH_STAGE_SEGMENTS

SEGMENTS = ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD", "FURNITURE")
BOOKS = 60


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two customers a book; each order keyed against the order of the books, some without a customer; the folder and the orders."""
    folder = str(tmp_path_factory.mktemp("tables"))
    customers = [(SLICE * b + k, SEGMENTS[(b + k) % 5]) for b in range(BOOKS) for k in (0, 1)]
    orders = [(5000 - n, c, datetime.datetime(2000 + n % 5, 1, 2)) for n, (c, _) in enumerate(customers * 3)]
    orders += [(n, None, datetime.datetime(2001, 1, 2)) for n in range(7)]
    spark.createDataFrame(customers, "c_custkey long, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    rows = [(o, c, d, "2-HIGH", "OFP"[o % 3]) for o, c, d in orders]
    schema = "o_orderkey long, o_custkey long, o_orderdate timestamp, o_orderpriority string, o_orderstatus string"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/orders.parquet")
    return folder, orders


def test_text_files_do_not_grow_in_number(spark, tables, tmp_path):
    folders = write_text(spark, tables[0], str(tmp_path / "text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for what, folder in folders.items():
        files = sorted(glob.glob(f"{folder}/**/*.txt", recursive=True))
        assert 1 < len(files) <= parts, what
        above = ["exported list"] if what == "unknown" else []
        for f in files:
            lines = open(f, encoding="utf-8").read().splitlines()
            assert lines[: len(above)] == above and lines[len(above)].startswith("HN,") and len(lines) > len(above) + 1
            assert not any(x.startswith("HN,") or x == "exported list" for x in lines[len(above) + 1 :])


def test_text_rows_in_order_of_books(spark, tables):
    folder, orders = tables
    got = sorted((r.place, r.hn, r.year) for r in ingest.q_text_events(spark, folder).collect())
    wanted = sorted(orders, key=lambda o: (o[1] is None, o[1] is not None and o[1] // SLICE, o[0]))
    assert got == [(n + 1, None if c is None else str(c), str(d.year)) for n, (_, c, d) in enumerate(wanted)]


def test_splits_grow_with_the_files(spark, tmp_path):
    lines = ["HN,v", *(f"{n},{'x' * 40}" for n in range(50_000))]
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "a.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    source = TableSource(str(tmp_path / "t"), {"hn": "HN"}, format="csv")
    rows = ingest._in_splits(spark, source, "text-split").selectExpr("hn", f"shiftright(row_idx, {SPLIT_BITS}) as split", "row_idx").collect()
    assert 1 < len({r.split for r in rows}) <= ingest.PIECES + 1
    assert [r.hn for r in sorted(rows, key=lambda r: r.row_idx)] == [str(n) for n in range(50_000)]


def test_workbook_sheets_are_parsed_once(spark, tables):
    """The branches of a build share one exchange an input, so each of the three sheets is parsed in one place."""
    summary = ingest.q_workbook_summary(spark, tables[0])
    everyone = next(r for r in summary.collect() if r.scope == "all")
    known = {c for _, c, _ in tables[1] if c is not None and SEGMENTS[(c // SLICE + c % SLICE) % 5] in TPCH_STAGE_SEGMENTS}
    assert (everyone.known_patients, everyone.treatment_events) == (len(known), 3 * len(known))
    plan = summary._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("MapInArrow") == 3


def test_sheet_work_per_cell():
    """Python calls for a cell of a sheet, whatever the number of its rows; rows done are dropped."""
    writer = WorkbookWriter()
    for n in range(3000):
        writer.row("s", n, [f"n{n}", f"i{n}", f"s{n % 7}", f"f{n}"])
    book, calls = Workbook(writer.content(), "b"), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = list(book.rows("s"))
    finally:
        sys.setprofile(None)
    assert got == [(n, {0: str(n), 1: str(n), 2: str(n % 7), 3: str(n)}) for n in range(3000)]
    assert calls < 30 * 4 * 3000


@pytest.mark.parametrize("chunk", [1, 7, 1 << 16])
def test_sheet_in_chunks(monkeypatch, chunk):
    """Rows that lie in several chunks are whole; what follows the rows is no row, and need not be sound."""
    monkeypatch.setattr(workbook, "CHUNK_BYTES", chunk)
    head = '<?xml version="1.0"?><w xmlns="u"><dims/><sheetData>'
    rows = '<row r="2"><c r="B2"><v>1</v></c><c><v>2</v></c></row><row/><row r="9"><c t="b"><v>1</v></c></row>'
    wanted = [(1, {1: "1", 2: "2"}), (2, {}), (8, {0: "True"})]
    tail = '</sheetData><a><row r="3"/></a>'
    for text, there in ((f"{head}{rows}{tail}</w>", wanted), (f"{head}{rows}{tail}<b></w>", wanted), (f"{head}</sheetData></w>", []), (f"{head[:-11]}</w>", [])):
        assert list(_book(text).rows("s")) == there
    assert list(_book(f"{head}{rows}{tail}</w>").rows("s", last=2)) == wanted[:2]
    with pytest.raises(ElementTree.ParseError):
        list(_book(f"{head}{rows}<row>{tail}</w>").rows("s"))


def _book(sheet: str) -> Workbook:
    writer, out = WorkbookWriter(), io.BytesIO()
    writer.row("s", 0, [])
    whole = zipfile.ZipFile(io.BytesIO(writer.content()))
    with zipfile.ZipFile(out, "w") as z:
        for part in whole.namelist():
            z.writestr(part, sheet if part == "xl/worksheets/sheet1.xml" else whole.read(part))
    return Workbook(out.getvalue(), "b")
