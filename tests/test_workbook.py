"""Workbooks: cell forms, gaps, headers, point cells, folders of files, and the build from one."""

from __future__ import annotations

import argparse
import io
import zipfile

import pytest
from py_oracle import build as py_build
from test_semantics import spark_outputs, trap_tables

from cohortlens import CohortBuild, clinical_spec
from cohortlens.sources import workbook as wb
from cohortlens.sources.exports import WorkbookWriter
from cohortlens.sources.tables import PANDAS_NA_TOKENS, SHEET_COLUMNS, TableSource, read_cell, read_inputs, read_source, workbook_sources

MAIN = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def save(path, rows_of: dict[str, list[list[str | None]]]) -> str:
    """A workbook of sheets whose rows are lists of cells (kind letter and text)."""
    w = WorkbookWriter()
    for sheet, rows in rows_of.items():
        for number, cells in enumerate(rows):
            w.row(sheet, number, cells)
    path.write_bytes(w.content())
    return str(path)


def by_hand(sheet: str, strings: str = "", styles: str = "", workbook: str = "", target: str = "worksheets/sheet1.xml", part: str = "xl/worksheets/sheet1.xml") -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {MAIN} xmlns:r="{OFFICE}">{workbook}<sheets><sheet name="S" sheetId="1" r:id="rId7"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="x"><Relationship Id="rId7" Type="t" Target="{target}"/></Relationships>')
        z.writestr(part, f"<worksheet {MAIN}><dimension ref='A1'/><sheetData>{sheet}</sheetData><mergeCells/></worksheet>")
        if strings:
            z.writestr("xl/sharedStrings.xml", f"<sst {MAIN}>{strings}</sst>")
        if styles:
            z.writestr("xl/styles.xml", f"<styleSheet {MAIN}>{styles}</styleSheet>")
    return out.getvalue()


def rows(content: bytes) -> list:
    return list(wb.Workbook(content, "x.xlsx").rows(0))


def test_strings_with_runs_guides_and_space():
    strings = '<si><t xml:space="preserve"> a &amp; b </t></si><si><r><t>one</t></r><r><rPr/><t>two</t></r><rPh><t>guide</t></rPh></si><si/>'
    sheet = '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c><c r="C1" t="s"><v>2</v></c><c r="D1" t="inlineStr"><is><t>in</t></is></c><c r="E1" t="str"><f>A1</f><v>of formula</v></c></row>'
    assert rows(by_hand(sheet, strings)) == [(0, {0: " a & b ", 1: "onetwo", 2: "", 3: "in", 4: "of formula"})]


def test_numbers_booleans_errors_and_blanks():
    cells = ["<c><v>7</v></c>", "<c><v>7.0</v></c>", "<c><v>0.1</v></c>", "<c><v>1E3</v></c>", "<c><v>12345678901234567</v></c>", "<c t='b'><v>1</v></c>", "<c t='e'><v>#N/A</v></c>", "<c/>", "<c t='n'><v>-2.50</v></c>"]
    assert rows(by_hand(f"<row>{''.join(cells)}</row>")) == [(0, {0: "7", 1: "7", 2: "0.1", 3: "1000", 4: "12345678901234567", 5: "True", 8: "-2.5"})]


def test_dates_by_format():
    styles = '<numFmts><numFmt numFmtId="164" formatCode="0.00&quot;d&quot;"/><numFmt numFmtId="165" formatCode="[h]:mm;@"/><numFmt numFmtId="166" formatCode="yyyy\\-mm"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs>'
    styles += '<cellXfs>' + "".join(f'<xf numFmtId="{n}"/>' for n in (0, 14, 164, 165, 166)) + "</cellXfs>"
    cells = "".join(f'<c s="{s}"><v>{v}</v></c>' for s, v in ((0, 44197), (1, 44197), (2, 1.5), (3, 0.25), (4, 44197.5), (1, 59), (1, 61)))
    expected = {0: "44197", 1: "2021-01-01 00:00:00", 2: "1.5", 3: "06:00:00", 4: "2021-01-01 12:00:00", 5: "1900-02-28 00:00:00", 6: "1900-03-01 00:00:00"}
    assert rows(by_hand(f"<row>{cells}</row>", styles=styles)) == [(0, expected)]
    later = rows(by_hand('<row><c s="1"><v>1</v></c></row>', styles=styles, workbook='<workbookPr date1904="1"/>'))
    assert later == [(0, {0: "1904-01-02 00:00:00"})]


def test_gaps_and_absolute_targets():
    sheet = '<row r="2"><c r="B2"><v>1</v></c></row><row r="5"><c r="AB5"><v>2</v></c></row><row><c><v>3</v></c></row>'
    content = by_hand(sheet, target="/data/one.xml", part="data/one.xml")
    assert rows(content) == [(1, {1: "1"}), (4, {27: "2"}), (5, {0: "3"})]
    assert list(wb.Workbook(content, "x").rows("S", last=1)) == [(1, {1: "1"})]
    with pytest.raises(ValueError, match="no sheet 'T'"):
        list(wb.Workbook(content, "x").rows("T"))


def test_point_cell_reads_no_later_row(spark, tmp_path):
    """What stands after the row is never parsed: here it is no XML at all."""
    content = by_hand('<row r="1"><c><v>0</v></c></row><row r="6"><c r="H6"><v>119.0</v></c></row><row r="7"><c r="A7"><v>1</v></c></row>')
    broken = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(content)) as old, zipfile.ZipFile(broken, "w") as new:
        for n in old.namelist():
            data = old.read(n)
            new.writestr(n, data.replace(b"</sheetData>", b" " * 200_000 + b"<oops </sheetData>") if "sheet1" in n else data)
    (tmp_path / "b.xlsx").write_bytes(broken.getvalue())
    src = TableSource(str(tmp_path / "b.xlsx"), {}, format="xlsx", sheet="S")
    assert read_cell(spark, src, 4, 7) == 119
    assert read_cell(spark, src, 3, 7) is None


@pytest.mark.parametrize("cell,value", [(None, None), ("s", None), ("sno", None), ("e#N/A", None), ("sN/A", None), ("n119", 119), ("n119.9", 119), ("n-3.2", -3), ("s 12 ", 12), ("f7", 7), ("n1e300", None), ("snan", None)])
def test_override_cells(spark, tmp_path, cell, value):
    sheet = [["shead"]] + [["n1"]] * 4 + [["n1", None, "s1", None, None, None, None, cell, "n9"]] + [["n2"]]
    path = save(tmp_path / "b.xlsx", {"Other": [["s1"]], "Dashboard": sheet})
    assert read_cell(spark, TableSource(path, {}, format="xlsx", sheet="Dashboard"), 4, 7) == value


def test_folder_of_workbooks_in_order(spark, tmp_path):
    """Rows come by the workbook's name, then by the sheet's row; absent and repeated columns; rows of any number of batches."""
    n = wb.BATCH_ROWS + 5
    save(tmp_path / "b.xlsx", {"X": [["sHN", "sStage"]] + [[f"n{k}", "sII"] for k in range(n)]})
    save(tmp_path / "a.xlsx", {"X": [["sStage", "sHN", "sHN", "sปี"], ["sI", "sa1", "swrong", "n2564"], [], [None, "sa2", None, "n2564.5"]]})
    save(tmp_path / "c.xlsx", {"X": []  or [["sHN"]]})
    src = TableSource(str(tmp_path), {"hn": "HN", "year": "ปี", "stage": "Stage"}, format="xlsx", sheet="X")
    got = [(r.hn, r.year, r.stage) for r in read_source(spark, src, ["hn", "year", "stage"]).orderBy("row_idx").collect()]
    assert got[:2] == [("a1", "2564", "I"), ("a2", "2564.5", None)]
    assert got[2:] == [(str(k), None, "II") for k in range(n)]
    wanted = TableSource(str(tmp_path), {"hn": "HN"}, format="xlsx", sheet="Y")
    with pytest.raises(Exception, match="no sheet 'Y'"):
        read_source(spark, wanted, ["hn"]).collect()


def test_explicit_order_column(spark, tmp_path):
    path = save(tmp_path / "a.xlsx", {"X": [["sHN", "sno"], ["sx", "n3"], ["sy", "s1"], ["sz", None]]})
    src = TableSource(path, {"hn": "HN"}, format="xlsx", sheet="X", order_by="no")
    assert {r.hn: r.row_idx for r in read_source(spark, src, ["hn"]).collect()} == {"x": 3, "y": 1, "z": None}


def book(tmp_path, cell="n119"):
    ents, evs, unk = trap_tables()
    text = lambda v: None if v is None else f"s{v}"
    columns = {k: f"s{v}" for k, v in SHEET_COLUMNS.items()}
    path = save(
        tmp_path / "cohort.xlsx",
        {
            "Dashboard": [["stotal"]] + [[]] * 4 + [[None] * 7 + [cell]],
            "Patient Data": [[columns["hn"], columns["year"], columns["stage"]]] + [list(map(text, r[:3])) for r in ents],
            "Treatment Data": [list(columns.values())] + [list(map(text, r[:4])) for r in evs],
            "Unknown": [["spreamble"], [columns["hn"], columns["year"]]] + [list(map(text, r)) for r in unk],
        },
    )
    return path, ents, evs, unk


def test_build_from_a_workbook(spark, tmp_path):
    path, ents, evs, unk = book(tmp_path)
    inputs = read_inputs(spark, **workbook_sources(path))
    assert inputs.unknown_override == 119 and [r.name for r in inputs.source_files.collect()] == ["cohort.xlsx"]
    missing = lambda row: tuple(None if v in PANDAS_NA_TOKENS else v for v in row)
    ents = [(*missing(r[:3]), i) for i, r in enumerate(ents)]
    evs = [(*missing(r[:4]), i) for i, r in enumerate(evs)]
    expected = py_build(ents, evs, [missing(r) for r in unk], clinical_spec(), 119)
    got = spark_outputs(CohortBuild(inputs, clinical_spec()))
    for k in ("summary", "stages", "heatmap", "regimens"):
        assert got[k] == sorted(expected[k], key=repr), k


def test_job_from_a_workbook(spark, tmp_path):
    from cohortlens.plans.job import run

    path, *_ = book(tmp_path, cell=None)
    args = argparse.Namespace(workbook=path, rollup_pattern=None, top_k=6, var_name=None, out=str(tmp_path / "out"))
    paths = run(spark, args)
    summary = {r["scope"]: r for r in spark.read.parquet(paths["summary"]).collect()}
    assert summary["all"]["unknown_patients"] == 3 and summary["all"]["known_patients"] == 7
