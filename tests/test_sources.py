"""Sources and sinks: CSV exports with a preamble row, absent optional columns,
the override cell, Parquet ingestion order, flat sinks and the document round trip."""

from __future__ import annotations

import csv
import os
import tempfile

from py_oracle import build as py_build
from test_semantics import spark_outputs, trap_tables

from cohortlens import CohortBuild, clinical_spec
from cohortlens.plans.document import document_scopes, flatten_heatmap
from cohortlens.sources.sinks import read_document, read_slice, write_document, write_flat
from cohortlens.sources.tables import PANDAS_NA_TOKENS, TableSource, read_inputs, read_source


def write_csv(path, header, rows, preamble=None):
    with open(path, "w", newline="", encoding="utf-8") as fh:
        w = csv.writer(fh)
        if preamble is not None:
            w.writerow(preamble)
        w.writerow(header)
        for r in rows:
            w.writerow(["" if v is None else v for v in r])


def sheet_dir():
    d = tempfile.mkdtemp(prefix="sheets-")
    ents, evs, unk = trap_tables()
    write_csv(f"{d}/patients.csv", ["HN", "ปี", "Stage_หลัก"], [(h, y, s) for h, y, s, _ in ents])
    write_csv(f"{d}/treatments.csv", ["HN", "ปี", "Stage_หลัก", "วิธีการรักษา"], [(h, y, s, t) for h, y, s, t, _ in evs])
    write_csv(f"{d}/unknown.csv", ["HN", "ปี"], unk, preamble=["รายชื่อผู้ป่วยไม่ระบุระยะ", ""])
    write_csv(f"{d}/unknown_noyear.csv", ["HN"], [(h,) for h, _ in unk], preamble=["x"])
    dash = [[""] * 9 for _ in range(6)]
    dash[4][7] = "119"
    write_csv(f"{d}/dashboard.csv", [f"c{i}" for i in range(9)], dash)
    return d, ents, evs, unk


def sources(d, unknown_file="unknown.csv"):
    return dict(
        entities=TableSource(f"{d}/patients.csv", {"hn": "HN", "year": "ปี", "stage": "Stage_หลัก"}, format="csv", null_tokens=PANDAS_NA_TOKENS),
        events=TableSource(
            f"{d}/treatments.csv", {"hn": "HN", "year": "ปี", "stage": "Stage_หลัก", "treatment": "วิธีการรักษา"}, format="csv", null_tokens=PANDAS_NA_TOKENS
        ),
        unknown=TableSource(f"{d}/{unknown_file}", {"hn": "HN", "year": "ปี"}, format="csv", header_row=1, null_tokens=PANDAS_NA_TOKENS),
    )


def as_read(rows):
    """What a spreadsheet reader hands over: blanks and NA tokens are missing."""
    return [tuple(None if (isinstance(v, str) and v in PANDAS_NA_TOKENS) else v for v in r) for r in rows]


def test_csv_sheets_with_preamble_and_override(spark):
    d, ents, evs, unk = sheet_dir()
    inputs = read_inputs(spark, **sources(d), override=TableSource(f"{d}/dashboard.csv", {}, format="csv"))
    assert inputs.unknown_override == 119
    assert inputs.unknown.count() == len(unk)
    b = CohortBuild(inputs, clinical_spec())
    # ingestion order follows the file order, so the trap outcomes are unchanged
    ents_idx = [(h, y, s, i) for i, (h, y, s) in enumerate(as_read([r[:3] for r in ents]))]
    evs_idx = [(h, y, s, t, i) for i, (h, y, s, t) in enumerate(as_read([r[:4] for r in evs]))]
    expected = py_build(ents_idx, evs_idx, as_read(unk), clinical_spec(), 119)
    got = spark_outputs(b)
    for k in ("summary", "stages", "heatmap", "regimens"):
        assert got[k] == sorted(expected[k], key=repr), k


def test_absent_year_column_means_sentinel(spark):
    d, ents, evs, unk = sheet_dir()
    inputs = read_inputs(spark, **sources(d, "unknown_noyear.csv"))
    years = {r["year"] for r in inputs.unknown.collect()}
    assert years == {None}
    b = CohortBuild(inputs, clinical_spec())
    summary = {r["scope"]: r["unknown_patients"] for r in b.summary.collect()}
    assert summary["all"] == 3 and summary["2564"] == 0  # u1, u2, " u2": not cleaned


def test_parquet_row_order_from_metadata(spark):
    d = tempfile.mkdtemp(prefix="pq-")
    rows = [(f"h{i}", "2564", "II" if i % 2 else "III") for i in range(50)]
    spark.createDataFrame(rows, "HN string, y string, st string").coalesce(1).write.parquet(f"{d}/ents")
    df = read_source(spark, TableSource(f"{d}/ents", {"hn": "HN", "year": "y", "stage": "st"}), ["hn", "year", "stage"])
    got = [r["hn"] for r in df.orderBy("row_idx").collect()]
    assert got == [r[0] for r in rows]


def test_flat_sink_and_document_round_trip(spark):
    ents, evs, unk = trap_tables()
    from conftest import tables

    b = CohortBuild(tables(spark, ents, evs, unk), clinical_spec(), materialize="checkpoint")
    out = tempfile.mkdtemp(prefix="out-")
    write_flat(b, out)
    sl = read_slice(spark, out, "regimens", "2565")
    assert sl.count() == b.regimens.where("scope = '2565'").count()
    write_document(b, f"{out}/doc", var_name="COHORT_DATA")
    files = [f for f in os.listdir(f"{out}/doc") if f.startswith("part-")]
    text = open(f"{out}/doc/{files[0]}", encoding="utf-8").read()
    assert text.startswith("window.COHORT_DATA = {") and "ระยะ" in text  # UTF-8, not escaped
    doc = read_document(spark, f"{out}/doc")
    d = doc.collect()[0]["document"]
    assert d["years"] == ["2564", "2565"]
    assert d["all"]["summary"]["stageCount"] == 4
    assert [p["stage"] for p in d["all"]["panels"]] == ["I", "II", "III", "IV"]
    assert [h["treatment"] for h in d["all"]["heatmap"]][:2] == ["Hormone", "Radiation"]
    back = flatten_heatmap(document_scopes(doc), b.spec)
    cols = ["scope", "treatment", "stage", "count", "percent"]
    assert sorted(map(tuple, back.select(cols).collect())) == sorted(map(tuple, b.heatmap.select(cols).collect()))


def test_batch_job_end_to_end(spark):
    import argparse

    from cohortlens.plans.job import run

    d, ents, evs, unk = sheet_dir()
    out = tempfile.mkdtemp(prefix="job-")
    args = argparse.Namespace(
        entities=f"{d}/patients.csv", events=f"{d}/treatments.csv", unknown=f"{d}/unknown.csv",
        dashboard=f"{d}/dashboard.csv", format="csv", unknown_format="csv", unknown_header_row=1,
        rollup_pattern=None, top_k=6, var_name=None, out=out,
    )
    paths = run(spark, args)
    summary = {r["scope"]: r for r in spark.read.parquet(paths["summary"]).collect()}
    assert summary["all"]["unknown_patients"] == 119 and summary["all"]["known_patients"] == 7
    doc = read_document(spark, f"{out}/document").collect()[0]["document"]
    assert doc["all"]["summary"]["unknownStagePatients"] == 119


def test_other_formats_and_multi_file_order(spark):
    """Ingestion order = files ranked by path, then position inside the file."""
    import glob

    d = tempfile.mkdtemp(prefix="fmt-")
    rows = [(f"h{i:03d}", "2564", "II" if i % 3 else "IV") for i in range(120)]
    df = spark.createDataFrame(rows, "HN string, y string, st string")
    for part in (0, 1):  # two files per format: rows 0..59 and 60..119
        chunk = df.where(f"CAST(substring(HN, 2) AS INT) DIV 60 = {part}").coalesce(1)
        chunk.write.mode("append").parquet(f"{d}/parquet")
        chunk.write.mode("append").orc(f"{d}/orc")
        chunk.write.mode("append").json(f"{d}/json")
    cols = {"hn": "HN", "year": "y", "stage": "st"}
    for fmt in ("parquet", "orc", "json"):
        files = sorted(f for f in glob.glob(f"{d}/{fmt}/part-*") if not f.endswith(".crc"))
        first_in_file = [spark.read.format(fmt).load(f).first()["HN"] for f in files]
        chunks = [[r[0] for r in rows if r[0][1:] >= h[1:]][:60] for h in first_in_file]
        got = read_source(spark, TableSource(f"{d}/{fmt}", cols, format=fmt), ["hn", "year", "stage"])
        names = [r["hn"] for r in got.orderBy("row_idx").collect()]
        assert names == chunks[0] + chunks[1], fmt


def test_order_by_column_types(spark):
    import datetime as dt

    d = tempfile.mkdtemp(prefix="ord-")
    base = dt.datetime(2024, 1, 1)
    rows = [(f"h{i}", "2564", "II", base + dt.timedelta(microseconds=7 * (5 - i))) for i in range(5)]
    spark.createDataFrame(rows, "HN string, y string, st string, ts timestamp").write.parquet(f"{d}/t")
    d = f"{d}/t"
    got = read_source(spark, TableSource(d, {"hn": "HN", "year": "y", "stage": "st"}, order_by="ts"), ["hn", "year", "stage"])
    assert [r["hn"] for r in got.orderBy("row_idx").collect()] == ["h4", "h3", "h2", "h1", "h0"]


def test_override_cell_parsing(spark):
    from cohortlens.sources.tables import read_cell

    d = tempfile.mkdtemp(prefix="cell-")
    for name, value in (("num", "119.0"), ("text", "n/a"), ("blank", "")):
        grid = [[""] * 9 for _ in range(6)]
        grid[4][7] = value
        write_csv(f"{d}/{name}.csv", [f"c{i}" for i in range(9)], grid)
    assert read_cell(spark, TableSource(f"{d}/num.csv", {}, format="csv"), 4, 7) == 119
    assert read_cell(spark, TableSource(f"{d}/text.csv", {}, format="csv"), 4, 7) is None
    assert read_cell(spark, TableSource(f"{d}/blank.csv", {}, format="csv"), 4, 7) is None


def csv_source(path, **kw):
    return TableSource(path, {"hn": "HN", "year": "YEAR", "stage": "STAGE"}, format="csv", **kw)


def test_text_order_beyond_128_partitions(spark):
    """One file a partition: the later file still wins, in path order."""
    d = tempfile.mkdtemp(prefix="many-")
    for k in range(220):
        stage = {1: "II", 2: "III"}.get(k, "I")
        write_csv(f"{d}/f{k:04d}.csv", ["HN", "YEAR", "STAGE"], [("u" if k < 3 else f"v{k}", "2565", stage)])
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(1 << 30))
    try:
        rows = read_source(spark, csv_source(d), ["hn", "year", "stage"])
        got = [r["stage"] for r in rows.where("hn = 'u'").orderBy("row_idx").collect()]
        assert got == ["I", "II", "III"]
        assert rows.select("row_idx").distinct().count() == 220
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)


def test_short_preamble_keeps_every_column(spark):
    d = tempfile.mkdtemp(prefix="short-")
    with open(f"{d}/unknown.csv", "w", encoding="utf-8") as fh:
        fh.write("A title\n\nHN,YEAR\nu1,2564\nu2,\n")
    rows = read_source(spark, csv_source(f"{d}/unknown.csv", header_row=1), ["hn", "year"])
    assert [(r["hn"], r["year"]) for r in rows.orderBy("row_idx").collect()] == [("u1", "2564"), ("u2", None)]


def test_swapped_header_is_refused(spark):
    import pytest

    for header_row in (0, 1):
        d = tempfile.mkdtemp(prefix="swap-")
        pre = ["t"] if header_row else None
        write_csv(f"{d}/a.csv", ["HN", "YEAR"], [("u1", "2564")], preamble=pre)
        write_csv(f"{d}/b.csv", ["YEAR", "HN"], [("2565", "u2")], preamble=pre)
        with pytest.raises(Exception, match="header|CSV header"):
            read_source(spark, csv_source(d, header_row=header_row), ["hn", "year"]).collect()


def test_one_scan_for_one_read(spark):
    d = tempfile.mkdtemp(prefix="scan-")
    write_csv(f"{d}/a.csv", ["HN", "YEAR"], [("u1", "2564")])
    df = spark.read.csv(d)
    assert df.count() == 2
    ordered = csv_source(d, order_by=None)
    plan = read_source(spark, ordered, ["hn", "year"])._jdf.queryExecution().executedPlan().toString()
    # the rows, and the offsets alone for the ranks of the splits
    assert plan.count("FileScan csv") == 2 and "ReadSchema: struct<>" in plan


def test_cells_that_hold_no_number(spark):
    from cohortlens.sources.tables import read_cell

    d = tempfile.mkdtemp(prefix="cell-")
    for text, expected in (("NaN", None), ("inf", None), ("12.0", 12), ("", None), ("x", None)):
        path = f"{d}/{text or 'blank'}.csv"
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(f"title\na,b\n1,{text}\n")
        assert read_cell(spark, TableSource(path, {}, format="csv"), 1, 1) == expected
        assert read_cell(spark, TableSource(path, {}, format="csv"), 1, 7) is None
        assert read_cell(spark, TableSource(path, {}, format="csv"), 9, 0) is None


def test_floating_ids_are_refused(spark):
    import pytest

    d = tempfile.mkdtemp(prefix="ids-") + "/t"
    spark.createDataFrame([(12345678.0, "2565", "I")], "HN double, YEAR string, STAGE string").write.parquet(d)
    with pytest.raises(ValueError, match="floating"):
        read_source(spark, TableSource(d, {"hn": "HN"}), ["hn"])
