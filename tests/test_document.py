"""Nested document: the expression-built layout equals the long-table assembly,
and carries the published invariants (SURVEY §5)."""

from __future__ import annotations

import json

import pytest
from conftest import tables
from test_semantics import random_tables, trap_tables

from cohortlens import CohortBuild, clinical_spec
from cohortlens.plans.document import _document_rows_long, document_json, document_rows, full_document
from cohortlens.spec import active_only_variant
from pyspark.sql import functions as F


def as_json(df):
    return {r["scope"]: r["j"] for r in df.select("scope", F.to_json("dataset").alias("j")).collect()}


@pytest.mark.parametrize("case", ["traps", "random", "variant"])
def test_fast_document_equals_long_assembly(spark, case):
    ents, evs, unk = trap_tables() if case == "traps" else random_tables(31)
    spec = clinical_spec() if case != "variant" else active_only_variant(clinical_spec(), ("Other",))
    b = CohortBuild(tables(spark, ents, evs, unk), spec, materialize="cache")
    assert as_json(document_rows(b)) == as_json(_document_rows_long(b))
    b.release()


def test_document_invariants(spark):
    ents, evs, unk = random_tables(41, n_ids=60, n_evs=400)
    b = CohortBuild(tables(spark, ents, evs, unk), clinical_spec(), materialize="cache")
    doc = json.loads(document_json(full_document(b)).collect()[0]["value"])
    assert list(doc) == ["sourceFile", "years", "all", "byYear", "notes"]
    assert doc["years"] == sorted(doc["byYear"])
    for ds in [doc["all"], *doc["byYear"].values()]:
        s = ds["summary"]
        assert list(s) == ["knownStagePatients", "treatmentEvents", "stageCount", "unknownStagePatients",
                           "activePatients", "multimodalPatients", "multimodalPercent"]
        assert s["activePatients"] == sum(p["activePatients"] for p in ds["panels"])
        assert [h["treatment"] for h in ds["heatmap"]] == [h.value for h in b.spec.heatmap]
        for p in ds["panels"]:
            # every active patient sits in exactly one shown row or the tail
            assert sum(r["count"] for r in p["regimens"]) == p["activePatients"]
            assert len(p["regimens"]) <= b.spec.top_k + 1
            for r in p["regimens"]:
                assert r["combined"] == (" + " in r["name"])
                assert r["percent"] == (round(r["count"] / p["patients"] * 100, 1) if p["patients"] else 0.0)
    b.release()


def test_document_with_empty_scopes(spark):
    """A year with registry rows but no events, and a stage with nobody."""
    ents = [("a", "2564", "II", 1), ("b", "2565", "III", 2)]
    evs = [("a", "2564", "II", "Hormone", 10)]
    b = CohortBuild(tables(spark, ents, evs, []), clinical_spec())
    fast, slow = as_json(document_rows(b)), as_json(_document_rows_long(b))
    assert fast == slow
    ds = json.loads(fast["2565"])
    assert all(p["regimens"] == [] for p in ds["panels"])
    assert ds["summary"]["activePatients"] == 0 and ds["summary"]["multimodalPercent"] == 0.0


def test_clinical_document_invariants_on_test_tables(spark):
    """SURVEY §5 invariants on a whole-table build in the clinical layout."""
    from cohortlens.plans.catalog import QUERIES

    doc = json.loads(QUERIES["clinical_document"](spark, "/root/testdata/sf0.01").collect()[0]["value"])
    assert doc["years"] == sorted(doc["byYear"]) and doc["notes"]
    scopes = [doc["all"], *doc["byYear"].values()]
    for ds in scopes:
        s = ds["summary"]
        assert [p["stage"] for p in ds["panels"]] == ["I", "II", "III", "IV"]
        assert [h["treatment"] for h in ds["heatmap"]] == [h.value for h in clinical_spec().heatmap]
        # each customer has one segment: stage sizes add up to the known total
        assert sum(st["patients"] for st in ds["stages"]) == s["knownStagePatients"]
        assert sum(p["activePatients"] for p in ds["panels"]) == s["activePatients"]
        assert sum(p["multimodalPatients"] for p in ds["panels"]) == s["multimodalPatients"]
        for p in ds["panels"]:
            regs = p["regimens"]
            assert sum(r["count"] for r in regs) == p["activePatients"]
            top = max([r["count"] for r in regs] or [1])
            for r in regs:
                assert r["combined"] == (" + " in r["name"])
                assert r["percent"] == (round(r["count"] / p["patients"] * 100, 1) if p["patients"] else 0.0)
                assert r["width"] == round(r["count"] / top * 100, 1)
            shown = [r for r in regs if r["name"] != "อื่นๆ (รวม)"]
            assert all(a["count"] >= b["count"] for a, b in zip(shown, shown[1:]))
        for h in ds["heatmap"]:
            for code, cell in h["stages"].items():
                den = next(st["patients"] for st in ds["stages"] if st["stage"] == code)
                assert cell["percent"] == (round(cell["count"] / den * 100, 0) if den else 0.0)
    # registry years partition the known patients (one first-order year per customer)
    assert sum(ds["summary"]["knownStagePatients"] for ds in doc["byYear"].values()) == doc["all"]["summary"]["knownStagePatients"]
