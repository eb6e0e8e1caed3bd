"""Cohort semantics: hand-written trap cases and randomised differential tests
"""

from __future__ import annotations

import random

import pytest
from conftest import tables
from py_oracle import build as py_build

from cohortlens import CohortBuild, clinical_spec
from cohortlens.spec import active_only_variant


def spark_outputs(b: CohortBuild):
    def rows(df, cols):
        return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)

    return {
        "summary": rows(
            b.summary,
            ["scope", "known_patients", "treatment_events", "stage_count", "unknown_patients", "active_patients", "multimodal_patients", "multimodal_percent"],
        ),
        "stages": rows(b.stages, ["scope", "stage", "patients", "active_patients", "multimodal_patients", "multimodal_percent"]),
        "heatmap": rows(b.heatmap, ["scope", "treatment", "stage", "count", "percent"]),
        "regimens": rows(b.regimens, ["scope", "stage", "rank", "regimen", "count", "percent", "width", "combined"]),
        "years": sorted(r["year"] for r in b.years.collect()),
    }


def assert_same(spark_out, py_out):
    for k in ("summary", "stages", "heatmap", "regimens", "years"):
        assert spark_out[k] == sorted(py_out[k], key=repr) if k != "years" else spark_out[k] == py_out[k], k


def run(spark, ents, evs, unk, spec=None, override=None, materialize="none"):
    spec = spec or clinical_spec()
    inputs = tables(spark, ents, evs, unk)
    if override is not None:
        from dataclasses import replace

        inputs = replace(inputs, unknown_override=override)
    b = CohortBuild(inputs, spec, materialize=materialize)
    return b, spark_outputs(b), py_build(ents, evs, unk, spec, override)


# ---------------------------------------------------------------------------
# hand-written traps
# ---------------------------------------------------------------------------
def trap_tables():
    ents = [
        ("p1", "2564", "II", 1),  # 1: patient stage II, events at stage III
        ("p2", "2564", "II", 2),  # 4: duplicate id, last row wins -> III
        ("p2", "2564", "III", 3),
        (None, "2564", "IV", 4),  # 5: missing ids collapse to one pseudo-patient
        ("", "2564", "IV", 5),
        ("  ", "2565", "IV", 6),
        ("p3", "2564", "III", 7),  # 3: registered 2564, event in 2565
        ("p4", "2565", "III", 8),
        ("p5", "ไม่ระบุ", "IV", 9),  # sentinel year: only in 'all'
        ("\tp6　", " 2565.0 ", " IV ", 10),  # 13 + 14: whitespace and year parse
        ("p7", "2565", "X", 11),  # unknown stage, filtered
    ]
    evs = [
        ("p1", "2564", "III", "Hormone", 100),
        ("p1", "2564", "III", "Radiation", 101),
        ("p2", "2564", "II", "Surgery", 102),
        ("p2", "2564", "II", "Surgery", 103),  # duplicate event: counts as an event only once in coverage
        ("x9", "2564", "IV", "Chemotherapy", 104),  # 2: orphan event
        (None, "2564", "IV", "Hormone", 105),
        (" ", "2564", "IV", "Other", 106),  # 11: Other in regimen, not heatmap
        ("p3", "2565", "III", "Radiation", 107),  # 3
        ("p4", "2565", "III", "Mystery", 108),  # 10: unknown modality
        ("p4", "2565", "III", "Refer", 109),  # non-active
        ("p5", "2566", "IV", "Hormone", 110),  # 16: event-only year
        ("p6", "2565", "IV", "Immonotherapy", 111),
        ("p6", "2565", "IV", " Hormone ", 112),
        ("p7", "2565", "X", "Hormone", 113),
    ]
    unk = [("u1", "2564"), ("u1", "2564"), ("u2", "2565"), (None, "2565"), (" u2", "2565")]
    return ents, evs, unk


def test_traps_match_python_model(spark):
    ents, evs, unk = trap_tables()
    b, s_out, p_out = run(spark, ents, evs, unk)
    assert_same(s_out, p_out)


def test_trap_details(spark):
    ents, evs, unk = trap_tables()
    b, out, _ = run(spark, ents, evs, unk)
    summary = {r[0]: r for r in out["summary"]}
    assert out["years"] == ["2564", "2565"]  # 16: event-only 2566 is not a scope
    # known: p1 p2 ไม่ระบุ p3 p4 p5 p6 -> 7 (p2 once, pseudo-patient once)
    assert summary["all"][1] == 7
    # events: every stage-known event row, duplicates / non-active / unknown included
    assert summary["all"][2] == 13
    # 17: per-scope unknown distinct ids, whitespace variants stay distinct
    assert summary["2564"][4] == 1 and summary["2565"][4] == 2 and summary["all"][4] == 3
    heat = {(r[0], r[1], r[2]): r[3:] for r in out["heatmap"]}
    # 1: coverage uses the event stage (III) although p1 is stage II
    assert heat[("all", "Hormone", "III")][0] == 1
    # 2: orphan chemo at IV counts
    assert heat[("all", "Chemotherapy", "IV")][0] == 1
    regs = {(r[0], r[1], r[3]): r for r in out["regimens"]}
    # 1 + 4: p1 regimen sits under its registry stage II; p2 under III (last row wins)
    assert ("all", "II", "RT + ADT") in regs
    assert ("all", "III", "RP") in regs
    # 3: p3's 2565 event: in 2565 coverage, not in 2565 regimens
    assert heat[("2565", "Radiation", "III")][0] == 1
    assert not any(k[0] == "2565" and k[1] == "III" and k[2] == "RT" for k in regs)
    # 11: Other joins a regimen name but has no heatmap row
    assert ("all", "IV", "ADT + อื่นๆ") in regs
    assert not any(k[1] == "Other" for k in heat)
    # 13: p6 padded id / stage / modality are cleaned, year " 2565.0 " -> 2565
    assert ("2565", "IV", "ADT + IO") in regs


def test_unknown_override_only_for_all(spark):
    ents, evs, unk = trap_tables()
    b, s_out, p_out = run(spark, ents, evs, unk, override=119)
    assert_same(s_out, p_out)
    summary = {r[0]: r for r in s_out["summary"]}
    assert summary["all"][4] == 119 and summary["2564"][4] == 1


def test_rounding_ties(spark):
    # stage II: 16 patients; one has ADT only (1/16 -> 6.25 -> 6.2), 11 RT (11/16 -> 68.75 -> 68.8)
    ents = [(f"a{i}", "2564", "II", i) for i in range(16)]
    # stage III: 8 patients, 1 with chemo (coverage 1/8 = 12.5 -> 12.0 at 0 digits)
    ents += [(f"b{i}", "2564", "III", 100 + i) for i in range(8)]
    # stage IV: 64 patients, 20 with ADT (20/64 = 31.25 -> 31.2)
    ents += [(f"c{i}", "2564", "IV", 200 + i) for i in range(64)]
    evs = [("a0", "2564", "II", "Hormone", 1000)]
    evs += [(f"a{i}", "2564", "II", "Radiation", 1001 + i) for i in range(1, 12)]
    evs += [("b0", "2564", "III", "Chemotherapy", 2000)]
    evs += [(f"c{i}", "2564", "IV", "Hormone", 3000 + i) for i in range(20)]
    b, s_out, p_out = run(spark, ents, evs, [])
    assert_same(s_out, p_out)
    regs = {(r[0], r[1], r[3]): r for r in s_out["regimens"]}
    assert regs[("all", "II", "ADT")][5] == 6.2
    assert regs[("all", "II", "RT")][5] == 68.8
    assert regs[("all", "IV", "ADT")][5] == 31.2
    heat = {(r[0], r[1], r[2]): r for r in s_out["heatmap"]}
    assert heat[("all", "Chemotherapy", "III")][4] == 12.0
    # 7: stage I empty -> zero percents, no regimens
    assert heat[("all", "Hormone", "I")][3:] == (0, 0.0)
    assert not any(k[1] == "I" for k in regs)


@pytest.mark.parametrize("n_regimens", [6, 7, 9])
def test_fold_boundary_and_tie_order(spark, n_regimens):
    mods = ["Hormone", "Radiation", "Surgery", "Chemotherapy", "Targeted Therapy", "Interventional", "Immonotherapy", "Other"]
    ents, evs = [], []
    combos = [[m] for m in mods] + [[mods[0], mods[1]]]
    # one patient per regimen, first-seen order reversed against dimension order
    for i, combo in enumerate(combos[:n_regimens]):
        ents.append((f"p{i}", "2564", "IV", i))
        for j, m in enumerate(combo):
            evs.append((f"p{i}", "2564", "IV", m, 1000 - 10 * i + j))
    b, s_out, p_out = run(spark, ents, evs, [])
    assert_same(s_out, p_out)
    regs = sorted([r for r in s_out["regimens"] if r[0] == "all"], key=lambda r: r[2])
    assert len(regs) == min(n_regimens, 7)
    assert (regs[-1][3] == "อื่นๆ (รวม)") == (n_regimens > 6)
    if n_regimens > 6:
        assert regs[-1][4] == n_regimens - 6
    # ties are ordered by first active event: the last patient listed comes first
    expected_first = {6: "IR", 7: "IO", 9: "RT + ADT"}[n_regimens]
    assert regs[0][3] == expected_first


def test_fold_tie_order_first_seen(spark):
    ents = [(f"p{i}", "2564", "II", i) for i in range(3)]
    evs = [
        ("p2", "2564", "II", "Surgery", 5),  # RP seen first
        ("p1", "2564", "II", "Chemotherapy", 6),
        ("p0", "2564", "II", "Hormone", 7),
    ]
    b, s_out, p_out = run(spark, ents, evs, [])
    assert_same(s_out, p_out)
    names = [r[3] for r in sorted([r for r in s_out["regimens"] if r[0] == "all"], key=lambda r: r[2])]
    assert names == ["RP", "Chemo", "ADT"]


def test_active_variant(spark):
    ents, evs, unk = trap_tables()
    spec = active_only_variant(clinical_spec(), ("Other",))
    b, s_out, p_out = run(spark, ents, evs, unk, spec=spec)
    assert_same(s_out, p_out)


# ---------------------------------------------------------------------------
# randomised differential
# ---------------------------------------------------------------------------
MODS = ["Hormone", "Radiation", "Surgery", "Chemotherapy", "Targeted Therapy", "Interventional", "Immonotherapy", "Other", "Refer", "Supportive", "Mystery"]
STAGES = ["I", "II", "III", "IV", "X", None, " II"]
YEARS = ["2564", "2565", "2566", "2564.0", None, "abc", " 2567 "]


def random_tables(seed: int, n_ids: int = 40, n_ents: int = 60, n_evs: int = 200):
    rnd = random.Random(seed)
    ids = [f"h{i}" for i in range(n_ids)] + [None, "", " "]
    idx = list(range(10 * (n_ents + n_evs)))
    rnd.shuffle(idx)
    ents = [(rnd.choice(ids), rnd.choice(YEARS), rnd.choice(STAGES), idx.pop()) for _ in range(n_ents)]
    evs = [(rnd.choice(ids + ["orphan1", "orphan2"]), rnd.choice(YEARS), rnd.choice(STAGES), rnd.choice(MODS), idx.pop()) for _ in range(n_evs)]
    unk = [(rnd.choice(ids + [None]), rnd.choice(YEARS)) for _ in range(15)]
    return ents, evs, unk


@pytest.mark.parametrize("seed", range(6))
def test_random_against_python_model(spark, seed):
    ents, evs, unk = random_tables(seed)
    b, s_out, p_out = run(spark, ents, evs, unk)
    assert_same(s_out, p_out)


@pytest.mark.parametrize("seed", [11, 12])
def test_random_small_top_k_and_materialized(spark, seed):
    ents, evs, unk = random_tables(seed, n_ids=25, n_evs=300)
    spec = clinical_spec(top_k=3)
    b, s_out, p_out = run(spark, ents, evs, unk, spec=spec, materialize="checkpoint")
    assert_same(s_out, p_out)


def test_order_independence(spark):
    """Same rows, different partitioning and order -> same result (row_idx decides)."""
    ents, evs, unk = random_tables(3)
    _, a, _ = run(spark, ents, evs, unk)
    rnd = random.Random(7)
    rnd.shuffle(ents)
    rnd.shuffle(evs)
    inputs = tables(spark, ents, evs, unk)
    from cohortlens.model import CohortInputs

    inputs = CohortInputs(inputs.entities.repartition(5), inputs.events.repartition(7), inputs.unknown)
    b = CohortBuild(inputs, clinical_spec())
    assert spark_outputs(b) == a


def test_substage_rollup_in_pipeline(spark):
    from cohortlens.spec import CLINICAL_SUBSTAGE_PATTERN

    ents = [("a", "2564", "IIA", 1), ("b", "2564", "IIB", 2), ("c", "2564", "IVB", 3), ("d", "2564", "IID", 4)]
    evs = [("a", "2564", "IIC", "Hormone", 10), ("c", "2564", "IV", "Radiation", 11), ("d", "2564", "II", "Surgery", 12)]
    b = CohortBuild(tables(spark, ents, evs, []), clinical_spec(), rollup_pattern=CLINICAL_SUBSTAGE_PATTERN)
    out = spark_outputs(b)
    stages = {(r[0], r[1]): r[2] for r in out["stages"]}
    assert stages[("all", "II")] == 2 and stages[("all", "IV")] == 1  # IID is not a known sub-stage
    heat = {(r[0], r[1], r[2]): r[3] for r in out["heatmap"]}
    assert heat[("all", "Hormone", "II")] == 1 and heat[("all", "Radiation", "IV")] == 1
    regs = {(r[0], r[1], r[3]) for r in out["regimens"]}
    assert ("all", "II", "ADT") in regs and ("all", "IV", "RT") in regs


def test_empty_registry_still_has_all_scope(spark):
    evs = [("x", "2564", "II", "Hormone", 1), ("y", "2565", "IV", "Surgery", 2)]
    b, s_out, p_out = run(spark, [], evs, [("u", "2564")])
    assert_same(s_out, p_out)
    assert [r[0] for r in s_out["summary"]] == ["all"]
    assert s_out["summary"][0][1:5] == (0, 2, 4, 1)


def test_wide_dimensions_use_the_per_stage_fallback(spark):
    """10 stages x 7 heatmap rows = 70 cells > 63 bits: coverage goes through
    the per-stage rollup and must still equal the Python model."""
    from cohortlens.spec import Stage

    stages = tuple(Stage(f"S{i}", f"L{i}", f"N{i}", "#000000") for i in range(10))
    spec = clinical_spec(stages=stages, small_n_stage=None)
    assert not spec.cells_fit_one_mask()
    rnd = random.Random(77)
    codes = [s.code for s in stages] + ["X", None]
    ids = [f"h{i}" for i in range(30)] + [None]
    ents = [(rnd.choice(ids), rnd.choice(YEARS), rnd.choice(codes), i) for i in range(60)]
    evs = [(rnd.choice(ids), rnd.choice(YEARS), rnd.choice(codes), rnd.choice(MODS), 1000 + i) for i in range(300)]
    b, s_out, p_out = run(spark, ents, evs, [], spec=spec)
    assert_same(s_out, p_out)


@pytest.mark.parametrize(
    "seed,params",
    [
        (101, dict(top_k=1)),
        (102, dict(top_k=2, denominator="active")),
        (103, dict(top_k=4, min_share=10.0)),
        (104, dict(top_k=6, min_share=3.0, denominator="active")),
        (105, dict(top_k=9, coverage_digits=2, regimen_digits=0, width_digits=2, multimodal_digits=1)),
    ],
)
def test_parameter_sweep_against_python_model(spark, seed, params):
    ents, evs, unk = random_tables(seed, n_ids=30, n_evs=250)
    b, s_out, p_out = run(spark, ents, evs, unk, spec=clinical_spec(**params))
    assert_same(s_out, p_out)


def test_label_outside_regimen_order_sorts_last(spark):
    from cohortlens.spec import Modality

    spec = clinical_spec()
    spec = spec.with_params(modalities=spec.modalities + (Modality("Cryotherapy", "Cryo"),))
    ents = [("a", "2564", "II", 1), ("b", "2564", "II", 2)]
    evs = [("a", "2564", "II", "Cryotherapy", 10), ("a", "2564", "II", "Other", 11), ("a", "2564", "II", "Surgery", 12),
           ("b", "2564", "II", "Cryotherapy", 13)]
    b, s_out, p_out = run(spark, ents, evs, [], spec=spec)
    assert_same(s_out, p_out)
    names = {r[3] for r in s_out["regimens"] if r[0] == "all"}
    assert names == {"RP + อื่นๆ + Cryo", "Cryo"}


def test_python_model_on_whole_test_tables(spark):
    """Third implementation on real data: Spark == plain-Python model on the
    whole sf0.01 tables in the clinical encoding (DuckDB agrees separately)."""
    from cohortlens.plans.catalog import build

    b = build(spark, "/root/testdata/sf0.01", "C")
    raw = b.raw
    ents = [tuple(r) for r in raw.entities.select("hn", "year", "stage", "row_idx").collect()]
    evs = [tuple(r) for r in raw.events.select("hn", "year", "stage", "treatment", "row_idx").collect()]
    unk = [tuple(r) for r in raw.unknown.select("hn", "year").collect()]
    assert len(evs) == 15000
    assert_same(spark_outputs(b), py_build(ents, evs, unk, b.spec))
