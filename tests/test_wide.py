"""More stages, modalities and cells than one bigint mask has bits; the mix from the shared rollup; the document in parts."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from conftest import tables
from py_oracle import build as py_build
from test_plans import SF, executed, static_plans  # noqa: F401
from test_semantics import spark_outputs

from cohortlens import CohortBuild
from cohortlens.functions.numeric import mask_word, mask_words
from cohortlens.plans.catalog import build
from cohortlens.plans.document import document_scopes, full_document
from cohortlens.sources.sinks import read_document_parts, read_manifest, write_document_parts
from cohortlens.spec import CohortSpec, HeatRow, Modality, Stage


def spec_of(n_stages: int, n_active: int, n_heat: int, **kw) -> CohortSpec:
    mods = tuple(Modality(f"m{k}", f"s{k}") for k in range(n_active))
    return CohortSpec(
        stages=tuple(Stage(f"S{k}", f"label {k}", f"name {k}", "#000") for k in range(n_stages)),
        modalities=mods,
        regimen_order=tuple(m.short for m in reversed(mods)),
        heatmap=tuple(HeatRow(f"m{k}", f"row {k}") for k in range(n_heat)),
        non_active=("none", "m1"),
        **kw,
    )


def some_tables(spec: CohortSpec, seed: int, n: int = 150):
    rng = random.Random(seed)
    stages = [s.code for s in spec.stages] + ["elsewhere"]
    values = [m.value for m in spec.modalities] + ["none", "other", *[h.value for h in spec.heatmap]]
    years = ["2564", "2565", None]
    ents = [(f"h{rng.randrange(n)}", rng.choice(years), rng.choice(stages), i) for i in range(n)]
    evs = [(f"h{rng.randrange(n)}", rng.choice(years), rng.choice(stages), rng.choice(values), i) for i in range(4 * n)]
    return ents, evs, [(f"u{k}", "2564") for k in range(3)]


@pytest.mark.parametrize("sizes", [(3, 70, 66), (70, 5, 4), (64, 130, 64), (4, 8, 7)])
def test_wide_specs_equal_the_model(spark, sizes):
    spec = spec_of(*sizes)
    ents, evs, unk = some_tables(spec, sum(sizes))
    b = CohortBuild(tables(spark, ents, evs, unk), spec)
    expected, got = py_build(ents, evs, unk, spec), spark_outputs(b)
    for k in ("summary", "stages", "heatmap", "regimens"):
        assert got[k] == sorted(expected[k], key=repr), k


@pytest.mark.parametrize("sizes", [(3, 70, 66), (3, 6, 4)])
def test_mix_counts_distinct_pairs(spark, sizes):
    spec = spec_of(*sizes)
    ents, evs, unk = some_tables(spec, 7)
    shorts = {m.value: m.short for m in spec.modalities if m.value not in spec.non_active}
    scopes = {"all"} | {y for _, y, s, _ in ents if y and s in spec.stage_codes}
    pairs = {(scope, s, t, h) for h, y, s, t, _ in evs if s in spec.stage_codes and t in shorts for scope in ("all", y) if scope in scopes}
    n = Counter((scope, s, t) for scope, s, t, _ in pairs)
    total = Counter()
    for (scope, s, _), k in n.items():
        total[scope, s] += k
    expected = {(scope, s, t, shorts[t], k, round(k / total[scope, s] * 100, 1)) for (scope, s, t), k in n.items()}
    assert {tuple(r) for r in CohortBuild(tables(spark, ents, evs, unk), spec).modality_mix.collect()} == expected


def test_mask_words():
    assert mask_words("a", 63) == ["a"] and mask_words("a", 64) == ["a", "a_1"] and mask_words("a", 0) == ["a"]
    assert [mask_word("a", k) for k in (0, 62, 63, 126)] == ["a", "a", "a_1", "a_2"]


def test_mix_shuffles_the_events_once(spark, static_plans):  # noqa: F811
    """One exchange of event-sized rows: the rollup's; no second one for distinct entities."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = executed(build(spark, SF).modality_mix)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    by_hn = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and ", hn#" in line]
    assert len(by_hn) == 2, by_hn  # entities and events, each by (scope, hn)
    assert "count(distinct" not in plan and "stage#" not in "".join(by_hn)


def test_document_in_parts(spark, tmp_path):
    spec = spec_of(3, 6, 4, notes=("first", "second"))
    ents, evs, unk = some_tables(spec, 11)
    b = CohortBuild(tables(spark, ents, evs, unk), spec)
    write_document_parts(b, str(tmp_path / "doc"), source_name="a file")
    whole = full_document(b, "a file")
    by_scope = lambda rows: {r.scope: r.dataset for r in rows.collect()}
    assert by_scope(read_document_parts(spark, str(tmp_path / "doc"))) == by_scope(document_scopes(whole))
    assert list(by_scope(read_document_parts(spark, str(tmp_path / "doc"), "2565"))) == ["2565"]
    m = read_manifest(spark, str(tmp_path / "doc")).first().manifest
    d = whole.first().document
    assert (m.sourceFile, m.years, m.notes, m.scopes) == (d.sourceFile, d.years, d.notes, ["all", *d.years])
    files = [p for p in (tmp_path / "doc" / "scopes").glob("scope=*/part-*")]
    assert len(files) == len(m.scopes)


def test_lineage_names_files_not_parts(spark, tmp_path):
    from cohortlens.sources.tables import TableSource, source_files

    df = spark.createDataFrame([("h", "I")], "HN string, s string")
    df.write.parquet(str(tmp_path / "in folder.parquet"))
    df.write.partitionBy("s").parquet(str(tmp_path / "by stage"))
    df.write.csv(str(tmp_path / "a+b.csv"))
    (tmp_path / "single.csv").write_text("h,I\n")
    names = lambda p: sorted(r.name for r in source_files(spark, TableSource(str(p), {})).collect())
    assert names(tmp_path / "in folder.parquet") == ["in folder.parquet"]
    assert names(tmp_path / "by stage") == ["by stage"]
    assert names(tmp_path / "a+b.csv") == ["a+b.csv"]
    assert names(tmp_path / "single.csv") == ["single.csv"]
