"""Named queries over the test tables, one per operator group of the survey.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
whole customer / orders tables (FIXTURES.md §3 mapping).  Column names match
the SQL oracle in ``checks/oracle_sql.py``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.display import caution_flag, caution_note_sql, fmt_count, fmt_pct, headline, scope_label
from ..functions.sql import E
from ..functions.text import clean_text, clean_year, stage_rollup
from ..operators import coverage as cov
from ..operators import regimens as reg
from ..operators.prepare import active_only, distinct_entity_modality, not_blacklisted
from ..operators.scope import scoped_entities
from ..session import shared_folder
from ..sources import tpch
from ..spec import ALL_SCOPE, CLINICAL_SUBSTAGE_PATTERN, active_only_variant, clinical_spec, tpch_spec
from .cohort import CohortBuild
from .document import (
    document_heads,
    document_json,
    document_rows,
    document_scopes,
    flatten_heatmap,
    flatten_panels,
    flatten_stages,
    flatten_summary,
    full_document,
    parse_document,
)

from .ingest import QUERIES as INGEST_QUERIES

# The "Other"-like modality dropped in the active-denominator variant.
VARIANT_DROP = ("5-LOW",)


# Parameters exercised by the optional-feature queries.
OVERRIDE_UNKNOWN = 119
MIN_SHARE = 5.0


def build(
    spark: SparkSession,
    sf_dir: str,
    encoding: str = "P",
    variant: bool = False,
    materialize: str = "none",
    unknown_override: int | None = None,
    **spec_params,
) -> CohortBuild:
    spec = clinical_spec(**spec_params) if encoding == "C" else tpch_spec(encoding, **spec_params)
    if variant:
        spec = active_only_variant(spec, VARIANT_DROP)
    inputs = tpch.tpch_inputs(spark, sf_dir, encoding, unknown_override=unknown_override)
    return CohortBuild(inputs, spec, materialize=materialize)


def _registry_scopes(b: CohortBuild) -> DataFrame:
    """'all' plus every registry year: one row per scope, from the entity side only."""
    return b.entity_metrics.select("scope")


# -- P1 / P2 / P9 on messy text derived from clean columns ---------------------------
def q_clean_text(spark, sf):
    cust = tpch.read(spark, sf, "customer", "c_custkey", "c_mktsegment")
    raw = tpch.messy_text_sql("c_custkey", "c_mktsegment")
    return cust.select("c_custkey", E(raw, "raw_stage")).select("c_custkey", "raw_stage", clean_text("raw_stage", tpch_spec().sentinel).alias("stage"))


def q_clean_year(spark, sf):
    ents = tpch.raw_entities(spark, sf)
    raw = tpch.messy_year_sql("c_custkey", "year")
    return ents.select("c_custkey", E(raw, "raw_year")).select("c_custkey", "raw_year", clean_year("raw_year", tpch_spec().sentinel).alias("year"))


def q_stage_rollup(spark, sf):
    cust = tpch.read(spark, sf, "customer", "c_custkey")
    raw = tpch.substage_sql("c_custkey")
    return cust.select("c_custkey", E(raw, "raw_stage")).select(
        "c_custkey", "raw_stage", stage_rollup("raw_stage", tpch_spec().sentinel, CLINICAL_SUBSTAGE_PATTERN).alias("stage")
    )


# -- filters and set operations -----------------------------------------------------
def q_known_stage_filter(spark, sf):
    return build(spark, sf).entities


def q_active_filter(spark, sf):
    b = build(spark, sf)
    return active_only(b.events, b.spec)


def q_non_active_filter(spark, sf):
    b = build(spark, sf)
    return not_blacklisted(b.events, b.spec)


def q_distinct_entity_modality(spark, sf):
    b = build(spark, sf)
    return distinct_entity_modality(b.events, b.spec)


def q_years_list(spark, sf):
    return build(spark, sf).years


def q_scoped_entities(spark, sf):
    b = build(spark, sf)
    return scoped_entities(b.entities, b.spec)


# -- totals -------------------------------------------------------------------------
def q_stage_totals(spark, sf):
    return build(spark, sf).stages.select("scope", "stage_ord", "stage", "label", "patients")


def q_known_total(spark, sf):
    return build(spark, sf).summary.select("scope", "known_patients", "stage_count")


def q_event_total(spark, sf):
    return build(spark, sf).summary.select("scope", "treatment_events")


def q_unknown_total(spark, sf):
    return build(spark, sf).summary.select("scope", "unknown_patients")


def q_unknown_total_override(spark, sf):
    """The override replaces the whole-population figure only."""
    return build(spark, sf, unknown_override=OVERRIDE_UNKNOWN).summary.select("scope", "unknown_patients")


def q_summary(spark, sf):
    return build(spark, sf).summary


def q_multimodal_by_stage(spark, sf):
    return build(spark, sf).stages.select(
        "scope", "stage", "patients", "active_patients", "multimodal_patients", "multimodal_percent"
    )


# -- coverage -------------------------------------------------------------------------
def q_coverage_heatmap(spark, sf):
    return build(spark, sf).heatmap


def q_coverage_heatmap_wide(spark, sf):
    return build(spark, sf, "W").heatmap


def q_coverage_peak(spark, sf):
    return cov.coverage_peak(build(spark, sf).heatmap)


def q_coverage_trend(spark, sf):
    b = build(spark, sf)
    return cov.coverage_trend(b.heatmap, b.spec)


def q_heat_intensity(spark, sf):
    return cov.heat_intensity(build(spark, sf).heatmap)


def q_stage_modality_flow(spark, sf):
    return cov.stage_modality_flow(build(spark, sf).heatmap)


def q_modality_mix_by_stage(spark, sf):
    return build(spark, sf).modality_mix


# -- sets and regimens ------------------------------------------------------------------
def q_entity_modality_set(spark, sf):
    b = build(spark, sf)
    sets = reg.entity_sets(b.event_rollup, b.spec)
    return sets.join(_registry_scopes(b), "scope", "left_semi")


def q_regimen_label(spark, sf):
    b = build(spark, sf)
    dim = spark.createDataFrame(
        [(m.value, m.short, i) for i, m in enumerate(b.spec.regimen_modalities())],
        "treatment string, short string, regimen_ord int",
    )
    seen = b.events.select("treatment").distinct()
    # the dimension has one row per active modality, as many as the spec lists
    return seen.join(F.broadcast(dim), "treatment", "left").select(
        "treatment", F.coalesce("short", "treatment").alias("label"), "regimen_ord"
    )


def q_entity_stage_lookup(spark, sf):
    b = build(spark, sf)
    return reg.entity_assignments(b.fact, b.spec).select(
        "scope", "hn", "stage", reg.regimen_name("mask", b.spec).alias("regimen"), "first_idx"
    )


def q_regimen_counts(spark, sf):
    return build(spark, sf).regimen_counts.select("scope", "stage", "regimen", "n", "first_idx")


def q_regimen_topk(spark, sf):
    return build(spark, sf).regimens


def q_regimen_topk_wide(spark, sf):
    return build(spark, sf, "W").regimens


def q_active_denominator_heatmap(spark, sf):
    return build(spark, sf, variant=True).heatmap


def q_active_denominator_regimens(spark, sf):
    return build(spark, sf, variant=True).regimens


def q_regimen_topk_min_share(spark, sf):
    """Q4's optional extra cut-off: shown rows also need a minimum share."""
    return build(spark, sf, variant=True, min_share=MIN_SHARE).regimens


# -- the clinical vocabulary on the test tables (encoding C) ---------------------------
def q_clinical_regimen_topk(spark, sf):
    return build(spark, sf, "C").regimens


def q_clinical_coverage_heatmap(spark, sf):
    return build(spark, sf, "C").heatmap


def q_clinical_heat_note(spark, sf):
    return cov.heat_note(build(spark, sf, "C").heatmap)


def q_clinical_summary(spark, sf):
    return build(spark, sf, "C").summary


def q_clinical_document(spark, sf):
    """The whole document (all + byYear, years, notes) in the clinical layout."""
    return document_json(full_document(build(spark, sf, "C")))


def q_clinical_multimodal_by_stage(spark, sf):
    return build(spark, sf, "C").stages.select(
        "scope", "stage", "patients", "active_patients", "multimodal_patients", "multimodal_percent"
    )


# -- dashboard derivations ---------------------------------------------------------------
def dashboard_slice(b: CohortBuild, scope: str | DataFrame | None = None) -> DataFrame:
    """Q3 / F8: the top-of-page numbers of one scope, default the whole population.

    ``scope`` may also be a one-column DataFrame of scopes (kept by a semi-join,
    so a data-dependent choice never passes through the driver)."""
    if isinstance(scope, DataFrame):
        s = b.summary.join(scope.select(F.col(scope.columns[0]).alias("scope")), "scope", "left_semi")
    else:
        s = b.summary.where(F.col("scope") == F.lit(scope or ALL_SCOPE))
    return s.select(
        "scope",
        scope_label("scope").alias("scope_label"),
        fmt_count("known_patients").alias("known_fmt"),
        fmt_pct("multimodal_percent").alias("multimodal_fmt"),
        fmt_count("stage_count").alias("stage_count_fmt"),
        fmt_count("treatment_events").alias("events_fmt"),
        fmt_count("unknown_patients").alias("unknown_fmt"),
        headline("multimodal_patients", "active_patients").alias("headline"),
    )


def q_dashboard_slice(spark, sf):
    return dashboard_slice(build(spark, sf))


def q_dashboard_slice_latest(spark, sf):
    """F8 with a data-dependent scope: the latest registry year."""
    b = build(spark, sf)
    return dashboard_slice(b, b.years.agg(F.max("year").alias("scope")))


def q_headline(spark, sf):
    s = build(spark, sf).summary
    return s.select("scope", headline("multimodal_patients", "active_patients").alias("headline"))


def q_display_columns(spark, sf):
    b = build(spark, sf)
    return b.stages.select(
        "scope",
        "stage",
        scope_label("scope").alias("scope_label"),
        fmt_count("patients").alias("patients_fmt"),
        fmt_pct("multimodal_percent").alias("multimodal_fmt"),
        caution_flag("stage", b.spec.small_n_stage, "patients", b.spec.small_n_threshold).alias("caution"),
    ).withColumn("caution_note", E(caution_note_sql("caution")))


def q_regimen_display(spark, sf):
    r = build(spark, sf).regimens
    return r.select("scope", "stage", "rank", fmt_pct("percent").alias("percent_fmt"), fmt_count("count").alias("count_fmt"))


# -- document ----------------------------------------------------------------------------
def q_document(spark, sf):
    # one action: every branch sees the same rollup plans, so Spark reuses one
    # exchange per input (see rollup.entity_side_sql) and nothing is cached
    b = build(spark, sf)
    return document_rows(b).select("scope", F.to_json("dataset").alias("dataset_json"))


def q_document_roundtrip(spark, sf):
    b = build(spark, sf)
    text = document_rows(b).select("scope", F.to_json("dataset").alias("dataset_json"))
    return flatten_heatmap(text, b.spec)


def _read_back(spark, sf, encoding: str = "C") -> DataFrame:
    """The whole document as text, read back by the real reader."""
    return parse_document(document_json(full_document(build(spark, sf, encoding)), var_name="COHORT_DATA"))


def q_document_summary(spark, sf):
    return flatten_summary(document_scopes(_read_back(spark, sf)))


def q_document_stages(spark, sf):
    return flatten_stages(document_scopes(_read_back(spark, sf)))


def q_document_panels(spark, sf):
    return flatten_panels(document_scopes(_read_back(spark, sf)))


def q_document_heatmap(spark, sf):
    return flatten_heatmap(document_scopes(_read_back(spark, sf)), clinical_spec())


def q_document_heads(spark, sf):
    return document_heads(_read_back(spark, sf))


def _parts(spark, sf) -> str:
    """The document as one JSON a scope and a manifest, written under the shared folder."""
    from ..sources.sinks import write_document_parts

    path = shared_folder(spark, "document-parts")
    write_document_parts(build(spark, sf, "C"), path)
    return path


def q_document_parts_summary(spark, sf):
    from ..sources.sinks import read_document_parts

    return flatten_summary(read_document_parts(spark, _parts(spark, sf)))


def q_document_parts_heatmap(spark, sf):
    from ..sources.sinks import read_document_parts

    return flatten_heatmap(read_document_parts(spark, _parts(spark, sf)), clinical_spec())


def q_document_parts_manifest(spark, sf):
    from ..sources.sinks import read_manifest

    return document_heads(read_manifest(spark, _parts(spark, sf)), "manifest")


# -- more modalities than one bigint mask holds (encoding X) ------------------------------
def q_wide_entity_modality_set(spark, sf):
    b = build(spark, sf, "X")
    return reg.entity_sets(b.event_rollup, b.spec).join(_registry_scopes(b), "scope", "left_semi")


def q_wide_regimen_topk(spark, sf):
    return build(spark, sf, "X").regimens


def q_wide_coverage_heatmap(spark, sf):
    return build(spark, sf, "X").heatmap


def q_wide_modality_mix(spark, sf):
    return build(spark, sf, "X").modality_mix


def q_wide_multimodal_by_stage(spark, sf):
    return build(spark, sf, "X").stages.select(
        "scope", "stage", "patients", "active_patients", "multimodal_patients", "multimodal_percent"
    )


# -- the traps of SURVEY §1.1 (encoding T) -----------------------------------------------
def q_trap_regimen_topk(spark, sf):
    return build(spark, sf, "T").regimens


def q_trap_coverage_heatmap(spark, sf):
    return build(spark, sf, "T").heatmap


def q_trap_summary(spark, sf):
    return build(spark, sf, "T").summary


def q_trap_stage_totals(spark, sf):
    return build(spark, sf, "T").stages.select("scope", "stage", "label", "name", "color", "patients", "active_patients", "multimodal_patients")


def q_trap_stage_lookup(spark, sf):
    """Ids whose rows lack an order key are kept: such rows come before all others."""
    b = build(spark, sf, "T")
    return reg.entity_assignments(b.fact, b.spec).select("scope", "hn", "stage", "first_idx")


def q_variant_peak(spark, sf):
    """Peak of the variant with active denominators, where the snapshot states it."""
    return cov.coverage_peak(build(spark, sf, variant=True).heatmap)


def q_variant_trend(spark, sf):
    b = build(spark, sf, variant=True)
    return cov.coverage_trend(b.heatmap, b.spec)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "clean_text": q_clean_text,
    "clean_year": q_clean_year,
    "stage_rollup": q_stage_rollup,
    "known_stage_filter": q_known_stage_filter,
    "active_filter": q_active_filter,
    "non_active_filter": q_non_active_filter,
    "distinct_entity_modality": q_distinct_entity_modality,
    "years_list": q_years_list,
    "scoped_entities": q_scoped_entities,
    "stage_totals": q_stage_totals,
    "known_total": q_known_total,
    "event_total": q_event_total,
    "unknown_total": q_unknown_total,
    "unknown_total_override": q_unknown_total_override,
    "coverage_heatmap": q_coverage_heatmap,
    "coverage_heatmap_wide": q_coverage_heatmap_wide,
    "coverage_peak": q_coverage_peak,
    "coverage_trend": q_coverage_trend,
    "heat_intensity": q_heat_intensity,
    "entity_modality_set": q_entity_modality_set,
    "regimen_label": q_regimen_label,
    "entity_stage_lookup": q_entity_stage_lookup,
    "regimen_counts": q_regimen_counts,
    "regimen_topk": q_regimen_topk,
    "regimen_topk_wide": q_regimen_topk_wide,
    "multimodal_by_stage": q_multimodal_by_stage,
    "summary": q_summary,
    "active_denominator_heatmap": q_active_denominator_heatmap,
    "active_denominator_regimens": q_active_denominator_regimens,
    "regimen_topk_min_share": q_regimen_topk_min_share,
    "modality_mix_by_stage": q_modality_mix_by_stage,
    "clinical_regimen_topk": q_clinical_regimen_topk,
    "clinical_coverage_heatmap": q_clinical_coverage_heatmap,
    "clinical_heat_note": q_clinical_heat_note,
    "clinical_summary": q_clinical_summary,
    "clinical_multimodal_by_stage": q_clinical_multimodal_by_stage,
    "clinical_document": q_clinical_document,
    "stage_modality_flow": q_stage_modality_flow,
    "dashboard_slice": q_dashboard_slice,
    "dashboard_slice_latest": q_dashboard_slice_latest,
    "headline": q_headline,
    "display_columns": q_display_columns,
    "regimen_display": q_regimen_display,
    "document": q_document,
    "document_roundtrip": q_document_roundtrip,
    "document_summary": q_document_summary,
    "document_stages": q_document_stages,
    "document_panels": q_document_panels,
    "document_heatmap": q_document_heatmap,
    "document_heads": q_document_heads,
    "document_parts_summary": q_document_parts_summary,
    "document_parts_heatmap": q_document_parts_heatmap,
    "document_parts_manifest": q_document_parts_manifest,
    "trap_regimen_topk": q_trap_regimen_topk,
    "trap_coverage_heatmap": q_trap_coverage_heatmap,
    "trap_summary": q_trap_summary,
    "trap_stage_totals": q_trap_stage_totals,
    "trap_stage_lookup": q_trap_stage_lookup,
    "variant_coverage_peak": q_variant_peak,
    "variant_coverage_trend": q_variant_trend,
    "wide_entity_modality_set": q_wide_entity_modality_set,
    "wide_regimen_topk": q_wide_regimen_topk,
    "wide_coverage_heatmap": q_wide_coverage_heatmap,
    "wide_modality_mix": q_wide_modality_mix,
    "wide_multimodal_by_stage": q_wide_multimodal_by_stage,
    **INGEST_QUERIES,
}
