"""Cleaning and the known-stage / modality filters."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sql import E
from ..functions.text import clean_text_sql, clean_year_sql, stage_rollup_sql
from ..model import CohortInputs
from ..spec import CohortSpec


def _stage_sql(spec: CohortSpec, rollup_pattern: str | None) -> str:
    stage = clean_text_sql("stage", spec.sentinel)
    return stage_rollup_sql(stage, spec.sentinel, rollup_pattern) if rollup_pattern else stage


def clean_entities(df: DataFrame, spec: CohortSpec, rollup_pattern: str | None = None) -> DataFrame:
    return df.select(
        E(clean_text_sql("hn", spec.sentinel), "hn"),
        E(clean_year_sql("year", spec.sentinel), "year"),
        E(_stage_sql(spec, rollup_pattern), "stage"),
        "row_idx",
    )


def clean_events(df: DataFrame, spec: CohortSpec, rollup_pattern: str | None = None) -> DataFrame:
    return df.select(
        E(clean_text_sql("hn", spec.sentinel), "hn"),
        E(clean_year_sql("year", spec.sentinel), "year"),
        E(_stage_sql(spec, rollup_pattern), "stage"),
        E(clean_text_sql("treatment", spec.sentinel), "treatment"),
        "row_idx",
    )


def clean_unknown(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """The unknown sheet's id is deliberately not cleaned: nulls drop out of the
    distinct count, whitespace variants stay distinct."""
    return df.select(F.col("hn").cast("string").alias("hn"), E(clean_year_sql("year", spec.sentinel), "year"))


def known_stage(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """keep rows whose stage is one of the spec's stages."""
    return df.filter(F.col("stage").isin(spec.stage_codes))


def not_blacklisted(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """drop non-active modalities."""
    return df.filter(~F.col("treatment").isin(list(spec.non_active)))


def active_only(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """F3 (after F2): keep whitelisted modalities."""
    return not_blacklisted(df, spec).filter(F.col("treatment").isin(spec.active_values))


def distinct_entity_modality(events: DataFrame, spec: CohortSpec) -> DataFrame:
    """Distinct (hn, stage, treatment) triples outside the blacklist."""
    return not_blacklisted(events, spec).select("hn", "stage", "treatment").dropDuplicates()


def _raw_stage_prefilter(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """A null stage cleans to the sentinel, which F1 drops unless the sentinel is
    itself a stage: filtering the raw column first lets the scan skip those rows
    (a pushed-down ``IsNotNull``) before any cleaning runs."""
    return df if spec.sentinel in spec.stage_codes else df.where(F.col("stage").isNotNull())


def prepare(inputs: CohortInputs, spec: CohortSpec, rollup_pattern: str | None = None) -> CohortInputs:
    """Clean all three tables and apply F1 to entities and events."""
    ents = _raw_stage_prefilter(inputs.entities, spec)
    evs = _raw_stage_prefilter(inputs.events, spec)
    return replace(
        inputs,
        entities=known_stage(clean_entities(ents, spec, rollup_pattern), spec),
        events=known_stage(clean_events(evs, spec, rollup_pattern), spec),
        unknown=clean_unknown(inputs.unknown, spec),
    )
