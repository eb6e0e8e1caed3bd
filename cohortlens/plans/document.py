"""Nested document assembly and read-back.

The engine's results are flat tables keyed by ``scope``; the nested document
is only the last step.  Every collect here gathers a bounded number of rows
(stages x regimens <= top_k + 1, stages x heatmap rows) per scope, and the full
document gathers one dataset per scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import ordinal, pct_sql
from ..functions.sql import E, lit
from ..spec import ALL_SCOPE, CohortSpec
from .cohort import CohortBuild


def _by_key(arr, key: str = "k"):
    """array_sort on one orderable field (the payload may hold maps, which have no order)."""
    return F.array_sort(
        arr,
        lambda a, b: F.when(a.getField(key) < b.getField(key), -1).when(a.getField(key) > b.getField(key), 1).otherwise(0),
    )

SUMMARY_TYPE = (
    "struct<knownStagePatients:bigint,treatmentEvents:bigint,stageCount:int,unknownStagePatients:bigint,"
    "activePatients:bigint,multimodalPatients:bigint,multimodalPercent:double>"
)
STAGE_TYPE = "struct<stage:string,label:string,name:string,color:string,patients:bigint>"
HEAT_TYPE = "struct<treatment:string,label:string,stages:map<string,struct<count:bigint,percent:double>>>"
REGIMEN_TYPE = "struct<name:string,count:bigint,percent:double,width:double,combined:boolean>"
PANEL_TYPE = (
    "struct<stage:string,label:string,name:string,color:string,patients:bigint,activePatients:bigint,"
    f"multimodalPatients:bigint,multimodalPercent:double,regimens:array<{REGIMEN_TYPE}>>"
)
DATASET_TYPE = (
    f"struct<summary:{SUMMARY_TYPE},stages:array<{STAGE_TYPE}>,heatmap:array<{HEAT_TYPE}>,panels:array<{PANEL_TYPE}>>"
)
DOCUMENT_TYPE = (
    f"struct<sourceFile:string,years:array<string>,all:{DATASET_TYPE},byYear:map<string,{DATASET_TYPE}>,notes:array<string>>"
)


def document_rows(b: CohortBuild) -> DataFrame:
    """One row per scope: (scope, dataset) with the document's nested layout.

    The per-scope metrics row already holds every stage size and coverage
    cell, so summary, stages, heatmap and the panel shells are expressions over
    it; only the regimens need one grouping (bounded: stages x (k + 1) rows
    per scope) and one join on scope."""
    if not b.spec.cells_fit_one_mask():
        return _document_rows_long(b)
    spec = b.spec
    regs = b.regimens.groupBy("scope").agg(
        F.collect_list(F.struct("stage", "rank", F.col("regimen").alias("name"), "count", "percent", "width", "combined")).alias("regs")
    )
    den = "patients" if spec.denominator == "all" else "active"
    n_heat = len(spec.heatmap)
    stages = ", ".join(
        f"named_struct('stage', {lit(st.code)}, 'label', {lit(st.label)}, 'name', {lit(st.name)}, 'color', {lit(st.color)}, 'patients', patients_{i})"
        for i, st in enumerate(spec.stages)
    )
    heat = ", ".join(
        f"named_struct('treatment', {lit(h.value)}, 'label', {lit(h.label)}, 'stages', map("
        + ", ".join(
            f"{lit(st.code)}, named_struct('count', cov_{i}_{j}, 'percent', {pct_sql(f'cov_{i}_{j}', f'{den}_{i}', spec.coverage_digits)})"
            for i, st in enumerate(spec.stages)
        )
        + "))"
        for j, h in enumerate(spec.heatmap)
    )
    reg_fields = "named_struct('name', r.name, 'count', r.count, 'percent', r.percent, 'width', r.width, 'combined', r.combined)"
    panels = ", ".join(
        f"named_struct('stage', {lit(st.code)}, 'label', {lit(st.label)}, 'name', {lit(st.name)}, 'color', {lit(st.color)}, "
        f"'patients', patients_{i}, 'activePatients', active_{i}, 'multimodalPatients', multimodal_{i}, "
        f"'multimodalPercent', {pct_sql(f'multimodal_{i}', f'active_{i}', spec.multimodal_digits)}, "
        f"'regimens', transform(array_sort(filter(coalesce(regs, array()), r -> r.stage = {lit(st.code)}), "
        f"(a, c) -> CASE WHEN a.rank < c.rank THEN -1 WHEN a.rank > c.rank THEN 1 ELSE 0 END), r -> {reg_fields}))"
        for i, st in enumerate(spec.stages)
    )
    summary = (
        "named_struct('knownStagePatients', known_patients, 'treatmentEvents', treatment_events, "
        "'stageCount', CAST(stage_count AS INT), 'unknownStagePatients', unknown_patients, "
        "'activePatients', active_patients, 'multimodalPatients', multimodal_patients, 'multimodalPercent', multimodal_percent)"
    )
    dataset = f"named_struct('summary', {summary}, 'stages', array({stages}), 'heatmap', array({heat}), 'panels', array({panels}))"
    return b.metrics.join(regs, "scope", "left").select("scope", E(dataset, "dataset"))


def _document_rows_long(b: CohortBuild) -> DataFrame:
    """Wide-dimension path: assemble from the long stage / heatmap / regimen tables."""
    regs = b.regimens.groupBy("scope", "stage").agg(
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        F.col("rank").alias("k"),
                        F.struct(
                            F.col("regimen").alias("name"), "count", "percent", "width", "combined"
                        ).alias("v"),
                    )
                )
            ),
            lambda x: x.getField("v"),
        ).alias("regimens")
    )
    panel_rows = b.stages.join(regs, ["scope", "stage"], "left").select(
        "scope",
        F.struct(
            F.col("stage_ord").alias("k"),
            F.struct("stage", "label", "name", "color", "patients").alias("v"),
        ).alias("stage_item"),
        F.struct(
            F.col("stage_ord").alias("k"),
            F.struct(
                "stage",
                "label",
                "name",
                "color",
                "patients",
                F.col("active_patients").alias("activePatients"),
                F.col("multimodal_patients").alias("multimodalPatients"),
                F.col("multimodal_percent").alias("multimodalPercent"),
                F.coalesce(F.col("regimens"), F.array().cast(f"array<{REGIMEN_TYPE}>")).alias("regimens"),
            ).alias("v"),
        ).alias("panel_item"),
    )
    per_scope_stages = panel_rows.groupBy("scope").agg(
        F.transform(F.array_sort(F.collect_list("stage_item")), lambda x: x.getField("v")).alias("stages"),
        F.transform(F.array_sort(F.collect_list("panel_item")), lambda x: x.getField("v")).alias("panels"),
    )
    heat_rows = b.heatmap.groupBy("scope", "heat_ord", "treatment", "label").agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(F.collect_list(F.struct("stage_ord", "stage", F.struct("count", "percent").alias("cell")))),
                lambda x: F.struct(x.getField("stage").alias("key"), x.getField("cell").alias("value")),
            )
        ).alias("stages")
    )
    per_scope_heat = heat_rows.groupBy("scope").agg(
        F.transform(
            _by_key(F.collect_list(F.struct(F.col("heat_ord").alias("k"), F.struct("treatment", "label", "stages").alias("v")))),
            lambda x: x.getField("v"),
        ).alias("heatmap")
    )
    s = b.summary
    summary = F.struct(
        F.col("known_patients").alias("knownStagePatients"),
        F.col("treatment_events").alias("treatmentEvents"),
        F.col("stage_count").cast("int").alias("stageCount"),
        F.col("unknown_patients").alias("unknownStagePatients"),
        F.col("active_patients").alias("activePatients"),
        F.col("multimodal_patients").alias("multimodalPatients"),
        F.col("multimodal_percent").alias("multimodalPercent"),
    )
    return (
        s.join(per_scope_stages, "scope", "left")
        .join(per_scope_heat, "scope", "left")
        .select("scope", F.struct(summary.alias("summary"), "stages", "heatmap", "panels").alias("dataset"))
    )


def source_column(b: CohortBuild, source_name: str | None = None) -> Column:
    """The given name, or the names of the scanned files, in order."""
    if source_name is None:
        source_name = b.inputs.source_name
    if source_name or b.inputs.source_files is None:
        return F.lit(source_name)
    names = F.array_join(F.array_sort(F.collect_set("name")), "+")
    return b.inputs.source_files.agg(names.alias("names")).scalar()


def manifest(b: CohortBuild, source_name: str | None = None) -> DataFrame:
    """The document without its datasets: one row (sourceFile, years, scopes, notes)."""
    scopes = b.entity_metrics.select("scope")
    years = F.array_sort(F.collect_list(F.when(F.col("scope") != ALL_SCOPE, F.col("scope"))))
    notes = F.array(*[F.lit(n) for n in b.spec.notes]).cast("array<string>")
    return scopes.agg(years.alias("years")).select(
        F.struct(
            source_column(b, source_name).alias("sourceFile"),
            "years",
            F.concat(F.array(F.lit(ALL_SCOPE)), "years").alias("scopes"),
            notes.alias("notes"),
        ).alias("manifest")
    )


MANIFEST_TYPE = "struct<sourceFile:string,years:array<string>,scopes:array<string>,notes:array<string>>"


def full_document(b: CohortBuild, source_name: str | None = None) -> DataFrame:
    """Q2: one row holding the whole document (all + byYear + years + notes).

    The year scopes are exactly the registry years, so the year list, the
    ``all`` dataset and the ``byYear`` map come from one global aggregation."""
    rows = document_rows(b)
    is_all = F.col("scope") == ALL_SCOPE
    agg = rows.agg(
        F.array_sort(F.collect_list(F.when(~is_all, F.col("scope")))).alias("years"),
        F.first(F.when(is_all, F.col("dataset")), ignorenulls=True).alias("all"),
        F.map_from_entries(_by_key(F.collect_list(F.when(~is_all, F.struct("scope", "dataset"))), "scope")).alias("byYear"),
    )
    notes = F.array(*[F.lit(n) for n in b.spec.notes]).cast("array<string>")
    return agg.select(
        F.struct(
            source_column(b, source_name).alias("sourceFile"),
            "years",
            "all",
            "byYear",
            notes.alias("notes"),
        ).alias("document")
    )


def document_json(doc: DataFrame, var_name: str | None = None) -> DataFrame:
    """The document as one JSON text (optionally wrapped as a script assignment)."""
    body = F.to_json("document")
    if var_name:
        body = F.concat(F.lit(f"window.{var_name} = "), body, F.lit(";"))
    return doc.select(body.alias("value"))


def parse_document(text: DataFrame) -> DataFrame:
    """Read a document text back (JSON, or JSON wrapped in ``name = ...;``)."""
    body = F.regexp_replace(F.regexp_replace(F.col("value"), r"^[^{]*", ""), r";\s*$", "")
    return text.select(F.from_json(body, DOCUMENT_TYPE).alias("document"))


def document_scopes(parsed: DataFrame) -> DataFrame:
    """Document -> (scope, dataset) rows, the inverse of ``full_document``."""
    d = F.col("document")
    # no year scope is named like the whole population, so the keys are distinct
    whole = F.create_map(F.lit(ALL_SCOPE), d.getField("all"))
    scopes = F.when(d.getField("byYear").isNull(), whole).otherwise(F.map_concat(whole, d.getField("byYear")))
    return parsed.select(F.explode(scopes).alias("scope", "dataset"))


def flatten_heatmap(rows: DataFrame, spec: CohortSpec) -> DataFrame:
    """(scope, dataset_json | dataset) -> flat coverage rows, as the heatmap table."""
    if "dataset_json" in rows.columns:
        rows = rows.select("scope", F.from_json("dataset_json", DATASET_TYPE).alias("dataset"))
    heat = rows.select("scope", F.posexplode(F.col("dataset").getField("heatmap")).alias("heat_ord", "h"))
    cells = heat.select(
        "scope",
        F.col("heat_ord").cast("int").alias("heat_ord"),
        F.col("h").getField("treatment").alias("treatment"),
        F.col("h").getField("label").alias("label"),
        F.explode(F.col("h").getField("stages")).alias("stage", "cell"),
    )
    return cells.select(
        "scope",
        "heat_ord",
        "treatment",
        "label",
        ordinal("stage", spec.stage_codes).alias("stage_ord"),
        "stage",
        F.col("cell").getField("count").alias("count"),
        F.col("cell").getField("percent").alias("percent"),
    )


def _datasets(rows: DataFrame) -> DataFrame:
    return rows.select("scope", F.from_json("dataset_json", DATASET_TYPE).alias("dataset")) if "dataset_json" in rows.columns else rows


def flatten_summary(rows: DataFrame) -> DataFrame:
    """(scope, dataset) -> the summary fields of every scope."""
    return _datasets(rows).select("scope", "dataset.summary.*")


def flatten_panels(rows: DataFrame) -> DataFrame:
    """(scope, dataset) -> every regimen of every panel, with its place and the panel's stage data."""
    panels = _datasets(rows).select("scope", F.posexplode("dataset.panels").alias("panel", "p"))
    return panels.select("scope", "panel", "p.*").select("*", F.posexplode_outer("regimens").alias("place", "r")).select(
        "scope",
        F.col("panel").cast("int").alias("panel"),
        "stage",
        "label",
        F.col("name").alias("stage_name"),
        "color",
        "patients",
        "activePatients",
        "multimodalPatients",
        "multimodalPercent",
        F.col("place").cast("int").alias("place"),
        F.col("r.name").alias("regimen"),
        F.col("r.count").alias("count"),
        F.col("r.percent").alias("percent"),
        F.col("r.width").alias("width"),
        F.col("r.combined").alias("combined"),
    )


def flatten_stages(rows: DataFrame) -> DataFrame:
    """(scope, dataset) -> the stages of every scope, in order."""
    return _datasets(rows).select("scope", F.posexplode("dataset.stages").alias("place", "s")).select(
        "scope", F.col("place").cast("int").alias("place"), "s.*"
    )


def document_heads(parsed: DataFrame, of: str = "document") -> DataFrame:
    """The document's own lists (or a manifest's): (part, place, value) of sourceFile, years and notes."""
    listed = f"transform({of}.{{0}}, (v, i) -> named_struct('part', '{{0}}', 'place', i, 'value', v))"
    head = f"array(named_struct('part', 'sourceFile', 'place', 0, 'value', {of}.sourceFile))"
    return parsed.select(E(f"inline(concat({head}, {listed.format('years')}, {listed.format('notes')}))"))
