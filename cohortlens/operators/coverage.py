"""Coverage heatmap and its derivations.

Numerator: distinct entities per (event stage, modality) from the event table.
Denominator: distinct entities of that stage in the registry (or active
entities in the active-denominator variant).  The two populations differ on
purpose, so a cell may exceed 100 %.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.display import fmt_pct, heat_dark_text, heat_wash
from ..functions.numeric import bit_value_sql, pct
from ..functions.sql import E, lit
from ..spec import CohortSpec
from .rollup import event_side_sql


def coverage_cells(scopes: DataFrame, spec: CohortSpec, cells: DataFrame) -> DataFrame:
    """Wide-dimension path (more than 63 cells): the dense
    (scope, stage, treatment) grid with counts from the per-stage rollup
    ``cells`` (scope, hn, stage, cell_mask), attached by a small join."""
    grid_cells = ", ".join(
        f"named_struct('stage_ord', {s}, 'stage', {lit(st.code)}, 'heat_ord', {h}, 'treatment', {lit(row.value)}, "
        f"'label', {lit(row.label)})"
        for s, st in enumerate(spec.stages)
        for h, row in enumerate(spec.heatmap)
    )
    grid = scopes.select("scope", E(f"inline(array({grid_cells}))"))
    n_heat = len(spec.heatmap)
    per_stage = cells.groupBy("scope", "stage").agg(*[E(f"sum({bit_value_sql('cell_mask', h)})", f"c{h}") for h in range(n_heat)])
    pairs = ", ".join(f"named_struct('heat_ord', {h}, 'n', c{h})" for h in range(n_heat))
    long = per_stage.select("scope", "stage", E(f"inline(array({pairs}))"))
    joined = grid.join(long, ["scope", "stage", "heat_ord"], "left")
    return joined.select(*[c for c in joined.columns if c != "n"], E("coalesce(n, 0L)", "count"))


HEATMAP_COLUMNS = ["scope", "heat_ord", "treatment", "label", "stage_ord", "stage", "count", "percent"]


def coverage_heatmap_from_row(row: DataFrame, spec: CohortSpec, den_prefix: str) -> DataFrame:
    """A2 + J2 + J4 + P3 in one step: the per-scope row holds every cell count
    (``cov_s_h``) and every stage denominator (``<den_prefix>_s``), so the dense
    grid, its denominators and the percent come from one ``inline``, no join."""
    cells = ", ".join(
        f"named_struct('heat_ord', {h}, 'treatment', {lit(row_.value)}, 'label', {lit(row_.label)}, "
        f"'stage_ord', {s}, 'stage', {lit(st.code)}, 'count', cov_{s}_{h}, 'den', {den_prefix}_{s})"
        for s, st in enumerate(spec.stages)
        for h, row_ in enumerate(spec.heatmap)
    )
    grid = row.select("scope", E(f"inline(array({cells}))"))
    return grid.select(*HEATMAP_COLUMNS[:-1], pct("count", "den", spec.coverage_digits).alias("percent"))


def coverage_heatmap(cells: DataFrame, stages: DataFrame, spec: CohortSpec) -> DataFrame:
    """Wide-dimension path: attach the stage denominator and the percent."""
    den = stages.select("scope", "stage", "denominator")
    return cells.join(den, ["scope", "stage"]).select(
        *HEATMAP_COLUMNS[:-1], pct("count", "denominator", spec.coverage_digits).alias("percent")
    )


def coverage_peak(heatmap: DataFrame) -> DataFrame:
    """The stage with the highest percent per modality (ties -> earlier stage)."""
    key = F.struct(F.col("percent"), -F.col("stage_ord"))
    return heatmap.groupBy("scope", "treatment").agg(
        F.max_by("stage", key).alias("peak_stage"),
        F.max("percent").alias("peak_percent"),
        F.max_by("count", key).alias("peak_count"),
    )


def coverage_trend(heatmap: DataFrame, spec: CohortSpec) -> DataFrame:
    """Percent at the first and at the last stage, and the change."""
    last = len(spec.stages) - 1
    out = heatmap.groupBy("scope", "treatment").agg(
        F.max(F.when(F.col("stage_ord") == 0, F.col("percent"))).alias("first_percent"),
        F.max(F.when(F.col("stage_ord") == last, F.col("percent"))).alias("last_percent"),
    )
    return out.withColumn("change", F.col("last_percent") - F.col("first_percent"))


def heat_intensity(heatmap: DataFrame) -> DataFrame:
    """Cell wash and text contrast as the dashboard draws them."""
    return heatmap.select(
        "scope",
        "treatment",
        "stage",
        heat_wash("percent", "count").alias("wash"),
        heat_dark_text("percent", "count").alias("dark_text"),
        (F.col("count") == 0).alias("empty"),
    )


# The page's line under the coverage table, its modalities and stages.
HEAT_NOTE = (
    ("ADT ", "Hormone", "I"),
    (" ถึง ", "Hormone", "IV"),
    (" · รังสีสูงสุดที่ระยะ III ", "Radiation", "III"),
    (" · เคมีบำบัดเด่นในระยะ IV ", "Chemotherapy", "IV"),
)


def heat_note(heatmap: DataFrame, parts: tuple[tuple[str, str, str], ...] = HEAT_NOTE) -> DataFrame:
    """The line under the coverage table: one sentence a scope, of texts each followed by a cell's percent."""
    cells = [
        F.max(F.when((F.col("treatment") == value) & (F.col("stage") == stage), F.col("percent"))).alias(f"p{k}") for k, (_, value, stage) in enumerate(parts)
    ]
    shown = [x for k, (text, _, _) in enumerate(parts) for x in (F.lit(text), fmt_pct(f"p{k}"))]
    return heatmap.groupBy("scope").agg(*cells).select("scope", F.concat(*shown).alias("note"))


def stage_modality_flow(heatmap: DataFrame) -> DataFrame:
    """Q6: stage -> modality edges, the non-zero coverage cells."""
    return heatmap.where(F.col("count") > 0).select("scope", "stage", "treatment", F.col("count").alias("n"))


def modality_mix(ev: DataFrame, scopes: DataFrame, spec: CohortSpec, cells: DataFrame | None = None) -> DataFrame:
    """Q5: per (scope, event stage), the share of each active modality among
    distinct (entity, modality) pairs.

    An entity's cells say which pairs it has, so the counts are sums of the
    event rollup's cell bits; past 63 cells, of the per-stage rollup ``cells``."""
    places = {m.value: spec.cell_values.index(m.value) for m in spec.modalities}
    n_values = len(spec.cell_values)

    def row(stage: str, m, n: str) -> str:
        return f"named_struct('stage', {stage}, 'treatment', {lit(m.value)}, 'label', {lit(m.short)}, 'n', {n})"

    if cells is None:
        named = [(s, st, m, f"mix_{s}_{k}") for s, st in enumerate(spec.stages) for k, m in enumerate(spec.modalities)]
        sums = [E(f"sum({bit_value_sql('cov_mask', s * n_values + places[m.value])})", c) for s, _, m, c in named]
        wide = ev.where(E(event_side_sql(spec))).groupBy("scope").agg(*sums)
        rows = ", ".join(row(lit(st.code), m, c) for _, st, m, c in named)
    else:
        sums = [E(f"sum({bit_value_sql('cell_mask', places[m.value])})", f"mix_{k}") for k, m in enumerate(spec.modalities)]
        wide = cells.groupBy("scope", "stage").agg(*sums)
        rows = ", ".join(row("stage", m, f"mix_{k}") for k, m in enumerate(spec.modalities))
    kept = wide.join(scopes.select("scope"), "scope")  # registry scopes only (one row per scope)
    pairs = kept.select("scope", E(f"inline(array({rows}))")).where("n > 0")
    pairs = pairs.withColumn("total", F.sum("n").over(Window.partitionBy("scope", "stage")))
    return pairs.select("scope", "stage", "treatment", "label", "n", pct("n", "total", 1).alias("share"))
