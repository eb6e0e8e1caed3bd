"""Per-scope metrics (A1, A5-A11, A14) and the stage table.

Everything scalar about a scope comes from grouped aggregations by ``scope``
with fixed-width sums (a partial aggregation per map task, then at most one
row per task and scope crosses the shuffle):

* entity side  -> known ids and ids per stage (``stage_mask`` bits),
* event side   -> event count and coverage cells (``cov_mask`` bits),
* regimen side -> active and multi-modality ids per stage, summed from the
  already tiny regimen counts.

They are joined on ``scope`` into one wide row per scope; the stage table and
the coverage grid are ``inline`` explodes of that row, so zero cells exist
without any join to a dimension product.  Keeping the sides separate lets a
query that needs only the stage sizes (regimen percentages) avoid a second
pass over the events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import bit_value_sql, count_bits_sql, mask_words, pct_sql
from ..functions.sql import E, lit
from ..spec import ALL_SCOPE, CohortSpec
from .rollup import entity_side_sql, event_side_sql, stage_words
from .scope import with_scope


def _zero(c):
    return F.coalesce(c, F.lit(0).cast("bigint"))


def unknown_counts(unknown: DataFrame, spec: CohortSpec) -> DataFrame:
    """A11 per scope: distinct non-null unknown-stage ids (override applied later)."""
    return (
        with_scope(unknown.where(F.col("hn").isNotNull()), spec)
        .groupBy("scope")
        .agg(F.count_distinct("hn").alias("unknown_patients"))
    )


def entity_metrics(ent: DataFrame, spec: CohortSpec) -> DataFrame:
    """A1 + A8 per registry scope from the entity rollup (or the fact table)."""
    aggs = [F.count("stage_mask").alias("known_patients")]
    aggs += [E(f"coalesce(sum({bit_value_sql('stage_mask', i)}), 0L)", f"patients_{i}") for i in range(len(spec.stages))]
    # An empty 'all' row so the whole-population scope exists even with no input.
    seed = ent.sparkSession.range(1).select(F.lit(ALL_SCOPE).alias("scope"))
    rows = ent.where(E(entity_side_sql(spec))).select("scope", *stage_words(spec)).unionByName(seed, allowMissingColumns=True)
    return rows.groupBy("scope").agg(*aggs).where((F.col("known_patients") > 0) | (F.col("scope") == ALL_SCOPE))


def event_metrics(ev: DataFrame, spec: CohortSpec) -> DataFrame:
    """A9 + coverage cell counts per scope from the event rollup (or the fact table)."""
    n_heat, n_values = len(spec.heatmap), len(spec.cell_values)
    aggs = [_zero(F.sum("n_events")).alias("treatment_events")]
    if spec.cells_fit_one_mask():
        for s in range(len(spec.stages)):
            for h in range(n_heat):
                aggs.append(E(f"coalesce(sum({bit_value_sql('cov_mask', s * n_values + h)}), 0L)", f"cov_{s}_{h}"))
    return ev.where(E(event_side_sql(spec))).groupBy("scope").agg(*aggs)


def set_metrics(regimen_counts: DataFrame, spec: CohortSpec) -> DataFrame:
    """A5 + A6 per scope and stage, summed from the (tiny) regimen counts."""
    aggs = []
    several = f"{count_bits_sql(mask_words('mask', len(spec.modalities)))} >= 2"
    for i, st in enumerate(spec.stages):
        aggs.append(E(f"coalesce(sum(CASE WHEN stage = {lit(st.code)} THEN n END), 0L)", f"active_{i}"))
        aggs.append(E(f"coalesce(sum(CASE WHEN stage = {lit(st.code)} AND {several} THEN n END), 0L)", f"multimodal_{i}"))
    return regimen_counts.groupBy("scope").agg(*aggs)


def coverage_row(base: DataFrame, ev_m: DataFrame, den_prefix: str, spec: CohortSpec) -> DataFrame:
    """Registry scopes with their stage denominators (``<den_prefix>_s`` columns
    of ``base``) and coverage-cell counts (zero when a scope has no events)."""
    dens = [f"{den_prefix}_{i}" for i in range(len(spec.stages))]
    cells = [c for c in ev_m.columns if c.startswith("cov_")]
    out = base.select("scope", *dens).join(ev_m.select("scope", *cells), "scope", "left")
    return out.select("scope", *dens, *[E(f"coalesce({c}, 0L)", c) for c in cells])


def core_metrics(ent_m: DataFrame, set_m: DataFrame, spec: CohortSpec) -> DataFrame:
    """Registry scopes with stage sizes and active / multi-modality counts."""
    out = ent_m.join(set_m, "scope", "left")
    filled = {c for i in range(len(spec.stages)) for c in (f"active_{i}", f"multimodal_{i}")}
    return out.select(*[E(f"coalesce({c}, 0L)", c) if c in filled else c for c in out.columns])


def scope_metrics(
    core: DataFrame,
    ev_m: DataFrame,
    unknown: DataFrame,
    spec: CohortSpec,
    unknown_override: int | None = None,
) -> DataFrame:
    """One wide row per registry scope (``all`` plus every registry year)."""
    metrics = core.join(ev_m, "scope", "left").join(unknown_counts(unknown, spec), "scope", "left")
    zeroed = {"treatment_events", "unknown_patients"} | {c for c in ev_m.columns if c.startswith("cov_")}
    cols = [E(f"coalesce({c}, 0L)", c) if c in zeroed else c for c in metrics.columns]
    n = len(spec.stages)
    active = " + ".join(f"active_{i}" for i in range(n)) or "0L"
    multi = " + ".join(f"multimodal_{i}" for i in range(n)) or "0L"
    metrics = metrics.select(*cols, E(f"CAST({active} AS BIGINT)", "active_patients"), E(f"CAST({multi} AS BIGINT)", "multimodal_patients"))
    unknown_col = "unknown_patients"
    if unknown_override is not None:
        unknown_col = f"CASE WHEN scope = {lit(ALL_SCOPE)} THEN {int(unknown_override)}L ELSE unknown_patients END"
    keep = [c for c in metrics.columns if c != "unknown_patients"]
    return metrics.select(
        *keep,
        E(unknown_col, "unknown_patients"),
        E(pct_sql("multimodal_patients", "active_patients", spec.multimodal_digits), "multimodal_percent"),
        E(f"{n}", "stage_count"),
    )


SUMMARY_COLUMNS = [
    "scope",
    "known_patients",
    "treatment_events",
    "stage_count",
    "unknown_patients",
    "active_patients",
    "multimodal_patients",
    "multimodal_percent",
]


def summary(metrics: DataFrame) -> DataFrame:
    """A8-A11, A14 and the overall multi-modality share, one row per scope."""
    return metrics.select(*SUMMARY_COLUMNS)


def stage_table(metrics: DataFrame, spec: CohortSpec) -> DataFrame:
    """A1 + A5-A7 per (scope, stage), every stage present (zero-filled)."""
    rows = ", ".join(
        f"named_struct('stage_ord', {i}, 'stage', {lit(st.code)}, 'label', {lit(st.label)}, 'name', {lit(st.name)}, "
        f"'color', {lit(st.color)}, 'patients', patients_{i}, 'active_patients', active_{i}, 'multimodal_patients', multimodal_{i})"
        for i, st in enumerate(spec.stages)
    )
    den = "patients" if spec.denominator == "all" else "active_patients"
    out = metrics.select("scope", E(f"inline(array({rows}))"))
    return out.select(
        "*",
        E(pct_sql("multimodal_patients", "active_patients", spec.multimodal_digits), "multimodal_percent"),
        E(den, "denominator"),
    )


def stage_sizes(ent_m: DataFrame, spec: CohortSpec) -> DataFrame:
    """(scope, stage, denominator = ids in the stage) from the entity side only."""
    rows = ", ".join(f"named_struct('stage', {lit(st.code)}, 'denominator', patients_{i})" for i, st in enumerate(spec.stages))
    return ent_m.select("scope", E(f"inline(array({rows}))"))
