"""Per-(scope, entity) rollups: the core outputs' only passes over raw rows.

Both rollups group by ``(scope, hn)`` with fixed-width aggregates only
(``bit_or``, ``min``, ``max_by``, ``count``), so Spark runs a partial
aggregation before the shuffle.  A hot id (for instance the pseudo-patient
that all id-less rows collapse into) is reduced to one row per map task
before it is shuffled, and after the rollup each key holds exactly one row.

Because both sides come out hash-partitioned on ``(scope, hn)``, joining them
into the fact table needs no further exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import any_bit_sql, bit_sql, bit_word_sql, mask_words, ordinal_sql
from ..functions.sql import E, arr, lit
from ..spec import CohortSpec
from .scope import with_scope



def stage_words(spec: CohortSpec) -> list[str]:
    return mask_words("stage_mask", len(spec.stages))


def act_words(spec: CohortSpec) -> list[str]:
    return mask_words("act_mask", len(spec.modalities))


def cell_words(spec: CohortSpec) -> list[str]:
    """Words of the masks by stage (``cell_rollup``)."""
    return mask_words("cell_mask", len(spec.cell_values))


# A row without an order key comes before every row that has one.
ORDER_KEY = "coalesce(row_idx, -9223372036854775808L)"


def entity_rollup(entities: DataFrame, spec: CohortSpec) -> DataFrame:
    """(scope, hn) -> lookup_stage (J1: last row wins; rows without an order key come first), stage_mask (stages the id appears in).

    The last-wins pick runs on the stage *ordinal* so every aggregate buffer is
    fixed width (hash aggregation, no sort); the code is looked up afterwards."""
    return (
        with_scope(entities.select("hn", "year", E(ORDER_KEY, "row_idx"), E(ordinal_sql("stage", spec.stage_codes), "stage_ord")), spec)
        .groupBy("scope", "hn")
        .agg(
            F.max_by("stage_ord", "row_idx").alias("lookup_ord"),
            *[F.bit_or(E(bit_word_sql("stage_ord", w, len(spec.stages)))).alias(c) for w, c in enumerate(stage_words(spec))],
        )
        .select(
            "scope",
            "hn",
            E(f"CASE WHEN lookup_ord >= 0 THEN element_at({arr(spec.stage_codes)}, lookup_ord + 1) END", "lookup_stage"),
            *stage_words(spec),
        )
    )


def event_bits(events: DataFrame, spec: CohortSpec) -> DataFrame:
    """Per event row: cell bit and active-modality bit (0 when not applicable), and the modality's place among the cells."""
    allowed = f"NOT (treatment IN ({', '.join(lit(v) for v in spec.non_active)}))" if spec.non_active else "true"
    stage_ord = ordinal_sql("stage", spec.stage_codes)
    value_ord = ordinal_sql("treatment", spec.cell_values)
    act_ord = ordinal_sql("treatment", [m.value for m in spec.regimen_modalities()])
    n_values, n_act = len(spec.cell_values), len(spec.modalities)
    cell_pos = f"CASE WHEN {allowed} AND {value_ord} >= 0 AND {stage_ord} >= 0 THEN {stage_ord} * {n_values} + {value_ord} ELSE -1 END"
    act_pos = f"CASE WHEN {allowed} AND {act_ord} >= 0 THEN {act_ord} ELSE -1 END"
    return events.select(
        "hn",
        "year",
        "stage",
        E(ORDER_KEY, "row_idx"),
        E(bit_sql(cell_pos) if spec.cells_fit_one_mask() else "0L", "cell_bit"),
        *[E(bit_word_sql(act_pos, w, n_act), c) for w, c in enumerate(act_words(spec))],
        E(f"CASE WHEN {allowed} AND {value_ord} >= 0 THEN {value_ord} ELSE -1 END", "value_ord"),
    )


def event_rollup(events: DataFrame, spec: CohortSpec) -> DataFrame:
    """(scope, hn) -> cov_mask (cells), act_mask (active set, regimen bit
    order), first_idx (first active event, for first-seen tie order), n_events."""
    bits = with_scope(event_bits(events, spec), spec)
    aggs = [
        *[F.bit_or(c).alias(c) for c in act_words(spec)],
        F.min(F.when(E(any_bit_sql(act_words(spec))), F.col("row_idx"))).alias("first_idx"),
        F.count(F.lit(1)).alias("n_events"),
    ]
    if spec.cells_fit_one_mask():
        aggs.insert(0, F.bit_or("cell_bit").alias("cov_mask"))
    return bits.groupBy("scope", "hn").agg(*aggs)


def cell_rollup(events: DataFrame, spec: CohortSpec) -> DataFrame:
    """Wide-dimension path for coverage and mix (more than 63 cells):
    (scope, hn, stage) -> cell_mask, of as many words as the cell values need."""
    bits = with_scope(event_bits(events, spec), spec)
    words = [F.bit_or(E(bit_word_sql("value_ord", w, len(spec.cell_values)))).alias(c) for w, c in enumerate(cell_words(spec))]
    return bits.where(F.col("value_ord") >= 0).groupBy("scope", "hn", "stage").agg(*words)


# Every consumer of a rollup filters on these predicates, true by construction:
# F1 leaves known stages only and ORDER_KEY is never null, so no aggregate over
# at least one row of a side is null.  They reference every rollup column, so column pruning leaves each consumer with
# the *same* rollup plan and Spark reuses one exchange per input instead of
# rolling the raw rows up again for each output.  On the fact table they also
# drop the rows of the other side, which contribute nothing to that side's
# metrics.  A count is known not to be null, so only a comparison keeps it; the
# scope is named as the joins on it would otherwise add that to some consumers only.
def entity_side_sql(spec: CohortSpec) -> str:
    return "(scope IS NOT NULL AND lookup_stage IS NOT NULL AND " + " AND ".join(f"{c} IS NOT NULL" for c in stage_words(spec)) + ")"


def event_side_sql(spec: CohortSpec) -> str:
    cov = " AND cov_mask IS NOT NULL" if spec.cells_fit_one_mask() else ""
    return f"(n_events > 0 AND (first_idx IS NOT NULL) = {any_bit_sql(act_words(spec))}{cov})"


def fact_table(ent: DataFrame, ev: DataFrame) -> DataFrame:
    """One row per (scope, hn) seen on either side."""
    return ent.join(ev, ["scope", "hn"], "full_outer")
