"""Regimens: per-entity modality sets ranked per stage.

The entity's set comes from events of every stage, its stage from the
registry (last row wins).  Regimen frequency is a grouped count by
``(scope, stage, mask)``: the mask already sorts the labels into clinical
order, so no per-row string work happens before the aggregation.

Ties are broken first-seen: an entity's ``first_idx`` is its earliest active
event, a regimen's is the minimum over its entities; rank orders by
``(count desc, first_idx asc)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import any_bit_sql, combined_sql, count_bits_sql, decode_mask, decode_mask_sql, mask_words, pct_sql
from ..functions.sql import E, lit
from ..spec import CohortSpec
from .rollup import act_words, entity_side_sql, event_side_sql


def _words(spec: CohortSpec) -> list[str]:
    """The set's mask in the regimen tables."""
    return mask_words("mask", len(spec.modalities))


def regimen_name(mask: str, spec: CohortSpec):
    return decode_mask(mask, [m.short for m in spec.regimen_modalities()])


def regimen_name_sql(mask: str, spec: CohortSpec) -> str:
    return decode_mask_sql(mask, [m.short for m in spec.regimen_modalities()])


def entity_sets(ev: DataFrame, spec: CohortSpec) -> DataFrame:
    """A3 + P5: (scope, hn) -> modality count, first active event, regimen name."""
    return ev.where(E(any_bit_sql(act_words(spec)))).select(
        "scope",
        "hn",
        E(f"CAST({count_bits_sql(act_words(spec))} AS INT)", "n_modalities"),
        "first_idx",
        regimen_name("act_mask", spec).alias("regimen"),
    )


def entity_assignments(fact: DataFrame, spec: CohortSpec) -> DataFrame:
    """J1 + F6: entities with a registry stage and a non-empty active set."""
    keep = f"{entity_side_sql(spec)} AND {event_side_sql(spec)} AND {any_bit_sql(act_words(spec))}"
    return fact.where(E(keep)).select(
        "scope",
        "hn",
        F.col("lookup_stage").alias("stage"),
        *[F.col(a).alias(m) for a, m in zip(act_words(spec), _words(spec))],
        "first_idx",
    )


def regimen_counts(fact: DataFrame, spec: CohortSpec) -> DataFrame:
    """A4: (scope, stage, regimen) -> entities, first_idx."""
    counts = (
        entity_assignments(fact, spec)
        .groupBy("scope", "stage", *_words(spec))
        .agg(F.count(F.lit(1)).alias("n"), F.min("first_idx").alias("first_idx"))
    )
    return counts.withColumn("regimen", regimen_name("mask", spec))


def regimen_topk(counts: DataFrame, stages: DataFrame, spec: CohortSpec) -> DataFrame:
    """T1 + T2 + P6 + P7 + F7: top-k per (scope, stage) plus one folded tail row.

    The tail exists only when more than k regimens (or, with ``min_share``,
    more than the shown ones) exist; it always carries rank k + 1 and takes
    part in the width scale."""
    k = spec.top_k
    den = stages.select("scope", "stage", "denominator")
    # the mask settles ties of events that have no order key
    rank_w = Window.partitionBy("scope", "stage").orderBy(F.desc("n"), F.asc("first_idx"), *[F.asc(c) for c in _words(spec)])
    # rank <= k as a filter on the row number: only k rows of a group and task pass the shuffle
    best = counts.where("first_idx IS NOT NULL").withColumn("rank", F.row_number().over(rank_w)).where(F.col("rank") <= k)
    best = best.select("scope", "stage", "rank", F.col("n").alias("count"), *_words(spec))
    # the tail starts as the group's total; what is shown comes off below.  The
    # predicate is true by construction: with it both branches need the same columns of the counts
    total = counts.where("first_idx IS NOT NULL").groupBy("scope", "stage").agg(F.lit(k + 1).alias("rank"), F.sum("n").alias("count"), *[F.lit(0).cast("bigint").alias(c) for c in _words(spec)])
    rows = best.unionByName(total.select("scope", "stage", "rank", "count", *_words(spec))).join(den, ["scope", "stage"])
    top = F.col("rank") <= k
    if spec.min_share is not None:
        share = E("CASE WHEN denominator > 0 THEN CAST(count AS DOUBLE) / CAST(denominator AS DOUBLE) * 100.0D END")
        rows = rows.where(~top | F.coalesce(share >= F.lit(float(spec.min_share)), F.lit(False)))
    panel = Window.partitionBy("scope", "stage")  # at most k + 1 rows
    covered = F.coalesce(F.sum(F.when(top, F.col("count"))).over(panel), F.lit(0))
    folded = rows.withColumn("count", F.when(top, F.col("count")).otherwise(F.col("count") - covered))
    name = f"CASE WHEN rank <= {k} THEN {regimen_name_sql('mask', spec)} ELSE {lit(spec.tail_label)} END"
    folded = folded.select("*", E(name, "regimen"), F.max("count").over(panel).alias("panel_max"))
    return folded.select(
        "scope",
        "stage",
        F.col("rank").cast("int").alias("rank"),
        "regimen",
        F.col("count").cast("bigint").alias("count"),
        E(pct_sql("count", "denominator", spec.regimen_digits), "percent"),
        E(pct_sql("count", "panel_max", spec.width_digits), "width"),
        E(combined_sql("regimen"), "combined"),
    ).where(F.col("count") > 0)
