"""Scopes: the whole population plus one per registry year.

Instead of re-running the pipeline per year, every row is tagged with the
scopes it belongs to (``explode`` of ``['all', year]``) before the first partial
aggregation, so all scopes are computed in the same pass and the same shuffle.
The sentinel year never forms a scope; those rows count only in ``all``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..spec import ALL_SCOPE, CohortSpec


def scopes_of(year: Column, sentinel: str) -> Column:
    """Array of scopes a row with this year belongs to."""
    return F.when(year.isNull() | year.isin(sentinel, ALL_SCOPE), F.array(F.lit(ALL_SCOPE))).otherwise(
        F.array(F.lit(ALL_SCOPE), year)
    )


def with_scope(df: DataFrame, spec: CohortSpec) -> DataFrame:
    """G1: one output row per (input row, scope)."""
    return df.withColumn("scope", F.explode(scopes_of(F.col("year"), spec.sentinel)))


def years_list(entities: DataFrame, spec: CohortSpec) -> DataFrame:
    """Distinct registry years without the sentinel (sort at the sink)."""
    return entities.select("year").where((F.col("year") != spec.sentinel) & (F.col("year") != ALL_SCOPE)).distinct()


def scoped_entities(entities: DataFrame, spec: CohortSpec) -> DataFrame:
    """F4 in bulk: every known-stage entity row tagged with its scopes."""
    return with_scope(entities, spec).select("scope", "hn", "year", "stage", "row_idx")
