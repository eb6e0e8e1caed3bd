"""The whole build for every scope in one plan (Q1), plus its variant (Q4).

Physical shape::

    events   --clean/F1--explode scope--partial agg (scope,hn)--[exchange]--final agg  (ev)
    entities --clean/F1--explode scope--partial agg (scope,hn)--[exchange]--final agg  (ent)
    ent FULL JOIN ev USING (scope, hn)       <- co-partitioned, no exchange   (fact)
    ent  --groupBy(scope)            -> stage sizes, known ids
    ev   --groupBy(scope)            -> event count, coverage cells
    fact --groupBy(scope,stage,mask) -> regimen counts -> window top-k    -> regimens
                                                       -> groupBy(scope)  -> active / multi-modality
    all per-scope parts joined on scope -> one wide row per scope -> summary, stages, heatmap

Only the two rollups move raw-sized data; everything after them is
proportional to the number of entities (the fact table) or to the number of
scopes x stages x regimens.  Every consumer references all rollup columns
(``rollup.entity_side_sql`` / ``event_side_sql``), so within one action all
branches share one exchange per input: a single output, or the whole nested
document, reads the raw events once.  A build that runs several actions (one
write per output) should ``materialize`` the fact table (``checkpoint`` writes
it to ``spark.checkpoint.dir``: lineage cut, survives executor loss;
``cache`` keeps it in executor storage); every metric then reads it.
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from ..model import CohortInputs
from ..operators import coverage as cov
from ..operators import regimens as reg
from ..operators import rollup, summary
from ..operators.prepare import prepare
from ..operators.scope import years_list
from ..session import ensure_checkpoint_dir
from ..spec import CohortSpec


class CohortBuild:
    def __init__(
        self,
        inputs: CohortInputs,
        spec: CohortSpec,
        *,
        prepared: bool = False,
        materialize: str = "none",
        rollup_pattern: str | None = None,
        event_rollup: DataFrame | None = None,
    ) -> None:
        if materialize not in ("none", "cache", "checkpoint"):
            raise ValueError("materialize must be none, cache or checkpoint")
        self.raw = inputs
        self.spec = spec
        self._prepared = prepared
        self.materialize = materialize
        self.rollup_pattern = rollup_pattern
        self._event_rollup = event_rollup  # e.g. merged incremental partials (streaming)
        self._kept: list[DataFrame] = []

    # -- inputs ------------------------------------------------------------------
    @cached_property
    def inputs(self) -> CohortInputs:
        if self._prepared:
            return self.raw
        return prepare(self.raw, self.spec, self.rollup_pattern)

    @property
    def entities(self) -> DataFrame:
        return self.inputs.entities

    @property
    def events(self) -> DataFrame:
        return self.inputs.events

    # -- rollups -----------------------------------------------------------------
    @cached_property
    def entity_rollup(self) -> DataFrame:
        return rollup.entity_rollup(self.entities, self.spec)

    @cached_property
    def event_rollup(self) -> DataFrame:
        if self._event_rollup is not None:
            return self._event_rollup
        return rollup.event_rollup(self.events, self.spec)

    @cached_property
    def fact(self) -> DataFrame:
        fact = rollup.fact_table(self.entity_rollup, self.event_rollup)
        if self.materialize == "checkpoint":
            ensure_checkpoint_dir(fact.sparkSession)
            return fact.checkpoint(eager=True)
        if self.materialize == "cache":
            return self._keep(fact)
        return fact

    def _keep(self, df: DataFrame) -> DataFrame:
        """Persist a shared intermediate.  A persisted plan is matched by the
        cache manager whatever columns each consumer prunes, so outputs that
        share it read it once instead of re-running it (exchange reuse alone
        fails as soon as two consumers prune differently)."""
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(kept)
        return kept

    def _small(self, df: DataFrame) -> DataFrame:
        """Tiny per-scope results feed several outputs: keep them when materialising."""
        return df if self.materialize == "none" else self._keep(df)

    # -- per scope ---------------------------------------------------------------
    # With a materialised fact every metric reads it; otherwise each side reads
    # its own rollup so single-output queries never roll the events up twice.
    @property
    def _entity_source(self) -> DataFrame:
        return self.entity_rollup if self.materialize == "none" else self.fact

    @property
    def _event_source(self) -> DataFrame:
        return self.event_rollup if self.materialize == "none" else self.fact

    @cached_property
    def entity_metrics(self) -> DataFrame:
        return summary.entity_metrics(self._entity_source, self.spec)

    @cached_property
    def core_metrics(self) -> DataFrame:
        set_m = summary.set_metrics(self.regimen_counts, self.spec)
        return self._small(summary.core_metrics(self.entity_metrics, set_m, self.spec))

    @cached_property
    def event_metrics(self) -> DataFrame:
        return summary.event_metrics(self._event_source, self.spec)

    @cached_property
    def metrics(self) -> DataFrame:
        metrics = summary.scope_metrics(
            self.core_metrics, self.event_metrics, self.inputs.unknown, self.spec, self.inputs.unknown_override
        )
        return self._small(metrics)

    @cached_property
    def summary(self) -> DataFrame:
        return summary.summary(self.metrics)

    @cached_property
    def stages(self) -> DataFrame:
        return summary.stage_table(self.core_metrics, self.spec)

    @cached_property
    def denominators(self) -> DataFrame:
        """(scope, stage, denominator).  With all-patient denominators this reads
        only the entity side, so coverage never waits on the regimen path."""
        if self.spec.denominator == "all":
            return summary.stage_sizes(self.entity_metrics, self.spec)
        return self.stages.select("scope", "stage", "denominator")

    @cached_property
    def years(self) -> DataFrame:
        return years_list(self.entities, self.spec)

    # -- coverage ----------------------------------------------------------------
    @cached_property
    def cell_rollup(self) -> DataFrame:
        """Wide-dimension path only (more than 63 cells)."""
        return rollup.cell_rollup(self.events, self.spec)

    @cached_property
    def coverage_cells(self) -> DataFrame:
        """Wide-dimension path only: registry scopes x cells from the per-stage rollup."""
        scopes = self.entity_metrics.select("scope")
        return cov.coverage_cells(scopes, self.spec, self.cell_rollup)

    @cached_property
    def modality_mix(self) -> DataFrame:
        """Q5 from the same rollup as the coverage."""
        cells = None if self.spec.cells_fit_one_mask() else self.cell_rollup
        return cov.modality_mix(self._event_source, self.entity_metrics, self.spec, cells)

    @cached_property
    def heatmap(self) -> DataFrame:
        """Counts and denominators share one per-scope row: stage sizes from the
        entity side (or active counts in the active-denominator variant) next to
        the event side's cell counts; reads neither the regimen path (unless the
        variant needs it) nor the unknown table."""
        if not self.spec.cells_fit_one_mask():
            return cov.coverage_heatmap(self.coverage_cells, self.denominators, self.spec)
        if self.spec.denominator == "all":
            base, prefix = self.entity_metrics, "patients"
        else:
            base, prefix = self.core_metrics, "active"
        row = summary.coverage_row(base, self.event_metrics, prefix, self.spec)
        return cov.coverage_heatmap_from_row(row, self.spec, prefix)

    # -- regimens ----------------------------------------------------------------
    @cached_property
    def regimen_counts(self) -> DataFrame:
        return self._small(reg.regimen_counts(self.fact, self.spec))

    @cached_property
    def regimens(self) -> DataFrame:
        return self._small(reg.regimen_topk(self.regimen_counts, self.denominators, self.spec))

    def release(self) -> None:
        for df in self._kept:
            df.unpersist()
        self._kept.clear()
