"""cohortlens: entity-level cohort pattern analytics on Spark DataFrames.

Registry table (one row per entity: id, year, stage) + event table (one row
per event: id, year, stage, modality) -> coverage matrix, ranked per-entity
modality combinations ("regimens"), multi-modality shares and totals, for the
whole population and every year in one pass.
"""

from .model import CohortInputs
from .plans.cohort import CohortBuild
from .spec import CohortSpec, clinical_spec, tpch_spec

__all__ = ["CohortBuild", "CohortInputs", "CohortSpec", "clinical_spec", "tpch_spec"]
