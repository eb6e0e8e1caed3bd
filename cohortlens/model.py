"""Canonical input tables of a cohort build.

``entities``  hn string, year string, stage string, row_idx bigint
``events``    hn string, year string, stage string, treatment string, row_idx bigint
``unknown``   hn string, year string

``row_idx`` is the ingestion order; it decides "last row wins" for duplicate
entity ids and first-seen order among tied regimens, so it must be carried from
the source and never re-derived after a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

ENTITY_SCHEMA = T.StructType(
    [
        T.StructField("hn", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("row_idx", T.LongType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("hn", T.StringType()),
        T.StructField("year", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("treatment", T.StringType()),
        T.StructField("row_idx", T.LongType()),
    ]
)
UNKNOWN_SCHEMA = T.StructType(
    [
        T.StructField("hn", T.StringType()),
        T.StructField("year", T.StringType()),
    ]
)


@dataclass(frozen=True)
class CohortInputs:
    entities: DataFrame
    events: DataFrame
    unknown: DataFrame
    unknown_override: int | None = None  # S4: the dashboard's override cell
    source_name: str = ""  # S8: lineage field of the document, where it is not to come from the files
    source_files: DataFrame | None = None  # S8: names of the scanned files (column ``name``)

    def select_canonical(self) -> CohortInputs:
        return replace(
            self,
            entities=self.entities.select(*ENTITY_SCHEMA.fieldNames()),
            events=self.events.select(*EVENT_SCHEMA.fieldNames()),
            unknown=self.unknown.select(*UNKNOWN_SCHEMA.fieldNames()),
        )
