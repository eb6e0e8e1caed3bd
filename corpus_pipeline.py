"""Corpus pipeline: five of the corpus operators in a row over ``documents``.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet in the shared folder and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from cohortlens.llm import pipeline_stages as stages
from cohortlens.llm.shared import remove, shared_folder

STAGES = [
    ("language_id", stages.language_id),
    ("near_duplicates", stages.near_duplicates),
    ("personal_data", stages.personal_data),
    ("source_mix", stages.source_mix),
    ("byte_bpe", stages.byte_bpe),
]

#: The language models and the id lists of the last stage are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """All stages over ``documents``; the result of the last."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = shared_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
