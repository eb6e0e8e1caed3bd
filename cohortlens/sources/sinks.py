"""Sinks: flat result tables partitioned by scope, and the nested document.

Flat tables are the primary output: Parquet partitioned by ``scope``, so a
dashboard slice (F8) is a partition-pruned read.  The nested document is one
small JSON text (optionally wrapped as a script assignment)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.cohort import CohortBuild
from ..plans.document import DATASET_TYPE, MANIFEST_TYPE, document_json, document_rows, full_document, manifest, parse_document

FLAT_OUTPUTS = ("summary", "stages", "heatmap", "regimens")


def write_flat(b: CohortBuild, out_dir: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every flat output to ``out_dir/<name>`` partitioned by scope.

    The build should materialise its fact table first (several actions read it)."""
    paths = {}
    for name in FLAT_OUTPUTS:
        path = f"{out_dir.rstrip('/')}/{name}"
        getattr(b, name).write.mode(mode).partitionBy("scope").parquet(path)
        paths[name] = path
    return paths


def read_slice(spark: SparkSession, out_dir: str, name: str, scope: str | None = None) -> DataFrame:
    """F8: one scope of a flat output (partition pruning on ``scope``)."""
    df = spark.read.parquet(f"{out_dir.rstrip('/')}/{name}")
    return df.where(F.col("scope") == F.lit(scope or "all"))


def write_document(b: CohortBuild, path: str, var_name: str | None = None, mode: str = "overwrite") -> None:
    """The nested document as UTF-8 JSON text (one small file)."""
    document_json(full_document(b), var_name).coalesce(1).write.mode(mode).text(path)


def write_document_parts(b: CohortBuild, path: str, source_name: str | None = None) -> None:
    """S6 at any number of scopes: ``scopes/scope=<scope>`` holds one JSON text each, written by
    different tasks; ``manifest`` (source, years, scopes, notes), written last, names them.

    No row and no task ever holds more than one scope's dataset."""
    rows = document_rows(b).select("scope", F.to_json("dataset").alias("value"))
    rows.write.mode("overwrite").partitionBy("scope").text(f"{path.rstrip('/')}/scopes")
    manifest(b, source_name).select(F.to_json("manifest").alias("value")).coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}/manifest")


def read_document_parts(spark: SparkSession, path: str, scope: str | None = None) -> DataFrame:
    """S7 of the parts: (scope, dataset) rows of every scope, or of one (only its file is read)."""
    text = spark.read.text(f"{path.rstrip('/')}/scopes", wholetext=True).withColumn("scope", F.col("scope").cast("string"))
    if scope is not None:
        text = text.where(F.col("scope") == scope)
    return text.select("scope", F.from_json("value", DATASET_TYPE).alias("dataset"))


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The parts' manifest as a typed struct column ``manifest``."""
    return spark.read.text(f"{path.rstrip('/')}/manifest", wholetext=True).select(F.from_json("value", MANIFEST_TYPE).alias("manifest"))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """A written document back as a typed struct column ``document``."""
    return parse_document(spark.read.text(path, wholetext=True))
