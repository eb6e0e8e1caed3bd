"""Cohort inputs derived from the TPC-H-shaped test tables (FIXTURES.md §3).

customer -> entities (segment = stage, first order year = year), orders ->
events (the customer's segment = event stage, priority [/ status] =
modality), customers of the unknown segment -> unknown table.

Only the needed columns are read, so the parquet scans prune to them.  The
two customer joins are plain equi-joins on the customer key; the planner
broadcasts the customer side only when AQE's runtime size check allows it and
otherwise shuffles both sides (with skew-join splitting for hot keys).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql import arr, lit
from ..model import CohortInputs
from .tables import file_names
from ..spec import TPCH_STAGE_SEGMENTS, TPCH_UNKNOWN_SEGMENT, WIDE_LABELS


def read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


# Encoding C: the clinical vocabulary itself on the test tables.  Segments
# become the four main stages (the unknown segment stays unknown); each
# priority/status pair becomes a clinical modality, three of them non-active
# and one a label outside both lists.  A fixture design, not source data.
CLINICAL_STAGE_OF_SEGMENT = dict(zip(TPCH_STAGE_SEGMENTS, ("I", "II", "III", "IV")))
CLINICAL_MODALITY_OF_ORDER = {
    "1-URGENT/F": "Hormone",
    "1-URGENT/O": "Radiation",
    "1-URGENT/P": "Surgery",
    "2-HIGH/F": "Chemotherapy",
    "2-HIGH/O": "Targeted Therapy",
    "2-HIGH/P": "Interventional",
    "3-MEDIUM/F": "Immonotherapy",
    "3-MEDIUM/O": "Other",
    "3-MEDIUM/P": "Hormone",
    "4-NOT SPECIFIED/F": "Refer",
    "4-NOT SPECIFIED/O": "Supportive",
    "4-NOT SPECIFIED/P": "Loss Follow-up",
    "5-LOW/F": "Radiation",
    "5-LOW/O": "Surgery",
    "5-LOW/P": "Observation",
}


def _case_map(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items())
    return f"CASE {expr} {whens} ELSE {expr} END"


def treatment_expr(encoding: str) -> Column:
    if encoding in ("P", "T"):
        return F.col("o_orderpriority")
    if encoding == "W":
        return F.concat(F.col("o_orderpriority"), F.lit("/"), F.col("o_orderstatus"))
    if encoding == "C":
        return F.expr(_case_map("concat(o_orderpriority, '/', o_orderstatus)", CLINICAL_MODALITY_OF_ORDER))
    if encoding == "X":
        return F.expr(f"concat('M', lpad(CAST((o_orderkey + o_custkey) % {WIDE_LABELS} AS STRING), 2, '0'))")
    raise ValueError(f"unknown encoding {encoding!r}")


def stage_expr(encoding: str) -> Column:
    if encoding == "C":
        return F.expr(_case_map("c_mktsegment", CLINICAL_STAGE_OF_SEGMENT))
    return F.col("c_mktsegment")


def raw_entities(spark: SparkSession, sf_dir: str, encoding: str = "P") -> DataFrame:
    """customer + first order year; keeps c_custkey for derived messy inputs."""
    cust = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    first = (
        read(spark, sf_dir, "orders", "o_custkey", "o_orderdate")
        .groupBy("o_custkey")
        .agg(F.min("o_orderdate").alias("first_date"))
    )
    return cust.join(first, cust.c_custkey == first.o_custkey, "left").select(
        "c_custkey",
        F.col("c_custkey").cast("string").alias("hn"),
        F.year("first_date").cast("string").alias("year"),
        stage_expr(encoding).alias("stage"),
        F.col("c_custkey").alias("row_idx"),
    )


def raw_events(spark: SparkSession, sf_dir: str, encoding: str = "P") -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
    if encoding in ("W", "C"):
        cols.append("o_orderstatus")
    orders = read(spark, sf_dir, "orders", *cols)
    cust = read(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return orders.join(cust, orders.o_custkey == cust.c_custkey, "left").select(
        F.col("o_custkey").cast("string").alias("hn"),
        F.year("o_orderdate").cast("string").alias("year"),
        stage_expr(encoding).alias("stage"),
        treatment_expr(encoding).alias("treatment"),
        F.col("o_orderkey").alias("row_idx"),
    )


# Encoding T: the traps of SURVEY §1.1 put into the clean tables, each a pure
# function of the row's key, so that the same rows can be written in SQL.
TRAP_STAGE = "BUILDING"
TRAP_ORDERLESS_CUSTOMER = 7


def trapped_entities(ents: DataFrame) -> DataFrame:
    """Repeated ids with another stage, blank and padded ids, sentinel years, padded stages, missing order keys."""
    k = "c_custkey"
    return ents.select(
        k,
        F.expr(f"CASE WHEN {k} % 13 = 0 THEN '  ' WHEN {k} % 7 = 3 THEN concat({lit(NBSP)}, {k} - 1, ' ') ELSE hn END").alias("hn"),
        F.expr(f"CASE WHEN {k} % 17 = 0 THEN NULL WHEN {k} % 19 = 0 THEN concat(year, '.0') ELSE year END").alias("year"),
        F.expr(f"CASE WHEN {k} % 23 = 0 THEN concat(' ', stage, {lit(TAB)}) ELSE stage END").alias("stage"),
        F.expr(f"CASE WHEN {k} % 11 <> 0 THEN row_idx END").alias("row_idx"),
    )


def trapped_events(events: DataFrame) -> DataFrame:
    """Orphan, blank and padded ids, stages other than the registry's or missing, padded modalities, missing order keys."""
    k = "row_idx"
    return events.select(
        F.expr(f"CASE WHEN {k} % 29 = 0 THEN concat('orphan', hn) WHEN {k} % 31 = 0 THEN '' ELSE concat(hn, ' ') END").alias("hn"),
        "year",
        F.expr(f"CASE WHEN {k} % 37 = 0 THEN NULL WHEN {k} % 5 = 0 THEN {lit(TRAP_STAGE)} ELSE stage END").alias("stage"),
        F.expr(f"CASE WHEN {k} % 41 = 0 THEN concat(treatment, {lit(TAB)}) ELSE treatment END").alias("treatment"),
        F.expr(f"CASE WHEN hn <> '{TRAP_ORDERLESS_CUSTOMER}' THEN {k} END").alias("row_idx"),
    )


def tpch_inputs(spark: SparkSession, sf_dir: str, encoding: str = "P", unknown_override: int | None = None) -> CohortInputs:
    ents = raw_entities(spark, sf_dir, encoding)
    events = raw_events(spark, sf_dir, encoding)
    if encoding == "T":
        ents, events = trapped_entities(ents), trapped_events(events)
    unknown = ents.filter(F.col("stage") == TPCH_UNKNOWN_SEGMENT).select("hn", "year")
    listed = spark.read.format("binaryFile").load([f"{sf_dir}/{t}.parquet" for t in ("customer", "orders")])
    return CohortInputs(
        entities=ents.drop("c_custkey"),
        events=events,
        unknown=unknown,
        unknown_override=unknown_override,
        source_files=file_names(listed.select("path")),
    )


# ---------------------------------------------------------------------------
# Deliberately messy text derived from clean columns (for P1 / P2 / P9 checks).
# Every variant is a pure function of c_custkey and the clean value, so the
# same strings can be written on the SQL side.
# ---------------------------------------------------------------------------
TAB, NBSP, IDEO_SPACE, FILE_SEP, LF = "\t", "\u00a0", "\u3000", "\u001c", "\n"
THAI_DIGITS = "๐๑๒๓๔๕๖๗๘๙"
SUBSTAGES = ("I", "IIA", "IIB", "IIC", "II", "IIIA", "IIIB", "IIIC", "IVA", "IVB", "IV", "IID", "V", "iia")


def _case(key: str, variants: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(variants))
    return f"CASE {key} % {len(variants)} {whens} END"


def messy_text_sql(key: str, value: str) -> str:
    return _case(
        key,
        [
            f"concat({lit(TAB)}, {value}, ' ')",
            f"concat({lit(NBSP)}, {value})",
            f"concat({value}, {lit(IDEO_SPACE)})",
            "'  '",
            "CAST(NULL AS STRING)",
            f"concat({lit(FILE_SEP)}, {value}, {lit(LF)})",
            value,
        ],
    )


def messy_year_sql(key: str, y: str) -> str:
    head, rest = f"substring({y}, 1, 1)", f"substring({y}, 2, 100)"
    return _case(
        key,
        [
            y,
            f"concat({y}, '.0')",
            f"concat({y}, '.9')",
            f"concat('-', {y}, '.5')",
            f"concat(' ', {y}, {lit(TAB)})",
            f"concat({y}, 'd')",
            f"concat({head}, 'e3')",
            f"concat({head}, '_', {rest})",
            f"translate({y}, '0123456789', {lit(THAI_DIGITS)})",
            f"concat({y}, 'abc')",
            "'nan'",
            "'inf'",
            "''",
            "CAST(NULL AS STRING)",
            f"concat({lit(IDEO_SPACE)}, {y})",
            f"concat('.', {y})",
            f"concat('+', {y})",
            f"concat({head}, '__', {rest})",
        ],
    )


def substage_sql(key: str) -> str:
    return f"element_at({arr(SUBSTAGES)}, CAST({key} % {len(SUBSTAGES)} + 1 AS INT))"
