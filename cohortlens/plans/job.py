"""Batch job: read the three tables, build every output once, write them.

    spark-submit -m cohortlens.plans.job --entities s3://…/patients --events s3://…/treatments \\
        --unknown s3://…/unknown.csv --unknown-format csv --unknown-header-row 1 --out s3://…/cohort

or, straight from a workbook or a folder of them, ``--workbook s3://…/book.xlsx --out …``.

The fact table is checkpointed to the cluster's ``spark.checkpoint.dir`` (the
job sets none of its own when the cluster names one), so the four flat writes
and the document read it instead of the raw inputs, and a lost executor never
sends the job back to the raw tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ..sources.sinks import write_document, write_document_parts, write_flat
from ..sources.tables import PANDAS_NA_TOKENS, SHEET_COLUMNS, TableSource, read_inputs, workbook_sources
from ..spec import clinical_spec
from .cohort import CohortBuild


def run(spark: SparkSession, args: argparse.Namespace) -> dict[str, str]:
    def source(path: str, fmt: str, header_row: int = 0, order_by: str | None = None) -> TableSource:
        tokens = PANDAS_NA_TOKENS if fmt == "csv" else ()
        return TableSource(path, SHEET_COLUMNS, format=fmt, header_row=header_row, null_tokens=tokens, order_by=order_by)

    if getattr(args, "workbook", None):
        inputs = read_inputs(spark, **workbook_sources(args.workbook))
    else:
        override = TableSource(args.dashboard, {}, format="csv") if args.dashboard else None
        inputs = read_inputs(
            spark,
            entities=source(args.entities, args.format, order_by=getattr(args, "entities_order_by", None)),
            events=source(args.events, args.format, order_by=getattr(args, "events_order_by", None)),
            unknown=source(args.unknown, args.unknown_format, args.unknown_header_row),
            override=override,
        )
    spec = clinical_spec(top_k=args.top_k)
    b = CohortBuild(inputs, spec, materialize="checkpoint", rollup_pattern=args.rollup_pattern)
    paths = write_flat(b, args.out)
    if getattr(args, "document_parts", False):
        write_document_parts(b, f"{args.out.rstrip('/')}/document")
    else:
        write_document(b, f"{args.out.rstrip('/')}/document", var_name=args.var_name)
    b.release()
    return paths


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="cohort pattern build")
    p.add_argument("--workbook", help="a workbook, or a folder of them, in place of the three tables and the dashboard")
    p.add_argument("--entities")
    p.add_argument("--events")
    p.add_argument("--unknown")
    p.add_argument("--dashboard", help="sheet export holding the unknown-total override cell")
    p.add_argument("--format", default="parquet")
    p.add_argument("--entities-order-by", default=None, help="integer, date or timestamp column of the ingestion order")
    p.add_argument("--events-order-by", default=None)
    p.add_argument("--unknown-format", default="parquet")
    p.add_argument("--unknown-header-row", type=int, default=0)
    p.add_argument("--rollup-pattern", default=None, help="regex capturing the main stage from a sub-stage")
    p.add_argument("--top-k", type=int, default=6)
    p.add_argument("--var-name", default=None)
    p.add_argument("--document-parts", action="store_true", help="one JSON a scope and a manifest in place of one document")
    p.add_argument("--out", required=True)
    args = p.parse_args(argv)
    if not args.workbook and not (args.entities and args.events and args.unknown):
        p.error("give --workbook, or --entities, --events and --unknown")
    spark = SparkSession.builder.appName("cohortlens").getOrCreate()
    run(spark, args)


if __name__ == "__main__":
    main()
