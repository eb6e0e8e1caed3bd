"""Print condensed physical plans of the main outputs, as a large cluster would
plan them before runtime re-optimisation (AQE off, no broadcast joins).

Usage: python -m checks.show_plans [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys

from cohortlens.functions.text import decimal_digit_map, whitespace_chars
from cohortlens.plans.catalog import build
from cohortlens.plans.document import document_rows
from cohortlens.session import build_session

KEEP = re.compile(
    r"(Exchange|ReusedExchange|HashAggregate|SortAggregate|SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin|"
    r"Window|Generate|FileScan|Filter|Union|CartesianProduct|BatchEvalPython|ArrowEvalPython)"
)


def condense(plan: str) -> list[str]:
    # the whitespace and digit tables are literals inside the plan text; the
    # whitespace one contains line breaks
    plan = plan.replace(whitespace_chars(), "<unicode-space>")
    src, dst = decimal_digit_map()
    plan = plan.replace(src, "<unicode-digits>").replace(dst, "<ascii-digits>")
    # literals may still hold line breaks (long strings are abbreviated in plan
    # text): glue every line that does not start a plan node to the previous one
    node = re.compile(r"^[ :]*(\+- )?(\*\(\d+\) )?[A-Z]")
    lines: list[str] = []
    for line in plan.split("\n"):
        if lines and not node.match(line):
            lines[-1] += " " + line
        else:
            lines.append(line)
    out = []
    for line in lines:
        m = KEEP.search(line)
        if not m:
            continue
        indent = line[: len(line) - len(line.lstrip(" :+-*()0123456789"))]
        body = line[len(indent):]
        body = re.sub(r"#\d+L?", "", body)
        if "FileScan" in body:
            table = re.search(r"/([a-z_]+)\.parquet", body)
            pushed = re.search(r"PushedFilters: (\[[^\]]*\])", body)
            schema = re.search(r"ReadSchema: (struct<[^>]*>)", body)
            body = f"FileScan {table.group(1) if table else '?'} pushed={pushed.group(1) if pushed else '[]'} schema={schema.group(1) if schema else '?'}"
        elif "Exchange" in body and "Reused" not in body:
            body = re.sub(r", ENSURE_REQUIREMENTS.*", "", body)
        elif "ReusedExchange" in body:
            body = "ReusedExchange -> " + re.sub(r".*?(Exchange \w+\([^)]*\)).*", r"\1", body)
        elif "Aggregate" in body:
            keys = re.search(r"keys=\[([^\]]*)\]", body)
            funcs = re.search(r"functions=\[(.*?)\], output", body)
            kind = body.split("(")[0]
            body = f"{kind}(keys=[{keys.group(1) if keys else ''}], functions=[{(funcs.group(1) if funcs else '')[:90]}])"
        else:
            body = body[:140]
        out.append(f"{indent}{body}")
    return out


def main(argv: list[str]) -> None:
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    spark = build_session(**{"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"})
    print("# Physical plans (static: AQE off, broadcast joins off)\n")
    print("Generated by `python -m checks.show_plans`. Operator lines only; expression ids removed.\n")
    for name in ("regimens", "heatmap", "summary", "document"):
        b = build(spark, sf)
        df = document_rows(b) if name == "document" else getattr(b, name)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = condense(plan)
        scans = sum("FileScan orders" in line for line in lines)
        print(f"## {name}\n")
        print(f"orders scans: {scans}; exchanges: {sum('Exchange hashpartitioning' in line for line in lines)}; "
              f"reused: {sum('ReusedExchange' in line for line in lines)}\n")
        print("```")
        print("\n".join(lines))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
