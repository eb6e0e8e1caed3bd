"""Run a build twice in one Spark process that allows task retries: once
clean, once with the first attempt of one input task failing.  Prints JSON."""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from cohortlens.model import CohortInputs  # noqa: E402
from cohortlens.plans.catalog import build  # noqa: E402


MARKERS = os.environ.get("FAULT_MARKERS", "/tmp")


def failing_first_attempt(it):
    ctx = TaskContext.get()
    if ctx.partitionId() == 0 and ctx.attemptNumber() == 0:
        open(os.path.join(MARKERS, f"fail-{ctx.stageId()}-{ctx.taskAttemptId()}"), "w").close()
        raise RuntimeError("injected task failure")
    yield from it


def outputs(b):
    return {
        "regimens": sorted(map(list, b.regimens.collect())),
        "heatmap": sorted(map(list, b.heatmap.collect())),
        "summary": sorted(map(list, b.summary.collect())),
    }


def main() -> None:
    sf = sys.argv[1]
    spark = (
        SparkSession.builder.master("local[2,4]")  # up to 4 attempts per task
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    clean = outputs(build(spark, sf))
    res = {}
    for mat in ("none", "checkpoint"):
        b = build(spark, sf, materialize=mat)
        ev = b.raw.events
        flaky = ev.mapInPandas(failing_first_attempt, schema=ev.schema)
        b.raw = CohortInputs(b.raw.entities, flaky, b.raw.unknown, b.raw.unknown_override, source_files=b.raw.source_files)
        res[mat] = outputs(b) == clean
    res["injected_failures"] = len([f for f in os.listdir(MARKERS) if f.startswith("fail-")])
    print(json.dumps(res))
    spark.stop()


if __name__ == "__main__":
    main()
