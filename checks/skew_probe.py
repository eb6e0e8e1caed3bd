"""Skew probe: one id holds a third of all events; how much reaches one task?

Derives events from the test tables where every third order loses its
customer id (all of them collapse into the one pseudo-patient), runs the
regimen and coverage outputs with Spark's event log in a scratch folder, and
reports per stage the largest number of shuffle records any single task read.
With partial aggregation before every shuffle the hot id arrives as at most
one row per map task, so no task sees anything near the hot key's raw size.

Usage: python -m checks.skew_probe [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

import zstandard
from pyspark.sql import functions as F

from cohortlens import CohortBuild, tpch_spec
from cohortlens.model import CohortInputs
from cohortlens.session import build_session
from cohortlens.sources.tpch import tpch_inputs


def read_log(folder: str):
    for path in sorted(glob.glob(os.path.join(folder, "*", "events_*")) + glob.glob(os.path.join(folder, "app*"))):
        with open(path, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                yield json.loads(line)


def main(argv: list[str]) -> None:
    sf = argv[0] if argv else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-")
    # no coalescing, many reducers: a hot key would show up as one outsized task
    spark = build_session(
        shuffle_partitions=64,
        **{
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": scratch,
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
    base = tpch_inputs(spark, sf)
    hot = F.when(F.col("row_idx") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("hn"))
    events = base.events.withColumn("hn", hot)
    n_events = events.count()
    n_hot = events.where(F.col("hn").isNull()).count()
    b = CohortBuild(CohortInputs(base.entities, events, base.unknown), tpch_spec())
    b.regimens.collect()
    b.heatmap.collect()
    spark.stop()

    per_stage: dict[int, list[int]] = {}
    for e in read_log(scratch):
        if e["Event"] == "SparkListenerTaskEnd":
            sh = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {})
            recs = sh.get("Total Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append(recs)
    reads = {s: sorted(v) for s, v in per_stage.items() if sum(v) > 0}
    worst = max((v[-1] for v in reads.values()), default=0)
    print(
        json.dumps(
            {
                "events": n_events,
                "hot_key_events": n_hot,
                "max_shuffle_records_one_task": worst,
                "stages_with_shuffle_reads": len(reads),
                "per_stage_max_median_tasks": {str(s): [v[-1], v[len(v) // 2], len(v)] for s, v in sorted(reads.items())},
            }
        )
    )


if __name__ == "__main__":
    main(sys.argv[1:])
