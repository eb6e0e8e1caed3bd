"""Incremental event rollup: streamed partials merge to the batch result."""

from __future__ import annotations

import tempfile

from conftest import tables
from test_semantics import random_tables, spark_outputs

from cohortlens import CohortBuild, clinical_spec
from cohortlens.model import EVENT_SCHEMA
from cohortlens.streaming.incremental import compact_partials, merged_event_rollup, start_event_rollup


def test_streamed_partials_equal_batch(spark):
    ents, evs, unk = random_tables(21, n_evs=300)
    src = tempfile.mkdtemp(prefix="stream-src-")
    # three arrivals of event files
    for i in range(3):
        part = evs[i * 100 : (i + 1) * 100]
        spark.createDataFrame(part, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    out = tempfile.mkdtemp(prefix="stream-out-")
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    spec = clinical_spec()
    stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
    q = start_event_rollup(stream, spec, out, ckpt)
    q.awaitTermination(300)
    assert q.exception() is None
    inputs = tables(spark, ents, evs, unk)
    merged = merged_event_rollup(spark, out, spec)
    streamed = spark_outputs(CohortBuild(inputs, spec, event_rollup=merged))
    batch = spark_outputs(CohortBuild(inputs, spec))
    assert streamed == batch
    # several micro-batches really happened
    assert len({r["batch"] for r in spark.read.parquet(out).select("batch").distinct().collect()}) == 3

    # compaction is the same merge: a build over the compacted table agrees too
    compacted = compact_partials(spark, out, spec, tempfile.mkdtemp(prefix="stream-compact-") + "/rollup")
    again = spark_outputs(CohortBuild(inputs, spec, event_rollup=spark.read.parquet(compacted)))
    assert again == batch
    # a batch that arrives later is added to the compacted ones, none of which counts twice
    late = [("late", "2565", "I", "Surgery", 10_000)]
    spark.createDataFrame(late, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    q = start_event_rollup(spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), spec, out, ckpt)
    q.awaitTermination(300)
    both = merged_event_rollup(spark, out, spec, compacted)
    whole = merged_event_rollup(spark, out, spec)
    assert sorted(map(tuple, both.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)


def test_checkpoint_dir_comes_from_the_session(spark):
    from cohortlens.session import ensure_checkpoint_dir

    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = ensure_checkpoint_dir(spark)
    if configured:
        assert configured.rstrip("/").split("/")[-1] in path
    assert spark.sparkContext.getCheckpointDir()


def test_restart_is_exactly_once(spark):
    ents, evs, unk = random_tables(23, n_evs=200)
    src = tempfile.mkdtemp(prefix="stream-src-")
    out = tempfile.mkdtemp(prefix="stream-out-")
    ckpt = tempfile.mkdtemp(prefix="stream-ckpt-")
    spec = clinical_spec()

    def run_once():
        stream = spark.readStream.schema(EVENT_SCHEMA).option("maxFilesPerTrigger", 1).parquet(src)
        q = start_event_rollup(stream, spec, out, ckpt)
        q.awaitTermination(300)
        assert q.exception() is None

    spark.createDataFrame(evs[:100], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    run_once()
    run_once()  # restart, nothing new: no batch is replayed
    batches = {r["batch"] for r in spark.read.parquet(out).select("batch").distinct().collect()}
    assert len(batches) == 1
    spark.createDataFrame(evs[100:], EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(src)
    run_once()  # only the new file becomes a new batch
    batches = {r["batch"] for r in spark.read.parquet(out).select("batch").distinct().collect()}
    assert len(batches) == 2
    inputs = tables(spark, ents, evs, unk)
    merged = merged_event_rollup(spark, out, spec)
    assert spark_outputs(CohortBuild(inputs, spec, event_rollup=merged)) == spark_outputs(CohortBuild(inputs, spec))
