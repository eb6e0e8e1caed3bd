"""Incremental event rollup with Structured Streaming.

The event rollup's aggregates (``bit_or`` masks, ``min`` first event,
``count``) are associative, so a stream of new event files can be rolled up
one micro-batch at a time and the partial rollups merged later with the same
aggregates.  No streaming state is kept: each micro-batch is aggregated on its
own and written to ``<path>/batch=<id>``.  A retried batch overwrites its own
folder, and the query checkpoint records which batches committed, so the
partials are exactly-once even when executors are lost mid-batch.

A build then reads the merged partials instead of re-reading every event::

    q = start_event_rollup(spark.readStream.schema(EVENT_SCHEMA).parquet(src), spec, out, ckpt)
    q.awaitTermination()
    b = CohortBuild(inputs, spec, event_rollup=merged_event_rollup(spark, out, spec))

Cleaning, the known-stage filter and the scope explode run per micro-batch,
exactly as in the batch plan.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.prepare import clean_events, known_stage
from ..operators.rollup import act_words, event_rollup
from ..spec import CohortSpec


def batch_rollup(events: DataFrame, spec: CohortSpec, prepared: bool = False) -> DataFrame:
    ev = events if prepared else known_stage(clean_events(events, spec), spec)
    return event_rollup(ev, spec)


def start_event_rollup(
    events_stream: DataFrame,
    spec: CohortSpec,
    out_path: str,
    checkpoint_location: str,
    *,
    available_now: bool = True,
    prepared: bool = False,
) -> StreamingQuery:
    """Start the stream: every micro-batch's partial rollup lands in its own folder."""
    base = out_path.rstrip("/")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        batch_rollup(df, spec, prepared).write.mode("overwrite").parquet(f"{base}/batch={batch_id}")

    writer = events_stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def merged_event_rollup(spark: SparkSession, out_path: str, spec: CohortSpec, compacted_path: str | None = None) -> DataFrame:
    """Merge all partial rollups into the (scope, hn) event rollup.

    With the path that ``compact_partials`` returned, that table stands for the
    batches it holds, and only later ones are read from their own folders."""
    parts = spark.read.parquet(out_path.rstrip("/"))
    if compacted_path is not None:
        last = int(re.search(r"upto=(\d+)/?$", compacted_path)[1])
        done = spark.read.parquet(compacted_path)
        parts = parts.where(F.col("batch") > last).select(*done.columns).unionByName(done)
    return _merged(parts, spec)


def _merged(parts: DataFrame, spec: CohortSpec) -> DataFrame:
    aggs = [
        *[F.bit_or(c).alias(c) for c in act_words(spec)],
        F.min("first_idx").alias("first_idx"),
        F.sum("n_events").alias("n_events"),
    ]
    if spec.cells_fit_one_mask():
        aggs.insert(0, F.bit_or("cov_mask").alias("cov_mask"))
    return parts.groupBy("scope", "hn").agg(*aggs)


def compact_partials(spark: SparkSession, out_path: str, spec: CohortSpec, compacted_path: str) -> str:
    """Merge the partials so far into ``<compacted_path>/upto=<last batch>`` and return that path.

    The name holds the last batch that the table covers, so a merge never counts
    a batch twice (see ``merged_event_rollup``)."""
    parts = spark.read.parquet(out_path.rstrip("/"))
    last = parts.agg(F.max("batch")).first()[0]
    target = f"{compacted_path.rstrip('/')}/upto={last}"
    _merged(parts.where(F.col("batch") <= last), spec).write.mode("overwrite").parquet(target)
    return target
