from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="cohortlens-test-")
    s = (
        SparkSession.builder.master("local[*]")
        .appName("cohortlens-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.local.dir", scratch)
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def tables(spark, entities, events, unknown):
    from cohortlens.model import ENTITY_SCHEMA, EVENT_SCHEMA, UNKNOWN_SCHEMA, CohortInputs

    return CohortInputs(
        spark.createDataFrame(entities, ENTITY_SCHEMA),
        spark.createDataFrame(events, EVENT_SCHEMA),
        spark.createDataFrame(unknown, UNKNOWN_SCHEMA),
    )
