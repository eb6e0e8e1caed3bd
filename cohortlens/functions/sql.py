"""Helpers to write expressions as Spark SQL text.

Building a Column tree from Python costs one py4j round trip per node; a wide
plan (dozens of cells, each with a rounding expression) spends seconds on the
driver before anything runs.  The expression helpers therefore compose SQL
text and hand it to ``F.expr`` once; the JVM parses it into the same
expression tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(s: str) -> str:
    """A Spark SQL string literal (backslash escapes are on by default)."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def name(c: str) -> str:
    """A quoted column reference."""
    return "`" + c.replace("`", "``") + "`"


def arr(values: Sequence[str]) -> str:
    return "array(" + ", ".join(lit(v) for v in values) + ")"


def E(sql: str, alias: str | None = None) -> Column:
    c = F.expr(sql)
    return c.alias(alias) if alias else c
