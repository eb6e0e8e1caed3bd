"""Display-side derivations of the dashboard (P10-P15), as SQL expressions."""

from __future__ import annotations

from pyspark.sql import Column

from ..spec import ALL_SCOPE
from .sql import E, lit

# Dashboard wording, kept verbatim so derived strings match the page.
ALL_SCOPE_LABEL = "รวมทุกปี"
YEAR_SCOPE_PREFIX = "ปี "
HEADLINE_TEMPLATE = "ผู้ป่วย {mm} จาก {active} รายได้รับตั้งแต่ 2 วิธีขึ้นไป"
CAUTION_TEXT = " · n น้อย ระวังการตีความ"
# Heat-cell wash: max(WASH_FLOOR, WASH_TOP - percent / 100); dark text above WASH_DARK.
WASH_FLOOR = 0.22
WASH_TOP = 0.86
WASH_DARK = 0.53


def fmt_count_sql(n: str) -> str:
    """P10: grouped integer, null -> 0 (``1,234``)."""
    return f"format_number(CAST(coalesce({n}, 0) AS DOUBLE), 0)"


def fmt_pct_sql(x: str) -> str:
    """At most one decimal, trailing ``.0`` dropped, grouped, with ``%``."""
    return f"concat(regexp_replace(format_number(CAST(coalesce({x}, 0D) AS DOUBLE), 1), '\\\\.0$', ''), '%')"


def heat_wash_sql(percent: str, count: str) -> str:
    """Background wash of a heat cell; null for an empty cell (count 0)."""
    return f"(CASE WHEN {count} = 0 THEN CAST(NULL AS DOUBLE) ELSE greatest({WASH_FLOOR!r}D, {WASH_TOP!r}D - CAST({percent} AS DOUBLE) / 100.0D) END)"


def heat_dark_text_sql(percent: str, count: str) -> str:
    return f"({heat_wash_sql(percent, count)} > {WASH_DARK!r}D)"


def scope_label_sql(scope: str) -> str:
    """P14: 'all' -> all-years label, else the year prefix + year."""
    return f"CASE WHEN {scope} = {lit(ALL_SCOPE)} THEN {lit(ALL_SCOPE_LABEL)} ELSE concat({lit(YEAR_SCOPE_PREFIX)}, {scope}) END"


def headline_sql(multimodal: str, active: str) -> str:
    """P15: 'x of y received two or more modalities'."""
    head, rest = HEADLINE_TEMPLATE.split("{mm}")
    mid, tail = rest.split("{active}")
    return f"concat({lit(head)}, {fmt_count_sql(multimodal)}, {lit(mid)}, {fmt_count_sql(active)}, {lit(tail)})"


def caution_flag_sql(stage: str, small_n_stage: str | None, patients: str | None = None, threshold: int | None = None) -> str:
    """The page flags one fixed stage as small-n; optionally also any
    stage with fewer than ``threshold`` patients."""
    parts = []
    if small_n_stage is not None:
        parts.append(f"{stage} = {lit(small_n_stage)}")
    if threshold is not None and patients is not None:
        parts.append(f"coalesce({patients}, 0) < {int(threshold)}")
    return "(" + " OR ".join(parts) + ")" if parts else "false"


def caution_note_sql(flag: str) -> str:
    """The text the page appends to a flagged panel (empty otherwise)."""
    return f"CASE WHEN {flag} THEN {lit(CAUTION_TEXT)} ELSE '' END"


def fmt_count(n: str) -> Column:
    return E(fmt_count_sql(n))


def fmt_pct(x: str) -> Column:
    return E(fmt_pct_sql(x))


def heat_wash(percent: str, count: str) -> Column:
    return E(heat_wash_sql(percent, count))


def heat_dark_text(percent: str, count: str) -> Column:
    return E(heat_dark_text_sql(percent, count))


def scope_label(scope: str) -> Column:
    return E(scope_label_sql(scope))


def headline(multimodal: str, active: str) -> Column:
    return E(headline_sql(multimodal, active))


def caution_flag(stage: str, small_n_stage: str | None, patients: str | None = None, threshold: int | None = None) -> Column:
    return E(caution_flag_sql(stage, small_n_stage, patients, threshold))
