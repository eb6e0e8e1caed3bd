"""Null/blank-safe text cleaning, year normalisation and stage roll-up.

All three are plain SQL expressions (btrim / translate / rlike / try_cast), so
they stay inside whole-stage codegen; no Python runs per row.  Each helper
takes SQL expression text (a column name is one) and returns SQL text; the
``*_col`` variants wrap it into a Column.

The character tables are generated from rules rather than listed:

* whitespace = every code point for which ``str.isspace()`` is true, which is
  exactly what Python's ``str.strip()`` and ``float()`` remove;
* decimal digits = every code point with a Unicode decimal value, which is
  what ``float()`` accepts besides ASCII digits (Thai digits among them).
"""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column

from .sql import E, lit

# Python float() literal syntax after digit folding (sign, digit groups with
# single underscores, optional fraction, optional exponent).  nan / inf are left
# out on purpose: they cannot become an integer, so they fall back to text.
_DIGITS = r"[0-9](?:_?[0-9])*"
FLOAT_LITERAL = rf"^[+-]?(?:{_DIGITS}\.?|(?:{_DIGITS})?\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"
BIGINT_SAFE = 9.2e18


@functools.lru_cache(maxsize=1)
def whitespace_chars() -> str:
    return "".join(chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace())


@functools.lru_cache(maxsize=1)
def decimal_digit_map() -> tuple[str, str]:
    """(from, to) strings mapping every non-ASCII decimal digit to ASCII."""
    src, dst = [], []
    for c in range(0x80, sys.maxunicode + 1):
        ch = chr(c)
        d = unicodedata.decimal(ch, None)
        if d is not None:
            src.append(ch)
            dst.append(str(d))
    return "".join(src), "".join(dst)


def strip_sql(x: str) -> str:
    """``str.strip()``: remove Unicode whitespace (incl. U+001C..U+001F) at both ends."""
    return f"btrim(CAST({x} AS STRING), {lit(whitespace_chars())})"


def clean_text_sql(x: str, default: str) -> str:
    """Trimmed text; null, empty or all-blank becomes ``default``."""
    return f"coalesce(nullif({strip_sql(x)}, ''), {lit(default)})"


def clean_year_sql(x: str, default: str) -> str:
    """``str(int(float(x)))`` when ``x`` parses as a Python float literal,
    else the trimmed text, else ``default``.

    Truncates toward zero.  Deliberate deviations: inf / nan / values beyond the
    bigint range fall back to the trimmed text instead of raising."""
    src, dst = decimal_digit_map()
    trimmed = strip_sql(x)
    folded = f"translate({trimmed}, {lit(src)}, {lit(dst)})"
    number = f"try_cast(replace({folded}, '_', '') AS DOUBLE)"
    parsed = (
        f"CASE WHEN {folded} RLIKE {lit(FLOAT_LITERAL)} AND abs({number}) < 9.2E18 "
        f"THEN CAST(CAST({number} AS BIGINT) AS STRING) END"
    )
    slow = f"coalesce({parsed}, nullif({trimmed}, ''), {lit(default)})"
    # Fast path for the common case: an already canonical integer (no sign
    # other than '-', no leading zeros, no padding) that a double holds exactly
    # is its own answer, so the per-row translate and regex are skipped.
    raw = f"CAST({x} AS STRING)"
    canonical = f"(length({raw}) <= 15 AND CAST(try_cast({raw} AS BIGINT) AS STRING) = {raw})"
    return f"(CASE WHEN {canonical} THEN {raw} ELSE {slow} END)"


def stage_rollup_sql(x: str, default: str, pattern: str) -> str:
    """Sub-stage to main stage (IIA/IIB/IIC -> II, ...); anything else -> default.

    ``pattern`` must capture the main stage in group 1."""
    return f"CASE WHEN {x} RLIKE {lit(pattern)} THEN regexp_extract({x}, {lit(pattern)}, 1) ELSE {lit(default)} END"


def clean_text(x: str, default: str) -> Column:
    return E(clean_text_sql(x, default))


def clean_year(x: str, default: str) -> Column:
    return E(clean_year_sql(x, default))


def stage_rollup(x: str, default: str, pattern: str) -> Column:
    return E(stage_rollup_sql(x, default, pattern))
