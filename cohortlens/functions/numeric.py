"""Percent and bit helpers (P3, P5, P6, P7).  SQL text in, SQL text out; the
plain-named variants return Columns where callers need one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column

from .sql import E, arr, lit

#: Bits of one bigint word of a mask; masks of more bits have several words.
WORD_BITS = 63

_SPLITTER = "134217729.0D"  # 2**27 + 1, Veltkamp split of a double into two halves


def round_exact_sql(x: str, digits: int) -> str:
    """Python's ``round(x, digits)``: half-even on the *exact binary* value of x.

    ``bround`` rounds the shortest decimal representation instead, which differs
    when that representation is a tie that the binary value is not (0.15 is
    stored as 0.1499999...; Python gives 0.1, ``bround`` 0.2).  Such ties need
    denominators like 2000 and are common at scale.  The fix, in plain double
    arithmetic: T = rint(x * 10^(digits+1)) is the tie numerator; when x is the
    double nearest to T / 10^(digits+1) and T ends in 5, the exact sign of
    x * 10^(digits+1) - T (Dekker two-product; the power of ten splits exactly)
    decides the direction.  Exact ties (dyadic values) stay half-even.
    """
    if digits < 0 or digits > 15:
        return f"bround({x}, {digits})"
    s = f"{float(10 ** (digits + 1))!r}D"
    out = f"{float(10**digits)!r}D"
    t = f"rint(({x}) * {s})"
    p = f"(({x}) * {s})"
    c = f"(({x}) * {_SPLITTER})"
    hi = f"({c} - ({c} - ({x})))"
    lo = f"(({x}) - {hi})"
    err = f"(({hi} * {s} - {p}) + {lo} * {s})"
    diff = f"(({p} - {t}) + {err})"
    tie = f"(({x}) >= 0D AND abs({x}) < 1.0E15 AND {t} % 10D = 5D AND {t} / {s} = ({x}))"
    return (
        f"CASE WHEN {tie} AND {diff} > 0D THEN (({t} + 5D) / 10D) / {out} "
        f"WHEN {tie} AND {diff} < 0D THEN (({t} - 5D) / 10D) / {out} "
        f"ELSE bround({x}, {digits}) END"
    )


def pct_sql(num: str, den: str, digits: int) -> str:
    """``round(num / den * 100, digits)`` as Python rounds it; zero or null den -> 0.0.

    Evaluated in double in the same order as the definition."""
    ratio = f"(CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) * 100.0D)"
    return f"(CASE WHEN {den} IS NULL OR {den} = 0 THEN 0.0D ELSE {round_exact_sql(ratio, digits)} END)"


def ordinal_sql(x: str, values: Sequence[str]) -> str:
    """0-based position of ``x`` in ``values``; -1 when absent."""
    return f"(CAST(array_position({arr(values)}, {x}) AS INT) - 1)"


def bit_sql(pos: str) -> str:
    """``1L << pos`` when pos >= 0, else 0."""
    return f"(CASE WHEN ({pos}) >= 0 THEN shiftleft(1L, {pos}) ELSE 0L END)"


def mask_words(base: str, n_bits: int) -> list[str]:
    """Columns that hold a mask of so many bits: ``base``, ``base_1``, ..., 63 bits each."""
    return [base] + [f"{base}_{w}" for w in range(1, -(-n_bits // WORD_BITS))]


def bit_word_sql(pos: str, word: int, n_bits: int) -> str:
    """Word ``word`` of the mask with the one bit ``pos`` (0 where pos is negative)."""
    if n_bits <= WORD_BITS:
        return bit_sql(pos)
    low = word * WORD_BITS
    return f"(CASE WHEN ({pos}) >= {low} AND ({pos}) < {low + WORD_BITS} THEN shiftleft(1L, ({pos}) - {low}) ELSE 0L END)"


def bit_value_sql(mask: str, pos: int) -> str:
    """0/1 bigint for bit ``pos`` of the mask ``mask`` (null mask -> 0)."""
    return f"coalesce(shiftright({mask_word(mask, pos)}, {pos % WORD_BITS}) & 1L, 0L)"


def mask_word(base: str, pos: int) -> str:
    """The column that holds bit ``pos`` of a mask."""
    return mask_words(base, pos + 1)[-1]


def any_bit_sql(words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{w} <> 0" for w in words) + ")"


def count_bits_sql(words: Sequence[str]) -> str:
    return "(" + " + ".join(f"bit_count({w})" for w in words) + ")"


def decode_mask_sql(mask: str, labels: Sequence[str], sep: str = " + ") -> str:
    """P5: join the labels of the set bits, in bit order (``concat_ws`` skips nulls)."""
    parts = ", ".join(
        f"CASE WHEN shiftright({mask_word(mask, i)}, {i % WORD_BITS}) & 1L = 1L THEN {lit(lab)} END" for i, lab in enumerate(labels)
    )
    return f"concat_ws({lit(sep)}, {parts})"


def combined_sql(name: str, sep: str = " + ") -> str:
    """A regimen is combined when its name joins two or more labels."""
    return f"contains({name}, {lit(sep)})"


def pct(num: str, den: str, digits: int) -> Column:
    return E(pct_sql(num, den, digits))


def ordinal(x: str, values: Sequence[str]) -> Column:
    return E(ordinal_sql(x, values))


def decode_mask(mask: str, labels: Sequence[str], sep: str = " + ") -> Column:
    return E(decode_mask_sql(mask, labels, sep))
