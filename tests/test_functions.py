"""Scalar functions against Python's own behaviour."""

from __future__ import annotations

import sys

from py_oracle import py_clean, py_clean_year, py_pct

from cohortlens.functions.display import fmt_count, fmt_pct, heat_dark_text, heat_wash, scope_label
from cohortlens.functions.numeric import decode_mask, pct
from cohortlens.functions.text import clean_text, clean_year, stage_rollup
from cohortlens.spec import CLINICAL_SUBSTAGE_PATTERN

SENT = "ไม่ระบุ"


def one_col(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr("v")).collect()]


def test_clean_text_matches_str_strip_for_every_space(spark):
    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    near = ["​", "⁠", "﻿", "᠎", "_", "x"]  # not whitespace for str.strip
    values = [None, "", "abc"]
    for ch in spaces + near:
        values += [ch + "ab" + ch, ch, ch + ch + "a b" + ch]
    got = one_col(spark, values, lambda c: clean_text(c, SENT))
    assert got == [py_clean(v, SENT) for v in values]


def test_clean_year_matches_python(spark):
    values = [
        "2564", "2564.0", "2564.9", "-1.5", " 2564 ", "2564d", "2564f", "1e3", "1_000", "1__000", "_1", "1_",
        "๒๕๖๔", "２５６４", "abc", "nan", "NaN", "inf", "-inf", "", "  ", None, "+7", ".5", "5.", "1.e2", "-0.4",
        "　2565　", "12345678.0", "1.2345678E7", "0x10", "1,000", "١٢٣",
        # fast-path boundaries: canonical integers vs everything that is not
        "0", "-0", "007", "-5", "+5", " 5", "5 ", "123456789012345", "-123456789012345",
        "1234567890123456", "12345678901234567", "99999999999999999", "9223372036854775807",
    ]
    got = one_col(spark, values, lambda c: clean_year(c, SENT))
    assert got == [py_clean_year(v, SENT) for v in values]


def test_pct_half_even_matches_python_round(spark):
    pairs = [(n, d) for d in range(0, 130) for n in range(0, 2 * d + 1)] + [(0, 0), (5, 0)]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = df.select("n", "d", pct("n", "d", 0).alias("p0"), pct("n", "d", 1).alias("p1")).collect()
    for r in got:
        assert r["p0"] == py_pct(r["n"], r["d"], 0), (r["n"], r["d"])
        assert r["p1"] == py_pct(r["n"], r["d"], 1), (r["n"], r["d"])


def test_stage_rollup(spark):
    values = ["I", "IIA", "IIB", "IIC", "II", "IIIA", "IIIC", "IVA", "IVB", "IV", "IID", "V", "iia", None, "IVC"]
    got = one_col(spark, values, lambda c: stage_rollup(c, SENT, CLINICAL_SUBSTAGE_PATTERN))
    assert got == ["I", "II", "II", "II", "II", "III", "III", "IV", "IV", "IV", SENT, SENT, SENT, SENT, "IV"]


def test_decode_mask_order(spark):
    df = spark.createDataFrame([(0,), (1,), (5,), (255,)], "m long")
    got = [r[0] for r in df.select(decode_mask("m", ["RP", "RT", "ADT", "Chemo", "ARPI", "IR", "IO", "อื่นๆ"])).collect()]
    assert got == ["", "RP", "RP + ADT", "RP + RT + ADT + Chemo + ARPI + IR + IO + อื่นๆ"]


def test_display_helpers(spark):
    df = spark.createDataFrame([(1234567, 46.0, 28.6, 0, "all"), (0, 0.0, 100.0, 3, "2565")], "n long, a double, b double, c long, s string")
    r = df.select(
        fmt_count("n").alias("n"),
        fmt_pct("a").alias("a"),
        fmt_pct("b").alias("b"),
        heat_wash("b", "c").alias("w"),
        heat_dark_text("b", "c").alias("d"),
        scope_label("s").alias("s"),
    ).collect()
    assert (r[0]["n"], r[0]["a"], r[0]["b"], r[0]["w"], r[0]["s"]) == ("1,234,567", "46%", "28.6%", None, "รวมทุกปี")
    assert (r[1]["n"], r[1]["a"], r[1]["b"], r[1]["s"]) == ("0", "0%", "100%", "ปี 2565")
    assert abs(r[1]["w"] - 0.22) < 1e-12 and r[1]["d"] is False


def test_pct_exact_binary_ties_at_large_denominators(spark):
    """0.15 is stored below the tie: Python rounds down where a decimal-string
    rounding would go up.  Denominators that are multiples of 2000 hit this."""
    import random

    rnd = random.Random(5)
    pairs = [(rnd.randrange(0, d + 1), d) for d in (2000, 4000, 20000, 160000, 6250000) for _ in range(1500)]
    pairs += [(129, 2000), (777, 2000), (1711, 2000)]
    df = spark.createDataFrame(pairs, "n long, d long")
    for r in df.select("n", "d", pct("n", "d", 1).alias("p")).collect():
        assert r["p"] == py_pct(r["n"], r["d"], 1), (r["n"], r["d"])


def test_clean_year_random_strings_match_python(spark):
    import random

    rnd = random.Random(11)
    alphabet = list("0123456789") * 3 + list("._eE+-") * 2 + [" ", "\t", "　", "x", "n", "a", "i", "f"] + list("๐๑๙٣")
    values = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 8))) for _ in range(4000)]
    got = one_col(spark, values, lambda c: clean_year(c, SENT))
    bad = [(v, g, py_clean_year(v, SENT)) for v, g in zip(values, got) if g != py_clean_year(v, SENT)]
    assert not bad, bad[:10]


def test_spec_rejects_duplicates():
    import pytest

    from cohortlens.spec import Modality, Stage, clinical_spec

    spec = clinical_spec()
    with pytest.raises(ValueError):
        spec.with_params(stages=spec.stages + (spec.stages[0],))
    with pytest.raises(ValueError):
        spec.with_params(modalities=spec.modalities + (Modality("Hormone", "X"),))
    assert not spec.with_params(modalities=tuple(Modality(f"m{i}", f"l{i}") for i in range(64))).cells_fit_one_mask()
    with pytest.raises(ValueError):
        spec.with_params(denominator="half")
    assert not spec.with_params(stages=tuple(Stage(f"S{i}", "", "", "") for i in range(10))).cells_fit_one_mask()
