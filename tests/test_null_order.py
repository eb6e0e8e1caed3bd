"""Rows without an order key count like others; they come before all rows that have one."""

from __future__ import annotations

import pytest
from conftest import tables
from test_semantics import spark_outputs

from cohortlens import CohortBuild, clinical_spec


@pytest.mark.parametrize("lost", ["entity", "events", "all"])
def test_null_order_keys_drop_nothing(spark, lost):
    gone = {"entity": (1,), "events": (), "all": (0, 1, 2)}[lost]
    ents = [("u1", "2565", "I", 0), ("u2", "2565", "II", 1), ("u3", "2565", "III", 2)]
    ents = [(h, y, s, None if i in gone else i) for h, y, s, i in ents]
    cut = lost in ("events", "all")
    evs = [("u1", "2565", "I", "Surgery", None if cut else 0), ("u2", "2565", "II", "Hormone", None if cut else 1), ("u2", "2565", "II", "Surgery", 2)]
    b = CohortBuild(tables(spark, ents, evs, []), clinical_spec())
    for row in b.summary.collect():
        assert (row["known_patients"], row["treatment_events"], row["active_patients"], row["multimodal_patients"]) == (3, 3, 2, 1)


def test_a_row_with_an_order_key_wins_over_one_without(spark):
    ents = [("u1", None, "II", 0), ("u1", None, "I", None)]
    evs = [("u1", None, "I", "Surgery", 5)]
    out = spark_outputs(CohortBuild(tables(spark, ents, evs, []), clinical_spec()))
    assert {r[1] for r in out["regimens"]} == {"II"}


def test_topk_limits_groups_before_the_shuffle(spark):
    ents = [(f"u{k}", None, "I", k) for k in range(40)]
    evs = [(f"u{k}", None, "I", t, 100 * k + i) for k in range(40) for i, t in enumerate(("Surgery", "Hormone", "Radiation")[: k % 4])]
    b = CohortBuild(tables(spark, ents, evs, []), clinical_spec(top_k=2))
    plan = b.regimens._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    rows = [tuple(r) for r in b.regimens.orderBy("rank").collect()]
    assert [(r[2], r[4]) for r in rows if r[0] == "all"] == [(1, 10), (2, 10), (3, 10)]
