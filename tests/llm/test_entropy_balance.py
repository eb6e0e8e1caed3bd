import math
import random
from collections import defaultdict

import pytest

from cohortlens.llm import entropy_balance as eb

from .small import odd_documents, prose, save


def brute_targets(sizes, share=1.5):
    """Sources in order, filled at the same rate by weight until the caps or the whole are reached."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, target = share * sum(sizes.values()), set(order), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target | {s: level * weight[s] for s in open_}


def rows_of(rng, n, sources):
    return [(i, prose(rng, rng.randint(0, 60) if i % 9 else rng.randint(200, 900)) if i % 17 else None, "en", rng.choice(sources)) for i in range(n)]


def check(rows, out):
    size = [len((t or "").encode().split()) for _, t, *_ in rows]
    by, longest = defaultdict(int), defaultdict(int)
    for (i, t, _, s), n in zip(rows, size):
        by[s] += n
        longest[s] = max(longest[s], n)
    target = brute_targets(by)
    assert len(out) == len(rows)
    assert sorted(r.size for r in out) == sorted(size)
    taken, source = defaultdict(int), {i: s for i, _, _, s in rows}
    for r in out:
        s = source[r.doc_id]
        assert r.source_size == by[s] and math.isclose(r.target, target[s], abs_tol=1e-6)
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    for s in by:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1


@pytest.mark.parametrize("sources", [["a", "b", "c", None, "é", "Z"], ["only"], ["s%02d" % k for k in range(9)]])
def test_query_meets_targets(spark, tmp_path, sources):
    rows = rows_of(random.Random(len(sources)), 300, sources)
    folder = save(spark, tmp_path, rows)
    out = eb.op8_source_mix(spark, folder).collect()
    check(rows, out)
    again = eb.op8_source_mix(spark, save(spark, tmp_path / "again", list(reversed(rows)), partitions=5)).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))


def test_rates_are_exponential_in_size(spark, tmp_path):
    rows = rows_of(random.Random(4), 400, ["a", "b", "c"])
    out = [r for r in eb.op8_source_mix(spark, save(spark, tmp_path, rows)).collect() if 0 < r.size and r.rate < 2 and r.source_size]
    source = {i: s for i, _, _, s in rows}
    by = defaultdict(set)
    for r in out:
        by[source[r.doc_id]].add(round(math.log(r.rate) / r.size, 6))
    assert all(len(v) <= 2 for v in by.values()) and by


def test_odd_documents_repeated_rows_and_empty(spark, tmp_path):
    rows = odd_documents() + [(5, odd_documents()[5][1], "en", "a")]
    out = eb.op8_source_mix(spark, save(spark, tmp_path / "a", rows)).collect()
    check([r for r in rows], out)
    assert eb.op8_source_mix(spark, save(spark, tmp_path / "b", [])).count() == 0
    blank = [(1, None, None, "a"), (2, " ", None, None)]
    assert [(r.size, r.target, r.taken) for r in eb.op8_source_mix(spark, save(spark, tmp_path / "c", blank)).collect()] == [(0, 0.0, 0)] * 2


def test_mixed_copies_rows_with_all_columns(spark, tmp_path):
    rows = rows_of(random.Random(6), 120, ["a", "b"])
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows)}/documents.parquet")
    copies = {r.doc_id: r.copies for r in eb.mix(docs).collect()}
    out = eb.mixed(docs)
    assert out.columns == docs.columns
    found = defaultdict(int)
    for r in out.collect():
        found[r.doc_id] += 1
    assert found == {i: c for i, c in copies.items() if c}


def test_mixed_gives_rows_without_an_id_and_repeated_rows_their_own_copies(spark, tmp_path):
    rng = random.Random(7)
    rows = [(None, prose(rng, rng.randint(1, 60)), "en", rng.choice("ab")) for _ in range(80)]
    rows += [(i % 4, prose(rng, rng.randint(1, 60)), "en", rng.choice("ab")) for i in range(40)]
    rows += [(9, "three equal rows", "en", "a")] * 3 + [(None, "two equal rows", "en", "b")] * 2
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows)}/documents.parquet")
    target, taken = {r.source: r.target for r in eb.mix(docs).collect()}, defaultdict(int)
    for r in eb.mixed(docs).collect():
        taken[r.source] += len(r.text.split())
    # half the longest document, as for rows that have ids
    assert all(abs(taken[s] - target[s]) <= 31 for s in target)


@pytest.mark.parametrize("copies", [1, 2, 4, 5])
def test_uneven_copies_of_equal_rows(spark, tmp_path, monkeypatch, copies):
    rows = [(i, "a b", "en", "a") for i in (None, None, None, 3, 3, 3)]
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows)}/documents.parquet")
    dealt = f"explode(transform(sequence(1, 3), x -> cast({copies} div 3 + if(x <= {copies} % 3, 1, 0) as long))) as copies"
    monkeypatch.setattr(eb, "mix", lambda d, *a, keep=(): d.select("doc_id", *keep).distinct().selectExpr("doc_id", *keep, dealt))
    found = [r.doc_id for r in eb.mixed(docs).collect()]
    assert found.count(None) == found.count(3) == copies
