"""Vector codes against brute-force Lloyd rounds, and the bounds against all distances."""

from __future__ import annotations

import hashlib
import math

import numpy as np

from cohortlens.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, own string, error string, b int"


def save(spark, folder, rows, schema=SCHEMA, partitions=3) -> str:
    full = [(i, v, label, "x", "y", "z", 7) for i, v, label in rows]
    spark.createDataFrame(full, schema).repartition(partitions).write.mode("overwrite").parquet(f"{folder}/embeddings.parquet")
    return str(folder)


def brute(rows, parts=16, entries=64, rounds=2):
    """Rows (vec_id, vector, label) of one length -> {vec_id: (code, error, label error)}, digest; integers only."""
    kept = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(256 * x) for x in v], label))
    kept.sort(key=lambda r: r[0])
    size = len(kept[0][1]) // parts
    cut = {i: [tuple(v[p * size : (p + 1) * size]) for p in range(parts)] for i, v, _ in kept}
    books = [[cut[i][p] for i, _, _ in kept[:entries]] for p in range(parts)]

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return {i: [min((dist(c[p], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for i, c in cut.items()}

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut[i][p] for i in cut if found[i][p][1] == k]
                if mine:
                    books[p][k] = tuple(sum(c) // len(mine) for c in zip(*mine))
    found = assign()
    errors = {i: sum(d for d, _ in found[i]) for i in cut}
    by_label = {}
    for i, _, label in kept:
        by_label[label] = by_label.get(label, 0) + errors[i]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return {i: ("".join(f"{k:02x}" for _, k in found[i]), errors[i], by_label[label]) for i, _, label in kept}, digest


def vectors(n, seed=3, size=32, spread=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.5, (spread, size))
    return [(int(i), [float(np.float32(x)) for x in centres[rng.integers(spread)] + rng.normal(0, 0.1, size)], int(rng.integers(3))) for i in rng.permutation(n)]


def got(spark, folder):
    rows = vc.op11_vector_codes(spark, folder).collect()
    return {r.vec_id: (r.code, r.error, r.label_error) for r in rows}, {r.codebooks_sha256 for r in rows}, rows


def test_codes_equal_brute_force(spark, tmp_path):
    rows = vectors(300)
    rows[3] = (rows[3][0], rows[3][1], None)
    rows[4] = (rows[4][0], rows[4][1], None)
    rows[5] = (rows[5][0], rows[6][1], 1)  # equal vectors
    rows += [(900, None, 1), (901, rows[0][1][:-1] + [None], 1), (902, rows[0][1][:-1] + [float("nan")], 2), (903, [float("inf")] + rows[0][1][1:], None)]
    expected, digest = brute(rows)
    found, digests, _ = got(spark, save(spark, tmp_path, rows))
    assert found == expected
    assert digests == {digest}


def test_fewer_rows_than_entries_and_ties(spark, tmp_path):
    rows = [(i, [float(x)] * 16, 0) for i, x in enumerate([0, 1, 1, 0, 0.5, -0.25])]
    expected, digest = brute(rows)
    found, digests, _ = got(spark, save(spark, tmp_path, rows))
    assert found == expected and digests == {digest}
    one = [(7, [0.5] * 16, 3)]
    expected, digest = brute(one)
    found, digests, _ = got(spark, save(spark, tmp_path / "one", one))
    assert found == expected and digests == {digest}


def test_odd_rows(spark, tmp_path):
    rows = vectors(80, seed=9)
    expected, _ = brute(rows)
    odd = [(None, rows[0][1], 1), (500, [1.0, 2.0], 1), (501, [], 1), (502, rows[0][1][:-1] + [1e30], 9), (3, rows[5][1], 2)]
    found, _, all_rows = got(spark, save(spark, tmp_path, rows + odd))
    assert len(all_rows) == 85
    assert found[500][:2] == found[501][:2] == found[502][:2] == (None, None) and found[502][2] is None
    assert found[None][0] is not None
    assert sum(r.vec_id == 3 for r in all_rows) == 2
    assert {k: v[0][:2] for k, v in found.items() if k in expected and v[0]}.keys() == expected.keys()


def test_empty_tables(spark, tmp_path):
    assert got(spark, save(spark, tmp_path, []))[2] == []
    assert got(spark, save(spark, tmp_path / "none", [(1, None, 1)]))[2] == []
    short = got(spark, save(spark, tmp_path / "short", [(1, [1.0], 1)]))[2]
    assert [(r.vec_id, r.code, r.error, r.label_error) for r in short] == [(1, None, None, None)]


def test_bounds_hold_and_decide_as_all_distances():
    rng = np.random.default_rng(1)
    x = rng.integers(-40, 40, (500, 3)).astype(float)
    entries = rng.integers(-40, 40, (32, 3)).astype(float)
    for b in (1, 4, 8, 31):
        books = entries
        own, error, near, bounds, outer = vc.measured(x, books, b)
        for step in (1, 3, 0, 25):
            after = books + rng.integers(-step, step + 1, books.shape)
            drift = np.nextafter(np.sqrt(((after - books) ** 2).sum(1)), np.inf)
            low, out = vc.widened(vc.cut_down(bounds)), vc.widened(vc.cut_down(outer))
            own, error, near, bounds, outer, depth = vc.moved(x, after, drift, own, near, low, out)
            books = after
            d = vc.squared(x, books)
            assert (own == d.argmin(1)).all() and (error == d.min(1)).all()
            true = np.sqrt(np.take_along_axis(d, near, 1))
            assert (bounds <= true + 1e-6).all()
            rest = d.copy()
            np.put_along_axis(rest, near, np.inf, 1)
            rest[np.arange(len(x)), own] = np.inf
            assert (outer <= np.sqrt(rest.min(1)) + 1e-6).all()
            if step == 0:
                assert (depth == 0).mean() > 0.9 or b < 4


def test_bounds_in_16_bits_are_not_larger():
    v = np.concatenate([np.random.default_rng(2).uniform(0, 1e6, 2000), [0.0, 1.0, 255.999, np.inf]])
    w = vc.widened(vc.cut_down(v))
    assert (w <= v).all() and (w[:-1] >= v[:-1] * (1 - 2**-7)).all() and w[-1] == np.inf
