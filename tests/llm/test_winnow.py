import hashlib
import random

from cohortlens.llm import winnow

from .small import odd_documents, prose, save


def brute(hashes, window):
    picked = []
    size = min(window, len(hashes))
    for a in range(len(hashes) - size + 1 if hashes else 0):
        least = min(hashes[a : a + size])
        at = max(i for i in range(a, a + size) if hashes[i] == least)
        if not picked or picked[-1] != (least, at):
            picked.append((least, at))
    return picked


def test_winnowing_takes_the_rightmost_smallest():
    rng = random.Random(2)
    for n in (0, 1, 5, 23, 24, 25, 99, 100, 101, 400):
        text = "".join(rng.choice("ab ") for _ in range(n))
        for gram, window in ((3, 4), (24, 77), (1, 1)):
            hashes = winnow.gram_hashes(text, gram).tolist()
            assert len(hashes) == (max(n - gram + 1, 1) if n else 0)
            found = winnow.winnow(winnow.gram_hashes(text, gram), window)
            assert list(zip(found[0].tolist(), found[1].tolist())) == brute(hashes, window)


def test_shared_passage_is_always_found():
    rng = random.Random(4)
    for _ in range(20):
        passage = prose(rng, 60)[: winnow.GRAM + winnow.WINDOW - 1]
        a = winnow.fingerprint(prose(rng, 30) + passage + prose(rng, 30))
        b = winnow.fingerprint(prose(rng, 50) + passage)
        assert set(a[0].tolist()) & set(b[0].tolist())


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(winnow, "RANGE_ROWS", 4)
    rows = odd_documents()
    out = winnow.op3_winnowing(spark, save(spark, tmp_path, rows)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    down = sorted(rows, reverse=True, key=lambda r: r[0])
    for k, (i, text, *_) in enumerate(down):
        t, following = text or "", down[(k + 1) % len(down)][1] or ""
        half = len(t) // 2
        changed = t[: len(t) - half] + following[:half]
        r = by_id[i]
        assert r.n_chars == len(t)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == winnow.shown(winnow.fingerprint(t))
        assert r.edited_fingerprint == winnow.shown(winnow.fingerprint(changed))
        assert r.near_next == winnow.likeness(winnow.fingerprint(t)[0], winnow.fingerprint(following)[0])
        assert 0 <= r.near_edited <= 1
    assert by_id[5].fingerprint == by_id[6].fingerprint


def test_one_row_repeated_ids_and_empty(spark, tmp_path):
    one = winnow.op3_winnowing(spark, save(spark, tmp_path / "one", [(7, "abcd", None, None)])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(7, hashlib.sha256(b"abab").hexdigest())]
    rows = [(1, "b", None, None), (1, "a", None, None), (2, "cc", None, None), (None, "zz", None, None), (2, "cc", None, None)]
    out = winnow.op3_winnowing(spark, save(spark, tmp_path / "two", rows)).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in out) == [(-1, 2), (1, 1), (1, 1), (2, 2), (2, 2)]
    empty = winnow.op3_winnowing(spark, save(spark, tmp_path / "none", []))
    assert empty.count() == 0


def successors(rows):
    """(id, text) -> text of the next row by descending id, then by the order that the ties have."""
    out = [r for r in rows]
    return list(zip(out, out[1:] + out[:1]))


def test_ids_at_both_ends_of_the_range(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(winnow, "RANGE_ROWS", 3)
    rng = random.Random(12)
    ids = [-(1 << 63), -7 * 10**18, -5, 0, 5, 7 * 10**18, (1 << 63) - 1, *range(100, 130), 10**15]
    rows = [(i, prose(rng, rng.randint(1, 30)), "en", "a") for i in ids]
    out = {r.doc_id: r for r in winnow.op3_winnowing(spark, save(spark, tmp_path, rows)).collect()}
    down = sorted(rows, reverse=True)
    assert len(out) == len(rows)
    for (i, text, *_), (_, following, *_) in successors(down):
        assert out[i].edited_sha256 == hashlib.sha256(winnow.edited(text, following).encode()).hexdigest()


def test_rows_without_id_and_of_one_id_are_spread(spark, monkeypatch):
    """A third of the rows without an id and a third of one id: many parts, every row with one successor."""
    monkeypatch.setattr(winnow, "RANGE_ROWS", 8)
    rng = random.Random(13)
    rows = [(None if k % 3 == 0 else 77 if k % 3 == 1 else 1000 + k, f"text {rng.random()} {k}") for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    placed = winnow.in_order(df).collect()
    own = [r for r in placed if not r.guest]
    assert sorted((r.doc_id or 0, r.text) for r in own) == sorted((i or 0, t) for i, t in rows)
    parts = {}
    for r in own:
        parts[r.part] = parts.get(r.part, 0) + 1
    assert max(parts.values()) < 80 and len(parts) > 30
    assert sum(r.guest for r in placed) == len(parts)
    assert winnow.compare_edited(df).count() == len(rows)
    # descending ids, those without one last
    order = sorted(own, key=lambda r: (r.part, -(r.doc_id or 0)))
    assert [r.doc_id for r in order] == sorted((r.doc_id for r in own if r.doc_id is not None), reverse=True) + [None] * 200


def test_quantiles_of_a_sample_cut_skewed_ids(spark, monkeypatch):
    """One id far away leaves the others in as many parts as before."""
    monkeypatch.setattr(winnow, "RANGE_ROWS", 16)
    monkeypatch.setattr(winnow, "SAMPLED", 2)
    df = spark.range(2000).selectExpr("if(id = 7, 1000000000000000, id) as doc_id", "cast(id as string) as text")
    sizes = [r["count"] for r in winnow.in_order(df).where("not guest").groupBy("part").count().collect()]
    assert sum(sizes) == 2000 and max(sizes) < 200
