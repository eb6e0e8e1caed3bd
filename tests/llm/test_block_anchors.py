import hashlib
import random

from cohortlens.llm import block_anchors as ba

from .small import mirrored_words, odd_documents, prose, save


def brute(rows, size=50):
    words = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    first = {}
    for i, w in words:
        if i is None:
            continue
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((i if i is not None else -1, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def run(spark, folder):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_removed, r.kept_sha256) for r in ba.op7_block_anchors(spark, folder).collect())


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = odd_documents()
    shared = [prose(rng, n).split() for n in (49, 50, 51, 74, 75, 200)]
    for i in range(100, 260):
        w = prose(rng, rng.randint(5, 60)).split()
        for _ in range(rng.randint(0, 2)):
            s = rng.choice(shared)
            a = rng.randint(0, max(0, len(s) - 50))
            w += s[a : a + rng.randint(40, 130)] + prose(rng, rng.randint(0, 30)).split()
        rows.append((i, " ".join(w), "en", "a"))
    loop = prose(rng, 7)
    rows += [(300, " ".join([loop] * 20), "en", "a"), (301, " ".join([loop] * 9), "en", "a"), (302, "q " + " ".join([loop] * 30), "en", "a")]
    rows.append((110, rows[-1][1], "en", "a"))  # an id again, with another text
    rows.append((300, " ".join([loop] * 20), "en", "a"))  # a row again
    rows.append((None, " ".join(shared[-1]), "en", "a"))
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)


def test_empty_and_all_short(spark, tmp_path):
    assert run(spark, save(spark, tmp_path / "a", [])) == []
    rows = [(1, "a b c", None, None), (2, "a b c", None, None), (3, None, None, None)]
    assert run(spark, save(spark, tmp_path / "b", rows)) == brute(rows)


def test_longest_shared_run_below_the_size_stays(spark, tmp_path):
    rng = random.Random(5)
    s = prose(rng, 49)
    rows = [(1, "x " + s + " y", None, None), (2, "z " + s + " w", None, None), (3, "x " + s + " v", None, None)]
    out = run(spark, save(spark, tmp_path, rows))
    assert out == brute(rows) and [r[2] for r in out] == [0, 0, 50]


def test_mirrored_words_are_two(spark, tmp_path):
    rng = random.Random(14)
    rest = prose(rng, 49)
    rows = [(k, f"{w} {rest}", "en", "a") for k, w in enumerate(w for n in (512, 1024, 2048) for w in mirrored_words(n))]
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)


def test_calls_and_a_hot_passage(spark, tmp_path, monkeypatch):
    """A passage that most documents hold, over many calls: one entry a call in its buckets, and the same result."""
    rng = random.Random(15)
    passage = prose(rng, 130)
    rows = [(k, f"{prose(rng, rng.randint(0, 40))} {passage if k % 3 else ''} {prose(rng, 30)}", "en", "a") for k in range(120)]
    rows += [(None, passage, "en", "a"), (7, passage, "en", "a"), (-5, passage[:400], "en", "a")]
    folder = save(spark, tmp_path, rows)
    one = run(spark, folder)
    assert one == brute(rows)
    monkeypatch.setattr(ba, "CALL_BYTES", 3000)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert ba.calls(docs, "text", "doc_id", 3000).count() > 20
    assert run(spark, folder) == one


def test_ranges_are_the_words_removed(spark, tmp_path):
    rng = random.Random(16)
    shared = prose(rng, 70)
    rows = [(1, shared, "en", "a"), (2, f"before {shared} after", "en", "a"), (3, f"{shared} {prose(rng, 9)} {shared}", "en", "a")]
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows)}/documents.parquet")
    found = {r.doc_id: (r.starts, r.ends, bytes(r.kept).decode()) for r in ba.without_repeats(docs).collect()}
    assert found[1] == ([], [], shared) and found[2] == ([1], [71], "before after")
    assert found[3][:2] == ([0, 79], [70, 149])


def test_calls_go_to_python_in_small_batches(spark, tmp_path, monkeypatch):
    """What a batch takes lies outside the JVM's heap and in Python: a few calls at a time, and the session is as before."""
    key, sizes, stored = "spark.sql.execution.arrow.maxBytesPerBatch", [], ba.stored
    before = spark.conf.get(key)

    def noted(df, name):
        sizes.append(int(spark.conf.get(key)))
        return stored(df, name)

    monkeypatch.setattr(ba, "stored", noted)
    rows = odd_documents()
    assert run(spark, save(spark, tmp_path, rows)) == brute(rows)
    assert len(sizes) == 4 and max(sizes) <= 4 << 20 and spark.conf.get(key) == before
