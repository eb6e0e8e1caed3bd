import re
from collections import Counter

import numpy as np

from cohortlens.llm import quality_trees as q

from .small import mirrored_words, odd_documents, prose, save
import random

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    x = text or ""
    w = WORD.findall(x)
    seen, dup = set(), 0
    for line in x.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    found = Counter(zip(w, w[1:], w[2:]))
    cover = {i + k for i in range(len(w) - 2) if found[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, len(cover))


def labels(spark, folder, rows):
    spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_base_counts_match_brute_force(spark, tmp_path):
    rows = odd_documents() + [(50, "a b\na b\n\n a b\nc\na b", "en", "a"), (51, "l1 x\n\n\nl1 x\n", "en", "a"), (52, "# * $ % & | < > #", "en", "a")]
    labels(spark, tmp_path, [(1, 1, 0), (2, None, 0), (None, 1, 0), (999, 0, 0)])
    out = {r.doc_id: r for r in q.op2_quality_trees(spark, save(spark, tmp_path, rows)).collect()}
    for i, text, *_ in rows:
        r = out[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), i
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed
        assert not (failed and r.kept)


def test_trees_learn_keep_directions_and_match_a_walk():
    rng = np.random.default_rng(3)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.5) ^ (rng.random(3000) < 0.05)).astype(float)
    trees = q.grow(x, y, directions=(-1, 0, 1), trees=20)
    held = rng.random((500, 3))
    assert ((trees.score(held) >= 0.5) == (held[:, 0] < 0.5)).mean() > 0.97
    grid = np.tile(held[:1], (50, 1))
    grid[:, 0] = np.linspace(0, 1, 50)
    assert (np.diff(trees.margin(grid)) <= 1e-12).all()
    grid = np.tile(held[:1], (50, 1))
    grid[:, 2] = np.linspace(0, 1, 50)
    assert (np.diff(trees.margin(grid)) >= -1e-12).all()

    def walk(row):
        total = trees.base
        for k in trees.root:
            while trees.left[k] != k:
                k = trees.left[k] if row[trees.feature[k]] <= trees.threshold[k] else trees.right[k]
            total += trees.value[k]
        return total

    assert np.allclose([walk(r) for r in held[:40]], trees.margin(held[:40]))


def test_no_labels_or_one_kind():
    assert q.grow(np.zeros((0, 3)), np.zeros(0)).score(np.zeros((2, 3))).tolist() == q.constant(1.0).score(np.zeros((2, 3))).tolist()
    assert (q.grow(np.zeros((5, 3)), np.zeros(5)).score(np.zeros((2, 3))) < 0.5).all()


def test_held_out_accuracy(spark, tmp_path):
    rng = random.Random(1)
    rows, marks = [], []
    for i in range(300):
        good = i % 2 == 0
        text = prose(rng, 80)
        if not good:
            text = " ".join(w + rng.choice(["###", "$$$", "%%%"]) for w in text.split())
        rows.append((i, text, "en", "a"))
        marks.append((i, int(good), 0))
    folder = save(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    known = spark.createDataFrame(marks[:200], "doc_id long, quality int, toxic int")
    trees = q.learn(docs, known)
    out = {r.doc_id: r.score for r in q.judge(docs, trees).collect()}
    assert sum((out[i] >= 0.5) == bool(g) for i, g, _ in marks[200:]) >= 97


def test_mirrored_words_are_two(spark):
    for n in (512, 1024, 2048):
        a, b = mirrored_words(n)
        text = f"{a}\n{b}\n{a} x y {b} x y"
        s = q.statistics(q.pa.array([text]))
        assert (s["n_words"][0], s["word_chars"][0], s["n_symbols"][0], s["n_dup_lines"][0], s["n_repeat_words"][0]) == brute(text)


def test_empty_tables(spark, tmp_path):
    labels(spark, tmp_path, [])
    assert q.op2_quality_trees(spark, save(spark, tmp_path, [])).count() == 0
    rows = [(1, "some words", "en", "a"), (None, None, None, None)]
    labels(spark, tmp_path / "none", [])
    out = q.op2_quality_trees(spark, save(spark, tmp_path / "none", rows)).collect()
    assert sorted((r.n_words, r.kept) for r in out) == [(0, False), (2, False)]


def test_an_id_of_many_rows_teaches_once(spark):
    docs = spark.createDataFrame([(1, f"text {k} with some words") for k in range(200)] + [(2, "b " * 60)], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    found = []
    grown = q.grow
    try:
        q.grow = lambda x, y, *a, **k: (found.append(len(x)), grown(x, y, *a, **k))[1]
        q.learn(docs, marks)
    finally:
        q.grow = grown
    assert found == [2]
