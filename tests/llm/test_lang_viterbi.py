import itertools
import random
import zlib

import numpy as np

from cohortlens.llm import lang_viterbi as lv

from .small import odd_documents, prose, save


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(7)
    for k in (1, 2, 3):
        counts = np.array([0, 5, 1, 4, 0, 5])
        scores = rng.normal(size=(counts.sum(), k)).astype(np.float32)
        found = lv.viterbi(scores, counts, switch=0.8)
        at = 0
        for n in counts:
            own = scores[at : at + n]
            value = lambda path: sum(own[i, c] for i, c in enumerate(path)) - 0.8 * sum(a != b for a, b in zip(path, path[1:]))
            best = max(value(p) for p in itertools.product(range(k), repeat=int(n)))
            assert abs(value(found[at : at + n].tolist()) - best) < 1e-4
            at += n


def learning_rows(n=240):
    rng = random.Random(3)
    return [(k, prose(rng, 40, ("en", "fr", "de")[k % 3]), ("en", "fr", "de")[k % 3], "a") for k in range(n)]


def test_held_out_accuracy_and_spans(spark, tmp_path):
    rows = learning_rows() + [(1000, "Привет мир", "ru", "a"), (1001, "Как дела сегодня", "ru", "a")]
    rng = random.Random(9)
    mixed = prose(rng, 25, "fr") + " " + prose(rng, 25, "de")
    rows.append((2000, mixed, None, None))
    folder = save(spark, tmp_path, rows)
    out = {r.doc_id: r for r in lv.op10_language_id(spark, folder).collect()}
    held = [(i, lang) for i, _, lang, _ in rows if lang and zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, *_ in rows)
    assert np.mean([out[i].lang_pred == lang for i, lang in held]) > 0.95
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = lv.learn_from_documents(docs)
    assert "ru" in model.langs
    _, _, spans = lv.predict_texts([mixed, "Россия и мир", "漢字"], model)
    assert [s["lang"] for s in spans[0]] == ["fr", "de"]
    middle = len(mixed) // 2
    assert abs(spans[0][0]["end"] - mixed.index(" ", middle - 60)) < 200
    assert [s["lang"] for s in spans[1]] == ["ru"]  # its script leaves no other
    assert 0 <= out[2000].score <= 1 and out[2000].n_spans == 2


def test_odd_texts_and_no_labels(spark, tmp_path):
    rows = odd_documents()
    out = {r.doc_id: r for r in lv.op10_language_id(spark, save(spark, tmp_path / "a", rows)).collect()}
    assert len(out) == len(rows)
    for i in (0, 1, 2, 15):
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    blank = [(i, t, None, s) for i, t, _, s in rows]
    assert {r.lang_pred for r in lv.op10_language_id(spark, save(spark, tmp_path / "b", blank)).collect()} == {"und"}
    assert lv.op10_language_id(spark, save(spark, tmp_path / "c", [])).count() == 0


def test_repeated_learning_is_the_same(spark, tmp_path):
    folder = save(spark, tmp_path, learning_rows(60))
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    one, two = (lv.learn_from_documents(docs.repartition(n)) for n in (2, 5))
    assert one.langs == two.langs and np.array_equal(one.log_p, two.log_p)


def test_four_hundred_languages():
    """Labels past 255 are kept: every language has words of its own."""
    rng = random.Random(21)
    own = [["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(3)] for _ in range(400)]
    langs = [f"l{k:03d}" for k in range(400)]
    counts = np.zeros((400, lv.BUCKETS))
    for k, words in enumerate(own):
        counts[k] += np.bincount(lv.words_of([" ".join(words)]).trigram, minlength=lv.BUCKETS)
    log_p = (np.log(counts + 0.5) - np.log(counts.sum(1, keepdims=True) + 0.5 * lv.BUCKETS)).astype(np.float32)
    may = np.zeros((len(lv.SCRIPT_NAMES), 400), bool)
    may[lv.SCRIPT_NAMES.index("latin")] = True
    model = lv.Model(langs, log_p, may)
    pred, score, spans = lv.predict_texts([" ".join(words * 4) for words in own], model)
    assert pred == langs and min(score) == 1.0
    assert all(len(s) == 1 for s in spans)


def test_letters_of_unclaimed_scripts_count_against_the_score(spark):
    df = spark.createDataFrame([(k, prose(random.Random(k), 30, "de"), "de") for k in range(20)], "doc_id long, text string, lang string")
    model = lv.learn(df)
    texts = ["漢字漢字", "die sch 漢字", "die schei", "Привет мир", ""]
    pred, score, claimed = zip(*((p, s, c) for p, s, _, c in zip(*lv._predicted(texts, model, lv.SWITCH))))
    assert pred == ("de", "de", "de", "de", "und")
    assert score == (0.0, 0.75, 1.0, 0.0, 0.0) and claimed == (0.0, 0.75, 1.0, 0.0, 0.0)
