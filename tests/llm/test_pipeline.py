import random

import numpy as np

import corpus_pipeline
from cohortlens.llm import bitmap_join, bpe, entropy_balance, lang_viterbi, pii_crf

from .small import odd_documents, prose, save
from .test_bitmap_join import brute, common_words, groups


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(11)
    rows = odd_documents() + groups(rng, 100, 20, 4)
    rows += [(500, "Write to me at jo.do@mail.example.com " + prose(rng, 30), "en", "b"), (501, rows[-1][1], "en", "b")]
    folder = save(spark, tmp_path, rows)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, {i: t for i, t, *_ in rows}

    stages = dict(corpus_pipeline.STAGES)
    one = stages["language_id"](spark, docs, folder)
    assert one.columns == columns
    known = {r.doc_id for r in one.collect()}
    # 12 is mostly in scripts that no learned language uses
    assert known == {i for i, t in kept.items() if any(c.isalpha() for c in t or "")} - {12}

    two = stages["near_duplicates"](spark, one, folder)
    assert two.columns == columns
    first = {r.doc_id for r in two.collect()}
    assert first == {c for _, _, c in brute([r for r in rows if r[0] in known])}

    three = stages["personal_data"](spark, two, folder)
    assert three.dtypes == docs.dtypes
    texts = {r.doc_id: (r.text, r.n_chars) for r in three.collect()}
    assert set(texts) == first
    assert "[EMAIL]" in texts[500][0] and "jo.do" not in texts[500][0] and texts[500][1] == len(texts[500][0])
    assert all(texts[i][0] == kept[i] for i in first if not any(c in "0123456789@+" for c in kept[i]))

    four = stages["source_mix"](spark, three, folder)
    assert four.columns == columns
    copies = {r.doc_id: r.copies for r in entropy_balance.mix(three).collect()}
    mixed = [r.doc_id for r in four.collect()]
    assert sorted(mixed) == sorted(i for i, c in copies.items() for _ in range(c))

    five = stages["byte_bpe"](spark, four, folder).collect()
    enc = bpe._encoding(bpe.public_tokenizers.path(bpe.RANKS), bpe.public_tokenizers.PATTERN)
    assert sorted(r.doc_id for r in five) == sorted(mixed)
    for r in five:
        assert r.n_tokens == len(enc.encode_ordinary(texts[r.doc_id][0])) == len(r.ids) // 4

    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r.doc_id, bytes(r.ids)) for r in whole.collect()) == sorted((r.doc_id, bytes(r.ids)) for r in five)


def test_empty_and_extra_columns(spark, tmp_path):
    folder = save(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, folder).count() == 0
    df = spark.createDataFrame([(1, "bonjour à tous", None, "a", 14, 0.5, "q")], "doc_id long, text string, lang string, source string, n_chars long, lang_pred double, rep string")
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, df, folder)
        assert out.columns == df.columns, name
    model = lang_viterbi.Model(["fr"], lang_viterbi.np.zeros((1, lang_viterbi.BUCKETS), "float32"), lang_viterbi.np.ones((25, 1), bool))
    out = lang_viterbi.predict(df, model, keep=tuple(df.columns), add=("lang_pred",), prefix="stage_")
    assert out.columns == [*df.columns, "stage_lang_pred"]
    assert pii_crf.KINDS[:4] == pii_crf.BASE_KINDS


def test_repeated_rows_leave_one(spark, tmp_path):
    text = prose(random.Random(1), 40)
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "a"), (3, None, "en", "a")]
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows)}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def near_duplicates_of(spark, folder, rows):
    docs = spark.read.parquet(f"{save(spark, folder, rows)}/documents.parquet")
    out = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, str(folder))
    assert out.columns == docs.columns
    return sorted(((r.doc_id, r.text) for r in out.collect()), key=str)


def test_an_id_with_two_texts_loses_only_the_copy(spark, tmp_path):
    a, b, c = (prose(random.Random(k), 40) for k in range(3))
    rows = [(1, a, "en", "a"), (5, a, "en", "a"), (5, b, "en", "a"), (6, c, "en", "a"), (6, c + " end", "en", "a"), (7, None, "en", "a")]
    out = near_duplicates_of(spark, tmp_path, rows)
    assert len(out) == 4 and out.count((6, c)) + out.count((6, c + " end")) == 1
    assert {(1, a), (5, b), (7, None)} <= set(out)


def test_copies_without_an_id_go(spark, tmp_path):
    a, b, c = (prose(random.Random(k), 40) for k in range(3))
    rows = [(None, a, "en", "a"), (None, a, "en", "b"), (None, a + " end", "en", "a"), (None, b, "en", "a"), (4, b, "en", "a"), (None, c, "en", "a")]
    out = near_duplicates_of(spark, tmp_path, rows)
    assert len(out) == 3 and {(4, b), (None, c)} <= set(out)


def test_language_stage_rejects_scripts_that_no_language_uses(spark, tmp_path):
    """Texts mostly in other scripts go; every clean labelled document stays."""
    rng = random.Random(31)
    rows = [(k, prose(rng, rng.randint(1, 60), ("en", "fr", "de")[k % 3]), ("en", "fr", "de")[k % 3], "a") for k in range(150)]
    foreign = [(500, "это русский текст", None, "a"), (501, "漢字だけの文書", None, "a"), (502, "these are words 漢字", None, "a"), (503, "one это русский текст", None, "a"), (504, "12 34", "en", "a")]
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows + foreign)}/documents.parquet")
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["language_id"](spark, docs, str(tmp_path)).collect()}
    assert kept == {i for i, *_ in rows} | {502}


def test_columns_named_like_the_stages_own(spark):
    names = "doc_id long, text string, lang string, source string, n_chars long, stage_lang_pred string, near_key_ long, near_id_ string, mix_key_ string, MIX_copies_ long, mix_place_ int, Claimed string"
    rows = [(i, f"the same words of text number {i % 2} and a few more of them here", "en", "a", 40, "s", 5, "n", "m", 3, 1, "c") for i in range(6)]
    df = spark.createDataFrame(rows, names)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, "")
        assert out.columns == df.columns, name
        assert {tuple(r[5:]) for r in out.collect()} == {("s", 5, "n", "m", 3, 1, "c")}, name


def test_near_duplicates_gather_only_texts_that_may_be_near(spark, tmp_path, monkeypatch):
    """Common words in every document bring no further texts and places: one near copy, two texts."""
    rows = common_words(random.Random(23), 40)
    rows.append((90, rows[7][1] + " end", "en", "a"))
    monkeypatch.setattr(bitmap_join, "frequent_shingles", lambda docs: np.zeros(0, np.uint64))
    made, stored = {}, bitmap_join.stored

    def noted(df, name):
        out = stored(df, name)
        made[name] = out.count()
        return out

    monkeypatch.setattr(bitmap_join, "stored", noted)
    docs = spark.read.parquet(f"{save(spark, tmp_path, rows)}/documents.parquet")
    kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(40))
    assert made["texts"] == 2 and made["places-0"] == 0
