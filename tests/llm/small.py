"""Small document tables for the operators' tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string, n_words string, node string, place string"


def save(spark, folder, rows, schema=SCHEMA, partitions=3) -> str:
    """``rows`` (doc_id, text, lang, source) as a documents table with further columns that clash with outputs."""
    full = [(i, t, lang, s, None if t is None else len(t), "x", "y", None, "z", "p") for i, t, lang, s in rows]
    spark.createDataFrame(full, schema).repartition(partitions).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    return str(folder)


def prose(rng: random.Random, n: int, lang: str = "en") -> str:
    parts = {"en": ["th", "ing", "and", "er", "ou", "st"], "fr": ["é", "eau", "tion", "qu", "le", "oi"], "de": ["sch", "ung", "ei", "ü", "keit", "ge"]}[lang]
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(n))


def odd_documents():
    """Nulls, empty, very long, tied and repeated rows."""
    rng = random.Random(5)
    base = prose(rng, 120)
    long = prose(rng, 9000)
    rows = [
        (0, None, "en", "a"),
        (1, "", None, None),
        (2, "   \n\t ", "en", "a"),
        (3, "one", "en", "b"),
        (4, "A b\tc\x0bd", "fr", "b"),
        (5, base, "en", "a"),
        (6, base, "en", None),
        (7, base.replace(" ", "\n", 3), "en", "a"),
        (8, base + " tail words differ here", "en", "c"),
        (9, "".join(base.split(" ")[0:1]) + " " + base, "en", "a"),
        (10, long, "en", "a"),
        (11, "intro " + long[:3000] + " outro", "en", "b"),
        (12, "日本語 テキスト é́ ñ ß 𝟐𝟓", "fr", "b"),
        (13, "x" * 5000, "de", "c"),
        (14, "a a a a a a a a a a", "de", "c"),
        (15, "12 34 ... !!! $$$", "de", "c"),
    ]
    for k in range(16, 40):
        lang = ("en", "fr", "de")[k % 3]
        rows.append((k, prose(rng, rng.randint(3, 90), lang), lang, "abc"[k % 3]))
    return rows


def mirrored_words(n: int) -> tuple[str, str]:
    """Two words of n letters (a power of two) that any polynomial modulo 2**64 takes for one from 1,024 letters on."""
    word = "a"
    while len(word) < n:
        word += word.translate({97: "b", 98: "a"})
    return word, word.translate({97: "b", 98: "a"})
