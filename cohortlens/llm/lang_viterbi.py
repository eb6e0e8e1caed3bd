"""Language identification: script ranges narrow the candidates, Viterbi labels the words.

Learning counts hashed letter trigrams (with word edges) of every labelled text
by language, and how many letters of each script a language uses. The counts
are summed by Spark; the model is languages x ``BUCKETS`` logarithms, bounded by
the number of languages.

Prediction takes maximal runs of letters as words. The script of a word narrows
the languages that may claim it; a word's score in a language is the sum of its
trigrams' logarithms. Viterbi over all words of a text, with a penalty for each
switch, labels every word; neighbouring words of one label form a span. The
text's language is the one with the most labelled letters, its score that
language's share of all letters; letters of words whose script no language uses
count for none.

Defined cases: a null text or one without letters is ``und`` with score 0 and
no spans; with nothing learned every text is ``und``; ties of letters go to the
language first in code point order; rows with a null label or null text teach
nothing; a word whose script no language uses scores alike in all of them, and
a text of such words alone has the first language with score 0; languages may be
any number; texts are read whole, whatever their length; repeated rows are predicted alike.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import CALL_BYTES, map_batches, read_documents

#: Hash buckets of trigrams in each language.
BUCKETS = 1 << 15
#: Natural-logarithm price of changing the language between two words.
SWITCH = 8.0
#: A language may claim a word if this share of its learned letters is of the word's script.
SCRIPT_SHARE = 0.001
#: Added to the score of a language that may not claim a word.
BARRED = -50.0

# First and last code points of the blocks of each script.
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x0370, 0x03FF),
    ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x06FF),
    ("arabic", 0x0750, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("gurmukhi", 0x0A00, 0x0A7F),
    ("gujarati", 0x0A80, 0x0AFF),
    ("tamil", 0x0B80, 0x0BFF),
    ("telugu", 0x0C00, 0x0C7F),
    ("kannada", 0x0C80, 0x0CFF),
    ("malayalam", 0x0D00, 0x0D7F),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("hangul", 0x1100, 0x11FF),
    ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x4DBF),
    ("han", 0x4E00, 0x9FFF),
]
SCRIPT_NAMES = ["other", *dict.fromkeys(name for name, _, _ in SCRIPTS)]


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point: is it a letter, its lower case (where that is one character), its script."""
    n = 0x110000
    letter, lower, script = np.zeros(n, bool), np.arange(n, dtype=np.uint32), np.zeros(n, np.uint8)
    for i in range(0x33480):  # no letters are assigned above
        if unicodedata.category(c := chr(i))[0] == "L":
            letter[i] = True
            if len(c.lower()) == 1:
                lower[i] = ord(c.lower())
    for name, first, last in SCRIPTS:
        script[first : last + 1] = SCRIPT_NAMES.index(name)
    return letter, lower, script


@dataclass
class Words:
    """Letters of several texts, one after the other, and the words that they form."""

    letters_at: np.ndarray  # place of each letter in its text
    trigram: np.ndarray  # bucket of the trigram around each letter
    script: np.ndarray  # of each letter
    first: np.ndarray  # of each word: its first letter
    length: np.ndarray  # of each word, in letters
    text: np.ndarray  # of each word: its text


def words_of(texts: list[str | None]) -> Words:
    is_letter, lower, scripts = _tables()
    texts = [t or "" for t in texts]
    joined = "\n" + "\n".join(texts) + "\n"
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum([1] + [len(t) + 1 for t in texts])[:-1]
    letter = is_letter[cp]
    at = np.flatnonzero(letter)
    folded = np.where(letter, lower[cp], np.uint32(32))
    h = folded[at - 1] * np.uint32(0x9E3779B1) + folded[at] * np.uint32(0x85EBCA6B) + folded[at + 1] * np.uint32(0xC2B2AE35)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    trigram = (h >> np.uint32(32 - BUCKETS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    length = np.diff(first, append=len(at))
    text = np.searchsorted(starts, at[first], side="right") - 1
    letter_text = np.repeat(text, length)
    return Words(at - starts[letter_text] if len(at) else at, trigram, scripts[cp[at]], first, length, text)


@dataclass
class Model:
    langs: list[str]
    log_p: np.ndarray  # languages x BUCKETS
    may: np.ndarray  # scripts x languages


def learn(df: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Model of every row of ``df`` that has a text and a label; counts are summed on the executors."""
    spark = df.sparkSession
    rows = df.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    width = BUCKETS + len(SCRIPT_NAMES)

    def count(batches):
        from .batches import slices

        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, "text"):
                labels = np.array(part.column("lang").to_pylist(), dtype=object)
                w = words_of(part.column("text").to_pylist())
                of = labels[np.repeat(w.text, w.length)]
                for name in sorted(set(labels)):
                    own = sums.setdefault(name, np.zeros(width, np.int64))
                    mine = of == name
                    own[:BUCKETS] += np.bincount(w.trigram[mine], minlength=BUCKETS)
                    own[BUCKETS:] += np.bincount(w.script[mine], minlength=len(SCRIPT_NAMES))
        for name, own in sums.items():
            used = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(own[used], pa.int64())], ["lang", "slot", "n"]
            )

    totals = rows.mapInArrow(count, "lang string, slot int, n bigint").groupBy("lang", "slot").agg(F.sum("n").alias("n"))
    found = totals.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((len(langs), width))
    if langs:
        row = {name: i for i, name in enumerate(langs)}
        counts[[row[x] for x in found.column("lang").to_pylist()], found.column("slot").to_numpy()] = found.column("n").to_numpy()
    grams, letters = counts[:, :BUCKETS], counts[:, BUCKETS:]
    log_p = np.log(grams + 0.5) - np.log(grams.sum(1, keepdims=True) + 0.5 * BUCKETS)
    may = letters.T >= SCRIPT_SHARE * np.maximum(letters.sum(1), 1)
    return Model(langs, log_p.astype(np.float32), may)


def word_scores(w: Words, model: Model) -> np.ndarray:
    """Words x languages; zero for a word whose script no language uses."""
    if len(w.first) == 0:
        return np.zeros((0, len(model.langs)), np.float32)
    sums = np.stack([np.add.reduceat(p[w.trigram], w.first) for p in model.log_p], axis=1)
    sums -= sums.max(1, keepdims=True)
    may = model.may[w.script[w.first]]
    claimed = may.any(1)
    return np.where(claimed[:, None], sums + np.where(may, np.float32(0), np.float32(BARRED)), np.float32(0))


def viterbi(scores: np.ndarray, counts: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of every word, for texts of ``counts`` words one after the other; all texts step together."""
    k = scores.shape[1]
    kind = np.min_scalar_type(max(k - 1, 0))
    label = np.zeros(len(scores), kind)
    order = np.argsort(-counts, kind="stable")
    counts, first = counts[order], (np.cumsum(counts) - counts)[order]
    longest = int(counts[0]) if len(counts) else 0
    if not longest or not k:
        return label
    # how many texts have more than t words
    active = np.searchsorted(-counts, -np.arange(longest), side="left")
    best = np.zeros((int(active[0]), k), np.float32)
    came = np.zeros(len(scores), kind)  # best label at the word before
    stay = np.zeros((len(scores), k), bool)
    for t in range(longest):
        n = active[t]
        at, v = first[:n] + t, best[:n]
        top = v.max(1)
        came[at] = v.argmax(1)
        hop = (top - np.float32(switch))[:, None]
        stay[at] = v >= hop
        best[:n] = np.maximum(v, hop) - top[:, None] + scores[at]
    now = best.argmax(1).astype(kind)
    last = first[: len(now)] + counts[: len(now)] - 1
    held = np.zeros(len(now), kind)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        at = first[:n] + t
        fresh = at == last[:n]
        cur = np.where(fresh, now[:n], held[:n])
        label[at] = cur
        held[:n] = np.where(stay[at, cur], cur, came[at])
    return label


def predict_texts(texts: list[str | None], model: Model, switch: float = SWITCH):
    """Language, score and spans (start, end in code points, language) of each text."""
    return _predicted(texts, model, switch)[:3]


def _predicted(texts: list[str | None], model: Model, switch: float):
    """``predict_texts``, and the share of each text's letters that some language claims."""
    n, k = len(texts), len(model.langs)
    pred, score, spans, claimed = ["und"] * n, [0.0] * n, [[] for _ in range(n)], [0.0] * n
    w = words_of(texts)
    if not k or not len(w.first):
        return pred, score, spans, claimed
    label = viterbi(word_scores(w, model), np.bincount(w.text, minlength=n), switch)
    share = np.zeros((n, k))
    np.add.at(share, (w.text, label), w.length)
    total = share.sum(1)
    used = model.may[w.script[w.first]].any(1)
    known = np.zeros((n, k))
    np.add.at(known, (w.text[used], label[used]), w.length[used])
    for i in np.flatnonzero(total):
        best = int(share[i].argmax())
        pred[i], score[i], claimed[i] = model.langs[best], float(known[i, best] / total[i]), float(known[i].sum() / total[i])
    change = np.flatnonzero((np.diff(w.text, prepend=-1) != 0) | (np.diff(label.astype(np.int64), prepend=-1) != 0))
    ends = np.append(change[1:], len(label)) - 1
    start = w.letters_at[w.first[change]]
    end = w.letters_at[w.first[ends] + w.length[ends] - 1] + 1
    for i, a, b, c in zip(w.text[change].tolist(), start.tolist(), end.tolist(), label[change].tolist()):
        spans[i].append({"start": a, "end": b, "lang": model.langs[c]})
    return pred, score, spans, claimed


_ADDED = {
    "lang_pred": ("string", pa.string()),
    "score": ("double", pa.float64()),
    "spans": ("array<struct<start:int,end:int,lang:string>>", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))),
    "claimed": ("double", pa.float64()),
}
#: Languages for which a call takes its full bytes of text; with more, scores of as many words fill the memory of fewer.
FULL_CALL = 16


def predict(
    df: DataFrame,
    model: Model,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    switch: float = SWITCH,
    add: tuple[str, ...] = ("lang_pred", "score", "spans"),
    prefix: str = "",
) -> DataFrame:
    """``keep`` columns with lang_pred, score, spans and claimed (those named in ``add``, behind ``prefix``) of every text."""

    def make():
        def apply(batch):
            found = dict(zip(_ADDED, _predicted(batch.column(text).to_pylist(), model, switch)))
            return [pa.array(found[c], _ADDED[c][1]) for c in add]

        return apply

    return map_batches(df, make, ", ".join(f"`{prefix}{c}` {_ADDED[c][0]}" for c in add), keep, text, CALL_BYTES * FULL_CALL // max(FULL_CALL, len(model.langs)))


def held_out(doc_id) -> F.Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 0 by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def learn_from_documents(docs: DataFrame) -> Model:
    return learn(docs.where(~held_out("doc_id")))


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Per document: whether it was held out, its language, the score, and its number of language spans."""
    model = learn_from_documents(read_documents(spark, sf_dir, "doc_id", "text", "lang"))
    found = predict(read_documents(spark, sf_dir, "doc_id", "text"), model)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", F.size("spans").cast("long").alias("n_spans"))
