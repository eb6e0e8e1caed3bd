"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are counted on its bytes. The trees are grown on
labelled documents (at most ``SAMPLE`` of them, the first by a hash of their
ids), by histogram splits of the logistic loss, with monotonic constraints on
chosen statistics: more symbols, repeated lines or repeated words can only lower
the score, more distinct words can only raise it. The grown trees are flattened
into node arrays, so scoring walks all rows and trees level by level in numpy.

Defined cases: null text has no words and fails the base rules; a label that is
null or whose document is missing teaches nothing, several labels of one
document count as their smallest; with no labels, or labels of one kind only,
the trees are a constant (kept when there are none); ties between splits go to
the earlier statistic and lower threshold; texts are read whole; repeated rows
score alike; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_batches, read_documents
from .words import SEPARATOR, Texts, byte_hash, mix64, read_texts, run_hash, windows

#: Labelled documents that the trees are grown on, at most.
SAMPLE = 20_000
TREES, DEPTH, BINS = 60, 4, 32
RATE, LEAST_ROWS, RIDGE = 0.15, 20, 1.0
#: Score from which a document is kept.
KEEP = 0.5

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Statistics that the trees see, with the direction in which the score may go.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 1,
    "upper_share": 0,
    "digit_share": 0,
    "punctuation_share": 0,
    "beyond_ascii_share": 0,
    "words_per_line": 0,
    "closed_line_share": 0,
    "longest_word": 0,
}
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))


def _per_text(t: Texts, mask: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=sums[1:])
    return sums[t.at[1:]] - sums[t.at[:-1]]


def _repeats(owner: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value: does its owner have it more than once, and is this one after the first?"""
    key = mix64(value + mix64(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    several, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:]] = same
    several[order[1:]] |= same
    several[order[:-1]] |= same
    return several, later


def statistics(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts and the trees' statistics of every text."""
    t = read_texts(column)
    n, raw = len(t.count), t.raw
    text = t.text
    out = {"n_words": t.count.astype(np.int64)}
    lead = (raw & 0xC0) != 0x80
    out["word_chars"] = _per_text(t, lead & ~SEPARATOR[raw])
    out["n_symbols"] = _per_text(t, _SYMBOLS[raw])

    # lines: cut at \n and at the ends of texts
    breaks = np.flatnonzero(raw == 10)
    starts = np.sort(np.concatenate([t.at[:-1], breaks + 1]))
    line_text = np.searchsorted(t.at, starts, side="right") - 1
    # an empty text has no bytes: its line begins where the next text's does
    ends = np.minimum(np.append(starts[1:], len(raw)), t.at[np.minimum(line_text + 1, n)])
    ends = np.where((ends > starts) & (raw[np.maximum(ends - 1, 0)] == 10 if len(raw) else False), ends - 1, ends)
    words_in = np.searchsorted(t.start, ends) - np.searchsorted(t.start, starts)
    real = words_in > 0
    starts, ends, line_text, words_in = starts[real], ends[real], line_text[real], words_in[real]
    _, later = _repeats(line_text, byte_hash(t.raw, starts, ends))
    lines = np.bincount(line_text, minlength=n)
    out["n_dup_lines"] = np.bincount(line_text[later], minlength=n).astype(np.int64)

    at = windows(t, 3)
    several, _ = _repeats(text[at], run_hash(t, at, 3))
    covered = np.zeros(len(t.start), bool)
    for k in range(3):
        covered[at[several] + k] = True
    out["n_repeat_words"] = np.bincount(text[covered], minlength=n).astype(np.int64)

    _, again = _repeats(text, t.hash)
    words, chars, rows = np.maximum(t.count, 1), np.maximum(out["word_chars"], 1), np.maximum(lines, 1)
    longest = np.zeros(n)
    np.maximum.at(longest, text, (t.end - t.start).astype(float))
    last = raw[ends - 1] if len(ends) else np.zeros(0, np.uint8)
    closed = np.bincount(line_text[np.isin(last, np.frombuffer(b".!?", np.uint8))], minlength=n)
    out["log_words"] = np.log1p(t.count)
    out["word_length"] = out["word_chars"] / words
    out["symbols_per_word"] = out["n_symbols"] / words
    out["dup_line_share"] = out["n_dup_lines"] / rows
    out["repeat_share"] = out["n_repeat_words"] / words
    out["distinct_share"] = 1 - np.bincount(text[again], minlength=n) / words
    out["upper_share"] = _per_text(t, (raw >= 65) & (raw <= 90)) / chars
    out["digit_share"] = _per_text(t, (raw >= 48) & (raw <= 57)) / chars
    out["punctuation_share"] = _per_text(t, np.isin(raw, np.frombuffer(b".,;:!?\"'()-", np.uint8))) / chars
    out["beyond_ascii_share"] = _per_text(t, lead & (raw >= 128)) / chars
    out["words_per_line"] = t.count / rows
    out["closed_line_share"] = closed / rows
    out["longest_word"] = longest
    return out


@dataclass
class Trees:
    """All trees' nodes in one set of arrays; a leaf points to itself."""

    root: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        row = np.arange(len(x))
        for root in self.root:
            node = np.full(len(x), root)
            for _ in range(DEPTH):
                node = np.where(x[row, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -50, 50)))


def constant(share: float) -> Trees:
    none = np.zeros(0, np.int64)
    odds = np.log(max(share, 1e-6) / max(1 - share, 1e-6))
    return Trees(none, none, np.zeros(0), none, none, np.zeros(0), float(odds))


def grow(x: np.ndarray, y: np.ndarray, directions=tuple(FEATURES.values()), trees: int = TREES) -> Trees:
    """Boosted trees of the logistic loss of labels ``y`` (0 or 1)."""
    if len(y) == 0:
        return constant(1.0)
    if y.min() == y.max():
        return constant(float(y[0]))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T)], axis=1)
    base = float(np.log(y.mean() / (1 - y.mean())))
    margin = np.full(len(y), base)
    root, feature, threshold, left, right, value = [], [], [], [], [], []

    def node() -> int:
        k = len(feature)
        feature.append(0), threshold.append(np.inf), left.append(k), right.append(k), value.append(0.0)
        return k

    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        top = node()
        root.append(top)
        open_ = [(top, np.arange(len(y)), -np.inf, np.inf, 0)]
        while open_:
            k, rows, low, high, depth = open_.pop()
            total_g, total_h = g[rows].sum(), h[rows].sum()
            weight = float(np.clip(-total_g / (total_h + RIDGE), low, high))
            best = (1e-6, None)
            if depth < DEPTH and len(rows) >= 2 * LEAST_ROWS:
                for f, way in enumerate(directions):
                    b = binned[rows, f]
                    n = np.cumsum(np.bincount(b, minlength=len(cuts[f]) + 1))[:-1]
                    sg = np.cumsum(np.bincount(b, g[rows], len(cuts[f]) + 1))[:-1]
                    sh = np.cumsum(np.bincount(b, h[rows], len(cuts[f]) + 1))[:-1]
                    if not len(n):
                        continue
                    wl = np.clip(-sg / (sh + RIDGE), low, high)
                    wr = np.clip(-(total_g - sg) / (total_h - sh + RIDGE), low, high)
                    loss = lambda w, a, c: a * w + 0.5 * (c + RIDGE) * w * w
                    gain = loss(weight, total_g, total_h) - loss(wl, sg, sh) - loss(wr, total_g - sg, total_h - sh)
                    fair = (n >= LEAST_ROWS) & (len(rows) - n >= LEAST_ROWS) & (way * (wr - wl) >= 0)
                    gain = np.where(fair, gain, 0)
                    i = int(gain.argmax())
                    if gain[i] > best[0]:
                        best = (gain[i], (f, i, wl[i], wr[i], way))
            if best[1] is None:
                value[k] = RATE * weight
                margin[rows] += value[k]
                continue
            f, i, wl, wr, way = best[1]
            feature[k], threshold[k], left[k], right[k] = f, float(cuts[f][i]), node(), node()
            middle = (wl + wr) / 2
            below = binned[rows, f] <= i
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high), (low, high))}[way]
            open_ += [(left[k], rows[below], *bounds[0], depth + 1), (right[k], rows[~below], *bounds[1], depth + 1)]
    return Trees(*(np.array(a) for a in (root, feature, threshold, left, right, value)), base)


def with_statistics(df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    names = BASE + list(FEATURES)

    def make():
        def apply(batch):
            found = statistics(batch.column(text))
            return [pa.array(found[c], pa.int64() if c in BASE else pa.float64()) for c in names]

        return apply

    fields = ", ".join([f"{c} bigint" for c in BASE] + [f"{c} double" for c in FEATURES])
    return map_batches(df, make, fields, keep, text)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees of at most ``sample`` labelled documents; their statistics alone come to the driver."""
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # a few bytes for each of at most ``sample`` rows
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("tie")).join(F.broadcast(chosen), "doc_id")
    # of rows that share an id one teaches, so that no more than ``sample`` come to the driver
    found = with_statistics(rows, keep=("doc_id", "quality", "tie")).groupBy("doc_id", "quality").agg(F.min(F.struct("tie", *FEATURES)).alias("s"))
    table = found.select("doc_id", "quality", *[F.col(f"s.{c}").alias(c) for c in FEATURES]).orderBy("doc_id").toArrow()
    x = np.stack([table.column(c).to_numpy() for c in FEATURES], axis=1) if len(table) else np.zeros((0, len(FEATURES)))
    return grow(x, (table.column("quality").to_numpy() > 0).astype(float))


def judge(df: DataFrame, trees: Trees, text: str = "text", keep: tuple[str, ...] = ("doc_id",), least: float = KEEP) -> DataFrame:
    """``keep`` columns with the base counts, base_failed, score and kept."""

    def make():
        def apply(batch):
            s = statistics(batch.column(text))
            failed = (s["n_words"] < 50) | (100 * s["n_repeat_words"] > 50 * s["n_words"])
            score = trees.score(np.stack([s[c] for c in FEATURES], axis=1))
            counts = [pa.array(s[c], pa.int64()) for c in BASE]
            return [*counts, pa.array(failed), pa.array(score), pa.array(~failed & (score >= least))]

        return apply

    fields = ", ".join(f"{c} bigint" for c in BASE) + ", base_failed boolean, score double, kept boolean"
    return map_batches(df, make, fields, keep, text)


def op2_quality_trees_base(spark, sf_dir: str) -> DataFrame:
    """Per document: the base counts and rules alone, which SQL can express."""
    found = with_statistics(read_documents(spark, sf_dir, "doc_id", "text"), keep=("doc_id",))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", *BASE, failed.alias("base_failed"))


def op2_quality_trees(spark, sf_dir: str) -> DataFrame:
    """Per document: base counts, whether the base rules fail it, the trees' score and the verdict."""
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    trees = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, trees)
