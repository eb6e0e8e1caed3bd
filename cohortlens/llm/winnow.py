"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points has a rolling hash; of every ``WINDOW``
neighbouring hashes the smallest is chosen, the rightmost where several are
smallest. A fingerprint is the list of chosen hashes with their positions. Two
texts that share ``GRAM + WINDOW - 1`` code points in a row share a chosen hash,
and the positions say where. Likeness is the Jaccard index of the chosen hashes.

Defined cases: null counts as the empty text; a text shorter than a gram has
one hash, of the whole text, at position 0 (the empty text has none); a text of
fewer hashes than a window is one window; two empty fingerprints are alike (1),
an empty and another are not (0); equal texts have equal fingerprints. In the
order of documents, rows with one id follow one another by a hash of their text and null ids
come last; an empty table gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import map_batches, read_documents
from .words import mix64, powers

#: Code points of a gram, and hashes of a window.
GRAM, WINDOW = 24, 77
_BASE = 0xA24BAED4963EE407


def gram_hashes(text: str, gram: int = GRAM) -> np.ndarray:
    """32-bit hash of every run of ``gram`` code points; one hash of a shorter text."""
    cp = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(cp)
    if n == 0:
        return np.zeros(0, np.uint64)
    size = min(gram, n)
    up, down = powers(_BASE, n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((cp + np.uint64(1)) * up[:n], out=sums[1:])
    rolling = (sums[size:] - sums[: n - size + 1]) * down[: n - size + 1]
    return mix64(rolling + np.uint64(size)) >> np.uint64(32)


def winnow(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Chosen hashes and their positions, in order."""
    n = len(hashes)
    if n == 0:
        return hashes.astype(np.uint32), np.zeros(0, np.int64)
    # the later of two equal hashes is the smaller key
    low = np.uint64(0xFFFFFFFF)
    keys = (hashes << np.uint64(32)) | (low - np.arange(n, dtype=np.uint64))
    size = min(window, n)
    least, span = keys, 1
    while span < size:
        step = min(span, size - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    chosen = least[np.flatnonzero(np.diff(least, prepend=~least[:1]) != 0)]
    return (chosen >> np.uint64(32)).astype(np.uint32), (low - (chosen & low)).astype(np.int64)


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    return winnow(gram_hashes(text, gram), window)


def shown(mark: tuple[np.ndarray, np.ndarray]) -> str:
    """``hash:position`` pairs, comma-joined."""
    return ",".join(["%08x:%d" % pair for pair in zip(mark[0].tolist(), mark[1].tolist())])


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(
    df: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), gram: int = GRAM, window: int = WINDOW
) -> DataFrame:
    """``keep`` columns with the arrays ``hashes`` and ``positions`` of every text."""

    def make():
        def apply(batch):
            marks = [fingerprint(t or "", gram, window) for t in batch.column(text).to_pylist()]
            return [
                pa.array([h.astype(np.int64) for h, _ in marks], pa.list_(pa.int64())),
                pa.array([p for _, p in marks], pa.list_(pa.int64())),
            ]

        return apply

    return map_batches(df, make, "hashes array<bigint>, positions array<bigint>", keep, text)


#: Documents of one range of ids, about; ranges at most; ids sampled for each range's bounds.
RANGE_ROWS, MOST_RANGES, SAMPLED = 512, 1 << 16, 4
#: Above the ranges of ids: the first range of rows without one.
_WITHOUT_ID = 1 << 24


def _cut(ids: np.ndarray, hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Range of each id among descending bounds; an id that holds several bounds is cut by its rows' hashes."""
    up = bounds[::-1]
    above = len(up) - np.searchsorted(up, ids, side="right")  # bounds greater than the id
    own = len(up) - np.searchsorted(up, ids, side="left") - above
    return above + np.where(own > 1, _slot(hashes, own), 0)


def _slot(hashes: np.ndarray, n) -> np.ndarray:
    """Which of n equal ranges a 64-bit hash is in, in order of the hashes."""
    return ((hashes >> 32) + (1 << 31)) * n >> 32


def in_order(df: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Rows (part, doc_id, text, guest), parts whole in a task and sorted by descending id.

    Rows that share an id, and rows without one (which come last), are in order of
    a hash of their text. Ids are cut at quantiles of a sample, which sets balance
    only; an id of many rows, and the rows without an id, are cut by the hash. The
    first row of a part is also a guest at the end of the part before it (of the
    first part: at the end of the last), so every row has its successor next to it
    after one shuffle. Rows are sorted on disk if need be and read as a stream.
    """
    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    n, with_id = rows.agg(F.count("*"), F.count("doc_id")).first()
    parts, others = (max(1, min(MOST_RANGES, -(-k // RANGE_ROWS))) for k in (with_id, n - with_id))
    share = min(1.0, SAMPLED * parts / max(with_id, 1))
    # at most some SAMPLED * MOST_RANGES ids
    sample = np.zeros(0, np.int64)
    if parts > 1:
        sample = rows.select("doc_id").where("doc_id is not null").sample(share, 7).toArrow().column(0).to_numpy()
    step = SAMPLED if share < 1 else RANGE_ROWS
    bounds = np.sort(sample)[::-1][step - 1 :: step]

    @F.pandas_udf("int")
    def part_of(ids: pd.Series, ties: pd.Series, none: pd.Series) -> pd.Series:
        i, h = ids.to_numpy(), ties.to_numpy()
        return pd.Series(np.where(none, _WITHOUT_ID + _slot(h, others), _cut(i, h, bounds)).astype(np.int32))

    # without nulls, so that whole numbers are not held as floats
    placed = rows.withColumn("part", part_of(F.coalesce("doc_id", F.lit(0).cast("long")), "tie", F.col("doc_id").isNull()))
    # (part, its highest id and lowest hash there): three numbers for each of the parts
    firsts = placed.groupBy("part").agg(F.max(F.struct("doc_id", F.bitwise_not("tie").alias("untie"))).alias("top"))
    used = sorted((r["part"], r["top"]["doc_id"], ~r["top"]["untie"]) for r in firsts.collect())
    if not used:
        return placed.select("part", "doc_id", "text", F.lit(False).alias("guest"))
    hosts = [(p, top, tie, used[i - 1][0]) for i, (p, top, tie) in enumerate(used)]
    firsts = df.sparkSession.createDataFrame(hosts, "first_part int, top long, top_tie long, host int")
    # four numbers a row and at most 2 * MOST_RANGES rows: 4 MB
    found = placed.join(F.broadcast(firsts), F.col("part") == F.col("first_part"))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    away = F.struct(F.col("host").alias("part"), F.lit(True).alias("guest"))
    is_first = F.col("doc_id").eqNullSafe(F.col("top")) & (F.col("tie") == F.col("top_tie"))
    seats = F.when(is_first, F.array(own, away)).otherwise(F.array(own))
    seated = found.select("doc_id", "text", "tie", F.explode(seats).alias("seat")).select("seat.part", "doc_id", "text", "tie", "seat.guest")
    return seated.repartition("part").sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), "tie", "text").drop("tie")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as much of the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_EDITED = {
    "doc_id": (T.LongType(), pa.int64()),
    "n_chars": (T.LongType(), pa.int64()),
    "edited_sha256": (T.StringType(), pa.string()),
    "fingerprint": (T.StringType(), pa.string()),
    "edited_fingerprint": (T.StringType(), pa.string()),
    "near_edited": (T.DoubleType(), pa.float64()),
    "near_next": (T.DoubleType(), pa.float64()),
}


def compare_edited(df: DataFrame, text: str = "text", doc_id: str = "doc_id", gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses."""
    arrow = pa.schema([(name, kind) for name, (_, kind) in _EDITED.items()])

    def run(batches):
        held, out = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("part", "doc_id", "text", "guest")]
            for part, i, t, guest in zip(*columns):
                if held is not None and held[0] != part:
                    held = None
                if held is None and guest:  # the second of several rows that share the first id
                    continue
                mark = fingerprint(t, gram, window)
                if held is not None:
                    out.append(row(held, t, mark))
                held = None if guest else (part, i, t, mark)
                if len(out) >= 500:
                    yield pa.RecordBatch.from_pylist(out, arrow)
                    out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    def row(held, following, next_mark):
        _, i, t, mark = held
        changed = edited(t, following)
        other = fingerprint(changed, gram, window)
        return {
            "doc_id": i,
            "n_chars": len(t),
            "edited_sha256": hashlib.sha256(changed.encode()).hexdigest(),
            "fingerprint": shown(mark),
            "edited_fingerprint": shown(other),
            "near_edited": likeness(mark[0], other[0]),
            "near_next": likeness(mark[0], next_mark[0]),
        }

    schema = T.StructType([T.StructField(name, kind) for name, (kind, _) in _EDITED.items()])
    return in_order(df, text, doc_id).mapInArrow(run, schema)


def op3_winnowing(spark, sf_dir: str) -> DataFrame:
    """Per document: fingerprints of its text and edited text, and likeness to the edited text and the next document."""
    return compare_edited(read_documents(spark, sf_dir, "doc_id", "text"))
