"""Substring dedup by fixed-block anchors.

Texts are sequences of words. Every text is cut into non-overlapping reference
blocks of ``BLOCK`` words, which are indexed; every rolling window of ``BLOCK``
words probes the index. A repeat of 2 * BLOCK words or more holds a whole block
of either text, wherever it lies, so no repeat is missed. Hits are extended to
all windows of ``2 * BLOCK`` words around them, and the windows whose words also
start in a document with a smaller id make up the maximal repeats; the words
that they cover are removed.

Texts are packed into calls (``calls.py``). A call puts each distinct window once
to the bucket of its hash: with the largest document that has it, and the smallest
that has it as a block. The bucket knows then the same of all calls, and answers
with the windows that are hits somewhere: those of a document above the smallest
block, and blocks of a document below the largest window. Around its hits a call
asks for the windows of twice the length with the smallest document that has them,
and learns the smallest of all calls. Nothing is emitted in pairs, and a window
that very many documents hold is one entry a call. Calls and answers go to Python
in small batches, since what a batch takes lies outside the heap.

Windows are compared by 64-bit hashes of the words' 64-bit hashes.

Defined cases: a null text has no words; a text of fewer than ``2 * BLOCK``
words keeps all; rows without an id keep all and remove nothing elsewhere; rows
that share an id remove nothing from one another (their ids are not smaller),
and each is judged by its own text; an empty table gives an empty table; only
the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import read_documents, slices, text_offsets
from .calls import bucket_of, by_row, pack, pack_keys, texts_of_call, unpack, unpack_keys
from .shared import done_with, scratch, small_batches, stored
from .words import Texts, read_texts, run_hash, windows

BLOCK = 25
#: Text bytes of a call, about (a longer text is a call of its own).
CALL_BYTES = 2 << 20
#: Calls whose windows a bucket's would make up, about: what a task holds of one.
CALLS_A_BUCKET = 2
_NONE = np.iinfo(np.int64).max
_LOW = np.iinfo(np.int64).min


def calls(docs: DataFrame, text: str, doc_id: str, limit: int = CALL_BYTES) -> DataFrame:
    """(call, ids, sizes, texts): one row a call, of whole texts."""
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches):
        part, seq, waiting, held = TaskContext.get().partitionId(), 0, [], 0

        def call():
            rows = pa.Table.from_batches(waiting)
            raw, at = text_offsets(rows.column("text").combine_chunks())
            row = [(part << 32) | seq, rows.column("doc_id").to_pylist(), np.diff(at).tolist(), raw.tobytes()]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], ["call", "ids", "sizes", "texts"])

        for batch in batches:
            for piece in slices(batch, "text", limit):
                size = len(text_offsets(piece.column("text"))[0])
                if waiting and held + size > limit:
                    yield call()
                    waiting, held, seq = [], 0, seq + 1
                waiting.append(piece)
                held += size
        if waiting:
            yield call()

    return rows.mapInArrow(run, "call bigint, ids array<bigint>, sizes array<bigint>, texts binary")


@dataclass
class Call:
    """A call's words, and the document of each text that takes part."""

    t: Texts
    doc: np.ndarray  # of each text; rows without an id have 0
    takes_part: np.ndarray  # has an id and two blocks' words at least

    def at(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of the windows of the texts that take part, and their texts."""
        at = windows(self.t, size)
        text = self.t.text[at]
        kept = self.takes_part[text]
        return at[kept], text[kept]


def opened(row: dict, block: int) -> Call:
    t = read_texts(texts_of_call(row))
    has_id = np.array([i is not None for i in row["ids"]], bool)
    doc = np.array([i or 0 for i in row["ids"]], np.int64)
    return Call(t, doc, has_id & (t.count >= 2 * block))


def _packed_ids(ids: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct ids, and the place of each among them."""
    known, which = np.unique(ids, return_inverse=True)
    return known.astype("<i8").tobytes(), pack(which)


def _ids(known: bytes, which: bytes, n: int) -> np.ndarray:
    return np.frombuffer(known, "<i8")[unpack(which, n).astype(np.int64)]


_ASK = "bucket int, call bigint, n int, keys binary, ids binary, who binary, blocks binary, n_blocks int, block_ids binary, block_who binary"


def _asked(row: dict, key: np.ndarray, doc: np.ndarray, largest: bool, is_block: np.ndarray | None, buckets: int) -> pa.RecordBatch:
    """One row for each bucket: distinct keys with their largest (or smallest) document, and those that are blocks with the smallest."""
    order = np.lexsort((doc, key))
    key, doc = key[order], doc[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(new)
    who = doc[np.append(first[1:], len(key)) - 1] if largest else doc[first]
    keys = key[first]
    cuts = np.searchsorted(bucket_of(keys, buckets), np.arange(buckets + 1))
    if is_block is not None:
        flagged = np.flatnonzero(is_block[order])
        place = np.cumsum(new)[flagged] - 1  # of the block's key; the first of a key has the smallest document
        once = np.ones(len(place), bool)
        once[1:] = place[1:] != place[:-1]
        place, least = place[once], doc[flagged[once]]
        block_cuts = np.searchsorted(place, cuts)
    rows = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        x, y = int(cuts[b]), int(cuts[b + 1])
        ids, which = _packed_ids(who[x:y])
        out = [b, row["call"], y - x, pack_keys(keys[x:y]), ids, which, None, 0, None, None]
        if is_block is not None:
            u, v = int(block_cuts[b]), int(block_cuts[b + 1])
            out[6:8] = pack(place[u:v] - x), v - u
            out[8:] = _packed_ids(least[u:v])
        rows.append(out)
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4, pa.int32(), *[pa.binary()] * 2]
    names = [f.split()[0] for f in _ASK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)


def _known(rows: pa.Table):
    """A bucket's questions: runs' sizes, sorted order of all keys, where a new key begins in it, and documents."""
    n = rows.column("n").to_numpy()
    keys = unpack_keys(rows.column("keys").to_pylist(), n)
    order = np.argsort(keys, kind="stable")
    new = np.ones(len(keys), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    doc = np.concatenate([_ids(i, w, s) for i, w, s in zip(*(rows.column(c).to_pylist() for c in ("ids", "who")), n.tolist())])
    return n, keys, order, new, doc


_ANSWER = pa.schema([("call", pa.int64()), ("keys", pa.binary()), ("least", pa.binary()), ("most", pa.binary())])
_ANSWER_SQL = "call bigint, keys binary, least binary, most binary"


def _answered(rows: pa.Table, n: np.ndarray, keep: np.ndarray, keys: np.ndarray, least: np.ndarray, most: np.ndarray | None) -> pa.Table:
    """One row for each question that has kept keys: those keys and what the bucket knows of them."""
    ends = np.cumsum(n)
    out: dict[str, list] = {c: [] for c in _ANSWER.names}
    for call, a, b in zip(rows.column("call").to_pylist(), (ends - n).tolist(), ends.tolist()):
        own = np.flatnonzero(keep[a:b]) + a
        if len(own):
            row = (call, keys[own].tobytes(), least[own].tobytes(), None if most is None else most[own].tobytes())
            for c, v in zip(out, row):
                out[c].append(v)
    return pa.Table.from_arrays([pa.array(v, f.type) for v, f in zip(out.values(), _ANSWER)], schema=_ANSWER)


def _hits(rows: pa.Table) -> pa.Table:
    """Windows that are hits somewhere: their smallest block's document is below their largest document."""
    n, keys, order, new, doc = _known(rows)
    start = np.concatenate([[0], np.cumsum(n)])
    block = np.full(len(keys), _NONE)
    parts = (rows.column(c).to_pylist() for c in ("blocks", "n_blocks", "block_ids", "block_who"))
    for a, places, size, ids, who in zip(start.tolist(), *parts):
        if size:
            block[a + unpack(places, size).astype(np.int64)] = _ids(ids, who, size)
    first = np.flatnonzero(new)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    least, most = np.minimum.reduceat(block[order], first)[which], np.maximum.reduceat(doc[order], first)[which]
    return _answered(rows, n, least < most, keys, least, most)


def _smallest(rows: pa.Table) -> pa.Table:
    """Every window with the smallest document that has it, where several calls do or one has it several times."""
    n, keys, order, new, doc = _known(rows)
    which = np.empty(len(keys), np.int64)
    which[order] = np.cumsum(new) - 1
    least = np.minimum.reduceat(doc[order], np.flatnonzero(new))[which]
    return _answered(rows, n, np.ones(len(keys), bool), keys, least, None)


def _told(answers: pa.Table):
    """A call's answers: sorted keys, with the smallest and the largest documents."""
    key = np.frombuffer(b"".join(answers.column("keys").to_pylist()), "<u8")
    least = np.frombuffer(b"".join(answers.column("least").to_pylist()), "<i8")
    most = answers.column("most").to_pylist()
    most = np.frombuffer(b"".join(most), "<i8") if most and most[0] is not None else least
    order = np.argsort(key)
    return key[order], least[order], most[order]


def _of(keys: np.ndarray, known: np.ndarray, value: np.ndarray, other: int) -> np.ndarray:
    """Each key's value, or another where it is not known."""
    if not len(known):
        return np.full(len(keys), other)
    place = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    return np.where(known[place] == keys, value[place], other)


def _around(c: Call, answers: pa.Table, block: int) -> np.ndarray:
    """First words of the windows of 2 * block words that touch a hit."""
    known, least, most = _told(answers)
    at, text = c.at(block)
    key, doc = run_hash(c.t, at, block), c.doc[text]
    is_block = (at - c.t.first[text]) % block == 0
    hit = (doc > _of(key, known, least, _NONE)) | (is_block & (doc < _of(key, known, most, _LOW)))
    wanted = np.zeros(len(c.t.start) + 1, np.int64)
    np.add.at(wanted, np.maximum(at[hit] - block, c.t.first[text[hit]]), 1)
    np.add.at(wanted, at[hit] + 1, -1)
    long, _ = c.at(2 * block)
    return long[np.cumsum(wanted)[long] > 0]


_CUT = "doc_id bigint, n_words bigint, n_removed bigint, starts array<bigint>, ends array<bigint>, kept binary"


def _cut(row: dict, answers: pa.Table, block: int) -> pa.Table:
    """Every text of a call without the words that its repeats cover, and their word ranges."""
    c = opened(row, block)
    t, size = c.t, 2 * block
    known, least, _ = _told(answers)
    at, text = c.at(size) if len(known) else (np.zeros(0, np.int64),) * 2
    repeat = c.doc[text] > _of(run_hash(t, at, size), known, least, _NONE)
    turn = np.zeros(len(t.start) + 1, np.int64)
    np.add.at(turn, at[repeat], 1)
    np.add.at(turn, at[repeat] + size, -1)
    gone = np.cumsum(turn)[:-1] > 0
    removed = np.concatenate([[0], np.cumsum(gone)])
    n_removed = removed[t.first[1:]] - removed[t.first[:-1]]
    starts, ends, kept = [], [], []
    for k in range(len(t.count)):
        words = t.raw[t.at[k] : t.at[k + 1]].tobytes().split()
        out = gone[t.first[k] : t.first[k + 1]]
        edges = np.flatnonzero(np.diff(out.astype(np.int8), prepend=0, append=0)) if n_removed[k] else np.zeros(0, np.int64)
        starts.append(edges[::2].tolist())
        ends.append(edges[1::2].tolist())
        kept.append(b" ".join([w for w, g in zip(words, out.tolist()) if not g] if n_removed[k] else words))
    lists = pa.list_(pa.int64())
    columns = [pa.array(row["ids"], pa.int64()), pa.array(t.count.astype(np.int64)), pa.array(n_removed.astype(np.int64)), pa.array(starts, lists), pa.array(ends, lists), pa.array(kept, pa.binary())]
    return pa.Table.from_arrays(columns, ["doc_id", "n_words", "n_removed", "starts", "ends", "kept"])


def without_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", block: int = BLOCK, columns: Sequence = ("*",)) -> DataFrame:
    """(doc_id, n_words, n_removed, starts, ends, kept) of every row, or what ``columns`` makes of them.

    ``starts`` and ``ends`` are the word ranges that repeat 2 * block words or more of a smaller document; ``kept`` has the
    words outside them, joined by one space, as bytes.
    """
    spark = docs.sparkSession
    with scratch(spark), small_batches(spark):
        packed = stored(calls(docs, text, doc_id, CALL_BYTES), "anchor-calls")
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), packed.count() // CALLS_A_BUCKET)

        def probes(batches):
            for row in by_row(batches):
                c = opened(row, block)
                at, of = c.at(block)
                if len(at):
                    yield _asked(row, run_hash(c.t, at, block), c.doc[of], True, (at - c.t.first[of]) % block == 0, buckets)

        asked = packed.mapInArrow(probes, _ASK)
        hits = stored(asked.groupBy("bucket").applyInArrow(_hits, _ANSWER_SQL), "anchor-hits")

        def extended(call: pa.Table, answers: pa.Table) -> pa.Table:
            row = next(by_row(call.to_batches()), None)
            if row is not None and answers.num_rows:
                c = opened(row, block)
                at = _around(c, answers, block)
                if len(at):
                    return pa.Table.from_batches([_asked(row, run_hash(c.t, at, 2 * block), c.doc[c.t.text[at]], False, None, buckets)])
            return no_questions

        kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}
        no_questions = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in _ASK.split(", ")]).empty_table()
        more = packed.groupBy("call").cogroup(hits.groupBy("call")).applyInArrow(extended, _ASK)
        repeats = stored(more.groupBy("bucket").applyInArrow(_smallest, _ANSWER_SQL), "anchor-repeats")
        done_with(hits)

        def cut(call: pa.Table, answers: pa.Table) -> pa.Table:
            return _cut(next(by_row(call.to_batches())), answers, block)

        whole = packed.groupBy("call").cogroup(repeats.groupBy("call")).applyInArrow(cut, _CUT)
        return stored(whole.select(*columns), "anchor-kept")


def op7_block_anchors(spark, sf_dir: str) -> DataFrame:
    """Per document: its words, how many are removed as repeats, and the digest of those that stay."""
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return without_repeats(read_documents(spark, sf_dir, "doc_id", "text"), columns=("doc_id", "n_words", "n_removed", digest))
