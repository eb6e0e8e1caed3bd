"""Token ids in binary files, compressed by an adaptive context-mixing range coder.

Documents are put in ascending id order, encoded by the tokenizers library (every
text ends with id ``END``) and written as token files. A file holds

    magic, number of documents, ids, blocks and ids of a block   (little endian)
    document table: which ids are null, doc ids, lengths         (zlib)
    order-0 table: the ids that occur and their frequencies      (zlib)
    block table: bytes of code, crc32 of the block's ids
    code of the blocks, each coded from a fresh state (mixing_coder)

Any block can be decoded without the others; its checksum is verified when it is
read. Files are rows (part, seq, content) of a Parquet table in shared storage,
so any executor can read and rewrite them; a file holds up to ``FILE_IDS`` ids
(a longer document is a file of its own).

Pieces of text are encoded once for each task that they occur in: the tokenizer
composes, lowers case, and cuts texts into runs of letters, single digits and
runs of other characters, which its model then merges each on its own. Words of
ASCII and the letters U+00C0 to U+00FF (where nothing composes) are cut here by
the same pattern and their pieces handed to the model; any other word is handed
to the tokenizer whole, as it is, and so is one that may hold an added token,
<|startoftext|> or <|endoftext|>, which the library finds as it is written and
gives its one id. Pieces of one hash are compared byte by byte.

Defined cases: null text counts as empty (only the end id); rows without an id
come first, rows that share an id by their text; an empty table gives no files
and an empty result; texts are read whole; only the named columns are read.
"""

from __future__ import annotations

import os
import struct
import zlib
from codecs import charmap_decode
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from . import mixing_coder
from .batches import read_documents, slices, text_offsets
from .shared import scratch, stored
from .words import SEPARATOR, byte_hash, eight_bytes

VOCABULARY = "word_bpe_49k.json"
END = 1
#: Ids of a file, about.
FILE_IDS = 8 << 20
#: Text bytes of a call: larger calls share more words.
TEXT_BYTES = 4 << 20
#: Pieces whose ids a worker keeps from task to task, at most; then it starts anew.
KEPT_WORDS = 1_500_000
MAGIC = b"TOKMIX02"
_HEAD = struct.Struct("<8sQQII")


# ---------------------------------------------------------------- ids of texts


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task for every core
    return Tokenizer.from_file(path)


#: Byte-level stand-ins of bytes, as the tokenizer's model has them, for a text that is decoded byte by byte.
_MOVED = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
_STAND_IN = "".join(chr(256 + _MOVED.index(b) if b in _MOVED else b) for b in range(256))

_SEP, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[SEPARATOR] = _SEP
_CLASS[ord("A") : ord("Z") + 1] = _CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[128:] = _ODD
_UPPER = np.zeros(256, bool)
_UPPER[ord("A") : ord("Z") + 1] = True
#: First byte of the letters from U+00C0 to U+00FF, and their second bytes (two characters there are no letters).
_LEAD = 0xC3
_SECOND = np.zeros(256, bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False


def _names(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of every byte range; of up to eight bytes, their number itself, with the size."""
    size = end - start
    kept = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(8) * (8 - np.minimum(size, 8)).astype(np.uint64))
    name = (eight_bytes(raw)[start] & kept) ^ (size.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    long = np.flatnonzero(size > 8)
    name[long] = byte_hash(raw, start[long], end[long])
    return name


def _same(raw: np.ndarray, start: np.ndarray, end: np.ndarray, other: np.ndarray) -> bool:
    """Do all byte ranges equal the range of one hash with them whose number is beside them?"""
    size, eight = end - start, eight_bytes(raw)
    if not (size == size[other]).all():
        return False
    other = start[other]
    left = np.flatnonzero((size > 8) & (start != other))  # ranges of up to eight bytes have one hash only if they are equal
    done = 0
    while len(left) and done < 64:
        some = np.minimum(size[left] - done, 8).astype(np.uint64)
        kept = np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * some)
        if ((eight[start[left] + done] ^ eight[other[left] + done]) & kept).any():
            return False
        done += 8
        left = left[size[left] > done]
    return all((raw[start[k] : end[k]] == raw[other[k] : other[k] + size[k]]).all() for k in left.tolist())


class WordIds:
    """Ids of pieces of text, found once each."""

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self._empty()

    def _empty(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.begin = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)

    def of(self, pieces: list[bytes], odd: list[bool]) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``ids``, and sizes, of each piece's ids; odd pieces are whole words for the library to take apart."""
        if len(self.known) > KEPT_WORDS:
            self._empty()
        known, begin = self.known, self.begin
        where = list(map(known.get, pieces))
        fresh = [k for k, w in enumerate(where) if w is None]
        merge = self.tokenizer.model.tokenize
        words = [k for k in fresh if odd[k]]
        found: list[list[int]] = []
        of_word = {}
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            codes = self.tokenizer.encode_batch_fast([pieces[k].decode() for k in some], add_special_tokens=False)
            of_word.update((k, c.ids) for k, c in zip(some, codes))
        for k in fresh:
            piece = pieces[k]
            if piece.isalpha():  # the letters a-z
                found.append([t.id for t in merge(piece.decode())])
            elif odd[k]:
                found.append(of_word[k])
            else:
                found.append([t.id for t in merge(charmap_decode(piece, "strict", _STAND_IN)[0])])
        sizes = np.array(list(map(len, found)), np.int64)
        new = np.arange(len(fresh)) + len(begin) - 1
        known.update(zip([pieces[k] for k in fresh], new.tolist()))
        ends = begin[-1] + np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else int(begin[-1])
        if total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), total - len(self.ids)), np.uint32)])
        self.ids[int(begin[-1]) : total] = np.fromiter(chain.from_iterable(found), np.uint32, total - int(begin[-1]))
        where = np.array([-1 if w is None else w for w in where], np.int64)
        where[fresh] = new
        self.begin = begin = np.concatenate([begin, ends])
        return begin[where], begin[where + 1] - begin[where]


@lru_cache(maxsize=1)
def _word_ids(path: str) -> WordIds:
    """Kept by the worker: its next task finds the pieces of the last ones."""
    return WordIds(path)


#: How the strings of the tokenizer's added tokens begin.
_ADDED = b"<|"


def pieces_of(raw: np.ndarray, at: np.ndarray):
    """Texts in lower case where that is safe, and the pieces that the tokenizer's pattern cuts them into.

    First byte of each piece, the byte after it, whether it is odd, and the first
    piece of each text (and their number). Words of ASCII and the letters from
    U+00C0 to U+00FF are cut here; any other, and one that may hold an added token,
    is an odd piece, as it is.
    """
    n = len(raw)
    kind = _CLASS[raw]
    lead = np.flatnonzero(raw == _LEAD)
    lead = lead[lead + 1 < n]
    second = lead[_SECOND[raw[lead + 1]]] + 1
    kind[second - 1] = kind[second] = _LETTER
    apart = kind == _SEP
    cut = np.zeros(n + 1, bool)  # a piece begins here
    cut[1:n] = kind[1:] != kind[:-1]
    cut[:n] |= kind == _DIGIT
    edges = at[at < n]  # texts begin here
    cut[edges] = True
    cut[:n] &= ~apart
    opens = ~apart  # a word begins here
    opens[1:] &= apart[:-1]
    opens[edges] = ~apart[edges]
    # odd words: one piece each, left as they are
    bad = np.flatnonzero(kind == _ODD)
    marks = np.flatnonzero(raw == _ADDED[0])
    marks = marks[marks + 1 < n]
    bad = np.concatenate([bad, marks[raw[marks + 1] == _ADDED[1]]])
    upper = _UPPER[raw]
    upper[second] = raw[second] <= 0x9E
    odd_start = np.zeros(0, np.int64)
    if len(bad):
        words = np.flatnonzero(opens)
        odd_start = words[np.unique(np.searchsorted(words, bad, side="right") - 1)]
        ends = np.flatnonzero(apart)
        stop = np.minimum(np.append(ends, n)[np.searchsorted(ends, odd_start)], np.append(words, n)[np.searchsorted(words, odd_start) + 1])
        for a, b in zip(odd_start.tolist(), stop.tolist()):
            upper[a:b] = False
            cut[a + 1 : b] = False
    raw = raw + (upper.view(np.uint8) << np.uint8(5))
    # an apostrophe right before a letter: 's 't 'm 'd 're 've 'll are pieces
    mark = np.flatnonzero((raw == 39) & cut[:n])
    mark = mark[cut[mark + 1]]
    mark = mark[(kind[mark + 1] == _LETTER) & ~opens[mark + 1]] if len(mark) else mark
    if len(mark):
        eight = eight_bytes(raw)[mark]
        one, two = (eight >> np.uint64(8)) & np.uint64(0xFF), (eight >> np.uint64(8)) & np.uint64(0xFFFF)

        def goes_on(places: np.ndarray) -> np.ndarray:
            """Are these inside the run of letters that the one before them belongs to?"""
            inside = places < n
            return inside & ~cut[np.where(inside, places, n)] & (kind[np.where(inside, places, 0)] == _LETTER)

        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = ~short & np.isin(two, np.frombuffer(b"revell", "<u2")) & goes_on(mark + 2)
        for some, size in ((mark[short], 2), (mark[long], 3)):
            rest = some + size
            rest = rest[goes_on(rest)]
            cut[some + 1] = False
            cut[rest] = True
    stops = np.flatnonzero(cut[:n] | (apart & ~np.append(True, apart[:-1]))) if n else np.zeros(0, np.int64)
    begins = cut[stops]
    first, last = stops[begins], np.append(stops[1:], n)[begins]
    is_odd = np.zeros(n, bool)
    is_odd[odd_start] = True
    return raw, first, last, is_odd[first], np.searchsorted(first, at)


def encode_texts(column: pa.Array, words: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each with its end id, and the number of each text's ids."""
    raw, start, end, odd, first_piece = pieces_of(*text_offsets(column))
    which, _ = pd.factorize(_names(raw, start, end))
    if len(which):
        order = np.zeros(int(which.max()) + 1, np.int64)
        order[which[::-1]] = np.arange(len(which))[::-1]  # the first piece of each hash
        if not _same(raw, start, end, order[which]):  # two pieces with one hash
            text = raw.tobytes()
            which, _ = pd.factorize(np.array([text[a:b] for a, b in zip(start.tolist(), end.tolist())], object))
            order = np.zeros(int(which.max()) + 1, np.int64)
            order[which[::-1]] = np.arange(len(which))[::-1]
    else:
        order = np.zeros(0, np.int64)
    text = raw.tobytes()
    begin, size = words.of([text[a:b] for a, b in zip(start[order].tolist(), end[order].tolist())], odd[order].tolist())
    # each text's pieces, then its end
    counts = np.diff(first_piece)
    places = np.arange(len(start)) + np.repeat(np.arange(len(counts)), counts)
    sizes, begins = np.ones(len(start) + len(counts), np.int64), np.zeros(len(start) + len(counts), np.int64)
    sizes[places], begins[places] = size[which], begin[which]
    ends = np.cumsum(sizes)
    ids = words.ids[np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
    last = first_piece[1:] + np.arange(len(counts))
    ids[ends[last] - 1] = END
    return ids, np.diff(ends[last], prepend=0)


# ---------------------------------------------------------------- the file


def _blocks(ids: np.ndarray) -> list[np.ndarray]:
    return [ids[i : i + mixing_coder.BLOCK] for i in range(0, len(ids), mixing_coder.BLOCK)]


def file_bytes(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    counts = np.bincount(ids)
    freq = mixing_coder.order0(counts)
    used = np.flatnonzero(freq)
    blocks = _blocks(ids)
    codes = []
    for k in range(0, len(blocks), mixing_coder.LANES):
        codes += mixing_coder.encode_blocks(blocks[k : k + mixing_coder.LANES], freq)
    null = np.array([d is None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    docs = zlib.compress(null.tobytes() + numbers.tobytes() + lengths.astype("<u8").tobytes())
    table = zlib.compress(used.astype("<u4").tobytes() + freq[used].astype("<u4").tobytes())
    index = np.array([(len(c), zlib.crc32(b.astype("<u4").tobytes())) for c, b in zip(codes, blocks)], "<u4").tobytes()
    head = _HEAD.pack(MAGIC, len(doc_ids), len(ids), len(blocks), mixing_coder.BLOCK)
    return b"".join([head, struct.pack("<II", len(docs), len(table)), docs, table, index, *codes])


def read_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Document ids, lengths and ids of a file; ValueError where a checksum fails."""
    magic, n_docs, n_ids, n_blocks, block = _HEAD.unpack_from(content)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at = _HEAD.size
    n, m = struct.unpack_from("<II", content, at)
    docs, table = zlib.decompress(content[at + 8 : at + 8 + n]), zlib.decompress(content[at + 8 + n : at + 8 + n + m])
    at += 8 + n + m
    null = np.frombuffer(docs, np.uint8, n_docs)
    numbers = np.frombuffer(docs, "<i8", n_docs, n_docs)
    lengths = np.frombuffer(docs, "<u8", n_docs, 9 * n_docs).astype(np.int64)
    used, some = np.frombuffer(table, "<u4").reshape(2, -1)
    freq = np.zeros(int(used.max()) + 1 if len(used) else 0, np.int64)
    freq[used] = some
    index = np.frombuffer(content, "<u4", 2 * n_blocks, at).reshape(-1, 2)
    at += 8 * n_blocks
    ends = at + np.cumsum(index[:, 0].astype(np.int64))
    codes = [content[e - int(s) : e] for e, s in zip(ends.tolist(), index[:, 0])]
    sizes = np.full(n_blocks, block)
    if n_blocks:
        sizes[-1] = n_ids - block * (n_blocks - 1)
    out: list[np.ndarray] = []
    for k in range(0, n_blocks, mixing_coder.LANES):
        out += mixing_coder.decode_blocks(codes[k : k + mixing_coder.LANES], sizes[k : k + mixing_coder.LANES], freq)
    for k, ids in enumerate(out):
        if zlib.crc32(ids.astype("<u4").tobytes()) != int(index[k, 1]):
            raise ValueError(f"block {k} fails its checksum")
    ids = np.concatenate(out) if out else np.zeros(0, np.uint32)
    return [None if z else int(d) for z, d in zip(null, numbers)], lengths, ids


# ---------------------------------------------------------------- tables


def token_files(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """(part, seq, content): token files of all rows; files in (part, seq) order hold ascending ids."""
    vocabulary = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_order = rows.repartitionByRange(parts, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text")

    def run(batches) -> Iterator[pa.RecordBatch]:
        words, part, seq = _word_ids(vocabulary), TaskContext.get().partitionId(), 0
        docs, lengths, ids, held = [], [], [], 0

        def file():
            content = file_bytes(docs, np.concatenate(lengths), np.concatenate(ids))
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([content], pa.binary())], ["part", "seq", "content"])

        for batch in batches:
            for piece in slices(batch, "text", TEXT_BYTES):
                some, n = encode_texts(piece.column("text"), words)
                if held and held + len(some) > FILE_IDS:
                    yield file()
                    docs, lengths, ids, held, seq = [], [], [], 0, seq + 1
                docs += piece.column("doc_id").to_pylist()
                lengths.append(n)
                ids.append(some.astype(np.uint16) if len(some) and int(some.max()) < 65536 else some)
                held += len(some)
        if docs:
            yield file()

    return in_order.mapInArrow(run, "part int, seq int, content binary")


def read_documents_of(files: DataFrame) -> DataFrame:
    """(part, seq, place, doc_id, ids) of every document in the files; ids packed little endian."""

    def run(batches):
        for batch in batches:
            for part, seq, content in zip(*(batch.column(c).to_pylist() for c in ("part", "seq", "content"))):
                docs, lengths, ids = read_file(content)
                ends = np.cumsum(lengths)
                for k in range(0, len(docs), 512):
                    some = range(k, min(k + 512, len(docs)))
                    packed = [ids[ends[i] - lengths[i] : ends[i]].astype("<u4").tobytes() for i in some]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * len(packed), pa.int32()),
                            pa.array([seq] * len(packed), pa.int32()),
                            pa.array(list(some), pa.int64()),
                            pa.array([docs[i] for i in some], pa.int64()),
                            pa.array(ends[k : k + 512] - lengths[k : k + 512], pa.int64()),
                            pa.array(packed, pa.binary()),
                        ],
                        ["part", "seq", "place", "doc_id", "start", "ids"],
                    )

    return files.mapInArrow(run, "part int, seq int, place bigint, doc_id bigint, start bigint, ids binary")


def op6_mixing_coder(spark, sf_dir: str) -> DataFrame:
    """Per document, from the files: where its ids start, how many they are, and their checksum."""
    with scratch(spark):  # the files go when they have been read back
        files = stored(token_files(read_documents(spark, sf_dir, "doc_id", "text")), "token-files")
        read = read_documents_of(files)
        n = (F.length("ids") / 4).cast("long")
        rows = stored(read.select("part", "seq", "doc_id", "start", n.alias("n_tokens"), F.crc32("ids").alias("ids_crc32")), "from-files")
    # one row a file
    whole = rows.groupBy("part", "seq").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    offsets = whole.select("part", "seq", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return rows.join(offsets, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")
