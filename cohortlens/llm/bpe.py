"""Byte-level BPE encoding and decoding with the tiktoken library.

The ranks come from a local file (base64 token, space, rank per line); the
library merges each match of the split pattern on its own. A long text is first
cut at places where a match must end, so that the library is given bounded
pieces and the ids are those of the whole text. Ids are kept as packed
little-endian unsigned 32-bit integers (``ids_array`` unpacks them).

Decoding never goes through text: it joins the raw bytes of the tokens, so ids
whose bytes are not valid UTF-8 on their own survive.

Defined cases: null text encodes as the empty text (no ids); an empty table
gives an empty table; repeated rows are encoded each on its own; columns beyond
those named are not read, and a kept column with an output's name gives way. A
null id list decodes to null; an id without a token raises ValueError.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_batches, read_documents, sha256_hex, text_offsets

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a text that the library is given at a time, or a little more.
PIECE_CHARS = 1 << 18

#: Places where a match of the pattern must end whatever follows: before white
#: space that follows a visible character, and where a run of letters or digits ends.
_CUT = regex.compile(r"(?<=[0-9A-Za-z.,;:!?)])(?=[ \n])|(?<=\p{L})(?=[ \n\p{N}\p{P}])|(?<=\p{N})(?=[ \n\p{L}\p{P}])")


def safe_pieces(text: str, limit: int = PIECE_CHARS) -> list[str]:
    """The text cut into pieces of about ``limit`` characters that encode independently."""
    if len(text) <= limit:
        return [text]
    out, start = [], 0
    while len(text) - start > limit:
        cut = _CUT.search(text, start + limit)
        if cut is None:
            break
        out.append(text[start : cut.start()])
        start = cut.start()
    out.append(text[start:])
    return out


@lru_cache(maxsize=4)
def _encoding(rank_file: str, pattern: str) -> tiktoken.Encoding:
    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _token_bytes(rank_file: str) -> pa.Array:
    """Token bytes by id; null where the file has no such rank."""
    with open(rank_file, "rb") as lines:
        pairs = [(int(b), base64.b64decode(a)) for a, b in (line.split() for line in lines if line.strip())]
    table: list[bytes | None] = [None] * (max(i for i, _ in pairs) + 1)
    for i, token in pairs:
        table[i] = token
    return pa.array(table, pa.large_binary())


def encode_text(text: str, encoding: tiktoken.Encoding, limit: int = PIECE_CHARS) -> np.ndarray:
    parts = [np.array(encoding.encode_ordinary(p), "<u4") for p in safe_pieces(text, limit)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def decode_ids(ids: np.ndarray, table: pa.Array) -> bytes:
    if len(ids) and int(ids.max()) >= len(table):
        raise ValueError(f"no token has id {int(ids.max())}")
    tokens = table.take(pa.array(ids, pa.uint32()))
    if tokens.null_count:
        raise ValueError("an id has no token")
    return text_offsets(tokens)[0].tobytes()


def encode(
    df: DataFrame,
    text: str = "text",
    out: str = "ids",
    keep: tuple[str, ...] = ("doc_id",),
    rank_file: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
) -> DataFrame:
    """``keep`` columns and ``out`` (binary): the packed ids of the whole text."""
    rank_file = rank_file or public_tokenizers.path(RANKS)

    def make():
        encoding = _encoding(rank_file, pattern)

        def apply(batch):
            texts = batch.column(text).to_pylist()
            return [pa.array([encode_text(t or "", encoding).tobytes() for t in texts], pa.binary())]

        return apply

    return map_batches(df, make, f"`{out}` binary", keep, text)


def decode(
    df: DataFrame,
    ids: str = "ids",
    out: str = "decoded",
    keep: tuple[str, ...] = ("doc_id",),
    rank_file: str | None = None,
) -> DataFrame:
    """``keep`` columns and ``out`` (binary): the raw bytes that the packed ids stand for."""
    rank_file = rank_file or public_tokenizers.path(RANKS)

    def make():
        table = _token_bytes(rank_file)

        def apply(batch):
            packed = batch.column(ids).to_pylist()
            return [pa.array([None if p is None else decode_ids(np.frombuffer(p, "<u4"), table) for p in packed], pa.binary())]

        return apply

    return map_batches(df, make, f"`{out}` binary", keep, ids)


def n_ids(ids) -> F.Column:
    return (F.length(ids) / 4).cast("long")


def ids_array(df: DataFrame, ids: str = "ids", out: str = "tokens", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``out`` (array<long>): the packed ids as an array."""

    def make():
        def apply(batch):
            packed = batch.column(ids).to_pylist()
            return [pa.array([None if p is None else np.frombuffer(p, "<u4").astype(np.int64) for p in packed], pa.list_(pa.int64()))]

        return apply

    return map_batches(df, make, f"`{out}` array<bigint>", keep, ids)


def op1_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Per document: token count, digest of its ids, digest of the bytes decoded from them."""
    coded = decode(encode(read_documents(spark, sf_dir, "doc_id", "text")), keep=("doc_id", "ids"))
    return coded.select(
        "doc_id",
        n_ids("ids").alias("n_tokens"),
        sha256_hex(F.col("ids")).alias("ids_sha256"),
        sha256_hex(F.col("decoded")).alias("decoded_sha256"),
    )
