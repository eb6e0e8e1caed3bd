"""Arrow-batch helpers that the operators of this subpackage share.

An operator that needs Python sees a table as a stream of Arrow record batches,
cut further so that one call handles a bounded number of text bytes (a longer
single document is a call of its own). Rows are never dropped or reordered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that one call of an operator's function handles at a time; a byte takes up to some 60 bytes of arrays.
CALL_BYTES = 1 << 20


def text_offsets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string (or binary) column and its n + 1 offsets; null counts as empty."""
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if large else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
    return raw, at - at[0]


def slices(batch: pa.RecordBatch, text: str | None, limit: int = CALL_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in row ranges of at most ``limit`` bytes of ``text``, one row at least."""
    if text is None:
        yield batch
        return
    _, at = text_offsets(batch.column(text))
    start, n = 0, batch.num_rows
    while start < n:
        end = int(np.searchsorted(at, at[start] + limit, side="right")) - 1
        end = min(max(end, start + 1), n)
        yield batch.slice(start, end - start)
        start = end


def map_batches(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], Sequence[pa.Array]]],
    fields: str,
    keep: Sequence[str],
    text: str | None,
    limit: int = CALL_BYTES,
) -> DataFrame:
    """``keep`` columns of ``df`` followed by the columns that the function made by ``make`` returns.

    ``make`` runs once in each task. A kept column that has the name of a new one,
    in any case, gives way to it.
    """
    added = T._parse_datatype_string(fields)
    new = {name.lower() for name in added.names}
    kept = [c for c in keep if c.lower() not in new]
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)
    names = schema.names

    def run(batches):
        apply = make()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            for part in slices(batch, text, limit):
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + list(apply(part)), names)

    needed = list(dict.fromkeys([*kept, *([text] if text else []), *[c for c in keep if c in df.columns]]))
    return df.select(*[F.col(f"`{c}`") for c in needed]).mapInArrow(run, schema)


def free_name(columns: Sequence[str], prefix: str) -> str:
    """The prefix, lengthened until no column begins with it (Spark compares names without case)."""
    while any(c.lower().startswith(prefix.lower()) for c in columns):
        prefix += "_"
    return prefix


def sha256_hex(column) -> F.Column:
    """Lowercase hex SHA-256 of a binary or string column."""
    return F.sha2(column, 256)


def row_key(*columns: str) -> list[F.Column]:
    """Two 64-bit names of the row's values in these columns, null or not; equal rows share them."""
    values = [c for name in columns for c in (F.col(name).isNull(), F.col(name))]
    return [F.xxhash64(F.lit(seed), *values) for seed in (1, 2)]


def read_documents(spark, sf_dir: str, *columns: str) -> DataFrame:
    """The named columns of the whole ``documents`` table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)
