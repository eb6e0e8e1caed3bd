"""Texts packed into calls, and questions that calls put to buckets of hashes.

A call is a row that holds some megabytes of whole texts with their ids, written
once, so that every later step sees the same calls. A call puts each of its
distinct hashes once to the bucket that holds the hash's range, sorted and packed,
with what it knows of them; the bucket sees one entry a call for a hash, however
often texts hold it, and answers the calls. Answers and calls then meet by the call.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as planes of bytes, as many as the largest needs; upper planes compress away."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def unpack(content: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        planes = np.frombuffer(content, np.uint8).reshape(-1, n)
        out[:, : len(planes)] = planes.T
    return out.reshape(-1).view("<u8")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Which of so many equal ranges a hash is in: in order of the hashes."""
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted hashes as the first and the steps to the next ones."""
    return keys[:1].tobytes() + pack(np.diff(keys))


def unpack_keys(content: list[bytes], sizes: np.ndarray) -> np.ndarray:
    """Hashes of several packed runs, one after the other."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    steps = np.zeros(int(at[-1]), np.uint64)
    for i, (run, size) in enumerate(zip(content, sizes.tolist())):
        steps[at[i]] = np.frombuffer(run, "<u8", 1)[0]
        steps[at[i] + 1 : at[i + 1]] = unpack(run[8:], size - 1)
    # sums of steps from the start of each run (modulo 2**64, so one running sum serves all)
    total = np.cumsum(steps, dtype=np.uint64)
    start = at[:-1]
    return total - np.repeat(total[start] - steps[start], sizes)


def texts_of_call(row: dict) -> pa.Array:
    """The call's texts, as bytes (columns ``sizes`` and ``texts``)."""
    at = np.concatenate([[0], np.cumsum(np.array(row["sizes"], np.int64))])
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64).tobytes()), pa.py_buffer(row["texts"])])


def by_row(batches) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {c: batch.column(c)[k].as_py() for c in batch.schema.names}
