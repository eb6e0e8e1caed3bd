"""Vector code compression: product codes, Lloyd rounds under Drake-Hamerly adaptive bounds.

A vector of integers is cut into ``parts`` equal parts; each part position has a
codebook of ``entries`` entries, and a part's code is its nearest entry (squared
Euclidean distance, ties to the lower index). Codebooks start as the parts of the
rows with the smallest ids; a round assigns all parts and moves every used entry
to the componentwise floor of its parts' mean.

The first assignment measures all entries. From then on each part carries, from
round to round in a written table, its entry, its b next closest entries with
ordered lower bounds on their distances, and one outer bound for all others. When
entries move, bounds shrink by how far each moved (the outer one by the largest
move). The exact distance to the part's own entry decides how far down the list
bounds must be looked past: not at all for most parts; else the listed entries up
to the first bound that exceeds it are measured in integers; only where the outer
bound does not exceed it are all entries. b starts at a quarter of the entries
and falls, batch by batch, to the deepest place that was needed, an eighth of the
entries at least. Bounds are held in 16 bits, cut downwards, so they stay bounds;
every decision between entries is made on exact integer distances.

Only codebooks come to the driver (parts * entries * components numbers, of sums
made in each task first) and, to start them, ``entries`` rows.

Defined cases: rows whose vector is null or holds a null or a component that is
not finite are dropped. The dimension is the commonest vector length that parts
divide (ties: the smaller). Rows of another length, or with a component beyond
``MOST`` in size, stay in the result with null code and error and take no part.
Rows without an id are coded, and seed codebooks after all others; rows that
share an id are coded each, and seed in the order of their components. With fewer
rows than ``entries`` the codebooks are shorter. An empty table gives an empty
table. Only the named columns are read, under names of the operator's own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import scratch, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest size of an integer component, and components of a part: squared distances stay exact in 53 bits.
MOST, MOST_WIDE = 1 << 20, 1 << 11
#: Vectors that one call measures at a time.
CALL_ROWS = 2048
#: Copies of a label's sum that its rows are dealt over.
SALTS = 16
#: Above any error of the arithmetic on bounds.
_SLACK = 1e-6


# ---------------------------------------------------------------- one part position, in numpy


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number rows to all entries."""
    return (x * x).sum(1)[:, None] - 2 * (x @ entries.T) + (entries * entries).sum(1)[None, :]


def cut_down(bounds: np.ndarray) -> np.ndarray:
    """Bounds in 16 bits: the upper half of a 32-bit float that is not larger."""
    single = bounds.astype(np.float32)
    single = np.where(single > bounds, np.nextafter(single, np.float32(0)), single)
    return (np.ascontiguousarray(single, np.float32).view(np.uint32) >> np.uint32(16)).astype(np.uint16)


def widened(bounds: np.ndarray) -> np.ndarray:
    return (bounds.astype(np.uint32) << np.uint32(16)).view(np.float32).astype(np.float64)


def measured(x: np.ndarray, entries: np.ndarray, b: int):
    """Nearest entry, its squared distance, the b next closest entries, their distances, and the next distance after those."""
    d = squared(x, entries)
    order = np.argsort(d, axis=1, kind="stable")  # ties to the lower index
    near = order[:, 1 : b + 1]
    rows = np.arange(len(x))
    outer = np.sqrt(d[rows, order[:, b + 1]]) if b + 1 < len(entries) else np.full(len(x), np.inf)
    return order[:, 0], d[rows, order[:, 0]], near, np.sqrt(np.take_along_axis(d, near, 1)), outer


def moved(x: np.ndarray, entries: np.ndarray, drift: np.ndarray, own: np.ndarray, near: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
    """``measured`` again after entries have moved by ``drift``, by bounds; also how deep each row had to look (b + 1: everywhere)."""
    b = near.shape[1]
    at = x - entries[own]
    own_squared = (at * at).sum(1)
    reach = np.sqrt(own_squared) + _SLACK
    bounds = np.maximum(bounds - drift[near], 0)
    outer = np.maximum(outer - drift.max(), 0)
    # a bound is no use past a smaller one further out
    low = np.minimum.accumulate(np.concatenate([bounds, outer[:, None]], 1)[:, ::-1], axis=1)[:, ::-1]
    bounds, outer = low[:, :b].copy(), low[:, b].copy()
    depth = (low <= reach[:, None]).sum(1)
    own, near = own.copy(), near.copy()

    some = np.flatnonzero((depth > 0) & (depth <= b))
    if len(some):
        deep = int(depth[some].max())
        listed = near[some, :deep]
        apart = x[some, None, :] - entries[listed]
        exact = (apart * apart).sum(2)
        asked = np.arange(deep) < depth[some, None]
        # the own entry and all listed ones, with exact distances where they were measured
        who = np.concatenate([own[some, None], near[some]], 1)
        value = np.concatenate([np.sqrt(own_squared[some])[:, None], bounds[some]], 1)
        value[:, 1 : deep + 1] = np.where(asked, np.sqrt(exact), value[:, 1 : deep + 1])
        far = np.full(who.shape, np.inf)
        far[:, 0] = own_squared[some]
        far[:, 1 : deep + 1] = np.where(asked, exact, np.inf)
        least = far.min(1)
        best = np.where(far == least[:, None], who, len(entries)).argmin(1)  # ties to the lower index
        rows = np.arange(len(some))
        own[some], own_squared[some] = who[rows, best], least
        value[rows, best] = -1  # first in order, then left out
        order = np.argsort(value, axis=1, kind="stable")[:, 1:]
        near[some] = np.take_along_axis(who, order, 1)
        bounds[some] = np.take_along_axis(value, order, 1)

    every = np.flatnonzero(depth > b)
    if len(every):
        own[every], own_squared[every], near[every], bounds[every], outer[every] = measured(x[every], entries, b)
    return own, own_squared, near, bounds, outer, depth


# ---------------------------------------------------------------- rows


def _integers(column: pa.Array, scale: int) -> tuple[np.ndarray, list[bytes | None]]:
    """Which rows are kept, and each kept row's floored components as 32-bit integers (none beyond MOST)."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    kept = column.is_valid().to_numpy(zero_copy_only=False) & (bad[ends] == bad[ends - sizes])
    with np.errstate(over="ignore", invalid="ignore"):
        floors = np.floor(values * scale)
    far = np.concatenate([[0], np.cumsum(~(np.abs(floors) <= MOST))])
    small = np.where(np.abs(floors) <= MOST, floors, 0).astype("<i4")
    fits = far[ends] == far[ends - sizes]
    packed = [small[e - s : e].tobytes() if ok else None for e, s, ok in zip(ends[kept].tolist(), sizes[kept].tolist(), fits[kept].tolist())]
    return kept, packed


def integer_rows(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: int = SCALE) -> DataFrame:
    """(vec_id, label, ints) of the kept rows; ints are packed 32-bit integers, null beyond ``MOST``."""
    rows = vectors.select(F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    schema = T.StructType([rows.schema["vec_id"], rows.schema["label"], T.StructField("ints", T.BinaryType())])

    def run(batches):
        for batch in batches:
            kept, packed = _integers(batch.column("v"), scale)
            mask = pa.array(kept)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").filter(mask), batch.column("label").filter(mask), pa.array(packed, pa.binary())], schema.names)

    return rows.mapInArrow(run, schema)


def _matrix(column: pa.Array, parts: int) -> np.ndarray:
    """(part, row, component) of rows that all have vectors of one length."""
    rows = len(column)
    whole = np.frombuffer(b"".join(column.to_pylist()), "<i4").astype(np.float64).reshape(rows, parts, -1)
    return np.ascontiguousarray(whole.transpose(1, 0, 2))


_STATE = [("own", "binary"), ("near", "binary"), ("bounds", "binary"), ("b", "int")]


def _packed_rows(values: np.ndarray) -> pa.Array:
    """(part, row, ...) as one binary value for each row."""
    rows = values.shape[1]
    flat = np.ascontiguousarray(values.swapaxes(0, 1)).reshape(rows, -1)
    width = flat.shape[1] * flat.itemsize
    return pa.Array.from_buffers(pa.binary(), rows, [None, pa.py_buffer((np.arange(rows + 1) * width).astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


def _unpacked(column: pa.Array, kind, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), parts, -1).swapaxes(0, 1)


def _first(books: np.ndarray, start_b: int) -> Callable:
    """Assignment by all distances: (own, error, near, bounds) of a batch."""

    def run(batch: pa.RecordBatch):
        x = _matrix(batch.column("ints"), len(books))
        found = [measured(x[j], books[j], start_b) for j in range(len(books))]
        return _joined(found, start_b)

    return run


def _next(books: np.ndarray, before: np.ndarray, least_b: int) -> Callable:
    """Assignment by the bounds that the rows carry from before the entries moved."""
    drift = np.nextafter(np.sqrt(((books - before) ** 2).sum(2)), np.inf)

    def run(batch: pa.RecordBatch):
        parts, b = len(books), batch.column("b")[0].as_py()
        x = _matrix(batch.column("ints"), parts)
        own = _unpacked(batch.column("own"), np.uint8, parts)[..., 0].astype(np.int64)
        near = _unpacked(batch.column("near"), np.uint8, parts).astype(np.int64) if b else np.zeros((parts, len(x[0]), 0), np.int64)
        bounds = widened(_unpacked(batch.column("bounds"), np.uint16, parts))
        found = [moved(x[j], books[j], drift[j], own[j], near[j], bounds[j, :, :b], bounds[j, :, b]) for j in range(parts)]
        needed = max((int(f[5][f[5] <= b].max(initial=0)) for f in found), default=0)
        return _joined([f[:5] for f in found], min(b, max(needed, least_b)))

    return run


def _joined(found: list, b: int):
    """Results of all parts; lists are cut to b entries, the rest goes under the outer bound."""
    own, error, near, bounds, outer = (np.stack([f[i] for f in found]) for i in range(5))
    bounds = np.concatenate([bounds, outer[..., None]], 2)
    bounds = np.concatenate([bounds[..., :b], bounds[..., b:].min(2, keepdims=True)], 2)
    return own.astype(np.uint8), error.sum(0).astype(np.int64), near[..., :b].astype(np.uint8), cut_down(bounds), b


def _runs(batch: pa.RecordBatch):
    """The batch in runs of rows that carry lists of one length."""
    if "b" not in batch.schema.names:
        cuts = [0, batch.num_rows]
    else:
        b = batch.column("b").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(b)) + 1).tolist(), batch.num_rows]
    for a, z in zip(cuts[:-1], cuts[1:]):
        for k in range(a, z, CALL_ROWS):
            yield batch.slice(k, min(CALL_ROWS, z - k))


def _assigned(rows: DataFrame, assign: Callable, final: bool) -> DataFrame:
    """All rows with their state, or at the end with (own, error)."""
    kept = ["vec_id", "label"] + ([] if final else ["ints"])
    added = [("own", "binary"), ("error", "bigint")] if final else _STATE
    schema = T.StructType([rows.schema[c] for c in kept] + T._parse_datatype_string(", ".join(f"{n} {k}" for n, k in added)).fields)

    def run(batches):
        for batch in batches:
            for part in _runs(batch) if batch.num_rows else ():
                own, error, near, bounds, b = assign(part)
                if final:
                    new = [_packed_rows(own[..., None]), pa.array(error)]
                else:
                    new = [_packed_rows(own[..., None]), _packed_rows(near), _packed_rows(bounds), pa.array(np.full(part.num_rows, b, np.int32))]
                yield pa.RecordBatch.from_arrays([part.column(c) for c in kept] + new, schema.names)

    return rows.mapInArrow(run, schema)


def _moved_books(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Every used entry at the floor of its parts' mean; sums are made in each task, then over tasks."""
    parts, entries, size = books.shape

    def run(batches):
        total, count = np.zeros((parts, entries, size), np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for part in _runs(batch) if batch.num_rows else ():
                x = _matrix(part.column("ints"), parts).astype(np.int64)
                own = _unpacked(part.column("own"), np.uint8, parts)[..., 0]
                for j in range(parts):
                    np.add.at(total[j], own[j], x[j])
                    count[j] += np.bincount(own[j], minlength=entries)
        part, entry = np.nonzero(count)
        if len(part):
            sums = pa.array(total[part, entry].tolist(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(count[part, entry]), sums], ["part", "entry", "n", "sums"])

    by_task = state.select("ints", "own", "b").mapInArrow(run, "part int, entry int, n bigint, sums array<bigint>")
    sums = by_task.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(size)])
    out = books.copy()
    for row in sums.collect():  # parts * entries rows at most
        out[row["part"], row["entry"]] = [row[f"s{i}"] // row["n"] for i in range(size)]
    return out


def codebooks_text(books: np.ndarray) -> str:
    return ",".join(str(int(v)) for v in books.ravel())


def vector_codes(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, own, error), codebooks): a byte of ``own`` for each part, and the (part, entry, component) numbers."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is a byte: 1 to 256 entries")
    rows = integer_rows(vectors, vec_id, vector, label, scale)
    size = F.length("ints") / 4
    widths = rows.where(F.col("ints").isNotNull()).groupBy(size.cast("int").alias("size")).count()
    width = widths.where((F.col("size") > 0) & (F.col("size") % parts == 0)).orderBy(F.desc("count"), "size").first()
    uncoded = ["vec_id", "label", F.lit(None).cast("binary").alias("own"), F.lit(None).cast("bigint").alias("error")]
    if width is None:
        return rows.select(*uncoded), np.zeros((parts, 0, 0))
    if width["size"] > parts * MOST_WIDE:
        raise ValueError(f"parts of more than {MOST_WIDE} components")
    fits = F.coalesce(F.length("ints") == 4 * width["size"], F.lit(False))
    chosen = rows.where(fits)
    seeds = chosen.select("vec_id", "ints", F.hex("ints").alias("h")).orderBy(F.col("vec_id").asc_nulls_last(), "h").limit(entries).collect()
    books = np.stack([np.frombuffer(bytes(s["ints"]), "<i4").reshape(parts, -1) for s in seeds]).astype(np.float64).transpose(1, 0, 2)
    start_b, least_b = max(len(seeds) // 4, min(1, len(seeds) - 1)), len(seeds) // 8
    with scratch(vectors.sparkSession):
        assign, state = _first(books, start_b), chosen
        for _ in range(rounds):
            state = stored(_assigned(state, assign, final=False), "vector-bounds")
            before, books = books, _moved_books(state, books)
            assign = _next(books, before, least_b)
        coded = stored(_assigned(state, assign, final=True).union(rows.where(~fits).select(*uncoded)), "vector-codes")
    return coded, books


def label_sums(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the errors summed over rows of equal labels (nulls together).

    A label may hold a third of all rows: sums are made in each task first, and a
    label's rows are dealt over ``SALTS`` copies of its sum.
    """
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "own"), F.lit(SALTS)).cast("int"))
    sums = sums.withColumnRenamed("label", "of_label").withColumnRenamed("salt", "of_salt")
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of_label")) & (F.col("salt") == F.col("of_salt")))


def op11_vector_codes(spark, sf_dir: str) -> DataFrame:
    """Per kept vector: its code, its error, its label's error, and the digest of the codebooks."""
    coded, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(codebooks_text(books).encode()).hexdigest()
    return label_sums(coded).select("vec_id", F.lower(F.hex("own")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
