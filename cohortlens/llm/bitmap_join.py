"""N-gram Jaccard join: size-banded tiles, bitmap bounds, exact intersection.

A document's set holds its distinct shingles (``SHINGLE`` words, A-Z in lower
case), as 64-bit hashes. Documents with equal sets are one node of the join, so
copies cost nothing. Two sets of Jaccard 3/4 or more share one of the first
n // 4 + 1 shingles of each, in any order that both keep; the order here puts
shingles that are frequent in a sample last, which keeps tiles small (the sample
changes the cost alone: the join is exact with any order).

- A tile holds the nodes that share such a shingle. In small tiles all pairs of
  fitting sizes are candidates. In larger ones every node is paired with the
  centre of its own size band and of the two next to it.
- A candidate pair must pass the bitmap bound: each set is hashed into a bitmap
  of about as many bits as it has shingles, and bits that one has and the other
  lacks are shingles that are not shared. What passes is decided by the exact
  intersection of the two sorted arrays.
- Links join nodes into components. In larger tiles whose nodes are in different
  components, the nodes outside the commonest component are paired with a few of
  its members, for ``STAR_ROUNDS`` rounds; that joins most groups at linear cost.
- The tiles that still hold several components are gone through once more, all
  pairs across components under the bitmap bound, and what passes is decided
  exactly. So no link between different components is missed, and pairs inside a
  component are not emitted.

What later steps read of a document is written apart, and a step's folder goes when
its last reader has ended. Shingles travel packed: one row for each batch and bucket, in which a node counts
once, whatever its copies there. Where a tile has many nodes, they are dealt to
blocks, and every pair of blocks is a task of its own.

Defined cases: a null text, or one without words, has the empty set and is
linked with nothing; fewer words than a shingle are one shingle, the whole
sequence; repeated rows have equal sets and are linked; rows go by a key of their id and
text, so rows without an id take part like others, but never name a component
unless all its rows are without; an empty table
gives an empty table; only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import map_batches, read_documents, row_key, slices
from .components import components
from .shared import done_with, scratch, small_batches, stored
from .words import Texts, mix64, read_texts, run_hash, windows

SHINGLE = 5
#: Tiles of at most so many nodes have all their pairs tried at once.
SMALL_TILE = 8
#: Rounds in which stragglers of larger tiles meet members of the commonest component, and how many members.
STAR_ROUNDS, STAR_MEMBERS = 1, 3
#: Bits for each shingle in the bitmaps of first candidates, and in those of larger tiles.
COARSE, FINE = 1, 8
#: Places of larger tiles that one task handles together, about, and nodes of a block where a tile has more.
TASK_PLACES, BLOCK_NODES = 8_192, 2_048
#: Documents whose shingles are counted for the order, about; frequent: in one of so many of them.
ORDER_SAMPLE, FREQUENT = 8192, 1024
#: Slots in which words of the sample are counted, by hash, and steps of rarity in a doubling of the count.
WORD_SLOTS, RARITY = 1 << 18, 4
#: Members that one task compares with a centre, about.
CENTRE_SHARE = 256


# ---------------------------------------------------------------- sets


def word_slot(t: Texts) -> np.ndarray:
    """Slot in which each word is counted."""
    return (mix64(t.hash ^ np.uint64(0x27D4EB2F165667C5)) % np.uint64(WORD_SLOTS)).astype(np.int64)


def ranked_sets(t: Texts, ranks: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``shingle_sets``, and each shingle's rank: the sum of its words' (``word_ranks``)."""
    total = np.concatenate([[0], np.cumsum(ranks[word_slot(t)], dtype=np.int64)])
    return _sets(t, size, total)


def shingle_sets(t: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """All texts' sets, sorted, one after the other, and the first place of each (and the end)."""
    return _sets(t, size)[:2]


def _sets(t: Texts, size: int, total: np.ndarray | None = None):
    at = windows(t, size)
    owner, value = t.text[at], run_hash(t, at, size)
    short = np.flatnonzero((t.count > 0) & (t.count < size))
    if len(short):
        whole = [run_hash(t, t.first[short[t.count[short] == k]], k) for k in range(1, size)]
        owner = np.concatenate([owner, *[short[t.count[short] == k] for k in range(1, size)]])
        value = np.concatenate([value, *whole])
    if total is not None:
        starts = np.concatenate([at, *[t.first[short[t.count[short] == k]] for k in range(1, size)]])
        rank = (total[starts + np.minimum(t.count[owner], size)] - total[starts]).astype(np.uint16)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    owner, value = owner[new], value[new]
    return value, np.searchsorted(owner, np.arange(len(t.count) + 1)), None if total is None else rank[order][new]


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def bitmap(shingles: np.ndarray, density: int = FINE) -> bytes:
    """Bits that the shingles hash to: ``density`` for each, up to the next power of two, 64 at least."""
    width = max(64, 1 << max(len(shingles) * density - 1, 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(mix64(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def folded(bits: bytes, width: int) -> np.ndarray:
    """A bitmap as 64-bit words, folded to ``width`` bytes: the bitmap that so many bits would have had."""
    words = np.frombuffer(bits, "<u8")
    while len(words) * 8 > width:
        half = len(words) // 2
        words = words[:half] | words[half:]
    return words


def may_link(n_a, n_b, only_a, only_b):
    """Can sets of these sizes be linked, with so many bits that only one of them has?"""
    most = np.minimum(n_a - only_a, n_b - only_b)
    return 100 * most >= 75 * (n_a + n_b - most)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _node(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names of every set; the first is the node."""
    n = np.diff(first).astype(np.uint64)
    one = mix64(_sums(mix64(values), first) + n)
    two = mix64(_sums(mix64(values ^ np.uint64(0xC2B2AE3D27D4EB4F)), first) ^ n)
    return one.view(np.int64), two.view(np.int64)


def _chosen(docs: DataFrame, share: float) -> DataFrame:
    return docs.where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select("text")


def word_ranks(docs: DataFrame, sample: int = ORDER_SAMPLE) -> np.ndarray:
    """By slot, the steps by which the words there are frequent in a sample; 0 for words that it lacks."""
    n = docs.count()

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                times = np.bincount(word_slot(read_texts(part.column("text"), lower_ascii=True)), minlength=WORD_SLOTS)
                found = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(times[found].astype(np.int64))], ["slot", "n"])

    times = np.zeros(WORD_SLOTS, np.int64)
    if n:
        counted = _chosen(docs, min(1.0, sample / n)).mapInArrow(count, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n"))
        found = counted.toArrow()
        times[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return np.minimum(RARITY * np.log2(1 + times), 255).astype(np.uint8)


def frequent_shingles(docs: DataFrame, sample: int = ORDER_SAMPLE, one_of: int = FREQUENT) -> np.ndarray:
    """Shingles in at least one of ``one_of`` sampled documents: at most ``one_of`` times the mean set size of them."""
    n = docs.count()
    if not n:
        return np.zeros(0, np.uint64)
    share = min(1.0, sample / n)
    chosen = _chosen(docs, share)

    def count(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                values, _ = shingle_sets(read_texts(part.column("text"), lower_ascii=True))
                found, times = np.unique(values, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(times.astype(np.int64))], ["shingle", "n"])

    counted = chosen.mapInArrow(count, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    least = max(8, int(share * n / one_of))
    found = counted.where(F.col("n") >= least).select("shingle").toArrow()
    return np.sort(found.column(0).to_numpy().astype(np.int64).view(np.uint64))


def profiles(docs: DataFrame, frequent: np.ndarray, ranks: np.ndarray | None = None) -> DataFrame:
    """doc_id, key, key2, n_shingles, node, check (second name), first (packed first shingles in the join's order), coarse, fine (bitmaps)."""

    ranks = np.zeros(WORD_SLOTS, np.uint8) if ranks is None else ranks

    def make():
        def apply(batch):
            values, at, rank = ranked_sets(read_texts(batch.column("text"), lower_ascii=True), ranks)
            n = np.diff(at)
            node, check = _node(values, at)
            if len(frequent):
                place = np.minimum(np.searchsorted(frequent, values), len(frequent) - 1)
                rank = rank + (frequent[place] == values) * np.uint16(1 << 15)
            first, coarse, fine = [], [], []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                own = values[a:b]
                # by rank, those of one rank by value
                first.append(own[np.argsort(rank[a:b], kind="stable")[: (b - a) // 4 + 1]].tobytes())
                coarse.append(bitmap(own, COARSE) if b > a else b"")
                fine.append(bitmap(own, FINE) if b > a else b"")
            empty = pa.array(n == 0)
            return [
                pa.array(n.astype(np.int64)),
                pa.array(node, mask=n == 0),
                pa.array(check, mask=n == 0),
                pa.array(first, pa.binary()),
                pa.array(coarse, pa.binary()),
                pa.array(fine, pa.binary()),
            ]

        return apply

    fields = "n_shingles bigint, node bigint, check bigint, first binary, coarse binary, fine binary"
    return map_batches(docs.select("doc_id", "key", "key2", "text"), make, fields, ("doc_id", "key", "key2"), "text")


# ---------------------------------------------------------------- tiles


def _packed(profiled: DataFrame, buckets: int) -> DataFrame:
    """First shingles by bucket: (bucket, keys, nodes, sizes, copies, runs), packed, one row for each batch and bucket; a batch's nodes once each."""

    def run(batches):
        for batch in batches:
            _, once, copies = np.unique(batch.column("node").to_numpy(zero_copy_only=False).astype(np.int64), return_index=True, return_counts=True)
            batch = batch.take(pa.array(once))
            first = batch.column("first").to_pylist()
            count = np.array([len(f) // 8 for f in first], np.int64)
            key = np.frombuffer(b"".join(first), "<u8")
            owner = np.repeat(np.arange(len(first)), count)
            node = batch.column("node").to_numpy(zero_copy_only=False)
            size = batch.column("n_shingles").to_numpy(zero_copy_only=False)
            mixed = mix64(key)
            bucket = (mixed >> np.uint64(32)).astype(np.int64) % buckets
            order = np.argsort(bucket, kind="stable")
            bucket, owner, key = bucket[order], owner[order], mixed[order].astype(np.uint32)
            edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2))
            rows = {c: [] for c in ("bucket", "keys", "nodes", "sizes", "copies", "runs")}
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                starts = np.flatnonzero(np.diff(owner[a:b], prepend=-1))
                who = owner[a:b][starts]
                rows["bucket"].append(int(bucket[a]))
                rows["keys"].append(key[a:b].tobytes())
                rows["nodes"].append(node[who].astype(np.int64).tobytes())
                rows["sizes"].append(size[who].astype(np.int32).tobytes())
                rows["copies"].append(copies[who].astype(np.int64).tobytes())
                rows["runs"].append(np.diff(starts, append=b - a).astype(np.int32).tobytes())
            kinds = [pa.int32()] + [pa.binary()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds)], list(rows))

    schema = "bucket int, keys binary, nodes binary, sizes binary, copies binary, runs binary"
    return profiled.where("n_shingles > 0").select("first", "node", "n_shingles").mapInArrow(run, schema)


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def band(size: np.ndarray) -> np.ndarray:
    """Size bands: linked sets are in one band or in neighbouring ones."""
    return np.floor(np.log(size) / np.log(4 / 3) + 1e-9).astype(np.int64)


_TILES = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("tile", pa.int64())])


def _tile_pairs(table: pa.Table) -> pa.Table:
    """Candidate pairs (kind 0: a, b) of a bucket's tiles, and the places of larger tiles (kind 1: a in tile)."""
    bucket = table.column("bucket")[0].as_py()
    key = _joined(table.column("keys"), np.uint32)
    runs = _joined(table.column("runs"), np.int32)
    node = np.repeat(_joined(table.column("nodes"), np.int64), runs)
    size = np.repeat(_joined(table.column("sizes"), np.int32), runs).astype(np.int64)
    copies = np.repeat(_joined(table.column("copies"), np.int64), runs)
    order = np.lexsort((node, key))
    key, node, size, copies = key[order], node[order], size[order], copies[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    copies = np.add.reduceat(copies, np.flatnonzero(new)) if len(key) else copies
    key, node, size = key[new], node[new], size[new]
    starts = np.flatnonzero(np.diff(key.astype(np.int64), prepend=-1))
    counts = np.diff(starts, append=len(key))
    pairs = []
    fits = lambda i, j: 4 * np.minimum(size[i], size[j]) >= 3 * np.maximum(size[i], size[j])
    for k in range(2, SMALL_TILE + 1):
        at = starts[counts == k]
        for i in range(k):
            for j in range(i + 1, k):
                ok = fits(at + i, at + j)
                pairs.append(np.stack([node[(at + i)[ok]], node[(at + j)[ok]]]))
    large = np.repeat(counts > SMALL_TILE, counts)
    key, node, size, copies = key[large], node[large], size[large], copies[large]
    if len(key):
        bands = band(size)
        by = np.lexsort((node, -copies, bands, key))
        head = np.ones(len(by), bool)
        head[1:] = (key[by][1:] != key[by][:-1]) | (bands[by][1:] != bands[by][:-1])
        centre_at = by[head]
        name = (key[centre_at].astype(np.int64) << 16) + bands[centre_at]
        for step in (-1, 0, 1):
            want = (key.astype(np.int64) << 16) + bands + step
            place = np.minimum(np.searchsorted(name, want), len(name) - 1)
            centre = centre_at[place]
            ok = (name[place] == want) & (node[centre] != node)
            ok &= 4 * np.minimum(size[centre], size) >= 3 * np.maximum(size[centre], size)
            pairs.append(np.stack([node[centre][ok], node[ok]]))
    both = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
    if both.shape[1]:
        both = np.unique(np.sort(both, axis=0), axis=1)
    n, m = both.shape[1], len(key)
    return pa.Table.from_arrays(
        [
            pa.array(np.repeat([0, 1], [n, m]).astype(np.int32)),
            pa.array(np.concatenate([both[0], node])),
            pa.array(np.concatenate([both[1], node])),
            pa.array(np.concatenate([np.zeros(n, np.int64), (np.int64(bucket) << 32) + key.astype(np.int64)])),
        ],
        schema=_TILES,
    )


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _only(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that rows of the first have and the second lacks."""
    return np.bitwise_count(a & ~b).sum(1).astype(np.int64)


def _clusters(places: pa.Table, bits: pa.Table):
    """For each cluster of a bucket, or pair of its blocks: the commonest component, the nodes by size with labels, sizes and bitmaps, and which are of the second block."""
    node, n = bits.column("node").to_numpy(), bits.column("n").to_numpy()
    fine = bits.column("bits").to_pylist()
    order = np.argsort(node)
    main, share, part, who, label, block = (places.column(c).to_numpy() for c in ("main", "share", "part", "node", "label", "block"))
    second = block != part >> 32  # a part is (left block, right block)
    # a node may be in several tiles of a cluster
    first = np.unique(np.stack([main, share, part, who]), axis=1, return_index=True)[1]
    main, share, part, who, label, second = (v[first] for v in (main, share, part, who, label, second))
    at = order[np.searchsorted(node[order], who)]
    by = np.lexsort((who, n[at], part, share, main))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (main[by][1:] != main[by][:-1]) | (share[by][1:] != share[by][:-1]) | (part[by][1:] != part[by][:-1])
    edges = np.append(np.flatnonzero(fresh), len(by))
    for a, b in zip(edges[:-1], edges[1:]):
        own = by[a:b]
        if len(np.unique(label[own])) > 1:
            yield int(main[own[0]]), who[own], label[own], n[at[own]], [fine[k] for k in at[own].tolist()], second[own]


def _near_pairs(i: int, others: np.ndarray, who, n, fine, found: set) -> None:
    """Adds the pairs of one node with others of fitting sizes that pass the bitmap bound."""
    others = others[(4 * n[others] >= 3 * n[i]) & (3 * n[others] <= 4 * n[i])]
    width = np.minimum([len(fine[k]) for k in others.tolist()], len(fine[i])) if len(others) else others
    for w in np.unique(width).tolist():
        some = others[width == w]
        one, rest = folded(fine[i], w)[None], np.stack([folded(fine[k], w) for k in some.tolist()])
        for k in some[may_link(n[i], n[some], _only(one, rest), _only(rest, one))].tolist():
            a, b = int(who[i]), int(who[k])
            found.add((min(a, b), max(a, b)))


def _tile_round(turn: int | None):
    """Pairs across the components of a bucket's larger tiles: of a few members of the commonest one, or (None) of all nodes."""

    def run(places: pa.Table, bits: pa.Table) -> pa.Table:
        found: set[tuple[int, int]] = set()
        for main, who, label, n, fine, second in _clusters(places, bits):
            members = np.flatnonzero(label == main)
            others = np.flatnonzero(label != main)
            two = bool(second.any())  # of two blocks, only pairs between them
            if turn is not None:
                spread = mix64(who[members].view(np.uint64) + np.uint64(turn))
                for i in members[np.argsort(spread)[:STAR_MEMBERS]].tolist():
                    _near_pairs(i, others[second[others] != second[i]] if two else others, who, n, fine, found)
                continue
            for i in others.tolist():
                # with members, and with others of larger size (or place) once
                rest = np.concatenate([members, others[others > i]])
                rest = rest[second[rest] != second[i]] if two else rest
                _near_pairs(i, rest[label[rest] != label[i]], who, n, fine, found)
        pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=_PAIR)

    return run


def _dealt(places: DataFrame, nodes: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """Places of larger tiles by bucket, those of tiles with one commonest component together, and the bitmaps of each bucket.

    A component with very many places is dealt to several buckets, by tile: a cluster
    is a share of its tiles. Where one of its tiles has many nodes, they are dealt to
    blocks, and each pair of blocks (a block with itself too) is a part with a bucket
    of its own.
    """
    count = places.groupBy("tile", "label").agg(F.count("*").alias("n"))
    main = count.groupBy("tile").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
    blocks = F.ceil(F.max("n") / BLOCK_NODES).cast("int")
    load = main.groupBy("main").agg(F.ceil(F.sum("n") / TASK_PLACES).alias("shares"), blocks.alias("blocks"))
    share = F.pmod(F.xxhash64("tile"), F.col("shares")).cast("int")
    with_main = places.join(main.join(load, "main").select("tile", "main", share.alias("share"), "blocks"), "tile")
    cut = with_main.withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    # a node is in the pairs of its block with every block
    pair = "transform(sequence(0, blocks - 1), o -> shiftleft(cast(least(block, o) as bigint), 32) + greatest(block, o))"
    parts = cut.select("main", "share", "node", "label", "block", F.explode(F.expr(pair)).alias("part"))
    bucket = F.pmod(F.xxhash64("main", "share", "part"), F.lit(buckets)).cast("int")
    here = stored(parts.select(bucket.alias("bucket"), "main", "share", "part", "node", "label", "block"), "dealt")
    bits = here.select("bucket", "node").distinct().join(nodes, "node").select("bucket", "node", "n", "bits")
    return here, stored(bits, "tile-bits")


def bounded(pairs: DataFrame, bits: DataFrame) -> DataFrame:
    """Pairs (a, b) that pass the bitmap bound."""
    sides = {s: bits.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("bits").alias(f"bits_{s}")) for s in "ab"}

    def run(batches):
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            only = np.zeros((2, len(n_a)), np.int64)
            left, right = batch.column("bits_a").to_pylist(), batch.column("bits_b").to_pylist()
            width = np.array([min(len(x), len(y)) for x, y in zip(left, right)], np.int64)
            for w in np.unique(width).tolist():
                own = np.flatnonzero(width == w)
                x, y = (np.stack([folded(side[k], w) for k in own.tolist()]) for side in (left, right))
                only[0, own], only[1, own] = _only(x, y), _only(y, x)
            yield batch.select(["a", "b"]).filter(pa.array(may_link(n_a, n_b, only[0], only[1])))

    joined = pairs.join(sides["a"], "a").join(sides["b"], "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return joined.mapInArrow(run, "a bigint, b bigint")


def texts_of(wanted: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the wanted nodes, gathered once for all rounds."""
    # the wanted documents grow with the input: no broadcast at any size
    reps = wanted.distinct().join(nodes.select("node", "row.key", "row.key2"), "node").hint("merge")
    # rows that share id and text (null ids too) are one key: one text for each node
    found = docs.select("key", "key2", "text").join(reps, ["key", "key2"])
    return stored(found.groupBy("key", "key2", "node").agg(F.first("text").alias("text")).select("node", "text"), "texts")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (u, v) among the pairs, by exact intersection of the two sets.

    A centre's members are split into shares, so a centre of very many members is
    compared in several tasks; texts are read as a stream.
    """
    share = F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / CENTRE_SHARE)).cast("int")
    counted = pairs.join(pairs.groupBy("a").agg(F.count("*").alias("members")), "a").withColumn("share", share)
    members = counted.select("a", "share", F.lit(1).alias("role"), F.col("b").alias("node"))
    centres = counted.select("a", "share", F.lit(0).alias("role"), F.col("a").alias("node")).distinct()
    # texts of the pairs grow with the input: no broadcast at any size
    seated = members.union(centres).join(texts.hint("merge"), "node").select("a", "share", "role", "node", "text")
    dealt = seated.repartition("a", "share").sortWithinPartitions("a", "share", "role")

    def run(batches):
        held, centre = None, None
        for batch in batches:
            for part in slices(batch, "text"):
                values, at = shingle_sets(read_texts(part.column("text"), lower_ascii=True))
                names, _ = _node(values, at)
                out = []
                for k, (a, s, role, node) in enumerate(zip(*(part.column(c).to_pylist() for c in ("a", "share", "role", "node")))):
                    if int(names[k]) != node:  # another text under the same id
                        continue
                    own = values[at[k] : at[k + 1]]
                    if role == 0:
                        held, centre = (a, s), own
                    elif held == (a, s) and linked(centre, own):
                        out.append((a, node))
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.int64()) for i in (0, 1)], ["u", "v"])

    return dealt.mapInArrow(run, "u bigint, v bigint")


# ---------------------------------------------------------------- the join


def keyed(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, text, key, key2) of every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.select("*", *(k.alias(name) for k, name in zip(row_key("doc_id", "text"), ("key", "key2"))))


def near_components(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, key, key2, n_shingles, component_id, n_copies, is_first) of every row.

    The keys name the row by its id and text; copies counts the rows of the same
    set. A component's first row has its smallest id, null last, then the smallest
    keys (equal rows are first together); rows without words are first.
    """
    with scratch(docs.sparkSession), small_batches(docs.sparkSession):
        return stored(_near_components(docs, text, doc_id), "near-components")


def _near_components(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    spark = docs.sparkSession
    docs = keyed(docs, text, doc_id)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    profiled = stored(profiles(docs, frequent_shingles(docs), word_ranks(docs)), "profiles")
    named = profiled.where("n_shingles > 0")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key", "key2")
    nodes = stored(
        named.groupBy("node").agg(F.min(row).alias("row"), F.first("n_shingles").alias("n"), F.count("*").alias("n_copies")), "nodes"
    )
    tiles = stored(_packed(profiled, buckets).groupBy("bucket").applyInArrow(_tile_pairs, _schema(_TILES)), "tiles")
    # what is left of the profiles: no first shingles, and bitmaps once a node
    found = stored(profiled.select("doc_id", "key", "key2", "n_shingles", "node"), "rows")
    bits = stored(named.groupBy("node").agg(F.first("n_shingles").alias("n"), F.first("coarse").alias("coarse"), F.first("fine").alias("fine")), "bits")
    done_with(profiled)
    coarse, fine = (bits.select("node", "n", F.col(c).alias("bits")) for c in ("coarse", "fine"))
    pairs = stored(bounded(tiles.where("kind = 0").select("a", "b").distinct(), coarse), "pairs")
    places = tiles.where("kind = 1").select("tile", F.col("a").alias("node"))
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(places.select("node"))
    texts = texts_of(wanted, docs, nodes)
    links = stored(verified(pairs, texts), "links")
    label = stored(components(links), "labels")

    # larger tiles that hold several components
    for turn in range(STAR_ROUNDS + 1):
        here = places.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        open_ = here.groupBy("tile").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("tile")
        places = stored(here.join(open_, "tile").select("tile", "node", "label"), f"places-{turn}")
        if places.isEmpty():
            break
        here, own = _dealt(places, fine, buckets)
        make = _tile_round(turn if turn < STAR_ROUNDS else None)
        more = here.groupBy("bucket").cogroup(own.groupBy("bucket")).applyInArrow(make, _schema(_PAIR))
        more = stored(more.distinct(), f"tile-pairs-{turn}")
        done_with(here, own)
        label = stored(joined_labels(label, verified(more, texts)), f"labels-{turn}")
        places = places.drop("label")
    known = nodes.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = known.groupBy("label").agg(F.min("row").alias("least"))
    by_node = known.join(least, "label").select("node", "least", "n_copies")
    joined = found.select("doc_id", "key", "key2", "n_shingles", "node").join(by_node, "node", "left")
    is_first = F.coalesce((F.col("key") == F.col("least.key")) & (F.col("key2") == F.col("least.key2")), F.lit(True))
    component = F.coalesce("least.doc_id", "doc_id").alias("component_id")
    return joined.select("doc_id", "key", "key2", "n_shingles", component, "n_copies", is_first.alias("is_first"))


def joined_labels(label: DataFrame, links: DataFrame) -> DataFrame:
    """Labels (node, label) after further links: the components that they join share the smallest label."""
    by_u = label.select(F.col("node").alias("u"), F.col("label").alias("lu"))
    by_v = label.select(F.col("node").alias("v"), F.col("label").alias("lv"))
    between = links.join(by_u, "u", "left").join(by_v, "v", "left")
    between = between.select(F.coalesce("lu", "u").alias("u"), F.coalesce("lv", "v").alias("v"))
    moved = stored(components(between), "moved")
    known = label.join(moved.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
    kept = known.select("node", F.coalesce("to", "label").alias("label"))
    return kept.union(moved.join(label, "node", "left_anti").select("node", "label"))


def _schema(schema: pa.Schema) -> str:
    kinds = {pa.int32(): "int", pa.int64(): "bigint"}
    return ", ".join(f"{f.name} {kinds[f.type]}" for f in schema)


def op9_bitmap_join(spark, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set and the smallest document it is linked with, directly or not."""
    return near_components(read_documents(spark, sf_dir, "doc_id", "text")).select("doc_id", "n_shingles", "component_id")
