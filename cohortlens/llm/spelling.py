"""Spelling variant grouping: one edit apart, by dynamic programming over sorted lists.

Words are runs of letters (``A-Za-z`` and U+00C0 to U+00FF, A-Z in lower case)
of ``LEAST`` code points or more that occur ``OFTEN`` times or more; two are near
if one inserted, deleted or replaced code point turns one into the other.

The vocabulary is counted in Spark and sorted; near words are found by scanning
the sorted list. Words of a range of it that share a prefix share the rows of the
edit matrix for that prefix, so a row is computed once for each query and
distinct prefix: adjacent LCPs (common prefixes of neighbours) say where prefixes
branch. A row has three cells, the band within one edit of the diagonal. A range
whose row has no cell of at most one edit is skipped whole; a query goes on with
what is left. All queries of a list go down it together, a row at a time.

The list is sorted in pieces that tasks scan on their own. A pair whose shorter
word has m letters is cut, by m, into ``BLOCKS`` blocks; one edit leaves all but
one block as they are. So each word is listed, for m its length and one less, and
for each block, with that block moved to its end: near words share all that comes
before it. Such a list begins with the row of equal prefixes, words of one list
share about two thirds of their letters, and no list grows with one word's
frequency. A pair that several blocks show (an insertion in a run of equal
letters) is taken from the first of them.

A word's form is its near word of largest n, where that is at least ``RATIO``
times its own; each step to a form multiplies n, so chains are short, and roots
are found by doubling: every round joins forms to the forms of forms.

Defined cases: a null or empty text has no words; texts are read whole; rows
without an id hash as if it were empty; rows that share an id, or are repeated,
count each; ties of n go to the smaller form in code-point order; an empty table
gives an empty table; only the named columns are read. Words are their letters,
of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import read_documents
from .shared import scratch, stored

LEAST, OFTEN, RATIO, BLOCKS = 7, 2, 10, 3
#: One run in so many loses a letter (a planted misspelling, by hash).
DROP_ONE_OF = 31
#: Letters that a task holds of its sorted list at a time, about; a list is never cut.
HELD_LETTERS = 1 << 22
#: States of a scan that are alive at once, about; more queries wait.
STATES = 1 << 20


# ---------------------------------------------------------------- vocabulary


def vocabulary(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, often: int = OFTEN) -> DataFrame:
    """(word, n): all words of all texts with how often they occur."""
    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text}`").alias("text"))
    runs = rows.select("id", F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least},}}"), F.lit(0))).alias("run"))
    upper = "".join(map(chr, range(65, 91)))
    lowered = runs.select("id", F.translate("run", upper, upper.lower()).alias("run"))
    hashed = lowered.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = "cast(h % length(run) as int)"
    word = F.expr(f"if(h % {DROP_ONE_OF} = 0, concat(substr(run, 1, {at}), substr(run, {at} + 2)), run)")
    counted = hashed.select(word.alias("word")).where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= often)


# ---------------------------------------------------------------- lists


def blocks_of(m: int, blocks: int = BLOCKS) -> list[tuple[int, int]]:
    """(letters before, letters after) of each block of a word of m letters; the rest is the block."""
    sizes = [(m + k) // blocks for k in range(blocks)]
    return [(sum(sizes[:j]), sum(sizes[j + 1 :])) for j in range(blocks)]


def lists(words: DataFrame, least: int = LEAST, blocks: int = BLOCKS) -> DataFrame:
    """(m, block, turned, n): each word once for every list it belongs to, the list's block moved to its end."""
    sizes = ", ".join(f"(m + {k}) div {blocks}" for k in range(blocks))
    rows = words.withColumn("m", F.explode(F.expr(f"filter(array(length(word) - 1, length(word)), x -> x >= {least})")))
    rows = rows.selectExpr("*", f"array({sizes}) as sizes").selectExpr("*", f"explode(sequence(0, {blocks - 1})) as block")
    rows = rows.selectExpr(
        "m", "block", "word", "n",
        "cast(aggregate(slice(sizes, 1, block), 0L, (a, x) -> a + x) as int) as before",
        f"cast(aggregate(slice(sizes, block + 2, {blocks}), 0L, (a, x) -> a + x) as int) as after",
    )
    shared = "concat(substr(word, 1, before), if(after = 0, '', substr(word, length(word) - after + 1)))"
    return rows.selectExpr("m", "block", f"{shared} as shared", f"concat({shared}, substr(word, before + 1, length(word) - before - after)) as turned", "n")


def _letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A byte for each letter (all are below U+0100) and each word's number of letters."""
    words = column.to_pylist()
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), np.array([len(w) for w in words], np.int64)


def _scan(a: np.ndarray, length: np.ndarray, m: int, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (query of m letters, word) one edit apart, of rows sorted by their letters; prefixes of ``shared`` letters must be equal.

    ``a`` has m + 1 letters a row (a zero ends the shorter ones).
    """
    n = len(a)
    differs = a[1:] != a[:-1]
    lcp = np.full(n, -1, np.int64)
    lcp[1:] = np.where(differs.any(1), differs.argmax(1), m + 1)
    opens = np.flatnonzero(lcp < shared)
    group = np.searchsorted(opens, np.arange(n), side="right") - 1
    ends = np.append(opens[1:], n)
    branch = [np.flatnonzero(lcp == d) for d in range(shared, m + 1)]
    queries = np.flatnonzero((length == m) & ((ends - opens)[group] > 1))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    weight = np.cumsum((ends - opens)[group[queries]])
    cuts = np.searchsorted(weight, np.arange(0, weight[-1] if len(weight) else 0, STATES), side="left").tolist() + [len(queries)]
    for x, y in zip(cuts[:-1], cuts[1:]):
        q = queries[x:y]
        lo, hi = opens[group[q]], ends[group[q]]
        c0, c1, c2 = (np.full(len(q), v, np.int8) for v in (1, 0, 1))
        for d in range(shared, m + 2):
            # words that end here are the first of their range
            over = length[lo] == d
            far = c1 if d == m else c0
            if d >= m:
                hit = over & (far == 1)
                found.append((q[hit], lo[hit]))
            if d > m:
                break
            lo = lo + over
            alive = lo < hi
            q, lo, hi, c0, c1, c2 = (v[alive] for v in (q, lo, hi, c0, c1, c2))
            # ranges branch where neighbours share just d letters
            at = branch[d - shared]
            first, last = np.searchsorted(at, lo, side="right"), np.searchsorted(at, hi, side="left")
            parts = last - first + 1
            of = np.repeat(np.arange(len(q)), parts)
            nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
            inner = np.minimum(first[of] + nth - 1, max(len(at) - 1, 0))
            start = np.where(nth == 0, lo[of], at[inner] if len(at) else 0)
            fresh = np.append(start[1:], 0)
            end = np.where(nth == parts[of] - 1, hi[of], fresh)
            # the next row of the band
            q, c0, c1, c2 = q[of], c0[of], c1[of], c2[of]
            letter = a[start, d]
            n0 = np.minimum(c0 + (letter != a[q, d - 1]), c1 + 1) if d else c1 + 1
            n1 = np.minimum(np.minimum(c1 + (letter != a[q, d]), c2 + 1), n0 + 1) if d < m else np.full(len(q), 2, np.int8)
            n2 = np.minimum(c2 + (letter != a[q, d + 1]), n1 + 1) if d + 1 < m else np.full(len(q), 2, np.int8)
            alive = (n0 <= 1) | (n1 <= 1) | (n2 <= 1)
            q, lo, hi = q[alive], start[alive], end[alive]
            c0, c1, c2 = (np.minimum(v[alive], 2).astype(np.int8) for v in (n0, n1, n2))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(v) for v in zip(*found))


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Letters that rows have in common from their start."""
    differs = a != b
    return np.where(differs.any(1), differs.argmax(1), a.shape[1])


def near_in_list(letters: np.ndarray, length: np.ndarray, m: int, block: int, blocks: int = BLOCKS):
    """(query place, word place, the rows' words as bytes) of one sorted list of turned words, for all its shared beginnings."""
    n = len(length)
    first = np.cumsum(length) - length
    a = np.zeros((n, m + 1), np.uint8)
    a[np.repeat(np.arange(n), length), np.arange(len(letters)) - np.repeat(first, length)] = letters
    before, after = blocks_of(m, blocks)[block]
    shared = before + after
    q, w = _scan(a, length, m, shared)
    twice = (length[w] == m) & (w < q)  # both directions are found between words of one length
    q, w = q[~twice], w[~twice]

    def words(rows: np.ndarray, size: int) -> np.ndarray:
        columns = [*range(before), *range(shared, size), *range(before, shared)]
        return a[rows][:, columns]

    out = []
    for size in (m, m + 1):
        some = length[w] == size
        left, right = words(q[some], m), words(w[some], size)
        head, tail = _common(left, right[:, :m]), _common(left[:, ::-1], right[:, ::-1][:, :m])
        new = np.ones(len(left), bool)
        for ahead, behind in blocks_of(m, blocks)[:block]:
            new &= ~((head >= ahead) & (tail >= behind))
        out.append((q[some][new], w[some][new], left[new], right[new]))
    return out


def _texts(rows: np.ndarray) -> list[str]:
    size = rows.shape[1]
    whole = rows.tobytes().decode("latin-1")
    return [whole[i : i + size] for i in range(0, len(whole), size)]


_PAIR = "word string, n bigint, near string, near_n bigint"


def near_words(words: DataFrame, least: int = LEAST, blocks: int = BLOCKS) -> DataFrame:
    """(word, n, near, near_n): every pair of near words, in both directions, once."""
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    listed = lists(words, least, blocks).repartition(parts, "m", "block", "shared").sortWithinPartitions("m", "block", "turned")
    names = ["word", "n", "near", "near_n"]

    def scanned(rows: pa.Table):
        m, block = (rows.column(c).to_numpy() for c in ("m", "block"))
        n = rows.column("n").to_numpy()
        cuts = np.flatnonzero(np.diff(m.astype(np.int64) * blocks + block, prepend=-1))
        for x, y in zip(cuts.tolist(), [*cuts[1:].tolist(), len(m)]):
            letters, length = _letters(rows.column("turned").slice(x, y - x))
            for q, w, left, right in near_in_list(letters, length, int(m[x]), int(block[x]), blocks):
                if len(q):
                    one, two = _texts(left), _texts(right)
                    n_one, n_two = n[x + q], n[x + w]
                    yield pa.RecordBatch.from_arrays([pa.array(one + two), pa.array(np.concatenate([n_one, n_two])), pa.array(two + one), pa.array(np.concatenate([n_two, n_one]))], names)

    def run(batches):
        held, letters = [], 0
        for batch in batches:
            held.append(batch)
            letters += batch.column("turned").nbytes
            if letters > HELD_LETTERS:
                rows = pa.Table.from_batches(held)
                # rows after the last beginning of a list wait for the rest of it
                names = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("m", "block", "shared")]
                fresh = np.logical_or.reduce([v[1:] != v[:-1] for v in names])
                cut = int(np.flatnonzero(fresh)[-1]) + 1 if fresh.any() else 0
                yield from scanned(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
                letters = sum(b.column("turned").nbytes for b in held)
        if held:
            yield from scanned(pa.Table.from_batches(held))

    return listed.mapInArrow(run, _PAIR)


# ---------------------------------------------------------------- forms and roots


def forms(words: DataFrame, pairs: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, n, n_near, form, form_n) of all words."""
    alone = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("bigint").alias("near_n"))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("near"))))
    both = pairs.unionByName(alone).groupBy("word").agg(F.max("n").alias("n"), F.count("near").alias("n_near"), best.alias("best"))
    enough = -F.col("best.less") >= ratio * F.col("n")
    return both.select("word", "n", "n_near", F.when(enough, F.col("best.near")).alias("form"), F.when(enough, -F.col("best.less")).alias("form_n"))


def roots(found: DataFrame) -> DataFrame:
    """(word, root) of the words that have a form: the last of its forms."""
    steps = stored(found.where("form is not null").select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = steps.select(F.col("word").alias("of"), F.col("root").alias("next"))
        steps = steps.join(further, F.col("root") == F.col("of"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        steps = stored(steps, "spelling-roots")
        if steps.where("moved").isEmpty():
            return steps.select("word", "root")
        steps = steps.select("word", "root")


def variants(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", least: int = LEAST, often: int = OFTEN, ratio: int = RATIO, blocks: int = BLOCKS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the whole vocabulary."""
    if least < blocks:
        raise ValueError("every block needs a letter")
    with scratch(docs.sparkSession):
        words = stored(vocabulary(docs, text, doc_id, least, often), "spelling-words")
        found = stored(forms(words, near_words(words, least, blocks), ratio), "spelling-forms")
        last = roots(found).withColumnRenamed("word", "of")
        whole = found.join(last, F.col("word") == F.col("of"), "left")
        return stored(whole.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling")


def op13_spelling_variants(spark, sf_dir: str) -> DataFrame:
    """The vocabulary of ``documents`` with each word's form and root."""
    return variants(read_documents(spark, sf_dir, "doc_id", "text"))
