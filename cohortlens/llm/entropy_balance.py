"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Document i of source s gets the rate w_i = min(cap, exp(lambda_s * c_i)), where
c_i is its size over its source's mean size. These are the rates nearest to one
copy each, in relative entropy, whose words add up to the source's target while
no rate exceeds ``cap``. The multiplier of each source solves a convex dual in
one variable; Newton steps, kept inside a bracket, solve all sources at once.

A rate depends on source and size alone, so the documents are first counted by
(source, size): every Newton step sums over that table. Copies are rounded along
it: the copies of the sizes up to some size are the rounded running sum of their
rates, so a source misses its target by half its longest document at most;
``REPAIRS`` single copies of the best fitting sizes then close most of that gap. Within (source, size, slice) documents take their
copies in the order of a hash of their id; slices of that hash keep a size that
very many documents share from meeting in one task.

All sums that decide anything are of integers (rates in billionths), so reruns
agree whatever the order of the partial sums.

Targets: sources in code point order, null last, weigh ``WEIGHTS``, repeating,
and share ``share`` of all words; a target stops at ``cap`` times its source's
words and the excess is shared again by weight among the others.

Defined cases: null text or one without words has size 0 and gives no words (one
copy); a null source is a source of its own; a source without words has target
0; repeated rows count and are copied each on its own; an empty table gives an
empty table; further columns are kept by ``mixed``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batches import free_name, row_key
from .shared import stored

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
#: Rates are kept in these parts of one copy.
UNIT = 1_000_000_000
#: Newton steps end when every source is this near to its target, or after STEPS.
TOLERANCE = 1e-6
STEPS = 40
#: Single copies by which a source's rounding is brought nearer to its target.
REPAIRS = 4
#: Slices of the id's hash in which documents of one source and size are ranked.
SLICES = 1024

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """source, source_size, n, target of a table (source, size, n)."""
    per_source = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    # one row per source from here on; sources are few against documents
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ring = F.array(*[F.lit(float(x)) for x in weights])
    weighed = per_source.withColumn("weight", F.element_at(ring, ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    # water level: sources reach their caps in the order of cap over weight
    full = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    whole = Window.partitionBy()
    done = full.rowsBetween(Window.unboundedPreceding, -1)
    rest = full.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(whole) * F.lit(float(share))
    level = (total - F.lit(float(cap)) * F.coalesce(F.sum("source_size").over(done), F.lit(0))) / F.sum("weight").over(rest)
    reached = weighed.select(
        "*", level.alias("level"), (F.lit(float(cap)) * F.col("source_size")).alias("most"), F.row_number().over(full).alias("turn")
    )
    # the first source that the level of those after it leaves below its cap sets the level
    below = F.col("level") * F.col("weight") < F.col("most")
    water = F.min_by(F.when(below, F.col("level")), F.when(below, F.col("turn"))).over(whole)
    target = F.least(F.col("most"), F.coalesce(water * F.col("weight"), F.col("most")))
    return reached.select("source", "source_size", "n", target.alias("target"))


def _rate(cap) -> F.Column:
    """Billionths of a copy; rounded so that equal inputs give equal integers everywhere."""
    tilted = F.exp(F.least(F.col("multiplier") * F.col("size") / F.col("mean"), F.lit(50.0)))
    return F.round(F.least(tilted, F.lit(float(cap))) * UNIT).cast("long")


def solve(sizes: DataFrame, targets: DataFrame, cap=CAP) -> DataFrame:
    """The multiplier of every source: (source, source_size, target, mean, multiplier)."""
    from math import log

    state = targets.where("source_size > 0 and target > 0").select(
        "source",
        "source_size",
        "target",
        (F.col("source_size") / F.col("n")).alias("mean"),
        # with all documents alike, the tilt that hits the target
        F.log(F.col("target") / F.col("source_size")).alias("multiplier"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        (F.col("target") >= F.col("source_size") * float(cap)).alias("closed"),
    )
    # a source at its cap takes cap copies of everything: no finite multiplier is needed
    state = stored(state.withColumn("multiplier", F.when(F.col("closed"), F.lit(1e12)).otherwise(F.col("multiplier"))), "balance-0")
    for step in range(1, STEPS + 1):
        open_ = state.where("not closed")
        moment = sizes.where("size > 0").join(open_.select("source", "mean", "multiplier"), F.expr("sizes_source <=> source")).drop("source")
        w = _rate(cap)
        slope = F.when(w < cap * UNIT, w).otherwise(F.lit(0)) * F.round(F.col("size") / F.col("mean") * 1000).cast("long")
        sums = moment.groupBy("sizes_source").agg(
            F.sum((F.col("n") * F.col("size")).cast("decimal(20,0)") * w.cast("decimal(18,0)")).alias("words"),
            F.sum((F.col("n") * F.col("size")).cast("decimal(20,0)") * slope.cast("decimal(18,0)")).alias("slope"),
        )
        gap = F.col("words").cast("double") / UNIT - F.col("target")
        grade = F.col("slope").cast("double") / (1000.0 * UNIT)
        met = state.join(sums, F.expr("sizes_source <=> source"), "left").withColumn("gap", gap).withColumn("grade", grade)
        now = F.col("multiplier")
        low = F.when(F.col("gap") < 0, now).otherwise(F.col("low"))
        high = F.when(F.col("gap") >= 0, now).otherwise(F.col("high"))
        newton = now - F.col("gap") / F.when(F.col("grade") > 0, F.col("grade"))
        # outside the bracket, or without a slope: halve the bracket, or widen it where it is open
        inside = (newton > F.coalesce(low, F.lit(-1e300))) & (newton < F.coalesce(high, F.lit(1e300)))
        halved = (
            F.when(low.isNotNull() & high.isNotNull(), (low + high) / 2).when(low.isNotNull(), low + F.abs(low) + log(2)).otherwise(high - F.abs(high) - log(2))
        )
        step_to = F.when(F.coalesce(inside, F.lit(False)), newton).otherwise(halved)
        near = F.abs(F.col("gap")) <= F.col("target") * TOLERANCE
        stop = F.col("closed") | F.coalesce(near, F.lit(True))
        state = stored(
            met.select(
                "source",
                "source_size",
                "target",
                "mean",
                F.when(stop, now).otherwise(step_to).alias("multiplier"),
                low.alias("low"),
                high.alias("high"),
                stop.alias("closed"),
            ),
            f"balance-{step}",
        )
        if state.where("not closed").isEmpty():
            break
    return state.drop("low", "high", "closed")


def _rounded(billionths) -> F.Column:
    """A sum of billionths of a copy, as the nearest whole number of copies."""
    whole = F.lit(UNIT).cast("decimal(10,0)")
    return F.floor((billionths + F.lit(UNIT // 2).cast("decimal(10,0)")) / whole).cast("long")


def _repaired(rounded: DataFrame, cap) -> DataFrame:
    """One copy more or less of the size nearest to what the source's rounding still misses, where that brings it nearer."""
    whole = Window.partitionBy("r_source")
    miss = F.col("target") - F.sum(F.col("r_size") * F.col("dealt")).over(whole)
    missed = rounded.withColumn("miss", miss)
    room = F.when(F.col("miss") > 0, F.col("dealt") < F.col("r_n") * cap).otherwise(F.col("dealt") > 0) & (F.col("r_size") > 0)
    off = F.abs(F.abs(F.col("miss")) - F.col("r_size"))
    fits = F.when(room & (off < F.abs(F.col("miss"))), F.struct(off.alias("off"), F.col("r_size").alias("at")))
    best = F.min(fits).over(whole)
    step = F.when(F.col("r_size") == F.col("best.at"), F.signum("miss").cast("long")).otherwise(F.lit(0))
    return missed.withColumn("best", best).withColumn("dealt", F.col("dealt") + F.coalesce(step, F.lit(0))).drop("miss", "best")


#: Whole copies of the first documents of a size, of ``dealt`` for all ``r_n``.
_SHARED = "((cast(dealt as decimal(18,0)) * cast({0} as decimal(18,0))) div r_n)"


def mix(
    docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", share=SHARE, cap=CAP, keep: tuple[str, ...] = ()
) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies) of every row of ``docs``, and its ``keep`` columns.

    Among rows that share an id, the ``keep`` columns decide the order.
    """
    slot = F.pmod(F.xxhash64(F.col(doc_id)), F.lit(SLICES)).cast("int")
    sized = stored(
        docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), n_words(text).alias("size"), *keep).withColumn("slot", slot),
        "sizes",
    )
    cells = stored(sized.groupBy("source", "size", "slot").agg(F.count("*").alias("n")), "cells")
    sizes = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = stored(source_targets(sizes, share=share, cap=cap), "targets")
    solved = solve(stored(sizes.withColumnRenamed("source", "sizes_source"), "by-size"), targets, cap)

    # rates and copies by (source, size): one row per distinct size of a source
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    m = solved.select(F.col("source").alias("m_source"), "mean", "multiplier")
    rated = sizes.join(t, F.expr("source <=> t_source")).join(m, F.expr("source <=> m_source"), "left")
    # a source without words keeps one copy; a target of zero takes none
    rate = F.when(F.col("size") == 0, F.lit(UNIT)).otherwise(F.coalesce(_rate(cap), F.lit(0)))
    rated = rated.withColumn("rate", rate)
    along = Window.partitionBy("source").orderBy("size")
    upto = F.sum(F.col("n").cast("decimal(18,0)") * F.col("rate").cast("decimal(18,0)"))
    before = F.coalesce(upto.over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("decimal(38,0)"))
    rounded = rated.select(
        F.col("t_source").alias("r_source"),
        F.col("size").alias("r_size"),
        F.col("n").alias("r_n"),
        "source_size",
        "target",
        (F.col("rate") / UNIT).alias("rate"),
        (_rounded(upto.over(along)) - _rounded(before)).alias("dealt"),
    )
    for _ in range(REPAIRS):
        rounded = _repaired(rounded, cap)
    rounded = stored(rounded, "dealt")
    # a size's copies shared out among its slices, in proportion to their documents
    spread = cells.join(rounded, F.expr("source <=> r_source and size = r_size"))
    slots = Window.partitionBy("source", "size").orderBy("slot")
    counted = F.sum("n").over(slots)
    spread = spread.withColumn("upto", counted).withColumn("dealt", F.expr(f"{_SHARED.format('upto')} - {_SHARED.format('upto - n')}"))
    spread = spread.select(
        F.col("r_source").alias("c_source"),
        F.col("size").alias("c_size"),
        F.col("slot").alias("c_slot"),
        "source_size",
        "target",
        "rate",
        F.floor(F.col("dealt") / F.col("n")).cast("long").alias("all_get"),
        (F.col("dealt") % F.col("n")).alias("some_get"),
    )
    place = F.row_number().over(Window.partitionBy("source", "size", "slot").orderBy(F.xxhash64(F.col("doc_id"), F.lit(7)), "doc_id", *keep))
    ranked = sized.withColumn("place", place)
    # a row for each source, size and slice: they grow with the documents, so no broadcast at any size
    joined = ranked.join(spread.hint("merge"), F.expr("source <=> c_source and size = c_size and slot = c_slot"))
    copies = F.col("all_get") + F.when(F.col("place") <= F.col("some_get"), F.lit(1)).otherwise(F.lit(0))
    return joined.select("doc_id", "source", "size", "source_size", "target", "rate", copies.cast("long").alias("copies"), *keep)


def mixed(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id") -> DataFrame:
    """Every row of ``docs``, with all its columns, as many times as the mix copies its document.

    Rows go by id, source and text, null or not; those that share all three share
    their copies out as evenly as whole copies allow.
    """
    prefix = free_name(docs.columns, "mix_")
    key = [f"{prefix}key_", f"{prefix}key2_"]
    copies, rows, at = f"{prefix}copies_", f"{prefix}rows_", f"{prefix}place_"
    columns = [F.col(f"`{c}`") for c in docs.columns]
    named = docs.withColumns(dict(zip(key, row_key(doc_id, source, text))))
    counts = mix(named, text, source, doc_id, keep=tuple(key)).groupBy(*key).agg(F.sum("copies").alias(copies), F.count("*").alias(rows))
    counts = stored(counts.where(f"{copies} > 0"), "copies")

    def copied(found, times):
        return found.withColumn(f"{prefix}copy_", F.explode(F.expr(f"array_repeat(0, cast({times} as int))"))).select(*columns)

    even = copied(named.join(counts.where(f"{copies} % {rows} = 0"), key), f"{copies} div {rows}")
    uneven = counts.where(f"{copies} % {rows} <> 0")
    if uneven.isEmpty():
        return even
    place = F.row_number().over(Window.partitionBy(*key).orderBy(key[0]))
    ranked = named.join(uneven, key).withColumn(at, place)
    more = copied(ranked, f"{copies} div {rows} + if({at} <= {copies} % {rows}, 1, 0)")
    return even.unionByName(more)


def op8_source_mix(spark, sf_dir: str) -> DataFrame:
    """Per document: its size, its source's size and target, and the words that the mix takes of it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", "rate"
    )
