"""Mixing sources to target weights by entropy balancing.

The mix takes each document at a rate between 0 and ``MAX_RATE`` as close to 1 (in relative
entropy) as the token constraints allow: the taken words of every source must meet its target.
The solution tilts rates exponentially by size, ``rate = MAX_RATE / (1 + exp(-tilt * size / mean
size))``, with one tilt per source: the maximum of a concave dual, found for all sources at once by
guarded Newton steps on the (source, size) counts. Rates become whole copies by comparing their
fraction with a hash of the row; the comparison's offset is set per source so that the words taken
meet the target to within about one document.

Nulls: a null text has no words, a null source is a source of its own and the last in order.
Repeated rows count each; where they are numbered (``numbered_draws``) each has a draw of its own, so that a
source of equal rows meets its target too, else they are copied alike. A source without words has target 0. An empty table
has an empty result. Input columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import null_key, ranked
from tideline.scale import cut, join_bounded

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_RATE = 2
TOLERANCE = 1e-4
MAX_STEPS = 100  # bisection alone needs fewer
FLAT_TILT = 60.0  # beyond it every rate of a sized document is at an end
HASH_BITS = 30
EQUAL_ROWS = 1 << 16
LEVELS = (11, 10, 10)  # bits of a rounding key fixed by each pass
RESULTS = ("source_size", "target", "rate", "copies", "taken")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """(_src, weight, source_size, target) from (source, size) rows.

    Targets follow the weights up to ``MAX_RATE`` times a source's size; what exceeds is dealt
    again by weight. The common level is found by Newton steps on two sums.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(per_source, [F.col("source").asc_nulls_last()], "_pos")
    each = F.array(*[F.lit(w) for w in weights])
    sources = cut(
        placed.select(
            null_key("source").alias("_src"),
            F.get(each, (F.col("_pos") % len(weights)).cast("int")).alias("weight"),
            "source_size",
        )
    )
    cap = F.lit(float(MAX_RATE)) * F.col("source_size")
    level, before = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        row = sources.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, cap)).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("free"),
            F.count_if(full).alias("n"),
        ).first()
        if not row["all"] or row["n"] == before or not row["free"]:
            break
        level, before = (share * row["all"] - (row["held"] or 0.0)) / row["free"], row["n"]
    return sources.withColumn("target", F.least(F.col("weight") * F.lit(level), cap))


def _rate(tilt: Column, x: Column) -> Column:
    return F.lit(float(MAX_RATE)) / (1 + F.exp(-tilt * x))


def solve_tilts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(_src, source_size, target, mean, tilt): the dual's solution per source.

    ``sizes`` is (_src, size, n). A step sums gradient and curvature per source, combined before
    the shuffle; a Newton step that leaves the bracket of the root is replaced by its middle.
    """
    means = sizes.groupBy("_src").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    ratio = F.col("target") / F.col("source_size")
    state = targets.join(means, "_src").select(
        "_src", "source_size", "target", "mean",
        F.lit(-FLAT_TILT).alias("lo"),
        F.lit(FLAT_TILT).alias("hi"),
        F.when(F.col("source_size") == 0, 0.0)
        .when(ratio >= MAX_RATE * (1 - TOLERANCE), FLAT_TILT)
        .otherwise(0.0)
        .alias("tilt"),
        ((F.col("source_size") == 0) | (ratio >= MAX_RATE * (1 - TOLERANCE))).alias("done"),
    )
    state = cut(state)
    for _ in range(MAX_STEPS):
        if state.filter(~F.col("done")).isEmpty():
            break
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("tilt"), x)
        words = F.col("size") * F.col("n")
        sums = (
            join_bounded(sizes, state.filter(~F.col("done")).select("_src", "mean", "tilt"), ["_src"], spread="size")
            .groupBy("_src")
            .agg(F.sum(words * rate).alias("_got"), F.sum(words * x * rate * (1 - rate / MAX_RATE)).alias("_slope"))
        )
        gap = F.col("_got") - F.col("target")
        low = F.when(gap < 0, F.col("tilt")).otherwise(F.col("lo"))
        high = F.when(gap >= 0, F.col("tilt")).otherwise(F.col("hi"))
        step = F.col("tilt") - gap / F.col("_slope")
        newton = F.when((F.col("_slope") > 0) & (step > low) & (step < high), step).otherwise((low + high) / 2)
        near = F.abs(gap) <= TOLERANCE * F.col("target")
        pinched = (high - low) < 1e-9
        moved = state.join(sums, "_src", "left")
        state = cut(
            moved.select(
                "_src", "source_size", "target", "mean",
                F.when(F.col("done"), F.col("lo")).otherwise(low).alias("lo"),
                F.when(F.col("done"), F.col("hi")).otherwise(high).alias("hi"),
                F.when(F.col("done") | near, F.col("tilt")).otherwise(newton).alias("tilt"),
                (F.col("done") | near | pinched).alias("done"),
            )
        )
    else:
        raise RuntimeError("the dual did not settle")
    return state.select("_src", "source_size", "target", "mean", "tilt")


def _rounding(size: Column, draw: Column) -> tuple[Column, Column]:
    """Whole copies of a rate, and the key by which one more is given to the smallest first."""
    x = size / F.greatest(F.col("mean"), F.lit(1e-9))
    rate = F.when(size == 0, 1.0).otherwise(_rate(F.col("tilt"), x))
    base = F.floor(rate)
    key = draw - F.floor((rate - base) * (1 << HASH_BITS)) + (1 << HASH_BITS)
    return base, F.when((base < MAX_RATE) & (size > 0), key)


def rounding_offsets(rows: DataFrame, tilts: DataFrame) -> DataFrame:
    """Tilts with ``limit``: rows whose rounding key is below it get one more copy.

    The key is found by a radix search: each pass sums words per bucket of the keys still in
    question, so a source of any size is a row per bucket and task.
    """
    joined = join_bounded(rows, tilts, ["_src"], spread="draw")
    base, key = _rounding(F.col("size"), F.col("draw"))
    keyed = joined.select("_src", "size", base.alias("base"), key.alias("key"))
    held = keyed.groupBy("_src").agg(F.sum(F.col("base") * F.col("size")).alias("_held"))
    state = tilts.join(held, "_src", "left").select(
        *tilts.columns,
        (F.col("target") - F.coalesce("_held", F.lit(0))).alias("left"),
        F.lit(0).cast("bigint").alias("limit"),
    )
    state = cut(state)
    shift = sum(LEVELS)
    for bits in LEVELS:
        open_ = state.select("_src", "left", "limit")
        inside = join_bounded(keyed, open_, ["_src"], spread="key").filter(
            F.shiftright("key", shift) == F.shiftright("limit", shift)
        )
        shift -= bits
        counts = inside.groupBy("_src", "left", F.shiftright("key", shift).alias("_b")).agg(F.sum("size").alias("w"))
        upto = Window.partitionBy("_src").orderBy("_b")  # at most 2 ** bits rows of a source
        sums = counts.withColumn("_upto", F.sum("w").over(upto))
        # the bucket the target falls into; the nearer of its ends in the last pass
        reach = F.col("w") / 2 if shift == 0 else F.lit(0)
        under = F.col("_upto") - reach <= F.col("left")
        taken = sums.groupBy("_src").agg(
            F.sum(F.when(under, F.col("w"))).alias("_w"), F.min(F.when(~under, F.col("_b"))).alias("_next"),
            F.max("_b").alias("_last"),
        )
        past = F.shiftleft(F.coalesce(F.col("_next"), F.col("_last") + 1), shift)
        state = cut(
            state.join(taken, "_src", "left").select(
                *tilts.columns,
                (F.col("left") - F.coalesce("_w", F.lit(0))).alias("left"),
                F.coalesce(past, F.col("limit")).alias("limit"),
            )
        )
    return state.select(*tilts.columns, "limit")


def mix_sources(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE) -> DataFrame:
    """``docs`` (source, size, draw, ...) with source_size, target, rate, copies and taken.

    ``size`` is a document's words, ``draw`` a uniform hash of ``HASH_BITS`` bits (``draw_of``).
    """
    docs = docs.drop(*RESULTS)
    rows = cut(docs.select("source", "size", "draw"))
    targets = source_targets(rows, weights, share)
    rows = rows.select(null_key("source").alias("_src"), "size", "draw")
    counts = cut(rows.groupBy("_src", "size").agg(F.count("*").alias("n")))
    limits = rounding_offsets(rows, solve_tilts(counts, targets))
    joined = join_bounded(docs.withColumn("_src", null_key("source")), limits, ["_src"], spread="draw")
    base, key = _rounding(F.col("size"), F.col("draw"))
    extra = F.coalesce(key < F.col("limit"), F.lit(False)).cast("bigint")
    rate = F.when(F.col("size") == 0, 1.0).otherwise(
        _rate(F.col("tilt"), F.col("size") / F.greatest(F.col("mean"), F.lit(1e-9)))
    )
    mixed = joined.withColumns({"rate": rate, "copies": base + extra})
    mixed = mixed.withColumn("taken", F.col("copies") * F.col("size"))
    return mixed.select(*docs.columns, *RESULTS)


def draw_of(*columns: Column | str) -> Column:
    """A uniform hash of a row's identity."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def numbered_draws(rows: DataFrame) -> DataFrame:
    """Narrow ``rows`` with ``draw`` (``draw_of``), where each of several equal rows gets another draw.

    Equal rows are counted, combined per task before the shuffle, and written out again by number; a
    count of more than ``EQUAL_ROWS`` is dealt over tasks in portions.
    """
    columns = [c for c in rows.columns if c != "draw"]
    counted = cut(rows.groupBy(*rows.columns).agg(F.count("*").alias("_n")))
    few = counted.filter(F.col("_n") <= EQUAL_ROWS).select(*rows.columns, F.explode(F.sequence(F.lit(1), F.col("_n"))).alias("_i"))
    many = counted.filter(F.col("_n") > EQUAL_ROWS)
    portions = many.withColumn("_low", F.explode(F.sequence(F.lit(1), F.col("_n"), F.lit(EQUAL_ROWS)))).repartition("_low", "draw")
    last = F.least(F.col("_low") + EQUAL_ROWS - 1, F.col("_n"))
    many = portions.select(*rows.columns, F.explode(F.sequence(F.col("_low"), last)).alias("_i"))
    draw = F.when(F.col("_i") == 1, F.col("draw")).otherwise(draw_of("draw", "_i"))
    return few.unionByName(many).select(*columns, draw.alias("draw"))


def repeat_rows(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every document as often as it is taken."""
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("_one")
    return mixed.filter(F.col("copies") > 0).select(*columns, times).drop("_one")
