"""Replaying the change log into a table, and comparing tables."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from tideline.functions.ordering import sequence_key
from tideline.functions.records import operation_kind
from tideline.operators import SHARD
from tideline.scale import cut, fits_broadcast

SHARD_GROUPS = 1024  # of a stream's state of covered ranges


def latest_changes(
    log: DataFrame, keys: Sequence[str], values: Sequence[str], order_by: Column | None = None
) -> DataFrame:
    """The last change of each key: keys, event_name, sequence_number, values.

    One aggregate with map-side combine: a hot key crosses the shuffle once per task. It works on
    rows sorted by key, as its buffers hold structs, and spills where a task's rows do not fit. Order
    and duplicates of the input do not matter. ``order_by`` replaces the sequence key, for logs
    that also hold their position as a number.
    """
    order = sequence_key("sequence_number") if order_by is None else order_by
    carried = [c for c in ("event_name", "sequence_number", *values) if c not in keys]
    return (
        log.groupBy(*keys)
        .agg(F.max_by(F.struct(*carried), order).alias("_last"))
        .select(*keys, "_last.*")
    )


def materialize_table(
    log: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    until: str | None = None,
    base: DataFrame | None = None,
    order_by: Column | None = None,
) -> DataFrame:
    """The table the log describes, up to and including sequence number ``until``.

    ``base`` is an earlier state of the table, unique on ``keys``: rows of keys the log touches
    are replaced, the others are kept without being aggregated again. The log's changes are then
    computed once and stored, and as long as their keys are few, ``base`` is not shuffled.
    """
    if until is not None:
        bound = sequence_key(F.lit(until))
        log = log.filter(sequence_key("sequence_number") <= bound)
    last = latest_changes(log, keys, values, order_by)
    if base is not None:
        last = cut(last)
    columns = list(dict.fromkeys([*keys, *values]))
    table = last.filter(operation_kind("event_name") == "upsert").select(*columns)
    if base is None:
        return table
    touched = last.select(*keys)
    if fits_broadcast(touched):
        touched = F.broadcast(touched)
    return base.select(*columns).join(touched, list(keys), "left_anti").unionByName(table)


def dedupe_replayed(
    log: DataFrame,
    keys: Sequence[str] = (*SHARD, "sequence_number"),
    within: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """One copy of each record, in batch or on a stream; no first copy is ever lost by default.

    On a stream the state keeps every key, unless ``run`` names a column that tells which consecutive
    stretch of its shard a record was delivered in, as a file of a stored log (``stream_change_log(...,
    run=...)``). Then the state is each shard's covered ranges of sequence numbers: it follows shards and
    out-of-order runs, not records, and a record is a copy if its number lies in a range. ``within``
    forgets keys that much older than the newest arrival, but drops late first copies with them: only
    for streams in order of arrival.
    """
    if not log.isStreaming:
        return log.dropDuplicates(list(keys))
    if run is not None:
        return _uncovered(log, run)
    if within is None:
        return log.dropDuplicates(list(keys))
    timed = log.withColumn("_arrival", F.col("arrival_ts").cast("timestamp")).withWatermark("_arrival", within)
    return timed.dropDuplicatesWithinWatermark(list(keys)).drop("_arrival")


def _uncovered(log: DataFrame, run: str) -> DataFrame:
    """Records outside their shard's covered ranges; each run then covers what lies between its ends.

    Shards are dealt by hash into ``SHARD_GROUPS`` groups whose state holds their ranges one by one, as a
    call per shard and micro-batch costs more than its records.
    """
    columns = [c for c in log.columns if c != run]
    place = [log.columns.index(c) for c in (*SHARD, run, "sequence_number")]

    def fresh(_key, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        covered: dict[tuple, tuple[list[int], list[int]]] = {}
        for *shard, low, high in zip(*state.get) if state.exists else ():
            lows, highs = covered.setdefault(tuple(shard), ([], []))
            lows.append(int(low))
            highs.append(int(high))
        ends: dict[tuple, dict[str, tuple[int, int]]] = {}
        given: set[tuple] = set()  # of this micro-batch and group
        for chunk in chunks:
            keep = []
            for stream, shard_id, name, text in zip(*(chunk.iloc[:, i] for i in place)):
                shard, number = (stream, shard_id), int(text)
                runs = ends.setdefault(shard, {})
                low, high = runs.get(name, (number, number))
                runs[name] = (min(low, number), max(high, number))
                lows, highs = covered.get(shard, ((), ()))
                i = bisect_right(lows, number) - 1
                new = (shard, number) not in given and not (i >= 0 and number <= highs[i])
                keep.append(new)
                if new:
                    given.add((shard, number))
            yield chunk.loc[keep, columns]
        for shard, runs in ends.items():
            covered[shard] = merged_ranges([*zip(*covered.get(shard, ((), ()))), *runs.values()])
        rows = [(*shard, str(low), str(high)) for shard, sides in covered.items() for low, high in zip(*sides)]
        state.update(tuple(list(side) for side in zip(*rows)))

    schema = log.select(*columns).schema
    ranges = "streams array<string>, shards array<string>, lows array<string>, highs array<string>"
    group = "_".join(["_group", *log.columns])  # none of the columns
    dealt = log.withColumn(group, F.pmod(F.xxhash64(*SHARD), F.lit(SHARD_GROUPS)))
    return dealt.groupBy(group).applyInPandasWithState(fresh, schema, ranges, "append", GroupStateTimeout.NoTimeout)


def merged_ranges(ranges: list[tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Lower and upper ends of the union of closed ranges of whole numbers, in order."""
    lows: list[int] = []
    highs: list[int] = []
    for low, high in sorted(ranges):
        if highs and low <= highs[-1] + 1:
            highs[-1] = max(highs[-1], high)
        else:
            lows.append(low)
            highs.append(high)
    return lows, highs


def compare_tables(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs: columns, ``side`` and ``copies``; empty if equal.

    Both sides are counted in one aggregate, so equal rows meet before they cross the shuffle.
    """
    columns = left.columns
    signed = left.withColumn("_n", F.lit(1)).unionByName(right.select(*columns).withColumn("_n", F.lit(-1)))
    difference = signed.groupBy(*columns).agg(F.sum("_n").alias("_n")).filter(F.col("_n") != 0)
    side = F.when(F.col("_n") > 0, "left").otherwise("right")
    return difference.select(*columns, side.alias("side"), F.abs("_n").alias("copies"))
