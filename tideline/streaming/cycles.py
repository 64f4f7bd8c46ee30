"""Reading a stored log in cycles driven by progress.

A cycle takes at most n records of each shard that is ready, hands them to a callback, and commits how far
every shard has come. A shard is ready when none of its parents is unfinished, so parents are always
read before their children. A closed shard with fewer than n records left is at its end: that needs no
record at its ending number, so shards that are empty, that were closed after their last record, or whose
end is made up, end as well.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.ordering import sequence_key
from tideline.functions.shards import is_closed
from tideline.operators import SHARD
from tideline.operators.lineage import lineage_edges
from tideline.operators.progress import PROGRESS_COLUMNS, plan_new_progress, processable_shards, tracked_progress
from tideline.scale import cut, step
from tideline.sources.tables import read_change_log, read_progress, update_progress
from tideline.streaming.process import BatchCallback, in_order

_PROGRESS = "stream string, shard_id string, parent_shard_ids array<string>, checkpoint string, owner_switches bigint"


class Cycles(NamedTuple):
    """What a run of cycles did: how many had records or ended shards, and the last progress version."""

    count: int
    version: int


def track_shards(spark: SparkSession, path: str, shards: DataFrame, position: str) -> tuple[int, DataFrame]:
    """Commit rows for the shards that must be read and are not tracked yet; the version and its rows."""
    def update(rows: DataFrame | None) -> DataFrame:
        rows = spark.createDataFrame([], _PROGRESS) if rows is None else rows
        return tracked_progress(rows, plan_new_progress(shards, rows, position))

    version = update_progress(spark, path, update)
    return version, read_progress(spark, path, version)


def advanced(progress: DataFrame, moved: DataFrame) -> DataFrame:
    """Progress rows with the checkpoints of ``moved`` (stream, shard_id, checkpoint), other rows as they are."""
    new = moved.select(*SHARD, F.col("checkpoint").alias("_moved"))
    checkpoint = F.coalesce("_moved", "checkpoint")
    return progress.join(new, SHARD, "left").withColumn("checkpoint", checkpoint).select(*PROGRESS_COLUMNS)


def read_in_cycles(
    spark: SparkSession,
    log_path: str,
    shards: DataFrame,
    progress_path: str,
    on_records: BatchCallback,
    n: int = fixed.MAX_RECORDS_PER_READ,
    position: str = fixed.TRIM_HORIZON,
    timestamp: Column | None = None,
    on_shard_end: BatchCallback | None = None,
    on_start: Callable[[], None] | None = None,
    on_stop: Callable[[], None] | None = None,
    max_cycles: int | None = None,
) -> Cycles:
    """Read on from committed progress until nothing is left, or for ``max_cycles``.

    ``on_records`` gets each cycle's records in shard and sequence order, ``on_shard_end`` the shards
    that ended in it; only then is the cycle committed, rebased on what other writers committed since.
    Delivery is at least once: a run that dies before a commit repeats that cycle's records. A new run
    goes on from the commit. New shards of ``shards`` are tracked from ``position`` as it begins.
    """
    if on_start is not None:
        on_start()
    version, progress = track_shards(spark, progress_path, shards, position)
    edges, _ = step(lineage_edges(shards))
    closed = cut(shards.filter(is_closed()).select(*SHARD))
    done = 0
    try:
        while max_cycles is None or done < max_cycles:
            ready = cut(processable_shards(shards, progress, edges))
            records = cut(read_change_log(spark, log_path, ready, timestamp=timestamp, limit=n))
            key = sequence_key("sequence_number")
            reached = records.groupBy(*SHARD).agg(F.max_by("sequence_number", key).alias("last"), F.count("*").alias("read"))
            short = F.coalesce("read", F.lit(0)) < n
            state = ready.join(reached, SHARD, "left").join(closed.withColumn("_closed", F.lit(True)), SHARD, "left")
            ended = F.coalesce("_closed", F.lit(False)) & short
            moved = cut(
                state.select(*SHARD, F.when(ended, fixed.SHARD_END).otherwise(F.col("last")).alias("checkpoint"), ended.alias("ended"))
                .filter(F.col("checkpoint").isNotNull())
            )
            if moved.isEmpty():
                break
            on_records(in_order(records), done)
            if on_shard_end is not None:
                on_shard_end(moved.filter("ended").select(*SHARD), done)
            version = update_progress(spark, progress_path, lambda rows, moved=moved: advanced(rows, moved))
            progress, done = read_progress(spark, progress_path, version), done + 1
    finally:
        if on_stop is not None:
            on_stop()
    return Cycles(done, version)
