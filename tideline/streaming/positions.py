"""Start positions and limits of a live stream."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.ordering import is_number, sequence_key
from tideline.operators import SHARD
from tideline.operators.lineage import reopen_leaf_shards
from tideline.operators.reads import apply_trim_policy, checked, trim_gaps
from tideline.scale import join_bounded


def latest_positions(log: DataFrame) -> DataFrame:
    """Per shard, the newest record there is: the start of a read of only what follows.

    Store it before the query starts, so that a restart uses the same start.
    """
    newest = F.max_by("sequence_number", sequence_key("sequence_number"))
    return log.groupBy(*SHARD).agg(newest.alias("checkpoint"))


class StartPlan(NamedTuple):
    """Start positions a stream can use, and the positions that were trimmed."""

    starts: DataFrame
    gaps: DataFrame


def resolve_starts(progress: DataFrame, log: DataFrame, trim_policy: str = "skip") -> StartPlan:
    """Progress rows as start positions, fixed against what the stored log holds now.

    LATEST becomes the shard's newest record, or TRIM_HORIZON where it has none. Numbers older
    than the retained data become TRIM_HORIZON, or with ``trim_policy="fail"`` make the query fail;
    ``gaps`` names them. Store the result before the query starts, so that a restart uses it too.
    """
    gaps = trim_gaps(progress, log)
    newest = latest_positions(log).withColumnRenamed("checkpoint", "_newest")
    latest = F.coalesce("_newest", F.lit(fixed.TRIM_HORIZON))
    checkpoint = F.when(F.col("checkpoint") == fixed.LATEST, latest).otherwise(F.col("checkpoint"))
    moved = apply_trim_policy(progress, log, trim_policy).join(newest, SHARD, "left")
    return StartPlan(moved.withColumn("checkpoint", checkpoint).select(*progress.columns), gaps)


def start_stream_at(
    stream: DataFrame, starts: DataFrame, timestamp: Column | None = None
) -> DataFrame:
    """Records of a stream beyond stored start positions.

    ``starts`` holds stream, shard_id and checkpoint: a sequence number, TRIM_HORIZON, SHARD_END for
    shards that are finished, or AT_TIMESTAMP for what arrives at or after ``timestamp``. Shards
    that are not in it are new and read whole. LATEST must have been resolved (``resolve_starts``);
    it and any other checkpoint make the query fail.
    """
    checkpoint = F.col("checkpoint")
    known = checkpoint.isin(fixed.TRIM_HORIZON, fixed.SHARD_END) | is_number(checkpoint)
    if timestamp is not None:
        known = known | (checkpoint == fixed.AT_TIMESTAMP)
    bounds = checked(starts, known).select(
        *SHARD,
        F.when(is_number(checkpoint), sequence_key(checkpoint)).alias("_after"),
        (checkpoint == fixed.SHARD_END).alias("_ended"),
        (checkpoint == fixed.AT_TIMESTAMP).alias("_timed"),
    )
    joined = join_bounded(stream, bounds, SHARD, "left")
    ended = F.coalesce("_ended", F.lit(False))
    after = F.col("_after").isNull() | (sequence_key("sequence_number") > F.col("_after"))
    if timestamp is not None:
        after = after & (~F.coalesce("_timed", F.lit(False)) | (F.col("arrival_ts") >= timestamp))
    return joined.filter(~ended & after).select(*stream.columns)


def drain_disabled_stream(
    stream: DataFrame, shards: DataFrame, keep_ancestors: bool = True
) -> DataFrame:
    """The records of a disabled stream that are still to be read: those of its listed shards.

    ``keep_ancestors=False`` reads the reopened leaves only. Run the result with
    ``trigger(availableNow=True)``: it ends when all of them are read.
    """
    readable = reopen_leaf_shards(shards, keep_ancestors).select(*SHARD)
    return join_bounded(stream, readable, SHARD, "left_semi")
