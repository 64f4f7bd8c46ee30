"""Positioned reads of a change log, and paged listings of streams and shards.

``log`` rows carry stream, shard_id, sequence_number and arrival_ts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.ordering import is_number, sequence_key, sequence_order
from tideline.functions.shards import normalize_stream_status
from tideline.operators import SHARD
from tideline.operators.lineage import lineage_depth, reopen_leaf_shards
from tideline.scale import cut, first_per_group, join_bounded


def checked(progress: DataFrame, known: Column) -> DataFrame:
    """Progress whose query fails on a checkpoint that is not ``known``."""
    text = F.coalesce("checkpoint", F.lit("null"))
    timeless = F.when(F.col("checkpoint") == fixed.AT_TIMESTAMP, ": no timestamp").otherwise("")
    message = F.concat(F.lit("unreadable checkpoint "), text, F.lit(" of shard "), "shard_id", timeless)
    readable = F.when(F.coalesce(known, F.lit(False)), F.col("checkpoint")).otherwise(F.raise_error(message))
    return progress.withColumn("checkpoint", readable)


def apply_start_positions(
    log: DataFrame, progress: DataFrame, timestamp: Column | None = None, inclusive: bool = False
) -> DataFrame:
    """Records at or after each tracked shard's checkpoint; untracked shards yield none.

    TRIM_HORIZON reads everything retained, LATEST and SHARD_END nothing that exists already,
    AT_TIMESTAMP what arrived at or after ``timestamp``, a sequence number what follows it
    (``inclusive=True``: and the record itself). Any other checkpoint, also a null one, and
    AT_TIMESTAMP without ``timestamp``, make the query fail.
    """
    key, at = sequence_key("sequence_number"), F.col("_at")
    after = (key >= at) if inclusive else (key > at)
    checkpoint = F.col("checkpoint")
    arrived = F.lit(False) if timestamp is None else F.col("arrival_ts") >= timestamp
    wanted = F.col("_from_start") | F.coalesce(after, F.lit(False))
    if timestamp is not None:
        wanted = wanted | (F.col("_from_time") & arrived)
    known = checkpoint.isin(fixed.TRIM_HORIZON, fixed.LATEST, fixed.SHARD_END) | is_number(checkpoint)
    if timestamp is not None:
        known = known | (checkpoint == fixed.AT_TIMESTAMP)
    starts = checked(progress, known).filter(~checkpoint.isin(fixed.LATEST, fixed.SHARD_END)).select(
        *SHARD,
        (checkpoint == fixed.TRIM_HORIZON).alias("_from_start"),
        (checkpoint == fixed.AT_TIMESTAMP).alias("_from_time"),
        F.when(is_number(checkpoint), sequence_key(checkpoint)).alias("_at"),
    )
    joined = join_bounded(log, starts, SHARD)
    return joined.filter(wanted).select(*log.columns)


def read_from(
    log: DataFrame,
    position: str,
    sequence: str | None = None,
    timestamp: Column | None = None,
) -> DataFrame:
    """The same for one start position common to all shards; a plain filter on the scan.

    AT_SEQUENCE and AFTER_SEQUENCE take ``sequence``, AT_TIMESTAMP takes ``timestamp``.
    """
    key = sequence_key("sequence_number")
    if position == fixed.TRIM_HORIZON:
        return log
    if position == fixed.LATEST:
        return log.filter(F.lit(False))
    if position == fixed.AT_TIMESTAMP:
        return log.filter(F.col("arrival_ts") >= timestamp)
    if position == "AT_SEQUENCE":
        return log.filter(key >= sequence_key(F.lit(sequence)))
    if position == "AFTER_SEQUENCE":
        return log.filter(key > sequence_key(F.lit(sequence)))
    raise ValueError(f"unknown start position {position!r}")


def limit_per_shard(log: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` records of each shard, all of them for None.

    ``clamp_limit`` gives the limit of a single fetch, for those who want one.
    """
    if n is None:
        return log
    order = sequence_order("sequence_number")
    return first_per_group(log, SHARD, order, n).drop("_rank")


def replay_order(log: DataFrame, shards: DataFrame, position: str | None = None) -> DataFrame:
    """Records with parents' shards before children's and in sequence order within a shard.

    A total, range-partitioned sort: a hot shard is cut into several consecutive ranges. Shards
    that are no longer listed have a null depth and come first, as they are the oldest.
    ``position`` names a column for the record's place in its stream.
    """
    depth = lineage_depth(shards)
    joined = join_bounded(log, depth, SHARD, "left")
    first = F.col("depth").asc_nulls_first()
    ordered = joined.orderBy("stream", first, "shard_id", *sequence_order("sequence_number"))
    return ordered if position is None else numbered(ordered, ["stream"], position)


def numbered(ordered: DataFrame, group: list[str], name: str) -> DataFrame:
    """Sorted rows with their 0-based place in ``group``, counted over the partitions in order.

    The rows are stored once; what is summed has a row per partition and group.
    """
    placed = cut(ordered.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_id", 33)
    counts = placed.groupBy(*group, part.alias("_part")).agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    joined = join_bounded(placed.withColumn("_part", part), starts, [*group, "_part"], spread="_id")
    return joined.withColumn(name, F.col("_start") + F.col("_id") - F.col("_first")).select(*ordered.columns, name)


def oldest_retained(log: DataFrame) -> DataFrame:
    """Per shard, the key and text of the oldest record still retained."""
    key = sequence_key("sequence_number")
    return log.groupBy(*SHARD).agg(F.min_by("sequence_number", key).alias("oldest_retained"))


def trim_gaps(progress: DataFrame, log: DataFrame) -> DataFrame:
    """Progress rows whose position is older than anything their shard retains."""
    older = sequence_key("checkpoint") < sequence_key("oldest_retained")
    return (
        progress.filter(is_number("checkpoint"))
        .join(oldest_retained(log), SHARD)
        .filter(older)
        .select(*SHARD, "checkpoint", "oldest_retained")
    )


def apply_trim_policy(progress: DataFrame, log: DataFrame, policy: str = "skip") -> DataFrame:
    """Resolve positions that point into trimmed data.

    ``"skip"`` moves them to TRIM_HORIZON; ``"fail"`` makes the query fail. A row that is at
    TRIM_HORIZON already is never moved.
    """
    if policy not in ("skip", "fail"):
        raise ValueError("policy must be 'skip' or 'fail'")
    gap = trim_gaps(progress, log).select(*SHARD, "oldest_retained")
    message = F.concat(F.lit("unable to read more records: data of shard "), "shard_id", F.lit(" is trimmed"))
    moved = F.raise_error(message) if policy == "fail" else F.lit(fixed.TRIM_HORIZON)
    trimmed = F.col("oldest_retained").isNotNull()
    return (
        progress.join(gap, SHARD, "left")
        .withColumn("checkpoint", F.when(trimmed, moved).otherwise(F.col("checkpoint")))
        .select(*progress.columns)
    )


def retention_filter(log: DataFrame, now: Column, hours: int = fixed.RETENTION_HOURS) -> DataFrame:
    """Records still within the retention period; the bound reaches the scan as a filter."""
    return log.filter(F.col("arrival_ts") >= now - F.expr(f"INTERVAL {hours} HOURS"))


def page_after(df: DataFrame, key: str, after: str | None = None, limit: int | None = None) -> DataFrame:
    """Keyset page: rows beyond ``after`` in key order, with ``has_more`` telling of others.

    A bounded sort of ``limit`` rows, and a count that stops behind them.
    """
    beyond = df if after is None else df.filter(F.col(key) > after)
    if limit is None:
        return beyond.orderBy(key).withColumn("has_more", F.lit(False))
    more = beyond.limit(limit + 1).count() > limit
    return beyond.orderBy(key).limit(limit).withColumn("has_more", F.lit(more))


def list_streams(streams: DataFrame, after: str | None = None, limit: int | None = None) -> DataFrame:
    """A page of stream names."""
    return page_after(streams.select(F.col("arn").alias("stream_name")), "stream_name", after, limit)


def describe_stream(
    streams: DataFrame,
    shards: DataFrame,
    stream: str,
    after: str | None = None,
    limit: int | None = None,
    keep_ancestors: bool = True,
) -> DataFrame:
    """One stream's status and a page of its shards; the name is the stream's address.

    A disabled stream lists all its shards at once, the leaves reopened, so that it is read to
    the end; with ``keep_ancestors=False`` the leaves only.
    """
    described = streams.filter(F.col("arn") == stream)
    head = described.select(
        F.col("arn").alias("stream"),
        F.col("arn").alias("stream_name"),
        normalize_stream_status("status").alias("stream_status"),
    )
    disabled = described.filter(F.col("status") == fixed.DISABLED).select(F.col("arn").alias("stream"))
    own = shards.filter(F.col("stream") == stream)
    page = page_after(own, "shard_id", after, limit).join(disabled, "stream", "left_anti")
    leaves = reopen_leaf_shards(own, keep_ancestors).join(disabled, "stream", "left_semi")
    listed = page.unionByName(leaves.withColumn("has_more", F.lit(False)))
    return head.join(listed, "stream").drop("stream").orderBy("shard_id")


def summarize_streams(streams: DataFrame, shards: DataFrame) -> DataFrame:
    """One summary row per stream.

    ``open_shard_count`` counts all shards, as the summary always has; ``open_shards`` counts
    those that really are open.
    """
    counts = shards.groupBy(F.col("stream").alias("arn")).agg(
        F.count("*").alias("_all"),
        F.count_if(F.col("ending_sequence_number").isNull()).alias("_open"),
    )
    zero = F.lit(0).cast("bigint")
    return streams.join(counts, "arn", "left").select(
        F.col("arn").alias("stream_name"),
        F.col("arn").alias("stream_arn"),
        normalize_stream_status("status").alias("stream_status"),
        "creation_ts",
        F.lit(fixed.STREAM_MODE).alias("stream_mode"),
        F.lit(fixed.ENCRYPTION_TYPE).alias("encryption_type"),
        F.lit(fixed.RETENTION_HOURS).alias("retention_hours"),
        F.coalesce("_all", zero).alias("open_shard_count"),
        F.coalesce("_open", zero).alias("open_shards"),
        F.lit(fixed.CONSUMER_COUNT).alias("consumer_count"),
    )
