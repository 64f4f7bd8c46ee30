"""Lag and throughput of a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.ordering import sequence_key
from tideline.functions.records import payload_bytes
from tideline.operators import SHARD


def lag_by_shard(log: DataFrame, now: Column) -> DataFrame:
    """Milliseconds between ``now`` and the arrival of each shard's last record, never negative."""
    last = F.max_by("arrival_ts", sequence_key("sequence_number"))
    behind = F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.col("_at").cast("timestamp"))
    return (
        log.groupBy(*SHARD)
        .agg(last.alias("_at"))
        .select(*SHARD, F.greatest(behind, F.lit(0).cast("bigint")).alias("behind_ms"))
    )


def throughput_by_shard(log: DataFrame, window: str = "1 hour", payload: str = "data") -> DataFrame:
    """Records and payload bytes per shard and arrival window.

    On a stream with a watermark, run in append mode, each window comes once, when it is closed.
    """
    return (
        log.groupBy(*SHARD, F.window("arrival_ts", window).alias("_w"))
        .agg(F.count("*").alias("records"), F.sum(payload_bytes(payload)).alias("bytes"))
        .select(*SHARD, F.col("_w.start").alias("window_start"), "records", "bytes")
    )


def stream_throughput(
    stream: DataFrame, window: str = "1 hour", late: str = "1 hour", payload: str = "data"
) -> DataFrame:
    """The same on a stream: windows that the newest arrival has passed by ``late``, in append mode."""
    return throughput_by_shard(stream.withWatermark("arrival_ts", late), window, payload)
