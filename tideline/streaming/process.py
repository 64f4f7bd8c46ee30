"""User callbacks over a change stream, and plain stream sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tideline.functions.ordering import sequence_key, sequence_order
from tideline.functions.records import to_delivered_record
from tideline.functions.shards import is_closed
from tideline.operators import SHARD

BatchCallback = Callable[[DataFrame, int], None]


def in_order(batch: DataFrame) -> DataFrame:
    """Records sorted by shard and sequence: each partition holds one run of consecutive records.

    Ranges are cut by record count, so a hot shard spans several partitions, in order.
    """
    return batch.orderBy("stream", "shard_id", *sequence_order("sequence_number"))


def process_stream(
    stream: DataFrame,
    on_records: BatchCallback,
    checkpoint_dir: str,
    shards: DataFrame | None = None,
    on_shard_end: BatchCallback | None = None,
    on_start: Callable[[], None] | None = None,
) -> DataStreamWriter:
    """Writer that calls back with ordered micro-batches; start it to run.

    ``on_start`` runs before the first batch of each (re)start. ``on_shard_end`` gets the closed
    shards whose last record the batch holds, and needs the ``shards`` catalog. For the end of
    the query, use ``run_to_end``. Delivery is at least once: a repeated batch has the same id.
    """
    started = False

    def handle(batch: DataFrame, batch_id: int) -> None:
        nonlocal started
        if not started and on_start is not None:
            on_start()
        started = True
        on_records(in_order(batch), batch_id)
        if on_shard_end is not None and shards is not None:
            last = batch.groupBy(*SHARD).agg(F.max(sequence_key("sequence_number")).alias("_last"))
            ends = shards.filter(is_closed()).select(
                *SHARD, sequence_key("ending_sequence_number").alias("_end")
            )
            ended = ends.join(last, SHARD).filter(F.col("_last") >= F.col("_end"))
            on_shard_end(ended.select(*SHARD), batch_id)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)


def run_to_end(
    writer: DataStreamWriter, on_stop: Callable[[StreamingQuery], None] | None = None
) -> StreamingQuery:
    """Run a writer over all that is available, then stop; errors are raised here."""
    query = writer.trigger(availableNow=True).start()
    try:
        query.awaitTermination()
    finally:
        if on_stop is not None:
            on_stop(query)
    return query


def delivered_record_sink(
    records: DataFrame, path: str, checkpoint_dir: str, generate_bytes: bool = True
) -> DataStreamWriter:
    """Writer that stores a stream of envelope columns as delivered records."""
    delivered = to_delivered_record(records, generate_bytes, keep=SHARD)
    return (
        delivered.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint_dir)
    )


def update_sink(updates: DataFrame, path: str, checkpoint_dir: str) -> DataStreamWriter:
    """Writer that stores each micro-batch of an update-mode query under its batch number."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        updates.writeStream.outputMode("update")
        .foreachBatch(store)
        .option("checkpointLocation", checkpoint_dir)
    )
