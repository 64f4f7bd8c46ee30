"""Small tables that a live stream keeps per shard: checkpoints and lag.

Each micro-batch makes the next version of the table from the last one and its own rows, and commits it
with the number of the batch. A batch that is repeated after a restart finds itself committed and is not
counted again. The tables have a row per shard, whatever the number of records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tideline import fixed
from tideline.functions.ordering import sequence_key, sequence_order
from tideline.operators import SHARD
from tideline.scale import first_per_group
from tideline.sources.commits import CommitConflict, publish, read_commit, versions

_COUNTS = "stream string, shard_id string, records bigint, last string, checkpoint string"


def state_sink(
    stream: DataFrame, path: str, checkpoint_dir: str, step: Callable[[DataFrame | None, DataFrame], DataFrame]
) -> DataStreamWriter:
    """Writer that commits ``step`` of the last table (None: there is none yet) and each micro-batch."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        known = versions(spark, path)
        base = read_commit(spark, path, known[-1]) if known else None
        if base is not None and base["query"] == query and base["batch"] >= batch_id:
            return
        folder = f"data/query={query}/batch={batch_id}"
        last = None if base is None else spark.read.parquet(f"{path}/{base['data']}")
        step(last, batch).write.mode("overwrite").parquet(f"{path}/{folder}")
        if not publish(spark, path, known[-1] + 1 if known else 0, {"data": folder, "query": query, "batch": batch_id}):
            raise CommitConflict(f"another query keeps its state in {path}")

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint_dir)


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """The table as committed last."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no state in {path}")
    return spark.read.parquet(f"{path}/{read_commit(spark, path, known[-1])['data']}")


def checkpoint_sink(
    stream: DataFrame, path: str, checkpoint_dir: str, every: int = fixed.CHECKPOINT_EVERY
) -> DataStreamWriter:
    """Writer that keeps each shard's last record at which a checkpoint every ``every`` records falls.

    The records of a shard are expected in order, in batches of any size. The table holds a shard's
    number of records, its last one and its checkpoint, which is null before the first.
    """
    return state_sink(stream, path, checkpoint_dir, lambda counts, batch: count_checkpoints(counts, batch, every))


def count_checkpoints(counts: DataFrame | None, batch: DataFrame, every: int) -> DataFrame:
    """(stream, shard_id, records, last, checkpoint) after a batch that follows ``counts``.

    The checkpoint is followed by (records mod every) others: it is in the batch if that holds more
    than these, and then among its last ``every`` records; else it stays.
    """
    counts = batch.sparkSession.createDataFrame([], _COUNTS) if counts is None else counts
    rows = batch.select(*SHARD, "sequence_number")
    last = F.max_by("sequence_number", sequence_key("sequence_number"))
    new = rows.groupBy(*SHARD).agg(F.count("*").alias("_new"), last.alias("_last"))
    newest = [c.desc() for c in sequence_order("sequence_number")]
    tail = first_per_group(rows, SHARD, newest, every).groupBy(*SHARD).agg(
        F.map_from_entries(F.collect_list(F.struct("_rank", "sequence_number"))).alias("_tail")  # ``every`` at most
    )
    total = F.coalesce("records", F.lit(0)) + F.coalesce("_new", F.lit(0))
    found = F.try_element_at("_tail", (total % every + 1).cast("int"))
    return counts.join(new, SHARD, "full").join(tail, SHARD, "left").select(
        *SHARD, total.alias("records"), F.coalesce("_last", "last").alias("last"),
        F.coalesce(found, "checkpoint").alias("checkpoint"),
    )


def lag_sink(stream: DataFrame, path: str, checkpoint_dir: str, now: Column) -> DataStreamWriter:
    """Writer that keeps each shard's lag: from its newest record so far to ``now``, as of the last batch."""
    return state_sink(stream, path, checkpoint_dir, lambda seen, batch: newest_lag(seen, batch, now))


def newest_lag(seen: DataFrame | None, batch: DataFrame, now: Column) -> DataFrame:
    """(stream, shard_id, last, last_arrival, behind_ms) after a batch, of all shards ever seen."""
    rows = batch.select(*SHARD, F.col("sequence_number").alias("last"), F.col("arrival_ts").alias("last_arrival"))
    rows = rows if seen is None else rows.unionByName(seen.drop("behind_ms"))
    newest = F.max_by(F.struct("last", "last_arrival"), sequence_key("last")).alias("_newest")
    behind = F.unix_millis(now.cast("timestamp")) - F.unix_millis(F.col("last_arrival").cast("timestamp"))
    return rows.groupBy(*SHARD).agg(newest).select(*SHARD, "_newest.*").withColumn(
        "behind_ms", F.greatest(behind, F.lit(0).cast("bigint"))
    )
