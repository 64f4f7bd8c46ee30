"""Keeping a replica of the source table from its change stream.

Each micro-batch is first reduced to one row per key and written as a delta; its cost follows
the batch, not the table. Readers merge the base with the deltas since; ``compact_replica`` folds
these into a new base. Deltas are named by query and batch, so a repeated batch replaces its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tideline.functions.ordering import sequence_key
from tideline.functions.records import operation_kind
from tideline.operators.replay import latest_changes
from tideline.scale import cut, fits_broadcast
from tideline.sources.commits import commit_next, read_commit, versions
from tideline.sources.tables import committed_folders

BUCKETS = 64


def replicate_sink(
    stream: DataFrame, target: str, keys: Sequence[str], values: Sequence[str], checkpoint_dir: str
) -> DataStreamWriter:
    """Writer that applies each micro-batch to the replica at ``target``; start it to run."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        delta = latest_changes(batch, keys, values)
        delta.write.mode("overwrite").parquet(f"{target}/delta/query={query}/batch={batch_id}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_dir)


def _deltas(spark: SparkSession, target: str) -> list[tuple[str, int, str]]:
    """(query, batch, folder) of every finished delta."""
    found = []
    for folder in committed_folders(spark, f"{target}/delta/query=*/batch=*"):
        query, batch = folder.rsplit("/", 2)[1:]
        found.append((query.split("=", 1)[1], int(batch.split("=", 1)[1]), folder))
    return found


def _newest(spark: SparkSession, target: str) -> dict:
    known = versions(spark, target)
    return read_commit(spark, target, known[-1]) if known else {"buckets": {}, "count": None, "folded": {}}


def _changes(spark: SparkSession, target: str, keys: Sequence[str], values: Sequence[str], base: dict) -> tuple[DataFrame | None, dict[str, int]]:
    """Last change of each key in the deltas a base has not folded in yet, and the last batch of each query."""
    folded = dict(base["folded"])
    deltas = [d for d in _deltas(spark, target) if d[1] > folded.get(d[0], -1)]
    if not deltas and not base["buckets"]:
        raise FileNotFoundError(f"no replica at {target}")
    for query, batch, _ in deltas:
        folded[query] = max(batch, folded.get(query, -1))
    if not deltas:
        return None, folded
    stored = spark.read.parquet(*[folder for _, _, folder in deltas]).select(*keys, "event_name", "sequence_number", *values)
    return latest_changes(stored, keys, values), folded


def _base_rows(spark: SparkSession, target: str, keys: Sequence[str], values: Sequence[str], folders: Iterable[str]) -> DataFrame:
    rows = spark.read.parquet(*[f"{target}/{folder}" for folder in sorted(set(folders))])
    return rows.select(*keys, "event_name", "sequence_number", *values)


def read_replica(
    spark: SparkSession, target: str, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """The replica's current rows.

    The deltas are reduced first; only base rows of their keys are merged with them, and while these
    are few the base is not shuffled.
    """
    base = _newest(spark, target)
    changes, _ = _changes(spark, target, keys, values, base)
    if not base["buckets"]:
        merged = changes
    else:
        merged = _base_rows(spark, target, keys, values, base["buckets"].values())
        if changes is not None:
            changes = cut(changes)
            touched = changes.select(*keys)
            if fits_broadcast(touched):
                touched = F.broadcast(touched)
            again = latest_changes(merged.join(touched, list(keys), "left_semi").unionByName(changes), keys, values)
            merged = merged.join(touched, list(keys), "left_anti").unionByName(again)
    return merged.filter(operation_kind("event_name") == "upsert").select(*keys, *values)


def compact_replica(
    spark: SparkSession, target: str, keys: Sequence[str], values: Sequence[str], buckets: int = BUCKETS
) -> int:
    """Fold the deltas so far into the base, after which they are not read again; the base's version.

    The base is kept in buckets of keys, each with its own folder, and only the buckets whose keys have
    changed are written anew: what is written follows the changes. The number of buckets is set by the
    first compaction; large buckets are spread over several files. Tombstones stay in the base, so that a
    late copy of an older change cannot bring a deleted row back. The new state is committed in one
    step; of two compactions at once, the later one folds again.
    """
    def build(_version: int | None, newest: dict | None) -> dict:
        base = newest or {"buckets": {}, "count": None, "folded": {}}
        count = base["count"] or buckets
        changes, folded = _changes(spark, target, keys, values, base)
        if changes is None:
            return base
        bucket = F.pmod(F.xxhash64(*keys), F.lit(count)).cast("int").alias("bucket")
        changes = cut(changes.select("*", bucket))
        touched = [str(r["bucket"]) for r in changes.select("bucket").distinct().collect()]  # ``count`` at most
        old = [base["buckets"][b] for b in touched if b in base["buckets"]]
        rows = changes.drop("bucket")
        if old:
            rows = latest_changes(rows.unionByName(_base_rows(spark, target, keys, values, old)), keys, values)
        folder = f"base/{uuid.uuid4().hex}"
        placed = rows.select("*", bucket).repartitionByRange("bucket", *keys)
        placed.write.partitionBy("bucket").parquet(f"{target}/{folder}")
        return {"buckets": base["buckets"] | {b: f"{folder}/bucket={b}" for b in touched}, "count": count, "folded": folded}

    return commit_next(spark, target, build)


def vacuum_replica(spark: SparkSession, target: str) -> int:
    """Remove the deltas that the newest base has folded in, and buckets of older bases; how many folders.

    Call it when no reader still uses an older base and no compaction runs.
    """
    newest = _newest(spark, target)
    if not newest["buckets"]:
        return 0
    old = [folder for query, batch, folder in _deltas(spark, target) if batch <= newest["folded"].get(query, -1)]
    used = set(newest["buckets"].values())
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/base/*/bucket=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []
    for folder in (s.getPath().toString() for s in found):
        if "/".join(["base", *folder.rsplit("/", 2)[1:]]) not in used:
            old.append(folder)
    for folder in old:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(old)


def stateful_latest(
    stream: DataFrame, keys: Sequence[str], values: Sequence[str], forget: str | None = None
) -> DataFrame:
    """Running last change of each key, kept in the state store; run in update mode.

    A built-in streaming aggregate: each task combines its rows per key before they are
    shuffled, and a record that arrives late never replaces a newer one. Its state keeps every key.
    With ``forget``, a key and its tombstone are forgotten once all arrivals are that much newer than the
    key's last change: no older record can come then that would have to be told from a newer one. So
    with ``forget`` at least the stream's retention the emitted image stays right.
    """
    if forget is None:
        return latest_changes(stream, keys, values)
    carried = [c for c in ("event_name", "sequence_number", *values) if c not in keys]
    timed = stream.withColumn("_arrival", F.col("arrival_ts").cast("timestamp")).withWatermark("_arrival", forget)
    rows = timed.select(*keys, *carried, "_arrival")
    number = rows.columns.index("sequence_number")

    def newest(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        seen, arrived = (int(state.get[0]), state.get[1]) if state.exists else (-1, 0)
        best = None
        for chunk in chunks:
            order = chunk.iloc[:, number].map(int)
            arrived = max(arrived, int(chunk["_arrival"].max().timestamp() * 1000))
            at = order.idxmax()
            if order[at] > seen:
                seen, best = order[at], chunk.loc[[at], [*keys, *carried]]
        state.update((str(seen), arrived))
        # the watermark is ``forget`` behind the newest arrival, so it passes the key's arrival that much later
        state.setTimeoutTimestamp(max(arrived, state.getCurrentWatermarkMs()) + 1)
        if best is not None:
            yield best

    schema = rows.drop("_arrival").schema
    return rows.groupBy(*keys).applyInPandasWithState(
        newest, schema, "sequence string, arrived bigint", "update", GroupStateTimeout.EventTimeTimeout
    )


def newest_updates(updates: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Table image from the rows an update-mode query has emitted so far."""
    last = updates.groupBy(*keys).agg(
        F.max_by(F.struct("event_name", *values), sequence_key("sequence_number")).alias("_last")
    )
    image = last.select(*keys, "_last.*")
    return image.filter(operation_kind("event_name") == "upsert").select(*keys, *values)
