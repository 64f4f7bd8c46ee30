"""Stored change logs, progress snapshots and tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline import fixed
from tideline.functions.ordering import is_number, sequence_key, sequence_order
from tideline.operators import SHARD
from tideline.sources.commits import CommitConflict, commit_next, publish, read_commit, versions
from tideline.operators.reads import (
    apply_start_positions,
    apply_trim_policy,
    limit_per_shard,
    read_from,
)


DAY = "arrival_date"
DIGITS, NUMBER = "_sequence_digits", "_sequence_text"  # the sequence number's order, as plain columns
TARGET_FILE_BYTES = 256 * 1024 * 1024
MAX_FILE_RECORDS = 5_000_000
UNKNOWN_BYTES = 1 << 60  # what the optimizer says of inputs it knows nothing of


def _ranges(log: DataFrame) -> int:
    """Ranges of about ``TARGET_FILE_BYTES`` of what the log is read from; at least the session's."""
    least = int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = log._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return max(least, size // TARGET_FILE_BYTES if size < UNKNOWN_BYTES else 0)


def write_change_log(
    log: DataFrame, path: str, mode: str = "append", partitions: int | None = None
) -> None:
    """Store a log in a folder per arrival day, as files of consecutive records.

    Rows are range-partitioned by day, stream, shard and sequence. The number of files follows
    the data, not the number of shards: small shards share a file, a hot shard fills several,
    and each file's statistics bound the shards and sequence numbers in it. Days serve retention
    and reads by time. ``partitions`` sets the number of ranges; by default it follows the
    estimated size of the input.
    """
    digits, text = sequence_order("sequence_number")
    dated = log.withColumns({DAY: F.to_date("arrival_ts"), DIGITS: digits, NUMBER: text})
    order = [DAY, *SHARD, DIGITS, NUMBER]
    ordered = dated.repartitionByRange(partitions or _ranges(log), *order).sortWithinPartitions(*order)
    ordered.write.mode(mode).option("maxRecordsPerFile", MAX_FILE_RECORDS).partitionBy(DAY).parquet(path)


def scan_change_log(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """A stored log; with ``since``, only the days from then on are listed and read."""
    return _plain(_stored(spark, path, since))


def _stored(spark: SparkSession, path: str, since: Column | None = None, files: list[str] | None = None) -> DataFrame:
    log = spark.read.parquet(path)
    if files is not None:
        log = spark.read.option("basePath", path).parquet(*files) if files else log.filter(F.lit(False))
    if since is not None:
        log = log.filter((F.col(DAY) >= since.cast("date")) & (F.col("arrival_ts") >= since))
    return log


def _plain(log: DataFrame) -> DataFrame:
    return log.drop(DAY, DIGITS, NUMBER)


def _beyond(sequence: str, inclusive: bool = False) -> Column:
    """Condition on the stored order of sequence numbers that statistics of files can answer."""
    text = sequence.lstrip("0")
    later = F.col(NUMBER) >= text if inclusive else F.col(NUMBER) > text
    return (F.col(DIGITS) > len(text)) | ((F.col(DIGITS) == len(text)) & later)


MANIFEST = "_manifest"  # a folder that readers of the log do not see


def index_change_log(spark: SparkSession, path: str) -> None:
    """Add the files a stored log has gained to its manifest: which shards' numbers each holds.

    A row per file and shard: reads by progress then open only files that hold what a shard still has to
    read, however far apart the shards are. Files not listed yet are always read. One indexer at a time.
    """
    log = spark.read.parquet(path)
    known = _names(_manifest(spark, path)) if _has_manifest(spark, path) else set()
    new = [f for f in log.inputFiles() if _name(f) not in known]
    if not new:
        return
    order = F.struct(F.col(DIGITS).alias("digits"), F.col(NUMBER).alias("text"))
    rows = spark.read.option("basePath", path).parquet(*new).groupBy(F.col("_metadata.file_path").alias("file"), *SHARD)
    folder = f"{path}/{MANIFEST}/{uuid.uuid4().hex}"
    rows.agg(F.min(order).alias("low"), F.max(order).alias("high")).coalesce(1 + len(new) // 1000).write.parquet(folder)


def _has_manifest(spark: SparkSession, path: str) -> bool:
    return bool(committed_folders(spark, f"{path}/{MANIFEST}/*"))


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(*committed_folders(spark, f"{path}/{MANIFEST}/*"))


def files_to_read(spark: SparkSession, path: str, progress: DataFrame) -> list[str] | None:
    """Files of a stored log that may hold records beyond ``progress``; None without a manifest.

    The names of files pass through the driver, as in every listing.
    """
    if not _has_manifest(spark, path):
        return None
    manifest = _manifest(spark, path)
    checkpoint = F.col("checkpoint")
    digits, text = sequence_order("checkpoint")
    # the record at the checkpoint itself is kept, as in the scan's bounds
    still = ~is_number(checkpoint) | (F.col("high") >= F.struct(digits.alias("digits"), text.alias("text")))
    rows = progress.filter(~checkpoint.isin(fixed.LATEST, fixed.SHARD_END)).select(*SHARD, "checkpoint")
    wanted, known = _names(manifest.join(rows, SHARD).filter(still)), _names(manifest)
    return [f for f in spark.read.parquet(path).inputFiles() if _name(f) in wanted or _name(f) not in known]


def _name(file: str) -> str:
    """A file's path without its scheme, which is spelt in several ways."""
    return unquote(urlparse(file).path)


def _names(manifest: DataFrame) -> set[str]:
    return {_name(f) for f, in manifest.select("file").distinct().collect()}


def _within_progress(log: DataFrame, progress: DataFrame, timestamp: Column | None) -> DataFrame:
    """Stored records less what the progress rows' bounds exclude, which the scan can skip.

    One aggregate gives the range of readable shards, the smallest number and the kinds of
    checkpoints; numbers and arrival times bound the scan if no row is read from its start.
    """
    checkpoint = F.col("checkpoint")
    row = (
        progress.filter(~checkpoint.isin(fixed.LATEST, fixed.SHARD_END))
        .agg(
            F.min("stream").alias("first"), F.max("stream").alias("last"),
            F.min("shard_id").alias("low"), F.max("shard_id").alias("high"),
            F.min(F.when(is_number(checkpoint), sequence_key(checkpoint))).alias("number"),
            F.bool_and(is_number(checkpoint)).alias("numbers"),
            F.bool_and(is_number(checkpoint) | (checkpoint == fixed.AT_TIMESTAMP)).alias("bounded"),
            F.bool_and(checkpoint == fixed.AT_TIMESTAMP).alias("times"),
        )
        .first()
    )
    if row["first"] is None:
        return log
    log = log.filter(F.col("stream").between(row["first"], row["last"]) & F.col("shard_id").between(row["low"], row["high"]))
    since = None
    if timestamp is not None and row["bounded"]:
        since = (F.col(DAY) >= timestamp.cast("date")) & (F.col("arrival_ts") >= timestamp)
    if row["numbers"]:
        return log.filter(_beyond(row["number"]["text"], inclusive=True))
    if row["times"] and since is not None:
        return log.filter(since)
    if row["bounded"] and since is not None:
        return log.filter(_beyond(row["number"]["text"], inclusive=True) | since)
    return log


def read_change_log(
    spark: SparkSession,
    path: str,
    progress: DataFrame | None = None,
    position: str = fixed.TRIM_HORIZON,
    sequence: str | None = None,
    timestamp: Column | None = None,
    limit: int | None = None,
    trim_policy: str = "skip",
) -> DataFrame:
    """Bounded positioned read: per shard from ``progress``, else from one ``position``.

    Positions reach the scan as conditions on stored columns, so files before them are skipped; where
    the log is indexed (``index_change_log``), each shard's own position chooses the files.
    ``limit`` bounds the records per shard. Positions older than the retained data read from the
    oldest record there is, or with ``trim_policy="fail"`` make the query fail.
    """
    by_time = progress is None and position == fixed.AT_TIMESTAMP
    files = None if progress is None or trim_policy != "skip" else files_to_read(spark, path, progress)
    log = _stored(spark, path, timestamp if by_time else None, files)
    if progress is not None:
        if trim_policy != "skip":
            progress = apply_trim_policy(progress, _plain(log), trim_policy)
        log = _plain(_within_progress(log, progress, timestamp))
        log = apply_start_positions(log, progress, timestamp)
    elif position in ("AT_SEQUENCE", "AFTER_SEQUENCE"):
        log = _plain(log.filter(_beyond(sequence, inclusive=position == "AT_SEQUENCE")))
    else:
        log = read_from(_plain(log), position, sequence, timestamp)
    return limit_per_shard(log, limit)


def read_retained(spark: SparkSession, path: str, now: Column, hours: int = fixed.RETENTION_HOURS) -> DataFrame:
    """Stored records within the retention period; older days are neither listed nor read."""
    return scan_change_log(spark, path, now - F.expr(f"INTERVAL {hours} HOURS"))


def read_records(
    spark: SparkSession, path: str, format: str = "json", schema: StructType | str | None = None
) -> DataFrame:
    """Change records delivered as files of another format."""
    reader = spark.read.format(format)
    return (reader if schema is None else reader.schema(schema)).load(path)


def stream_change_log(
    spark: SparkSession,
    path: str,
    schema: StructType,
    format: str = "parquet",
    max_files_per_trigger: int | None = None,
    run: str | None = None,
) -> DataFrame:
    """Continuous read of a stored log; a restarted query resumes from its own checkpoint.

    ``run`` names a column for the file a record comes from; files of a stored log hold consecutive
    records of their shards.
    """
    dated = StructType([*schema.fields])
    if format == "parquet":
        dated = dated.add(DIGITS, "integer").add(NUMBER, "string").add(DAY, "date")
    reader = spark.readStream.format(format).schema(dated)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    log = reader.load(path)
    return _plain(log if run is None else log.withColumn(run, F.col("_metadata.file_path")))


def committed_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders matching a pattern whose write has finished, by its success marker."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = marker.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marker)
    return [s.getPath().getParent().toString() for s in found or []]


def write_progress(progress: DataFrame, path: str, base: int | None = None) -> int:
    """Store the next snapshot beside the earlier ones and commit it; readers see it from then on.

    With ``base``, the version the rows were derived from, a commit by another writer since then is a
    ``CommitConflict``; without, the snapshot takes the next free version.
    """
    spark = progress.sparkSession
    content = _stored_snapshot(progress, path)
    if base is None:
        return commit_next(spark, path, lambda _version, _content: content)
    if not publish(spark, path, base + 1, content):
        raise CommitConflict(f"{path} has a version after {base}")
    return base + 1


def update_progress(
    spark: SparkSession, path: str, update: Callable[[DataFrame | None], DataFrame], attempts: int = 10
) -> int:
    """Commit ``update`` of the newest snapshot (None: there is none yet).

    If another writer commits first, the update is applied anew to what that one left, so that no
    writer's changes are lost.
    """
    def build(version: int | None, content: dict | None) -> dict:
        return _stored_snapshot(update(None if content is None else spark.read.parquet(f"{path}/{content['data']}")), path)

    return commit_next(spark, path, build, attempts)


def _stored_snapshot(rows: DataFrame, path: str) -> dict:
    folder = f"data/{uuid.uuid4().hex}"
    rows.write.parquet(f"{path}/{folder}")
    return {"data": folder}


def read_progress(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A progress snapshot, by default the newest one."""
    if version is None:
        known = versions(spark, path)
        if not known:
            raise FileNotFoundError(f"no progress snapshot in {path}")
        version = known[-1]
    return spark.read.parquet(f"{path}/{read_commit(spark, path, version)['data']}")


def vacuum_progress(spark: SparkSession, path: str, keep: int = 10) -> int:
    """Remove the data of all but the newest ``keep`` versions; how many. Their numbers stay taken."""
    old = [read_commit(spark, path, v)["data"] for v in versions(spark, path)[:-keep]]
    removed = 0
    for folder in old:
        where = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{folder}")
        removed += bool(where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True))
    return removed


def scan_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """Full scan of a source or replica table."""
    return spark.read.format(format).load(path)


def lookup_item(table: DataFrame, **key) -> DataFrame:
    """The item with the given key; the condition reaches the scan."""
    for name, value in key.items():
        table = table.filter(F.col(name) == value)
    return table
