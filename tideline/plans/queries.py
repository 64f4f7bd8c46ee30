"""Registered queries: every operator over the whole derived tables.

Each takes (spark, sf_dir). Results hold plain scalars; arrays become sorted comma text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions import attributes, records, shards as shard_functions
from tideline.functions.ordering import sequence_key
from tideline.operators import SHARD, errors, lineage, metrics, progress, reads, replay
from tideline.plans import views
from tideline.scale import cut, run_dir
from tideline.sources import tables
from tideline.sources.commits import CommitConflict
from tideline.streaming import cycles, positions, process, replication, state

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

KEYS = ["stream", "key_id"]
VALUES = ["new_event_type", "new_value", "new_k"]
UNTIL = "104500"
RECORD = [*SHARD, "sequence_number"]


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


def _now() -> Column:
    return F.expr(views.NOW)


def _half() -> Column:
    return F.expr("TIMESTAMP_NTZ '2024-01-16 00:00:00'")


def _text(array: str) -> Column:
    return F.array_join(F.array_sort(array), ",")


def _catalog(df: DataFrame) -> DataFrame:
    return df.select(
        *SHARD, "parent_shard_id", "adjacent_parent_shard_id", "ending_sequence_number"
    )


def _rows(df: DataFrame) -> DataFrame:
    return df.select(*SHARD, _text("parent_shard_ids").alias("parents"), "checkpoint", "owner_switches")


# Replay


@query
def materialize_table(spark, sf_dir):
    return replay.materialize_table(views.change_log(spark, sf_dir), KEYS, VALUES)


@query
def materialize_until(spark, sf_dir):
    return replay.materialize_table(views.change_log(spark, sf_dir), KEYS, VALUES, until=UNTIL)


@query
def materialize_onto_base(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    base = replay.materialize_table(log, KEYS, VALUES, until=UNTIL)
    later = reads.read_from(log, "AFTER_SEQUENCE", sequence=UNTIL)
    return replay.materialize_table(later, KEYS, VALUES, base=base)


@query
def compare_tables(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    older = replay.materialize_table(log, KEYS, VALUES, until=UNTIL)
    newer = replay.materialize_table(log, KEYS, VALUES)
    return replay.compare_tables(older, newer)


@query
def dedupe_replayed(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    again = reads.read_from(log, fixed.AT_TIMESTAMP, timestamp=_half())
    return replay.dedupe_replayed(log.unionByName(again)).select(*RECORD, "event_name")


@query
def replay_order(spark, sf_dir):
    """Places in the order; the oldest generation is no longer listed."""
    log = views.change_log(spark, sf_dir).select(*RECORD, "event_name")
    shards = views.shards_trimmed(views.all_shards(spark, sf_dir))
    return reads.replay_order(log, shards, position="place")


@query
def materialize_skewed(spark, sf_dir):
    """One shard with nine in ten records, one key with half of them."""
    return replay.materialize_table(views.as_skewed(views.change_log(spark, sf_dir)), KEYS, VALUES)


@query
def limit_skewed(spark, sf_dir):
    return reads.limit_per_shard(views.as_skewed(views.change_log(spark, sf_dir)).select(*RECORD), 5000)


@query
def lookup_item(spark, sf_dir):
    table = replay.materialize_table(views.change_log(spark, sf_dir), KEYS, VALUES)
    return tables.lookup_item(table, stream="s0", key_id=7)


# Records


def _json(spark, sf_dir) -> DataFrame:
    return views.as_records_json(views.change_log(spark, sf_dir))


@query
def decode_records(spark, sf_dir):
    decoded = records.decode_records(_json(spark, sf_dir))
    return decoded.select(
        "event_id",
        "event_name",
        "event_version",
        "sequence_number",
        "size_bytes",
        "stream_view_type",
        F.col("approximate_creation_ts").cast("timestamp_ntz").alias("created"),
        F.coalesce(F.size("new_image"), F.lit(0)).cast("bigint").alias("attributes"),
        F.col("old_image").isNull().alias("no_old_image"),
        F.col("_corrupt").isNull().alias("valid"),
    )


@query
def decode_odd_payloads(spark, sf_dir):
    """Names in three spellings; null, empty, blank and torn payloads are flagged."""
    odd = views.with_odd_payloads(_json(spark, sf_dir).withColumnRenamed("sequence_number", "number").withColumn("sequence_number", F.col("number")))
    decoded = records.decode_records(odd, keep=["number"], fields=["event_id", "event_name", "sequence_number", "new_image"])
    return decoded.select(
        "number", "event_id", "event_name", "sequence_number",
        attributes.attribute("new_image", "value", "N", "double").alias("new_value"),
        F.col("_valid").alias("valid"),
    )


@query
def decode_stored(spark, sf_dir):
    """Payloads that were stored before."""
    path = run_dir(spark, "payloads")
    _json(spark, sf_dir).select("data").write.parquet(path)
    decoded = records.decode_records(spark.read.parquet(path), fields=["event_id", "event_name", "sequence_number"])
    return decoded.drop("_corrupt", "_valid")


@query
def attribute_values(spark, sf_dir):
    decoded = records.decode_records(_json(spark, sf_dir), fields=["sequence_number", "new_image"])

    def get(name, type, as_type=None):
        return attributes.attribute("new_image", name, type, as_type)

    return decoded.select(
        "sequence_number",
        get("event_type", "S").alias("s"),
        get("value", "N", "double").alias("n"),
        F.decode(get("raw", "B"), "UTF-8").alias("b"),
        get("nothing", "NULL").alias("is_null"),
        get("large", "BOOL").alias("flag"),
        F.array_join(F.array_sort(get("tags", "SS")), ",").alias("ss"),
        F.array_join(get("numbers", "NS"), ",").alias("ns"),
        F.decode(F.get(get("blobs", "BS"), 0), "UTF-8").alias("bs"),
        F.size(get("detail", "M")).cast("bigint").alias("m_size"),
        F.size(get("parts", "L")).cast("bigint").alias("l_size"),
        attributes.has_attribute("new_image", "nothing").alias("has_nothing"),
        attributes.has_attribute("new_image", "absent").alias("has_absent"),
    )


@query
def encode_attribute_types(spark, sf_dir):
    """All ten types, encoded as variants and read back."""
    log = views.change_log(spark, sf_dir)
    kept = F.col("new_value").isNotNull()
    kind, number = F.col("new_event_type"), F.col("new_k").cast("string")
    tagged_kind, tagged_number = attributes.encode_attribute(kind, "S"), attributes.encode_attribute(number, "N")
    image = attributes.build_image(
        {
            "event_type": (kind, "S"),
            "value": (F.col("new_value"), "N"),
            "raw": (F.encode(kind, "UTF-8"), "B"),
            "nothing": (F.when(kept, F.lit(True)), "NULL"),
            "large": (F.col("new_value") > 20, "BOOL"),
            "tags": (F.when(kept, F.array(F.lit("tag"), kind)), "SS"),
            "numbers": (F.when(kept, F.array(number)), "NS"),
            "blobs": (F.when(kept, F.array(F.encode(kind, "UTF-8"))), "BS"),
            "detail": (F.when(kept, F.create_map(F.lit("k"), tagged_number)), "M"),
            "parts": (F.when(kept, F.array(tagged_kind, tagged_number)), "L"),
        }
    )
    encoded = log.select("sequence_number", image.alias("new_image"))

    def get(name, type, as_type=None):
        return attributes.attribute("new_image", name, type, as_type)

    return encoded.select(
        "sequence_number",
        get("event_type", "S").alias("s"),
        get("value", "N", "double").alias("n"),
        F.decode(get("raw", "B"), "UTF-8").alias("b"),
        get("nothing", "NULL").alias("is_null"),
        get("large", "BOOL").alias("flag"),
        F.array_join(F.array_sort(get("tags", "SS")), ",").alias("ss"),
        F.array_join(get("numbers", "NS"), ",").alias("ns"),
        F.decode(F.get(get("blobs", "BS"), 0), "UTF-8").alias("bs"),
        get(("detail", "k"), "N", "bigint").alias("m_number"),
        get(("parts", 0), "S").alias("l_first"),
        get(("parts", 1), "N", "bigint").alias("l_second"),
        F.size("new_image").cast("bigint").alias("attributes"),
    )


@query
def flatten_image(spark, sf_dir):
    decoded = records.decode_records(_json(spark, sf_dir), fields=["sequence_number", "event_name", "new_image"])
    return attributes.flatten_image(
        decoded,
        "new_image",
        {
            "new_event_type": ("event_type", "S"),
            "new_value": ("value", "N", "double"),
            "new_k": (("detail", "k"), "N", "bigint"),
            "first_part": (("parts", 0), "S"),
            "second_part": (("parts", 1), "N", "bigint"),
        },
        keep=["sequence_number", "event_name"],
    )


@query
def discover_attributes(spark, sf_dir):
    decoded = records.decode_records(_json(spark, sf_dir), fields=["new_image"])
    return attributes.discover_attributes(decoded, "new_image")


@query
def encode_roundtrip(spark, sf_dir):
    encoded = records.encode_records(views.as_envelopes(views.change_log(spark, sf_dir)), SHARD)
    decoded = records.decode_records(encoded, keep=SHARD)
    return decoded.select(
        *RECORD,
        "event_id",
        "event_name",
        F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"),
        F.col("approximate_creation_ts").cast("timestamp_ntz").alias("created"),
        attributes.attribute("keys", "key_id", "N", "bigint").alias("key_id"),
        attributes.attribute("new_image", "event_type", "S").alias("new_event_type"),
        attributes.attribute("new_image", "value", "N", "double").alias("new_value"),
        F.decode(attributes.attribute("new_image", "raw", "B"), "UTF-8").alias("raw"),
        attributes.attribute("new_image", "large", "BOOL").alias("large"),
    )


@query
def delivered_record(spark, sf_dir):
    sent = records.to_delivered_record(views.as_envelopes(views.change_log(spark, sf_dir)), keep=SHARD)
    received = records.decode_records(
        sent.drop("sequence_number"),
        keep=[*SHARD, "partition_key", "approximate_arrival_ts"],
        fields=["sequence_number", "event_name"],
    )
    return received.select(
        *RECORD,
        "event_name",
        "partition_key",
        F.col("approximate_arrival_ts").cast("timestamp_ntz").alias("arrival_ts"),
    )


@query
def delivered_without_bytes(spark, sf_dir):
    sent = records.to_delivered_record(
        views.as_envelopes(views.change_log(spark, sf_dir)), generate_bytes=False, keep=SHARD
    )
    return sent.select(*RECORD, records.payload_bytes("data").cast("bigint").alias("bytes"))


@query
def operation_kind(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    kind = records.operation_kind("event_name").alias("kind")
    return log.groupBy("stream", kind).agg(F.count("*").alias("n"))


# Lineage


@query
def catalog_assemble(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    first = views.as_pages(views.shards_open_parent(shards))
    again = views.as_pages(shards).withColumn("page_no", F.col("page_no") + 10)
    return _catalog(lineage.assemble_shard_catalog(first.unionByName(again)))


@query
def collect_all_pages(spark, sf_dir):
    pages = views.as_pages(views.all_shards(spark, sf_dir))
    listed = pages.groupBy("stream", "page_no").agg(
        F.collect_list(F.struct(*lineage.SHARD_COLUMNS)).alias("shards")
    )
    return _catalog(lineage.collect_all_pages(listed, "s1"))


@query
def shard_edges(spark, sf_dir):
    return lineage.lineage_edges(views.shards_trimmed(views.all_shards(spark, sf_dir)))


@query
def child_sets(spark, sf_dir):
    sets = lineage.child_sets(views.all_shards(spark, sf_dir))
    return sets.select(*SHARD, _text("children").alias("children"))


@query
def children_hash_cover(spark, sf_dir):
    cover = lineage.children_hash_cover(views.shards_narrow(views.all_shards(spark, sf_dir)))
    high = F.col("high.text").alias("max_ending_hash_key")
    return cover.select(*SHARD, "children", high)


@query
def leaf_shards(spark, sf_dir):
    return lineage.leaf_shards(views.all_shards(spark, sf_dir)).select(*SHARD)


@query
def open_shards(spark, sf_dir):
    return lineage.open_shards(views.all_shards(spark, sf_dir)).select(*SHARD)


@query
def lookup_shard(spark, sf_dir):
    shard_id = "shardId-00000001704585600000-00000001"
    return _catalog(lineage.lookup_shard(views.all_shards(spark, sf_dir), "s0", shard_id))


@query
def lineage_depth(spark, sf_dir):
    depth = lineage.lineage_depth(views.all_shards(spark, sf_dir))
    return depth.select(*SHARD, F.col("depth").cast("bigint").alias("depth"))


@query
def normalize_shards(spark, sf_dir):
    shards = shard_functions.normalize_shards(views.all_shards(spark, sf_dir))
    return shards.select(*lineage.SHARD_COLUMNS)


@query
def creation_time(spark, sf_dir):
    created = shard_functions.shard_creation_time().cast("timestamp_ntz").alias("created")
    return views.all_shards(spark, sf_dir).select(*SHARD, created)


@query
def last_fetched(spark, sf_dir):
    return lineage.last_fetched(views.as_pages(views.all_shards(spark, sf_dir), mixed_order=True))


@query
def graph_stats(spark, sf_dir):
    gap = views.shards_gap(views.all_shards(spark, sf_dir))
    return lineage.graph_stats(views.as_pages(gap, mixed_order=True))


@query
def earliest_closed_leaf(spark, sf_dir):
    gap = views.shards_gap(views.all_shards(spark, sf_dir))
    return lineage.earliest_closed_leaf(views.as_pages(gap, mixed_order=True))


@query
def close_open_parents(spark, sf_dir):
    shards = views.shards_open_parent(views.all_shards(spark, sf_dir))
    return _catalog(lineage.close_open_parents(views.as_pages(shards, mixed_order=True)))


@query
def close_open_parents_any_order(spark, sf_dir):
    shards = views.shards_open_parent(views.all_shards(spark, sf_dir))
    pages = views.as_pages(shards, mixed_order=True)
    return _catalog(lineage.close_open_parents(pages, ordered=False))


@query
def closed_leaves(spark, sf_dir):
    gap = views.shards_gap(views.all_shards(spark, sf_dir))
    return _catalog(lineage.closed_leaf_shards(views.as_pages(gap, mixed_order=True)))


def _repair(spark, sf_dir, siblings):
    shards = views.all_shards(spark, sf_dir)
    known = views.as_pages(shards.filter("gen < 3"))
    return _catalog(lineage.extend_closed_leaves(known, views.as_pages(shards), siblings=siblings))


@query
def extend_closed_leaves(spark, sf_dir):
    return _repair(spark, sf_dir, "all")


@query
def extend_closed_leaves_first(spark, sf_dir):
    return _repair(spark, sf_dir, "first")


@query
def reopen_leaves(spark, sf_dir):
    gap = views.shards_gap(views.all_shards(spark, sf_dir))
    return _catalog(lineage.reopen_leaf_shards(gap, keep_ancestors=False))


@query
def reopen_leaves_keep_ancestors(spark, sf_dir):
    gap = views.shards_gap(views.all_shards(spark, sf_dir))
    return _catalog(lineage.reopen_leaf_shards(gap))


@query
def inconsistent_shards(spark, sf_dir):
    return lineage.inconsistent_shards(views.shards_open_parent(views.all_shards(spark, sf_dir)))


@query
def closed_shard_violations(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    rows = views.as_progress(shards, "late").withColumn("checkpoint", F.lit(fixed.SHARD_END))
    torn = views.shards_narrow(shards)
    end = F.when(~((F.col("gen") == 1) & (F.col("bucket") == 1)), F.col("ending_sequence_number"))
    torn = torn.withColumn("ending_sequence_number", end).filter(
        "NOT (gen = 4 AND bucket % 2 = 0)"
    )
    return lineage.closed_shard_violations(torn, rows)


# Positioned reads


@query
def read_trim_horizon(spark, sf_dir):
    return reads.read_from(views.change_log(spark, sf_dir), fixed.TRIM_HORIZON).select(*RECORD)


@query
def read_latest(spark, sf_dir):
    """What arrives after the newest record of the first half of the log."""
    log = views.change_log(spark, sf_dir)
    starts = positions.latest_positions(log.filter(F.col("arrival_ts") < _half()))
    return reads.apply_start_positions(log.select(*RECORD, "arrival_ts"), starts).select(*RECORD)


@query
def read_at_timestamp(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    return reads.read_from(log, fixed.AT_TIMESTAMP, timestamp=_half()).select(*RECORD)


@query
def read_at_sequence(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    return reads.read_from(log, "AT_SEQUENCE", sequence="100000").select(*RECORD)


@query
def read_after_sequence(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    return reads.read_from(log, "AFTER_SEQUENCE", sequence="100000").select(*RECORD)


def _reading(spark, sf_dir) -> DataFrame:
    return views.as_reading(views.all_shards(spark, sf_dir))


@query
def read_after_checkpoint(spark, sf_dir):
    log = views.change_log(spark, sf_dir).select(*RECORD, "arrival_ts")
    return reads.apply_start_positions(log, _reading(spark, sf_dir), timestamp=_half())


@query
def read_at_checkpoint(spark, sf_dir):
    log = views.change_log(spark, sf_dir).select(*RECORD, "arrival_ts")
    rows = _reading(spark, sf_dir)
    return reads.apply_start_positions(log, rows, timestamp=_half(), inclusive=True)


@query
def read_stored_log(spark, sf_dir):
    path = run_dir(spark, "log")
    log = views.change_log(spark, sf_dir).select(*RECORD, "arrival_ts", "event_name")
    tables.write_change_log(log, path)
    rows = _reading(spark, sf_dir)
    got = tables.read_change_log(spark, path, progress=rows, timestamp=_half(), limit=50)
    return got.select(*RECORD, "event_name")


@query
def limit_per_shard(spark, sf_dir):
    return reads.limit_per_shard(views.change_log(spark, sf_dir).select(*RECORD), 25)


@query
def limit_per_shard_clamped(spark, sf_dir):
    log = views.as_change_log(spark.read.parquet(f"{sf_dir}/events.parquet"), None)
    return reads.limit_per_shard(log.select(*RECORD), shard_functions.clamp_limit(10000))


@query
def limit_per_shard_large(spark, sf_dir):
    log = views.as_change_log(spark.read.parquet(f"{sf_dir}/events.parquet"), None)
    return reads.limit_per_shard(log.select(*RECORD), 5000)


def _retained(spark, sf_dir) -> DataFrame:
    return reads.retention_filter(views.change_log(spark, sf_dir), _now(), hours=16 * 24)


@query
def retention_filter(spark, sf_dir):
    return reads.retention_filter(views.change_log(spark, sf_dir), _now(), hours=48).select(
        *RECORD, "arrival_ts"
    )


@query
def oldest_retained(spark, sf_dir):
    return reads.oldest_retained(_retained(spark, sf_dir))


@query
def trim_gaps(spark, sf_dir):
    return reads.trim_gaps(_reading(spark, sf_dir), _retained(spark, sf_dir))


@query
def trim_skip(spark, sf_dir):
    return _rows(reads.apply_trim_policy(_reading(spark, sf_dir), _retained(spark, sf_dir)))


# Progress


def _plan(spark, sf_dir, position):
    shards = views.all_shards(spark, sf_dir)
    return _rows(progress.plan_new_progress(shards, views.as_progress(shards, "mixed"), position))


@query
def plan_new_progress_latest(spark, sf_dir):
    return _plan(spark, sf_dir, fixed.LATEST)


@query
def plan_new_progress_trim(spark, sf_dir):
    return _plan(spark, sf_dir, fixed.TRIM_HORIZON)


@query
def plan_new_progress_timestamp(spark, sf_dir):
    return _plan(spark, sf_dir, fixed.AT_TIMESTAMP)


@query
def plan_new_progress_torn(spark, sf_dir):
    shards = views.shards_open_parent(views.all_shards(spark, sf_dir))
    rows = views.as_progress(shards, "mixed")
    torn = lineage.inconsistent_shards(shards)
    return _rows(progress.plan_new_progress(shards, rows, fixed.TRIM_HORIZON, torn))


@query
def order_progress_rows(spark, sf_dir):
    """Places in the order."""
    shards = views.all_shards(spark, sf_dir)
    rows = progress.order_progress_rows(views.as_progress(shards, "mixed"), shards)
    placed = reads.numbered(rows.withColumn("every", F.lit(0)), ["every"], "place")
    return placed.select(*SHARD, _text("parent_shard_ids").alias("parents"), "checkpoint", "owner_switches", "place")


@query
def garbage_progress(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    rows = views.as_progress(shards, "mixed")
    return _rows(progress.garbage_progress(rows, shards, shards))


@query
def finished_progress(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    return _rows(progress.finished_progress(views.as_progress(shards, "mixed"), shards, _now()))


@query
def processable_shards(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    rows = progress.tracked_progress(
        views.as_progress(shards, "mixed"),
        progress.plan_new_progress(shards, views.as_progress(shards, "mixed"), fixed.TRIM_HORIZON),
    )
    return progress.processable_shards(shards, rows)


@query
def next_progress(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    rows, late = views.as_progress(shards, "partial"), views.as_progress(shards, "late")
    finished = progress.finished_progress(late, shards, _now())
    return _rows(progress.next_progress(rows, late, finished))


def _sync(spark, sf_dir) -> progress.SyncResult:
    shards = views.all_shards(spark, sf_dir)
    rows = views.as_progress(shards, "mixed")
    return progress.sync_progress(shards, rows, fixed.LATEST, _now(), fresh_shards=shards)


@query
def sync_progress(spark, sf_dir):
    return _rows(_sync(spark, sf_dir).progress)


@query
def sync_audit(spark, sf_dir):
    return _sync(spark, sf_dir).audit


@query
def stored_progress(spark, sf_dir):
    path = run_dir(spark, "progress")
    shards = views.all_shards(spark, sf_dir)
    tables.write_progress(views.as_progress(shards, "partial"), path)
    late = views.as_progress(shards, "late")
    tables.write_progress(progress.tracked_progress(tables.read_progress(spark, path), late), path)
    return _rows(tables.read_progress(spark, path))


@query
def progress_checkpoints(spark, sf_dir):
    return progress.progress_checkpoints(views.change_log(spark, sf_dir))


@query
def unprocessed_counts(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    return progress.unprocessed_counts(log, _reading(spark, sf_dir), _half())


@query
def detect_shard_end(spark, sf_dir):
    log = views.change_log(spark, sf_dir)
    shards = views.all_shards(spark, sf_dir)
    reached = progress.progress_checkpoints(log.filter(F.col("arrival_ts") < _half()), every=1)
    rows = shards.select(
        *SHARD,
        shard_functions.parent_ids().alias("parent_shard_ids"),
        F.lit(0).cast("bigint").alias("owner_switches"),
    ).join(reached, SHARD)
    return _rows(progress.detect_shard_end(rows, shards, log))


# Streams, metrics, errors


def _streams(spark, sf_dir):
    shards = views.all_shards(spark, sf_dir)
    return views.as_streams(shards), shards


@query
def stream_status(spark, sf_dir):
    streams, _ = _streams(spark, sf_dir)
    status = shard_functions.normalize_stream_status("status")
    return shard_functions.readable_streams(streams.withColumn("status", status)).select("arn", "status")


@query
def list_streams(spark, sf_dir):
    return reads.list_streams(_streams(spark, sf_dir)[0], after="s0", limit=3)


@query
def describe_stream(spark, sf_dir):
    streams, shards = _streams(spark, sf_dir)
    after = "shardId-00000001704585600000-00000009"
    page = reads.describe_stream(streams, shards, "s1", after=after, limit=5)
    return page.select(
        "stream_name", "stream_status", "shard_id", "parent_shard_id", "has_more"
    )


@query
def describe_disabled_stream(spark, sf_dir):
    streams, shards = _streams(spark, sf_dir)
    page = reads.describe_stream(streams, views.shards_gap(shards), "s2", limit=1)
    return page.select(
        "stream_name", "stream_status", "shard_id", "ending_sequence_number", "has_more"
    )


@query
def summarize_streams(spark, sf_dir):
    summary = reads.summarize_streams(*_streams(spark, sf_dir))
    return summary.withColumns(
        {c: F.col(c).cast("bigint") for c in ("retention_hours", "consumer_count")}
    )


@query
def lag_by_shard(spark, sf_dir):
    return metrics.lag_by_shard(views.change_log(spark, sf_dir), _now())


@query
def throughput_by_shard(spark, sf_dir):
    log = views.change_log(spark, sf_dir).withColumn("data", F.encode("sequence_number", "UTF-8"))
    return metrics.throughput_by_shard(log, "6 hours")


@query
def classify_api_errors_skip(spark, sf_dir):
    return errors.classify_api_errors(views.api_errors(spark, sf_dir), "skip")


@query
def classify_api_errors_retry(spark, sf_dir):
    return errors.classify_api_errors(views.api_errors(spark, sf_dir), "retry")


# Streaming, run to the end of what is available


@query
def stream_materialize(spark, sf_dir):
    target, state = run_dir(spark, "replica"), run_dir(spark, "query")
    stream = views.stored_stream(spark, sf_dir)
    process.run_to_end(replication.replicate_sink(stream, target, KEYS, VALUES, state))
    return replication.read_replica(spark, target, KEYS, VALUES)


@query
def stream_resume(spark, sf_dir):
    """Two runs of one query with new data in between, then a compaction."""
    path, target, state = (run_dir(spark, n) for n in ("log", "replica", "query"))
    log = views.change_log(spark, sf_dir)
    for part in (log.filter(F.col("arrival_ts") < _half()), log.filter(F.col("arrival_ts") >= _half())):
        tables.write_change_log(part, path)
        stream = tables.stream_change_log(spark, path, log.schema)
        process.run_to_end(replication.replicate_sink(stream, target, KEYS, VALUES, state))
    replication.compact_replica(spark, target, KEYS, VALUES)
    return replication.read_replica(spark, target, KEYS, VALUES)


@query
def stream_latest(spark, sf_dir):
    """Only what arrives after the start: the first half is there before, the rest follows."""
    path, state, out = (run_dir(spark, n) for n in ("log", "query", "out"))
    log = views.change_log(spark, sf_dir)
    tables.write_change_log(log.filter(F.col("arrival_ts") < _half()), path)
    starts = cut(positions.latest_positions(tables.scan_change_log(spark, path)))
    tables.write_change_log(log.filter(F.col("arrival_ts") >= _half()), path)
    stream = tables.stream_change_log(spark, path, log.schema)
    new = positions.start_stream_at(stream, starts).select(*RECORD, "event_name")
    process.run_to_end(new.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
    return spark.read.parquet(out)


@query
def stream_stateful_latest(spark, sf_dir):
    """Four micro-batches, whose state is carried over."""
    out, state = run_dir(spark, "updates"), run_dir(spark, "query")
    running = replication.stateful_latest(views.stored_stream(spark, sf_dir), KEYS, VALUES)
    process.run_to_end(process.update_sink(running, out, state))
    return replication.newest_updates(spark.read.parquet(out), KEYS, VALUES)


def _collected(spark, stream: DataFrame) -> DataFrame:
    out, state = run_dir(spark, "out"), run_dir(spark, "query")
    process.run_to_end(stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
    return spark.read.parquet(out)


def _delivered_twice(spark, sf_dir) -> DataFrame:
    """Two streams of the same records, one file per trigger each: copies meet in later batches."""
    twice = views.stored_stream(spark, sf_dir).unionByName(views.stored_stream(spark, sf_dir, files=3))
    return twice.select(*RECORD, "event_name", "arrival_ts")


@query
def stream_dedupe(spark, sf_dir):
    once = replay.dedupe_replayed(_delivered_twice(spark, sf_dir), within=None)
    return _collected(spark, once.drop("arrival_ts"))


@query
def stream_dedupe_bounded(spark, sf_dir):
    """The state forgets what no stream can deliver again; the log spans 30 days."""
    once = replay.dedupe_replayed(_delivered_twice(spark, sf_dir), within="31 days")
    return _collected(spark, once.drop("arrival_ts"))


@query
def stream_drain(spark, sf_dir):
    gap = views.shards_gap(views.all_shards(spark, sf_dir))
    left = positions.drain_disabled_stream(views.event_stream(spark, sf_dir), gap)
    return _collected(spark, left.select(*RECORD, "event_name"))


def _stream_starts(spark, sf_dir, trim_policy="skip") -> tuple[positions.StartPlan, DataFrame]:
    """Start positions fixed when half of the log was there and its first days were gone, and the
    whole stored log as a stream of one file per trigger."""
    path = run_dir(spark, "log")
    log = views.change_log(spark, sf_dir).select(*RECORD, "event_name", "arrival_ts")
    half = log.filter(F.col("arrival_ts") < _half())
    tables.write_change_log(half, path)
    held = reads.retention_filter(tables.scan_change_log(spark, path), _now(), hours=24 * 24)
    plan = positions.resolve_starts(_reading(spark, sf_dir), held, trim_policy)
    plan = positions.StartPlan(cut(plan.starts), cut(plan.gaps))
    tables.write_change_log(log.filter(F.col("arrival_ts") >= _half()), path)
    return plan, tables.stream_change_log(spark, path, log.schema, max_files_per_trigger=10)


@query
def stream_from_progress(spark, sf_dir):
    """All kinds of checkpoints: LATEST is what was newest when half of the log was there."""
    plan, stream = _stream_starts(spark, sf_dir)
    new = positions.start_stream_at(stream, plan.starts, timestamp=_half())
    return _collected(spark, new.select(*RECORD, "event_name"))


@query
def stream_trim_skip(spark, sf_dir):
    plan, _ = _stream_starts(spark, sf_dir)
    return plan.gaps


@query
def stream_limited(spark, sf_dir):
    """Several micro-batches of a limited number of files hold what one would."""
    return _collected(spark, views.stored_stream(spark, sf_dir, files=6, per_trigger=2).select(*RECORD, "event_name"))


@query
def stream_delivered(spark, sf_dir):
    out, state = run_dir(spark, "out"), run_dir(spark, "query")
    envelopes = views.as_envelopes(views.event_stream(spark, sf_dir))
    process.run_to_end(process.delivered_record_sink(envelopes, out, state))
    decoded = records.decode_records(spark.read.parquet(out), keep=SHARD)
    return decoded.select(*RECORD, "event_name")


@query
def stream_process(spark, sf_dir):
    """Callbacks: ordered records are stored, ended shards are noted."""
    out, ends, state = (run_dir(spark, n) for n in ("out", "ends", "query"))
    shards = views.all_shards(spark, sf_dir)

    def on_records(batch: DataFrame, batch_id: int) -> None:
        batch.select(*RECORD).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    def on_shard_end(ended: DataFrame, batch_id: int) -> None:
        ended.write.mode("overwrite").parquet(f"{ends}/batch={batch_id}")

    stream = views.event_stream(spark, sf_dir)
    process.run_to_end(process.process_stream(stream, on_records, state, shards, on_shard_end))
    ended = spark.read.parquet(ends).select(*SHARD).withColumn("ended", F.lit(True))
    counts = spark.read.parquet(out).groupBy(*SHARD).agg(F.count("*").alias("records"))
    return counts.join(ended, SHARD, "left").select(
        *SHARD, "records", F.coalesce("ended", F.lit(False)).alias("ended")
    )


@query
def read_stored_log_at_timestamp(spark, sf_dir):
    path = run_dir(spark, "log")
    tables.write_change_log(views.change_log(spark, sf_dir).select(*RECORD, "arrival_ts"), path)
    return tables.read_change_log(spark, path, position=fixed.AT_TIMESTAMP, timestamp=_half())


def _stored(spark, sf_dir) -> str:
    path = run_dir(spark, "log")
    tables.write_change_log(views.change_log(spark, sf_dir).select(*RECORD, "arrival_ts", "event_name"), path)
    return path


@query
def read_stored_after_sequence(spark, sf_dir):
    return tables.read_change_log(spark, _stored(spark, sf_dir), position="AFTER_SEQUENCE", sequence="100000").select(*RECORD)


@query
def retention_stored(spark, sf_dir):
    return tables.read_retained(spark, _stored(spark, sf_dir), _now(), hours=48).select(*RECORD, "arrival_ts")


@query
def sharded_source_replay(spark, sf_dir):
    """Bounded read by per-shard positions, shards without a position from their start."""
    path = _stored(spark, sf_dir)
    shards = views.all_shards(spark, sf_dir)
    rows = _reading(spark, sf_dir)
    new = shards.select(*SHARD, F.lit(fixed.TRIM_HORIZON).alias("checkpoint")).join(rows.select(*SHARD), SHARD, "left_anti")
    every = rows.select(*SHARD, "checkpoint").unionByName(new)
    return tables.read_change_log(spark, path, progress=every, timestamp=_half()).select(*RECORD, "arrival_ts", "event_name")


@query
def sharded_source_stream(spark, sf_dir):
    """The same read as a stream."""
    path = _stored(spark, sf_dir)
    log = tables.scan_change_log(spark, path)
    starts = cut(positions.resolve_starts(_reading(spark, sf_dir), log).starts)
    stream = tables.stream_change_log(spark, path, log.schema, max_files_per_trigger=20)
    new = positions.start_stream_at(stream, starts, timestamp=_half())
    return _collected(spark, new.select(*RECORD, "arrival_ts", "event_name"))


# Commits, cycles and live state


@query
def progress_two_writers(spark, sf_dir):
    """Two writers begin with the same version: the second meets a clean conflict and is rebased."""
    path = run_dir(spark, "progress")
    shards = views.all_shards(spark, sf_dir)
    partial, late = views.as_progress(shards, "partial"), views.as_progress(shards, "late")
    version = tables.write_progress(partial, path)
    stale = tables.read_progress(spark, path)
    tables.update_progress(spark, path, lambda rows: progress.tracked_progress(rows, late))
    ended = partial.select(*SHARD, F.lit(fixed.SHARD_END).alias("checkpoint"))
    try:
        tables.write_progress(cycles.advanced(stale, ended), path, base=version)
    except CommitConflict:
        tables.update_progress(spark, path, lambda rows: cycles.advanced(rows, ended))
    return _rows(tables.read_progress(spark, path)).withColumn("versions", F.lit(3).cast("bigint"))


#: Records of a shard in a cycle: several cycles for the larger shards.
PER_CYCLE = 40


def _cycled(spark, sf_dir) -> tuple[str, DataFrame, DataFrame, DataFrame]:
    """Progress path, shards, records with the cycle that read them, and ended shards, of a read in cycles."""
    out, ends, path = (run_dir(spark, n) for n in ("out", "ends", "progress"))
    shards = views.all_shards(spark, sf_dir)

    def keep(folder: str, columns: list[str]):
        return lambda batch, cycle: batch.select(*columns).write.mode("overwrite").parquet(f"{folder}/cycle={cycle}")

    cycles.read_in_cycles(
        spark, _stored(spark, sf_dir), shards, path, keep(out, RECORD), n=PER_CYCLE, on_shard_end=keep(ends, SHARD)
    )
    return path, shards, spark.read.parquet(out), spark.read.parquet(ends)


@query
def read_in_cycles(spark, sf_dir):
    """Per tracked shard: what was read, in later cycles than its parents and no more a cycle than asked
    for, where it left progress, and how often its end was reported."""
    path, shards, read, ends = _cycled(spark, sf_dir)
    sizes = read.groupBy(*SHARD, "cycle").agg(F.count("*").alias("n"), F.sum(F.col("sequence_number").cast("bigint")).alias("numbers"))
    spans = cut(
        sizes.groupBy(*SHARD).agg(
            F.min("cycle").alias("first"), F.max("cycle").alias("last"), F.max("n").alias("most"),
            F.sum("n").alias("records"), F.sum("numbers").alias("numbers"),
        )
    )
    above = spans.select("stream", F.col("shard_id").alias("parent_id"), F.col("last").alias("above"))
    edges = lineage.lineage_edges(shards).join(above, ["stream", "parent_id"])
    above = edges.groupBy("stream", F.col("child_id").alias("shard_id")).agg(F.max("above").alias("above"))
    ended = ends.groupBy(*SHARD).agg(F.count("*").alias("ends"))
    rows = tables.read_progress(spark, path).join(spans, SHARD, "left").join(above, SHARD, "left").join(ended, SHARD, "left")
    zero = F.lit(0).cast("bigint")
    return rows.select(
        *SHARD, "checkpoint", F.coalesce("records", zero).alias("records"), F.coalesce("numbers", zero).alias("numbers"),
        F.coalesce(F.col("above") < F.col("first"), F.lit(True)).alias("after_parents"),
        F.coalesce(F.col("most") <= PER_CYCLE, F.lit(True)).alias("within_limit"), F.coalesce("ends", zero).alias("ends"),
    )


def _in_three_runs(spark, sf_dir, start) -> None:
    """Run the writer that ``start`` makes of a stream three times, restarted as the log grows."""
    path = run_dir(spark, "log")
    log = views.change_log(spark, sf_dir).select(*RECORD, "event_name", "arrival_ts")
    number = F.col("sequence_number").cast("bigint")
    bounds = log.agg(F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    a, b = (bounds["lo"] + (bounds["hi"] - bounds["lo"]) * k // 7 for k in (2, 5))
    for part in (number < a, number.between(a, b - 1), number >= b):
        tables.write_change_log(log.filter(part), path)
        process.run_to_end(start(tables.stream_change_log(spark, path, log.schema)))


@query
def stream_checkpoints(spark, sf_dir):
    """Checkpoints every ten records, counted on over restarts."""
    path, folder = run_dir(spark, "state"), run_dir(spark, "query")
    _in_three_runs(spark, sf_dir, lambda stream: state.checkpoint_sink(stream, path, folder))
    return state.read_state(spark, path).filter("checkpoint IS NOT NULL").select(*SHARD, "checkpoint")


@query
def stream_lag(spark, sf_dir):
    path, folder = run_dir(spark, "state"), run_dir(spark, "query")
    _in_three_runs(spark, sf_dir, lambda stream: state.lag_sink(stream, path, folder, _now()))
    return state.read_state(spark, path).select(*SHARD, "behind_ms")


@query
def stream_throughput(spark, sf_dir):
    """Windows that are closed when the stream has been read."""
    log = views.event_stream(spark, sf_dir).withColumn("data", F.encode("sequence_number", "UTF-8"))
    closed = metrics.stream_throughput(log.withColumn("arrival_ts", F.col("arrival_ts").cast("timestamp")), "6 hours", "1 hour")
    return _collected(spark, closed).withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


#: Out of order, repeated, and late: the first part comes when all others are there.
LATE = (3, 1, 3, 2, 1, 0, 2)


def _late(spark, sf_dir, run: str | None) -> DataFrame:
    path, log = views.stored_runs(spark, sf_dir, LATE, of=4)
    return tables.stream_change_log(spark, path, log.schema, max_files_per_trigger=2, run=run)


@query
def stream_dedupe_late(spark, sf_dir):
    """Default settings."""
    return _collected(spark, replay.dedupe_replayed(_late(spark, sf_dir, None)).drop("arrival_ts"))


@query
def stream_dedupe_runs(spark, sf_dir):
    """State of covered ranges per shard."""
    return _collected(spark, replay.dedupe_replayed(_late(spark, sf_dir, "file"), run="file").drop("arrival_ts"))


@query
def stream_compact_buckets(spark, sf_dir):
    """A replica compacted after every run: each compaction writes the touched buckets only."""
    target, folder = run_dir(spark, "replica"), run_dir(spark, "query")
    path = run_dir(spark, "log")
    log = views.change_log(spark, sf_dir)
    for part in (F.col("arrival_ts") < _half(), (F.col("arrival_ts") >= _half()) & (F.col("key_id") % 16 == 3), (F.col("arrival_ts") >= _half()) & (F.col("key_id") % 16 != 3)):
        tables.write_change_log(log.filter(part), path)
        stream = tables.stream_change_log(spark, path, log.schema)
        process.run_to_end(replication.replicate_sink(stream, target, KEYS, VALUES, folder))
        replication.compact_replica(spark, target, KEYS, VALUES)
    replication.vacuum_replica(spark, target)
    return replication.read_replica(spark, target, KEYS, VALUES)


@query
def stream_forgetful_latest(spark, sf_dir):
    """The stateful image whose state forgets keys a day behind; the stream comes in order."""
    out, folder = run_dir(spark, "updates"), run_dir(spark, "query")
    path, log = run_dir(spark, "log"), views.change_log(spark, sf_dir)
    number = F.col("sequence_number").cast("bigint")
    bounds = log.agg(F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    middle = (bounds["lo"] + bounds["hi"]) // 2
    for part in (number <= middle, number > middle):
        log.filter(part).coalesce(1).write.mode("append").parquet(path)
        stream = tables.stream_change_log(spark, path, log.schema, max_files_per_trigger=1)
        process.run_to_end(process.update_sink(replication.stateful_latest(stream, KEYS, VALUES, forget="24 hours"), out, folder))
    return replication.newest_updates(spark.read.parquet(out), KEYS, VALUES)


@query
def read_indexed(spark, sf_dir):
    """One lagging shard among finished ones reads the files that hold its records, and no others."""
    path = run_dir(spark, "log")
    log = views.change_log(spark, sf_dir).select(*RECORD, "arrival_ts", "event_name")
    tables.write_change_log(log, path, partitions=16)
    tables.index_change_log(spark, path)
    rows = views.as_progress(views.all_shards(spark, sf_dir), "late")
    first = rows.agg(F.min(F.struct(*SHARD)).alias("f")).select("f.*")
    lagging = first.select(*SHARD, F.lit(fixed.TRIM_HORIZON).alias("checkpoint"))
    rest = rows.join(first, SHARD, "left_anti").select(*SHARD, F.lit(fixed.SHARD_END).alias("checkpoint"))
    every = lagging.unionByName(rest)
    chosen, held = tables.files_to_read(spark, path, every), spark.read.parquet(path).inputFiles()
    fewer = F.lit(len(chosen) < len(held) // 2)
    return tables.read_change_log(spark, path, every).select(*RECORD, fewer.alias("fewer_files"))


@query
def flatten_inferred(spark, sf_dir):
    """Columns found in the data: whole numbers, fractions, and an attribute of two types."""
    log = views.change_log(spark, sf_dir)
    even = F.col("key_id") % 2 == 0
    image = attributes.build_image({
        "id": ("key_id", "N"), "kind": ("new_event_type", "S"), "value": ("new_value", "N"),
        "mixed": (F.when(even, F.col("new_k")), "N"),
    })
    other = attributes.build_image({
        "id": ("key_id", "N"), "kind": ("new_event_type", "S"), "value": ("new_value", "N"),
        "mixed": (F.col("new_k").cast("string"), "S"),
    })
    images = log.select("sequence_number", F.when(even, image).otherwise(other).alias("image"))
    return attributes.flatten_image(images, "image", attributes.infer_attributes(images, "image"), keep=["sequence_number"])
