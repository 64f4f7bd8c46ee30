"""Replay and streams: idempotence, restarts, start positions, stored reads."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from tideline import fixed, scale
from tideline.operators import SHARD, progress, reads, replay
from tideline.plans import views
from tideline.sources import tables
from tideline.streaming import positions, process, replication

KEYS = ["key_id"]
VALUES = ["new_event_type", "new_value"]
COLUMNS = [*SHARD, "sequence_number", "event_name", "arrival_ts", "key_id", *VALUES]


@pytest.fixture(scope="module")
def log(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return views.as_change_log(events, users_per_stream=None).select(*COLUMNS).cache()


@pytest.fixture(scope="module")
def table(log):
    """Brute force: apply the records in order to a dict."""
    state = {}
    for r in sorted(log.collect(), key=lambda r: int(r["sequence_number"])):
        if r["event_name"] == fixed.REMOVE:
            state.pop(r["key_id"], None)
        else:
            state[r["key_id"]] = (r["new_event_type"], r["new_value"])
    return state


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def as_dict(df):
    return {r["key_id"]: (r["new_event_type"], r["new_value"]) for r in df.collect()}


def test_replay_equals_brute_force_in_any_order_and_with_copies(log, table):
    assert as_dict(replay.materialize_table(log, KEYS, VALUES)) == table
    messy = log.unionByName(log.filter("key_id % 2 = 0")).orderBy(F.hash("sequence_number"))
    assert as_dict(replay.materialize_table(messy, KEYS, VALUES)) == table


@pytest.mark.parametrize("cut", ["99499", "99777", "100499"])
def test_replay_in_two_steps(log, table, cut):
    base = replay.materialize_table(log, KEYS, VALUES, until=cut)
    later = reads.read_from(log, "AFTER_SEQUENCE", sequence=cut)
    assert as_dict(replay.materialize_table(later, KEYS, VALUES, base=base)) == table


def test_compare_tables_counts_copies(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "x"), (3, None)], "k int, v string")
    found = {(r["k"], r["side"], r["copies"]) for r in replay.compare_tables(a, b).collect()}
    assert found == {(1, "left", 1), (2, "left", 1), (3, "right", 1)}
    assert replay.compare_tables(a, a).count() == 0


def test_replay_order_is_total(spark, log):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    full = views.as_change_log(events, users_per_stream=None)
    shards = views.as_shards(views.as_generations(full))
    rows = reads.replay_order(full.select(*SHARD, "sequence_number", "gen"), shards).collect()
    keys = [(r["depth"], r["shard_id"], int(r["sequence_number"])) for r in rows]
    assert len(keys) == 1000 and keys == sorted(keys)
    assert all(r["depth"] == r["gen"] for r in rows)


def test_limits_with_a_hot_shard(spark):
    """One shard holds most rows; both the one-pass and the sliced ranking are exact."""
    log = spark.range(0, 6000, 1, 16).selectExpr(
        "'s' AS stream",
        "CASE WHEN id % 20 < 19 THEN 'hot' ELSE concat('cold', id % 3) END AS shard_id",
        "string((id * 7919) % 6000) AS sequence_number",
    )
    for n in (10, 400, 5000):
        got = {}
        for r in reads.limit_per_shard(log, n).collect():
            got.setdefault(r["shard_id"], []).append(int(r["sequence_number"]))
        want = {}
        for r in log.collect():
            want.setdefault(r["shard_id"], []).append(int(r["sequence_number"]))
        want = {k: sorted(v)[:n] for k, v in want.items()}
        assert {k: sorted(v) for k, v in got.items()} == want


def test_salted_join_equals_broadcast_join(log):
    small = log.select(*SHARD).distinct().withColumn("x", F.length("shard_id"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        a = scale.join_bounded(log, small, SHARD, how)
        b = scale.join_bounded(log, small, SHARD, how, max_bytes=1)
        assert replay.compare_tables(a, b).count() == 0


def test_checkpoint_interval(log):
    seqs = {}
    for r in log.collect():
        seqs.setdefault(r["shard_id"], []).append(int(r["sequence_number"]))
    for every in (1, 7, 10, 1000):
        want = {}
        for shard, numbers in seqs.items():
            whole = len(numbers) // every * every
            if whole:
                want[shard] = str(sorted(numbers)[whole - 1])
        got = {r["shard_id"]: r["checkpoint"] for r in progress.progress_checkpoints(log, every).collect()}
        assert got == want


def test_restart_reads_at_most_the_unchecked_records_again(log):
    rows = progress.progress_checkpoints(log, 10)
    left = progress.unprocessed_counts(log, rows)
    assert all(0 < r["records"] < 10 for r in left.collect())


def test_start_positions(log):
    shard = log.first()["shard_id"]
    own = sorted(int(r["sequence_number"]) for r in log.filter(F.col("shard_id") == shard).collect())
    mark = str(own[5])
    schema = "stream string, shard_id string, parent_shard_ids array<string>, checkpoint string, owner_switches bigint"

    def count(checkpoint, **kw):
        rows = log.sparkSession.createDataFrame([("s0", shard, [], checkpoint, 0)], schema)
        return reads.apply_start_positions(log, rows, **kw).count()

    assert count(fixed.TRIM_HORIZON) == len(own)
    assert count(fixed.LATEST) == 0 and count(fixed.SHARD_END) == 0
    assert count(mark) == len(own) - 6 and count(mark, inclusive=True) == len(own) - 5
    assert count("000" + mark) == len(own) - 6
    at = F.lit("2024-01-01").cast("timestamp_ntz")
    assert count(fixed.AT_TIMESTAMP, timestamp=at) == len(own)
    for position, n in (("AT_SEQUENCE", 5), ("AFTER_SEQUENCE", 6)):
        got = reads.read_from(log.filter(F.col("shard_id") == shard), position, sequence=mark)
        assert got.count() == len(own) - n


# Streams


def stream_of(spark, path, log):
    return tables.stream_change_log(spark, path, log.schema, max_files_per_trigger=2)


def test_replica_survives_restart_compaction_and_repeats(spark, log, table, folder):
    path, target = f"{folder}/log", f"{folder}/replica"
    thirds = [log.filter((F.col("sequence_number").cast("bigint") - 99500) % 3 == i) for i in range(3)]
    for i, part in enumerate(thirds):
        tables.write_change_log(part, path)
        writer = replication.replicate_sink(stream_of(spark, path, log), target, KEYS, VALUES, f"{folder}/state")
        process.run_to_end(writer)
        if i == 1:
            replication.compact_replica(spark, target, KEYS, VALUES)
    assert as_dict(replication.read_replica(spark, target, KEYS, VALUES)) == table
    # A second query over everything repeats every record.
    again = replication.replicate_sink(stream_of(spark, path, log), target, KEYS, VALUES, f"{folder}/state2")
    process.run_to_end(again)
    assert as_dict(replication.read_replica(spark, target, KEYS, VALUES)) == table
    replication.compact_replica(spark, target, KEYS, VALUES)
    assert as_dict(replication.read_replica(spark, target, KEYS, VALUES)) == table


def test_stateful_image_over_several_batches(spark, log, table, folder):
    tables.write_change_log(log.orderBy(F.hash("sequence_number")), f"{folder}/log")
    running = replication.stateful_latest(stream_of(spark, f"{folder}/log", log), KEYS, VALUES)
    query = process.run_to_end(process.update_sink(running, f"{folder}/out", f"{folder}/state"))
    assert len(query.recentProgress) > 1
    updates = spark.read.parquet(f"{folder}/out")
    assert as_dict(replication.newest_updates(updates, KEYS, VALUES)) == table


def test_latest_start_survives_a_restart(spark, log, folder):
    path = f"{folder}/log"
    halves = [log.filter("sequence_number < 99800"), log.filter("sequence_number >= 99800")]
    tables.write_change_log(halves[0], path)
    positions.latest_positions(tables.scan_change_log(spark, path)).write.parquet(f"{folder}/start")
    starts = spark.read.parquet(f"{folder}/start")

    def run():
        new = positions.start_stream_at(stream_of(spark, path, log), starts)
        process.run_to_end(
            new.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        )
        return spark.read.schema(new.schema).parquet(f"{folder}/out").count()

    assert run() == 0
    tables.write_change_log(halves[1], path)
    assert run() == halves[1].count()


def test_callbacks(spark, log, folder):
    tables.write_change_log(log, f"{folder}/log")
    closed = log.groupBy(*SHARD).agg(F.max(F.col("sequence_number").cast("bigint")).cast("string").alias("ending_sequence_number"))
    seen, ended, calls = [], [], []

    def on_records(batch, batch_id):
        rows = [(r["shard_id"], int(r["sequence_number"])) for r in batch.collect()]
        assert rows == sorted(rows)
        seen.extend(rows)

    writer = process.process_stream(
        stream_of(spark, f"{folder}/log", log),
        on_records,
        f"{folder}/state",
        closed,
        lambda df, i: ended.extend(r["shard_id"] for r in df.collect()),
        lambda: calls.append("start"),
    )
    process.run_to_end(writer, lambda q: calls.append("stop"))
    assert len(seen) == 1000 and len(set(seen)) == 1000
    assert sorted(ended) == sorted({s for s, _ in seen})
    assert calls == ["start", "stop"]


# Stored reads


@pytest.fixture
def stored(spark, log, folder):
    path = f"{folder}/log"
    tables.write_change_log(log, path, partitions=6)
    return path


def pushed(df, what):
    """What the scan node of the plan says of pushed or partition filters."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.maxMetadataStringLength", 5000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    return scan.split(f"{what}: [", 1)[1].split("]", 1)[0]


def test_positions_reach_the_scan(spark, log, stored):
    later = tables.read_change_log(spark, stored, position="AFTER_SEQUENCE", sequence="100300")
    assert "_sequence_digits" in pushed(later, "PushedFilters") and "_sequence_text" in pushed(later, "PushedFilters")
    assert later.count() == log.filter(F.col("sequence_number").cast("bigint") > 100300).count()

    marks = progress.progress_checkpoints(log, 7)
    got = tables.read_change_log(spark, stored, progress=marks)
    assert "_sequence_digits" in pushed(got, "PushedFilters") and "shard_id" in pushed(got, "PushedFilters")
    assert got.count() == reads.apply_start_positions(log, marks).count()

    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    kept = tables.read_retained(spark, stored, now, hours=48)
    assert "arrival_date" in pushed(kept, "PartitionFilters")
    assert kept.count() == reads.retention_filter(log, now, hours=48).count()
    timed = marks.withColumn("checkpoint", F.lit(fixed.AT_TIMESTAMP))
    since = F.lit("2024-01-25 00:00:00").cast("timestamp_ntz")
    got = tables.read_change_log(spark, stored, progress=timed, timestamp=since)
    assert "arrival_date" in pushed(got, "PartitionFilters")
    assert got.count() == log.filter(F.col("arrival_ts") >= since).count()


def test_fewer_bytes_are_read(spark, log, stored):
    import glob
    import os

    files = [f for f in glob.glob(f"{stored}/*/*.parquet") if os.path.getsize(f)]
    assert len(files) >= 30
    newest = tables.read_change_log(spark, stored, position="AFTER_SEQUENCE", sequence="100480")
    rows = newest.select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < rows < len(files) / 4


@pytest.mark.parametrize("bad", ["abc", None, "AT_TIMESTAMP"])
def test_unreadable_checkpoints_fail(spark, log, stored, folder, bad):
    rows = log.select(*SHARD).distinct().withColumn("checkpoint", F.lit(bad).cast("string"))
    with pytest.raises(Exception, match="unreadable checkpoint"):
        reads.apply_start_positions(log, rows).count()
    with pytest.raises(Exception, match="unreadable checkpoint"):
        positions.start_stream_at(log, rows).count()


def test_resolved_starts(spark, log):
    half = log.filter("sequence_number < 99800")
    shard = half.select(*SHARD).first()
    rows = log.select(*SHARD).distinct().withColumn("checkpoint", F.lit(fixed.LATEST))
    plan = positions.resolve_starts(rows, half)
    want = log.join(half.select(*SHARD, "sequence_number"), [*SHARD, "sequence_number"], "left_anti").count()
    assert positions.start_stream_at(log, plan.starts).count() == want
    old = rows.filter(F.col("shard_id") == shard["shard_id"]).withColumn("checkpoint", F.lit("1"))
    plan = positions.resolve_starts(old, half)
    assert plan.gaps.count() == 1 and plan.starts.first()["checkpoint"] == fixed.TRIM_HORIZON
    with pytest.raises(Exception, match="unable to read more records"):
        positions.resolve_starts(old, half, "fail").starts.collect()


def test_limits_above_the_fetch_limit(log):
    one = log.withColumn("shard_id", F.lit("only"))
    assert reads.limit_per_shard(one, 999).count() == 999
    wide = one.unionByName(one.withColumn("sequence_number", F.concat(F.lit("1"), "sequence_number")))
    assert reads.limit_per_shard(wide, 1500).count() == 1500
    got = {r["sequence_number"] for r in reads.limit_per_shard(wide, 1500).collect()}
    every = sorted((r["sequence_number"] for r in wide.collect()), key=int)
    assert got == set(every[:1500])


def test_unlisted_shards_stay_in_the_order(spark, log):
    shards = spark.createDataFrame(
        [("s0", log.first()["shard_id"], None, None)],
        "stream string, shard_id string, parent_shard_id string, adjacent_parent_shard_id string",
    )
    ordered = reads.replay_order(log, shards, position="place").collect()
    assert len(ordered) == log.count() and sorted(r["place"] for r in ordered) == list(range(len(ordered)))
    listed = [r["place"] for r in ordered if r["depth"] is not None]
    assert min(listed) > max(r["place"] for r in ordered if r["depth"] is None)


def test_salted_join_equals_plain(spark, log):
    small = log.select(*SHARD).distinct().withColumn("mark", F.monotonically_increasing_id())
    for how in ("inner", "left", "left_semi"):
        plain = log.join(small, SHARD, how)
        salted = scale.join_bounded(log, small, SHARD, how, max_bytes=0)
        assert replay.compare_tables(plain, salted).count() == 0


def test_stored_read_with_trim_policy(spark, log, stored):
    shard = log.first()["shard_id"]
    old = spark.createDataFrame(
        [("s0", shard, [], "1", 0)],
        "stream string, shard_id string, parent_shard_ids array<string>, checkpoint string, owner_switches bigint",
    )
    whole = log.filter(F.col("shard_id") == shard).count()
    assert tables.read_change_log(spark, stored, old).count() == whole
    assert tables.read_change_log(spark, stored, old, limit=3).count() == 3
    with pytest.raises(Exception, match="unable to read more records"):
        tables.read_change_log(spark, stored, old, trim_policy="fail").collect()


def test_progress_snapshots(spark, folder):
    rows = spark.createDataFrame(
        [("s", "a", [], "1", 0)],
        "stream string, shard_id string, parent_shard_ids array<string>, checkpoint string, owner_switches bigint",
    )
    path = f"{folder}/progress"
    with pytest.raises(FileNotFoundError):
        tables.read_progress(spark, path)
    assert tables.write_progress(rows, path) == 0
    newer = tables.read_progress(spark, path).withColumn("checkpoint", F.lit("2"))
    assert tables.write_progress(newer, path) == 1
    assert tables.read_progress(spark, path).first()["checkpoint"] == "2"
    assert tables.read_progress(spark, path, 0).first()["checkpoint"] == "1"


def test_replica_merges_only_touched_keys(spark, log, table, folder):
    path, target = f"{folder}/log", f"{folder}/replica"
    halves = [log.filter("sequence_number < 99800"), log.filter("sequence_number >= 99800")]
    for half in halves:
        tables.write_change_log(half, path)
        writer = replication.replicate_sink(stream_of(spark, path, log), target, KEYS, VALUES, f"{folder}/state")
        process.run_to_end(writer)
        if half is halves[0]:
            replication.compact_replica(spark, target, KEYS, VALUES)
    merged = replication.read_replica(spark, target, KEYS, VALUES)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert as_dict(merged) == table and "BroadcastHashJoin" in plan
    replication.compact_replica(spark, target, KEYS, VALUES)
    assert replication.vacuum_replica(spark, target) > 2
    assert as_dict(replication.read_replica(spark, target, KEYS, VALUES)) == table
