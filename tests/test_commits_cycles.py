"""Commits by several writers, reading in cycles, live state per shard, copies out of order."""

from __future__ import annotations

import random
import shutil
import subprocess
import sys
import tempfile
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tideline import fixed
from tideline.operators import SHARD, replay
from tideline.sources import commits, tables
from tideline.streaming import cycles, process, replication, state

PROGRESS = "stream string, shard_id string, parent_shard_ids array<string>, checkpoint string, owner_switches bigint"
LOG = "stream string, shard_id string, sequence_number string, arrival_ts timestamp"
CATALOG = (
    "stream string, shard_id string, parent_shard_id string, adjacent_parent_shard_id string, "
    "starting_sequence_number string, ending_sequence_number string, starting_hash_key string, ending_hash_key string"
)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def rows_of(spark, *checkpoints):
    return spark.createDataFrame([("s", k, [], v, 0) for k, v in checkpoints], PROGRESS)


def log_of(spark, *records):
    """Records (shard, number), all of one time."""
    rows = spark.createDataFrame([("s", k, str(v)) for k, v in records], "stream string, shard_id string, sequence_number string")
    return rows.withColumn("arrival_ts", F.lit("2024-01-05 00:00:00").cast("timestamp"))


def shard(name, parent=None, end=None):
    return ("s", name, parent, None, "0", end, "0", fixed.MAX_HASH_KEY)


def test_of_writers_at_once_each_gets_a_version_of_its_own(spark, folder):
    with ThreadPoolExecutor(4) as pool:
        write = lambda i: tables.write_progress(rows_of(spark, ("a", str(i))), folder)
        assert sorted(pool.map(write, range(4))) == [0, 1, 2, 3]
    found = {tables.read_progress(spark, folder, v).first()["checkpoint"] for v in range(4)}
    assert found == {"0", "1", "2", "3"}


def test_one_of_two_publishers_wins(spark, folder):
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: commits.publish(spark, folder, 0, {"data": i}), range(8)))
    assert sum(won) == 1 and commits.read_commit(spark, folder, 0) == {"data": won.index(True)}


def test_updates_are_rebased_and_stale_writes_conflict(spark, folder):
    base = tables.write_progress(rows_of(spark, ("a", "1"), ("b", "1")), folder)
    moved = lambda k, v: spark.createDataFrame([("s", k, v)], "stream string, shard_id string, checkpoint string")
    tables.update_progress(spark, folder, lambda rows: cycles.advanced(rows, moved("a", "2")))
    with pytest.raises(commits.CommitConflict):
        tables.write_progress(rows_of(spark, ("b", "9")), folder, base=base)
    tables.update_progress(spark, folder, lambda rows: cycles.advanced(rows, moved("b", "3")))
    assert {r["shard_id"]: r["checkpoint"] for r in tables.read_progress(spark, folder).collect()} == {"a": "2", "b": "3"}
    assert tables.vacuum_progress(spark, folder, keep=1) == 2
    assert tables.read_progress(spark, folder).count() == 2


def test_a_killed_writer_blocks_nobody(spark, folder):
    tables.write_progress(rows_of(spark, ("a", "1")), folder)
    rows_of(spark, ("a", "5")).write.parquet(f"{folder}/data/killed")  # data without a commit
    Path(f"{folder}/_commits/.draft-killed").write_text('{"data"')
    assert commits.versions(spark, folder) == [0]
    assert tables.write_progress(rows_of(spark, ("a", "2")), folder) == 1
    assert tables.read_progress(spark, folder).first()["checkpoint"] == "2"


def test_cycles_end_empty_and_made_up_shards_and_keep_the_order(spark, folder):
    catalog = spark.createDataFrame(
        [shard("a", end="9"), shard("empty", "a", end="8"), shard("b", "empty", end=fixed.SYNTHETIC_END), shard("c", "b")], CATALOG
    )
    log = log_of(spark, *[("a", i) for i in range(1, 6)], *[("b", i) for i in range(11, 15)], *[("c", i) for i in range(21, 24)])
    tables.write_change_log(log, f"{folder}/log")
    seen, ended, calls = [], [], []

    def on_records(batch, cycle):
        seen.append([(r["shard_id"], int(r["sequence_number"])) for r in batch.collect()])

    run = lambda **kw: cycles.read_in_cycles(
        spark, f"{folder}/log", catalog, f"{folder}/progress", on_records, n=2,
        on_shard_end=lambda b, _: ended.extend(r["shard_id"] for r in b.collect()),
        on_start=lambda: calls.append("start"), on_stop=lambda: calls.append("stop"), **kw,
    )
    assert run(max_cycles=2).count == 2
    assert seen == [[("a", 1), ("a", 2)], [("a", 3), ("a", 4)]] and ended == []
    run()
    assert sum(seen, []) == [("a", i) for i in range(1, 6)] + [("b", i) for i in range(11, 15)] + [("c", i) for i in range(21, 24)]
    assert all(len(batch) <= 2 for batch in seen) and ended == ["a", "empty", "b"] and calls == ["start", "stop"] * 2
    rows = {r["shard_id"]: r["checkpoint"] for r in tables.read_progress(spark, f"{folder}/progress").collect()}
    assert rows == {"a": "SHARD_END", "empty": "SHARD_END", "b": "SHARD_END", "c": "23"}
    assert run().count == 0


def test_a_failed_cycle_is_repeated(spark, folder):
    catalog = spark.createDataFrame([shard("a")], CATALOG)
    tables.write_change_log(log_of(spark, ("a", 1), ("a", 2), ("a", 3)), f"{folder}/log")
    seen = []

    def on_records(batch, cycle):
        seen.append([int(r["sequence_number"]) for r in batch.collect()])
        if len(seen) == 2:
            raise RuntimeError("lost")

    run = lambda: cycles.read_in_cycles(spark, f"{folder}/log", catalog, f"{folder}/progress", on_records, n=2)
    with pytest.raises(RuntimeError):
        run()
    run()
    assert seen == [[1, 2], [3], [3]]


@pytest.mark.parametrize("seed", range(3))
def test_checkpoints_do_not_depend_on_batches(spark, seed):
    rng = random.Random(seed)
    records = [(rng.choice("ab"), i) for i in range(40)]
    counts, at = None, 0
    while at < len(records):
        size = rng.choice((1, 3, 9, 14))
        counts = state.count_checkpoints(counts, log_of(spark, *records[at : at + size]), every=4).checkpoint()
        at += size
    for row in counts.collect():
        mine = [n for k, n in records if k == row["shard_id"]]
        whole = len(mine) // 4 * 4
        assert row["records"] == len(mine) and int(row["last"]) == mine[-1]
        assert row["checkpoint"] == (str(mine[whole - 1]) if whole else None)


def test_late_first_copies_are_kept_by_default(spark, folder):
    schema, numbers = LOG, []
    for day, n in ((5, 1), (5, 2), (3, 3), (5, 1)):
        rows = spark.createDataFrame([("s", "a", str(n))], "stream string, shard_id string, sequence_number string")
        rows.withColumn("arrival_ts", F.lit(f"2024-01-0{day} 00:00:00").cast("timestamp")).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/log")
    writer = replay.dedupe_replayed(stream).writeStream.format("parquet").option("path", f"{folder}/out")
    process.run_to_end(writer.option("checkpointLocation", f"{folder}/state"))
    numbers = sorted(r["sequence_number"] for r in spark.read.parquet(f"{folder}/out").collect())
    assert numbers == ["1", "2", "3"]


def test_covered_ranges_are_held_by_groups_of_shards(spark, tmp_path, monkeypatch):
    """The state's rows do not follow the shards; null shards and copies in later runs count as before."""
    monkeypatch.setattr(replay, "SHARD_GROUPS", 4)
    names = [None, *[f"shard{i}" for i in range(30)]]
    schema = "stream string, shard_id string, sequence_number string, run string"
    for number, (low, high) in enumerate([(10, 14), (1, 3), (2, 6), (10, 12)]):
        rows = [("s", name, str(n), f"r{number}") for name in names for n in range(low, high + 1)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/log")
    once = replay.dedupe_replayed(stream, run="run")
    writer = once.writeStream.format("parquet").option("path", f"{tmp_path}/out")
    query = process.run_to_end(writer.option("checkpointLocation", f"{tmp_path}/query"))
    assert 0 < query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 4
    got = sorted((r["shard_id"] or "", int(r["sequence_number"])) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == sorted((name or "", n) for name in names for n in (*range(1, 7), *range(10, 15)))


def test_merged_ranges():
    rng = random.Random(1)
    for _ in range(200):
        ranges = [(a, a + rng.randrange(6)) for a in (rng.randrange(40) for _ in range(rng.randrange(8)))]
        lows, highs = replay.merged_ranges(ranges)
        covered = {x for lo, hi in zip(lows, highs) for x in range(lo, hi + 1)}
        assert covered == {x for lo, hi in ranges for x in range(lo, hi + 1)}
        assert all(b > a + 1 for a, b in zip(highs, lows[1:]))


def test_compaction_writes_touched_buckets_only(spark, folder):
    keys, values = ["k"], ["v"]
    rows = spark.range(64).select(F.col("id").alias("k"), F.lit("INSERT").alias("event_name"), F.lit("1").alias("sequence_number"), F.lit(0).alias("v"))
    target = f"{folder}/replica"
    rows.write.parquet(f"{target}/delta/query=q/batch=0")
    replication.compact_replica(spark, target, keys, values, buckets=8)
    before = commits.read_commit(spark, target, 0)["buckets"]
    rows.filter("k = 5").withColumn("sequence_number", F.lit("2")).withColumn("v", F.lit(7)).write.parquet(f"{target}/delta/query=q/batch=1")
    replication.compact_replica(spark, target, keys, values)
    after = commits.read_commit(spark, target, 1)["buckets"]
    assert len(before) == 8 and sum(after[b] != before[b] for b in before) == 1
    assert replication.vacuum_replica(spark, target) == 3
    assert {r["k"]: r["v"] for r in replication.read_replica(spark, target, keys, values).collect()} == {i: 7 if i == 5 else 0 for i in range(64)}


def test_the_rest_stands_without_the_text_operators(folder):
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "tideline", f"{folder}/tideline", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ("__spark_entry__.py", "corpus_pipeline.py"):
        shutil.copy(root / name, folder)
    code = "import __spark_entry__ as e; print(len(e.queries()), sorted(e.queries()) == sorted(e.oracle_sql()))"
    for _ in range(2):
        said = subprocess.run([sys.executable, "-c", code], cwd=folder, capture_output=True, text=True, check=True).stdout.split()
        assert int(said[0]) > 100 and said[1] == "True"
        Path(f"{folder}/corpus_pipeline.py").unlink(missing_ok=True)
