"""Schemas found in images, indexed logs, and state that is forgotten."""

from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions import attributes as A
from tideline.plans import views
from tideline.sources import tables
from tideline.streaming import process, replication


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")


def image_of(spark, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return df.select(F.from_json("t", "map<string,variant>").alias("image"))


def test_inferred_columns(spark):
    df = image_of(
        spark,
        '{"a":{"N":"1"},"big":{"N":"123456789012345678901234567890"},"f":{"N":"1.5"},"mix":{"S":"x"},"gone":{"NULL":true}}',
        '{"a":{"N":"-7"},"f":{"N":"2"},"mix":{"N":"3"},"gone":{"S":"y"},"only":{"NULL":true},"m":{"M":{"k":{"N":"1"}}}}',
        '{"big":{"N":"1"},"exact":{"N":"0.1234567890123456789"}}',
        None,
    )
    schema = A.infer_attributes(df, "image")
    assert schema == {
        "a": ("a", "N", "bigint"), "big": ("big", "N"), "exact": ("exact", "N"), "f": ("f", "N", "double"), "gone": ("gone", "S"),
        "m": ("m", "M"), "mix_N": ("mix", "N", "bigint"), "mix_S": ("mix", "S"), "only": ("only", "NULL"),
    }
    flat = A.flatten_image(df, "image", schema).collect()
    assert [r["mix_S"] for r in flat] == ["x", None, None, None] and [r["a"] for r in flat] == [1, -7, None, None]
    assert [r["big"] for r in flat][0] == "123456789012345678901234567890"
    assert A.infer_attributes(df.filter("image IS NULL"), "image") == {}


def progress_of(spark, *rows):
    return spark.createDataFrame([("s", k, v) for k, v in rows], "stream string, shard_id string, checkpoint string")


def test_an_indexed_log_reads_the_files_of_each_position(spark, folder):
    rows = spark.range(300).select(
        F.lit("s").alias("stream"), F.format_string("k%d", F.col("id") % 3).alias("shard_id"),
        F.col("id").cast("string").alias("sequence_number"), F.lit("2024-01-05").cast("timestamp").alias("arrival_ts"),
    )
    tables.write_change_log(rows.filter("sequence_number < 200"), folder, partitions=6)
    assert tables.files_to_read(spark, folder, progress_of(spark, ("k0", "1"))) is None
    tables.index_change_log(spark, folder)
    files = lambda *p: {tables._name(f) for f in tables.files_to_read(spark, folder, progress_of(spark, *p))}
    held = lambda: {tables._name(f) for f in spark.read.parquet(folder).inputFiles()}
    assert not files(("k0", fixed.SHARD_END), ("k1", fixed.LATEST), ("k2", "500"))
    lagging = files(("k0", "0"), ("k1", "200"), ("k2", "200"))
    mine = spark.read.parquet(folder).filter("shard_id = 'k0'").select("_metadata.file_path").distinct().collect()
    assert lagging == {tables._name(r[0]) for r in mine} < held()
    before = held()
    tables.write_change_log(rows.filter("sequence_number >= 200"), folder, partitions=2)  # not indexed yet
    assert files(("k2", "500")) == held() - before
    progress = progress_of(spark, ("k0", "150"), ("k1", fixed.SHARD_END), ("k2", "297"))
    want = {("k0", n) for n in range(153, 300, 3)}
    for _ in range(2):
        got = tables.read_change_log(spark, folder, progress).collect()
        assert {(r["shard_id"], int(r["sequence_number"])) for r in got} == want | {("k2", 299)}
        tables.index_change_log(spark, folder)
    assert tables.read_change_log(spark, folder, progress_of(spark, ("k1", "999"))).count() == 0


def test_forgetting_keeps_the_image_and_bounds_the_state(spark, folder):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    log = views.as_change_log(events, users_per_stream=None).select("stream", "shard_id", "sequence_number", "event_name", "arrival_ts", "key_id", "new_value")
    number = F.col("sequence_number").cast("bigint")
    low, high = log.agg(F.min(number), F.max(number)).first()
    for k in range(6):  # in order
        log.filter(F.floor((number - low) * 6 / (high - low + 1)) == k).coalesce(1).write.mode("append").parquet(f"{folder}/log")
    images, states = [], []
    for forget in (None, "24 hours"):
        stream = tables.stream_change_log(spark, f"{folder}/log", log.schema, max_files_per_trigger=1)
        running = replication.stateful_latest(stream, ["key_id"], ["new_value"], forget)
        out = f"{folder}/out-{forget is None}"
        query = process.run_to_end(process.update_sink(running, out, f"{folder}/state-{forget is None}"))
        states.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
        rows = replication.newest_updates(spark.read.parquet(out), ["key_id"], ["new_value"]).collect()
        images.append({r["key_id"]: r["new_value"] for r in rows})
    assert images[0] == images[1] and images[0]
    assert states[1] < states[0]
