"""Change log, shard catalog, progress and error log derived from the given tables.

Users are grouped into streams, so the number of streams and shards grows with the data. A
stream passes through five generations of shards: split, rollover, merge, split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.attributes import build_typed_image
from tideline.operators import SHARD
from tideline.operators.lineage import SHARD_COLUMNS
from tideline.scale import cut, run_dir

USERS_PER_STREAM = 10
BUCKETS = (2, 4, 4, 2, 4)
SEQUENCE_OFFSET = 99500  # widths change inside the log, so text order is wrong on purpose
FIRST_DAY_MS = 1704067200000
GENERATION_MS = 6 * 86400 * 1000
PAGE = 5
NOW = "TIMESTAMP_NTZ '2024-01-31 00:00:00'"


def _bigint(value) -> Column:
    return F.lit(value).cast("bigint")


def _pick(values: tuple, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index)


def _shard_id(gen: Column, bucket: Column, stream_no: Column) -> Column:
    ms = F.lit(FIRST_DAY_MS) + gen.cast("bigint") * F.lit(GENERATION_MS)
    return F.concat(
        F.lit("shardId-"),
        F.lpad(ms.cast("string"), 20, "0"),
        F.lit("-"),
        F.format_string("%08d", (stream_no * 8 + bucket).cast("bigint")),
    )


def as_change_log(events: DataFrame, users_per_stream: int | None = USERS_PER_STREAM) -> DataFrame:
    """Events as change records; a pure projection, for batch and stream alike."""
    stream_no = _bigint(0)
    if users_per_stream:
        stream_no = F.floor(F.col("user_id") / users_per_stream).cast("bigint")
    gen = F.least(F.lit(4), F.floor((F.dayofmonth("ts") - 1) / 6).cast("int"))
    bucket = F.col("user_id") % _pick(BUCKETS, gen)
    name = (
        F.when(F.col("event_type").isin("signup", "purchase"), fixed.INSERT)
        .when(F.col("event_type").isin("view", "click"), fixed.MODIFY)
        .otherwise(fixed.REMOVE)
    )
    kept = F.col("event_type") != "error"
    number = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        F.concat(F.lit("s"), stream_no.cast("string")).alias("stream"),
        stream_no.alias("stream_no"),
        gen.alias("gen"),
        bucket.alias("bucket"),
        _shard_id(gen, bucket, stream_no).alias("shard_id"),
        (F.col("event_id") + SEQUENCE_OFFSET).cast("string").alias("sequence_number"),
        name.alias("event_name"),
        F.col("user_id").alias("key_id"),
        F.col("ts").alias("arrival_ts"),
        F.when(kept, F.col("event_type")).alias("new_event_type"),
        F.when(kept, F.col("value")).alias("new_value"),
        F.when(kept, number).alias("new_k"),
    )


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_change_log(spark.read.parquet(f"{sf_dir}/events.parquet"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log as a stream over the events table."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return as_change_log(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parquet*"))


def stored_stream(spark: SparkSession, sf_dir: str, files: int = 4, per_trigger: int = 1) -> DataFrame:
    """The change log as a stream of several files, read a few at a time."""
    log = change_log(spark, sf_dir)
    path = run_dir(spark, "log")
    log.repartitionByRange(files, F.col("sequence_number").cast("bigint")).write.parquet(path)
    reader = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(path)


def stored_runs(spark: SparkSession, sf_dir: str, order: tuple[int, ...], of: int) -> tuple[str, DataFrame]:
    """The log in ``of`` files of consecutive records, written in the given order, with repeats; and the log."""
    log = change_log(spark, sf_dir).select(*SHARD, "sequence_number", "event_name", "arrival_ts")
    path, number = run_dir(spark, "runs"), F.col("sequence_number").cast("bigint")
    bounds = log.agg(F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    width = (bounds["hi"] - bounds["lo"]) // of + 1
    for part in order:
        low = bounds["lo"] + part * width
        log.filter(number.between(low, low + width - 1)).coalesce(1).write.mode("append").parquet(path)
    return path, log


def as_skewed(log: DataFrame) -> DataFrame:
    """Nine in ten records moved to one shard, and half of these to one key."""
    hot = F.col("sequence_number").cast("bigint") % 10 > 0
    hot_key = hot & (F.col("sequence_number").cast("bigint") % 2 == 0)
    return log.withColumns(
        {
            "stream": F.when(hot, "s0").otherwise(F.col("stream")),
            "shard_id": F.when(hot, _shard_id(F.lit(0), _bigint(0), _bigint(0))).otherwise(F.col("shard_id")),
            "key_id": F.when(hot_key, _bigint(0)).otherwise(F.col("key_id")),
        }
    )


def with_odd_payloads(payloads: DataFrame) -> DataFrame:
    """Payloads with every third in capitals, and some null, empty, blank and torn ones."""
    n = F.col("sequence_number").cast("bigint")
    text = F.col("data").cast("string")
    capital = text
    for name in (fixed.EVENT_ID, fixed.EVENT_NAME, fixed.BODY, fixed.SEQUENCE_NUMBER, fixed.NEW_IMAGE):
        for spelt in (name[0].lower() + name[1:], name[0].upper() + name[1:]):
            capital = F.replace(capital, F.lit(f'"{spelt}":'), F.lit(f'"{name.upper()}":'))
    odd = (
        F.when(n % 50 == 1, F.lit(None).cast("string"))
        .when(n % 50 == 2, F.lit(""))
        .when(n % 50 == 3, F.lit("  "))
        .when(n % 50 == 4, F.concat(F.lit("{"), text))
        .when(n % 3 == 0, capital)
        .otherwise(text)
    )
    return payloads.withColumn("data", odd.cast("binary"))


def as_generations(log: DataFrame) -> DataFrame:
    """Sequence range of each stream's generations."""
    number = F.col("sequence_number").cast("bigint")
    return log.groupBy("stream", "stream_no", "gen").agg(
        F.min(number).alias("lo"), F.max(number).alias("hi")
    )


def as_shards(generations: DataFrame) -> DataFrame:
    """Catalog columns plus stream_no, gen, bucket and the generation's middle number."""
    gen, bucket, no = F.col("gen"), F.col("bucket"), F.col("stream_no")
    buckets = F.sequence(_bigint(0), (_pick(BUCKETS, gen) - 1).cast("bigint"))
    parent_bucket = F.when(gen.isin(1, 4), bucket % 2).otherwise(bucket)
    end = F.when(gen < 4, F.col("hi").cast("string"))
    return generations.withColumn("bucket", F.explode(buckets)).select(
        "stream",
        _shard_id(gen, bucket, no).alias("shard_id"),
        F.when(gen > 0, _shard_id(gen - 1, parent_bucket, no)).alias("parent_shard_id"),
        F.when(gen == 3, _shard_id(gen - 1, bucket + 2, no)).alias("adjacent_parent_shard_id"),
        F.col("lo").cast("string").alias("starting_sequence_number"),
        end.alias("ending_sequence_number"),
        F.lit(fixed.MIN_HASH_KEY).alias("starting_hash_key"),
        F.lit(fixed.MAX_HASH_KEY).alias("ending_hash_key"),
        "stream_no",
        "gen",
        "bucket",
        F.floor((F.col("lo") + F.col("hi")) / 2).cast("bigint").cast("string").alias("middle"),
    )


def all_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived catalog, stored once as a catalog table would be."""
    return cut(as_shards(as_generations(change_log(spark, sf_dir))))


def shards_trimmed(shards: DataFrame) -> DataFrame:
    """Oldest generation gone: parents that are no longer listed."""
    return shards.filter("gen > 0")


def shards_open_parent(shards: DataFrame) -> DataFrame:
    """Generation 3 still open: children of open parents."""
    end = F.when(F.col("gen") != 3, F.col("ending_sequence_number"))
    return shards.withColumn("ending_sequence_number", end)


def shards_gap(shards: DataFrame) -> DataFrame:
    """Newest generation missing: closed leaves."""
    return shards.filter("gen < 4")


def shards_narrow(shards: DataFrame) -> DataFrame:
    """Children of one bucket cover only the lower half of the hash range."""
    half = "170141183460469231731687303715884105727"
    narrow = (F.col("gen") == 4) & (F.col("bucket") % 2 == 1)
    return shards.withColumn(
        "ending_hash_key", F.when(narrow, half).otherwise(F.col("ending_hash_key"))
    )


def as_pages(shards: DataFrame, mixed_order: bool = False) -> DataFrame:
    """Listing of each stream in shard-id order, a few shards per page.

    The position follows from generation and bucket, without ranking. ``mixed_order`` lists odd
    streams backwards, children before their parents.
    """
    before = _pick((0, 2, 6, 10, 12), F.col("gen"))
    rank = (before + F.col("bucket")).cast("bigint")
    if mixed_order:
        rank = F.when(F.col("stream_no") % 2 == 1, F.lit(15) - rank).otherwise(rank)
    return shards.select(
        *SHARD_COLUMNS,
        F.floor(rank / PAGE).cast("bigint").alias("page_no"),
        (rank % PAGE).alias("pos"),
    )


def _row(shards: DataFrame, condition: str, checkpoint: Column) -> DataFrame:
    return shards.filter(condition).select(
        *SHARD,
        F.array_compact(F.array("parent_shard_id", "adjacent_parent_shard_id")).alias(
            "parent_shard_ids"
        ),
        checkpoint.alias("checkpoint"),
        _bigint(0).alias("owner_switches"),
    )


def _orphans(shards: DataFrame) -> DataFrame:
    """Two rows per stream whose shard and parents are in no catalog."""
    heads = shards.filter("gen = 0 AND bucket = 0")
    n = F.explode(F.sequence(_bigint(1), _bigint(2)))
    return heads.select("stream", n.alias("n")).select(
        "stream",
        F.concat(F.lit("gone-"), F.col("n").cast("string")).alias("shard_id"),
        F.array(F.concat(F.lit("gone-parent-"), F.col("n").cast("string"))).alias(
            "parent_shard_ids"
        ),
        F.lit(fixed.SHARD_END).alias("checkpoint"),
        _bigint(0).alias("owner_switches"),
    )


def as_progress(shards: DataFrame, profile: str) -> DataFrame:
    """Progress rows of a profile; ``mixed`` gives stream n the profile n mod 4."""
    if profile == "mixed":
        names = ("none", "mid", "late", "partial")
        parts = [
            as_progress(shards.filter(f"stream_no % 4 = {i}"), name)
            for i, name in enumerate(names)
        ]
        return reduce(DataFrame.unionByName, parts)
    end, middle = F.lit(fixed.SHARD_END), F.col("middle")
    if profile == "none":
        return _row(shards, "FALSE", end)
    if profile == "mid":
        return _row(shards, "gen = 1", end).unionByName(
            _row(shards, "gen = 2 AND bucket < 2", middle)
        )
    if profile == "partial":
        return _row(shards, "gen = 2 AND bucket = 0", middle)
    if profile == "late":
        return (
            _row(shards, "gen < 3 OR (gen = 3 AND bucket = 0)", end)
            .unionByName(_row(shards, "gen = 3 AND bucket = 1", middle))
            .unionByName(_orphans(shards))
        )
    raise ValueError(f"unknown profile {profile!r}")


def as_reading(shards: DataFrame) -> DataFrame:
    """Progress with every kind of checkpoint, for positioned reads."""
    checkpoint = (
        F.when(F.col("gen") == 0, fixed.SHARD_END)
        .when(F.col("gen") == 1, fixed.TRIM_HORIZON)
        .when(F.col("gen") == 2, F.col("middle"))
        .when(F.col("gen") == 3, fixed.AT_TIMESTAMP)
        .when(F.col("bucket") == 0, fixed.LATEST)
        .otherwise(F.col("middle"))
    )
    return _row(shards, "NOT (gen = 4 AND bucket = 3)", checkpoint)


def as_records_json(log: DataFrame) -> DataFrame:
    """Payloads in tagged-union form, half with upper- and half with lower-case initials."""
    tag = F.struct
    keys = F.struct(tag(F.col("key_id").cast("string").alias("N")).alias("key_id"))
    image = F.when(
        F.col("new_value").isNotNull(),
        F.struct(
            tag(F.col("key_id").cast("string").alias("N")).alias("key_id"),
            tag(F.col("new_event_type").alias("S")).alias("event_type"),
            tag(F.col("new_value").cast("string").alias("N")).alias("value"),
            tag(F.base64(F.encode("new_event_type", "UTF-8")).alias("B")).alias("raw"),
            tag((F.col("new_value") > 20).alias("BOOL")).alias("large"),
            tag(F.lit(True).alias("NULL")).alias("nothing"),
            tag(F.array(F.lit("tag"), F.col("new_event_type")).alias("SS")).alias("tags"),
            tag(F.array(F.col("new_k").cast("string")).alias("NS")).alias("numbers"),
            tag(F.array(F.base64(F.encode("new_event_type", "UTF-8"))).alias("BS")).alias("blobs"),
            tag(F.struct(tag(F.col("new_k").cast("string").alias("N")).alias("k")).alias("M")).alias(
                "detail"
            ),
            tag(
                F.array(
                    F.to_variant_object(tag(F.col("new_event_type").alias("S"))),
                    F.to_variant_object(tag(F.col("new_k").cast("string").alias("N"))),
                ).alias("L")
            ).alias("parts"),
        ),
    )
    seconds = F.unix_micros(F.col("arrival_ts").cast("timestamp")).cast("decimal(20,0)")
    seconds = (seconds / F.lit(1000000)).cast("decimal(20,6)")

    def record(initial) -> Column:
        body = F.struct(
            F.lit(64).alias(initial(fixed.SIZE_BYTES)),
            F.col("sequence_number").alias(initial(fixed.SEQUENCE_NUMBER)),
            F.lit("NEW_IMAGE").alias(initial(fixed.VIEW_TYPE)),
            F.col("_keys").alias(initial(fixed.KEYS)),
            F.col("_image").alias(initial(fixed.NEW_IMAGE)),
            F.col("_seconds").alias(initial(fixed.CREATION_TIME)),
        )
        return F.to_json(
            F.struct(
                F.concat(F.lit("ev-"), F.col("sequence_number")).alias(initial(fixed.EVENT_ID)),
                F.col("event_name").alias(initial(fixed.EVENT_NAME)),
                F.lit("1.1").alias(initial(fixed.EVENT_VERSION)),
                F.struct(F.lit("someone").alias("principalId")).alias("userIdentity"),
                F.lit(1).alias("unknownField"),
                body.alias(fixed.BODY),
            )
        )

    even = F.col("sequence_number").cast("bigint") % 2 == 0
    text = F.when(even, record(lambda s: s[0].upper() + s[1:])).otherwise(
        record(lambda s: s[0].lower() + s[1:])
    )
    parts = log.withColumns({"_keys": keys, "_image": image, "_seconds": seconds})
    return parts.select(
        *SHARD, "sequence_number", "arrival_ts", F.encode(text, "UTF-8").alias("data")
    )


def as_envelopes(log: DataFrame) -> DataFrame:
    """Change records as envelope columns with images, ready to be encoded."""
    kept = F.col("new_value").isNotNull()
    image = build_typed_image(
        {
            "key_id": (F.col("key_id"), "N"),
            "event_type": (F.col("new_event_type"), "S"),
            "value": (F.col("new_value"), "N"),
            "raw": (F.encode("new_event_type", "UTF-8"), "B"),
            "large": (F.col("new_value") > 20, "BOOL"),
        }
    )
    return log.select(
        *SHARD,
        F.concat(F.lit("ev-"), F.col("sequence_number")).alias("event_id"),
        "event_name",
        F.lit("1.1").alias("event_version"),
        "sequence_number",
        F.col("key_id").alias("size_bytes"),
        F.lit("NEW_IMAGE").alias("stream_view_type"),
        build_typed_image({"key_id": (F.col("key_id"), "N")}).alias("keys"),
        F.when(kept, image).alias("new_image"),
        F.col("arrival_ts").cast("timestamp").alias("approximate_creation_ts"),
    )


def as_streams(shards: DataFrame) -> DataFrame:
    """One row per stream: address, status cycling over the known ones, creation time."""
    heads = shards.filter("gen = 0 AND bucket = 0")
    statuses = ("ENABLED", "ENABLING", "DISABLED", "DISABLING", "ENABLED")
    return heads.select(
        F.col("stream").alias("arn"),
        _pick(statuses, (F.col("stream_no") % 5).cast("int")).alias("status"),
        (F.lit("2024-01-01").cast("timestamp_ntz")).alias("creation_ts"),
    )


APIS = ("DescribeStream", "GetRecords", "GetShardIterator", "ListStreams", "PutRecord")
ERRORS = (
    "InternalServerError",
    "ResourceNotFound",
    "Throttled",
    "ExpiredIterator",
    "LimitExceeded",
    "TrimmedDataAccess",
    "Other",
)


def api_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An error log with one row per event, over all APIs and error kinds."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n = F.col("event_id")
    kind = _pick(ERRORS, (F.floor(n / 5) % 7).cast("int"))
    throttled = kind == "Throttled"
    return events.select(
        F.concat(F.lit("req-"), n.cast("string")).alias("request_id"),
        _pick(APIS, (n % 5).cast("int")).alias("api"),
        F.when(throttled, "ClientError").otherwise(kind).alias("error_type"),
        F.when(throttled, "ThrottlingException").otherwise(F.concat(kind, F.lit("Exception"))).alias(
            "error_code"
        ),
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("message"),
        F.when(kind == "InternalServerError", 500).otherwise(400).alias("status"),
        F.when(F.floor(n / 35) % 2 == 0, fixed.TRIM_HORIZON)
        .otherwise("AFTER_SEQUENCE_NUMBER")
        .alias("iterator_type"),
    )
