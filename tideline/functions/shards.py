"""Shard and stream fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.ordering import _col


def normalize_shards(df: DataFrame) -> DataFrame:
    """Shards as listed by the source: no adjacent parent, the whole hash range each."""
    return df.withColumns(
        {
            "adjacent_parent_shard_id": F.lit(None).cast("string"),
            "starting_hash_key": F.lit(fixed.MIN_HASH_KEY),
            "ending_hash_key": F.lit(fixed.MAX_HASH_KEY),
        }
    )


def normalize_stream_status(c: Column | str) -> Column:
    """Source status to consumer status; an unknown status fails the query."""
    c = _col(c)
    text = F.coalesce(c, F.lit("null"))
    branches = iter(fixed.STREAM_STATUS.items())
    source, target = next(branches)
    result = F.when(c == source, target)
    for source, target in branches:
        result = result.when(c == source, target)
    return result.otherwise(F.raise_error(F.concat(F.lit("unknown stream status "), text)))


def is_readable_status(c: Column | str) -> Column:
    """Only streams in a readable (normalised) status yield a catalog."""
    return _col(c).isin(*fixed.READABLE_STATUS)


def readable_streams(streams: DataFrame) -> DataFrame:
    """Streams whose normalised ``status`` allows reading their shards."""
    return streams.filter(is_readable_status("status"))


def is_closed(c: Column | str = "ending_sequence_number") -> Column:
    """A shard is closed once its ending sequence number is known."""
    return _col(c).isNotNull()


def shard_creation_time(c: Column | str = "shard_id") -> Column:
    """Creation time held in the id's second token as epoch milliseconds; else null."""
    token = F.try_element_at(F.split(_col(c), fixed.SHARD_ID_SEPARATOR), F.lit(2))
    return F.timestamp_millis(token.try_cast("bigint"))


def parent_ids() -> Column:
    """Parents as listed on a shard, whether or not they are still in the catalog."""
    return F.array_compact(F.array("parent_shard_id", "adjacent_parent_shard_id"))


def clamp_limit(n: int | None) -> int | None:
    """Limits above the maximum are lowered to it; no limit stays no limit."""
    return None if n is None else min(n, fixed.MAX_RECORDS_PER_READ)
