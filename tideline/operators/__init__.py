"""DataFrame operators: lineage, progress, positioned reads, replay, metrics, errors.

Every table carries ``stream``; shards are identified by (stream, shard_id), so one job serves
any number of streams.
"""

SHARD = ["stream", "shard_id"]
