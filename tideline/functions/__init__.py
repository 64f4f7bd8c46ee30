"""Column functions: ordering keys, attribute values, record envelopes, shard fields."""
