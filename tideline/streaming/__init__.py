"""Change logs as streams: start positions, replication, stateful images, callbacks."""
