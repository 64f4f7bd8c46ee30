"""Lineage, repair and planning against brute force on many small random graphs.

Each graph is a stream of its own, so that one job checks all of them.
"""

from __future__ import annotations

import random

import pytest

from tideline import fixed
from tideline.operators import lineage, progress
from test_golden import PAGE_SCHEMA, PROGRESS_SCHEMA, SHARD_SCHEMA

GRAPHS = 150


def random_graph(rng):
    """{id: (parents, open)} with up to two parents, some of them trimmed."""
    n = rng.randint(1, 12)
    graph = {}
    for i in range(n):
        pool = [f"n{j}" for j in range(i)] + ["gone"]
        parents = rng.sample(pool, min(len(pool), rng.choice([0, 1, 1, 2])))
        graph[f"n{i}"] = (parents, rng.random() < 0.4)
    return graph


def brute_plan(graph, tracked, torn, position):
    known = {s: [p for p in parents if p in graph] for s, (parents, _) in graph.items()}

    def read_from_start(s):
        return position != fixed.LATEST or s in tracked or any(read_from_start(p) for p in known[s])

    seeds = [s for s, (_, is_open) in graph.items() if is_open and s not in tracked and s not in torn]
    reached, todo = set(), list(seeds)
    while todo:
        s = todo.pop()
        if s not in reached:
            reached.add(s)
            todo += [] if s in tracked else known[s]
    wanted = set(seeds)
    for s in reached - tracked:
        if any(read_from_start(p) for p in known[s]):
            wanted |= set(known[s]) - tracked
    start = fixed.TRIM_HORIZON
    return {s: start if position != fixed.AT_TIMESTAMP and read_from_start(s) else position for s in wanted}


@pytest.fixture(scope="module")
def graphs():
    rng = random.Random(7)
    made = []
    for k in range(GRAPHS):
        graph = random_graph(rng)
        tracked = {s for s in graph if rng.random() < 0.25}
        torn = {s for s in graph if rng.random() < 0.1}
        made.append((f"s{k}", graph, tracked, torn))
    return made


@pytest.fixture(scope="module")
def catalog(spark, graphs):
    rows = []
    for stream, graph, _, _ in graphs:
        for s, (parents, is_open) in graph.items():
            first, second = (parents + [None, None])[:2]
            rows.append((stream, s, first, second, "1", None if is_open else "2", "0", "9"))
    return spark.createDataFrame(rows, SHARD_SCHEMA).cache()


@pytest.mark.parametrize("position", [fixed.LATEST, fixed.TRIM_HORIZON, fixed.AT_TIMESTAMP])
def test_plans(spark, graphs, catalog, position):
    rows = [(st, s, [], "5", 0) for st, _, tracked, _ in graphs for s in tracked]
    bad = [(st, s) for st, _, _, torn in graphs for s in torn]
    got = progress.plan_new_progress(
        catalog,
        spark.createDataFrame(rows, PROGRESS_SCHEMA),
        position,
        spark.createDataFrame(bad, "stream string, shard_id string"),
    )
    found: dict = {}
    for r in got.collect():
        assert found.setdefault(r["stream"], {}).setdefault(r["shard_id"], r["checkpoint"]) == r["checkpoint"]
    for stream, graph, tracked, torn in graphs:
        assert found.get(stream, {}) == brute_plan(graph, tracked, torn, position)


def test_depth(graphs, catalog):
    found = {(r["stream"], r["shard_id"]): r["depth"] for r in lineage.lineage_depth(catalog).collect()}
    for stream, graph, _, _ in graphs:
        def depth(s):
            return max((1 + depth(p) for p in graph[s][0] if p in graph), default=0)

        assert {s: found[stream, s] for s in graph} == {s: depth(s) for s in graph}


def listing(rng, ids):
    """A random listing: (id, parent or None, closed), some shards listed twice."""
    parent = {s: rng.choice([None, *ids[:i]]) if i else None for i, s in enumerate(ids)}
    closed = {s: rng.random() < 0.6 for s in ids}
    order = ids + rng.sample(ids, len(ids) // 4)
    if rng.random() < 0.5:
        rng.shuffle(order)
    return [(s, parent[s], closed[s]) for s in order]


def replay_listing(entries, repairs, siblings_first=True):
    """Walk the entries one by one: which shards there are, their ends, and the closed leaves."""
    ends, leaves = {}, set()

    def add(s, parent, closed):
        ends[s] = "2" if closed else None
        if closed:
            leaves.add(s)
        if parent in ends:
            ends[parent] = ends[parent] or fixed.SYNTHETIC_END
            leaves.discard(parent)

    for entry in entries:
        add(*entry)
    first = dict(ends), set(leaves)
    for entry in repairs:
        if entry[1] in leaves:
            add(*entry)
    return (*first, ends)


def test_listings_and_repairs(spark):
    rng = random.Random(11)
    cases, pages, refresh = [], [], []

    def rows(stream, entries):
        return [
            (stream, s, p, None, "1", "2" if closed else None, "0", "9", i // 3, i % 3)
            for i, (s, p, closed) in enumerate(entries)
        ]

    for k in range(GRAPHS):
        ids = [f"n{i}" for i in range(rng.randint(1, 12))]
        entries = listing(rng, ids)
        shown = [e for e in entries if rng.random() < 0.7] or entries[:1]
        later = listing(rng, ids)
        # A shard keeps its parent in the later listing.
        parent = {s: p for s, p, _ in entries}
        later = [(s, parent[s], closed) for s, _, closed in later]
        cases.append((f"s{k}", replay_listing(shown, later)))
        pages += rows(f"s{k}", shown)
        refresh += rows(f"s{k}", later)
    pages, refresh = (spark.createDataFrame(r, PAGE_SCHEMA) for r in (pages, refresh))

    def by_stream(df):
        found: dict = {}
        for r in df.collect():
            found.setdefault(r["stream"], {})[r["shard_id"]] = r["ending_sequence_number"]
        return found

    closed = by_stream(lineage.close_open_parents(pages))
    leaves = by_stream(lineage.closed_leaf_shards(pages))
    repaired = by_stream(lineage.extend_closed_leaves(pages, refresh, siblings="first"))
    for stream, (ends, closed_leaves, after) in cases:
        assert closed[stream] == ends
        assert set(leaves.get(stream, {})) == closed_leaves
        assert set(repaired[stream]) == set(after)
