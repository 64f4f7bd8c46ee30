"""The parent/child graph of shards: assembling, repairing and checking it.

``pages`` are listed shards with ``page_no`` and ``pos``; ``shards`` is a catalog with one row
per shard. Both carry stream, shard_id, parent_shard_id, adjacent_parent_shard_id,
starting_sequence_number, ending_sequence_number, starting_hash_key and ending_hash_key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.ordering import sequence_key
from tideline.functions.shards import is_closed, parent_ids
from tideline.operators import SHARD
from tideline.scale import cut, step, step_counting

SHARD_COLUMNS = [
    "stream",
    "shard_id",
    "parent_shard_id",
    "adjacent_parent_shard_id",
    "starting_sequence_number",
    "ending_sequence_number",
    "starting_hash_key",
    "ending_hash_key",
]


def _listed_at() -> Column:
    return F.struct(F.col("page_no").cast("bigint"), F.col("pos").cast("bigint"))


def _each_parent(name: str) -> Column:
    """A row per parent, the second parent of a merge included."""
    return F.explode(F.array_distinct(parent_ids())).alias(name)


def _last_listing(pages: DataFrame) -> DataFrame:
    rest = [c for c in SHARD_COLUMNS if c not in SHARD]
    return (
        pages.groupBy(*SHARD)
        .agg(F.max_by(F.struct(*rest), _listed_at()).alias("s"), F.max(_listed_at()).alias("_at"))
        .select(*SHARD, "s.*", "_at")
    )


def assemble_shard_catalog(pages: DataFrame) -> DataFrame:
    """One row per shard; a shard listed again is replaced by its last listing."""
    return _last_listing(pages).drop("_at")


def collect_all_pages(pages: DataFrame, stream: str) -> DataFrame:
    """All shards of one stream, whatever the page; a page row holds its ``shards`` array."""
    return pages.filter(F.col("stream") == stream).select(F.explode("shards").alias("s")).select("s.*")


def _with_children(pages: DataFrame, ordered: bool) -> DataFrame:
    """Catalog plus ``_has_child``: some child was listed after the shard's last listing."""
    last_child = (
        pages.select("stream", _each_parent("shard_id"), _listed_at().alias("_listed"))
        .groupBy(*SHARD)
        .agg(F.max("_listed").alias("_child_at"))
    )
    seen = F.col("_child_at") > F.col("_at") if ordered else F.col("_child_at").isNotNull()
    return (
        _last_listing(pages)
        .join(last_child, SHARD, "left")
        .withColumn("_has_child", F.coalesce(seen, F.lit(False)))
        .drop("_at", "_child_at")
    )


def _close_parents(graph: DataFrame) -> DataFrame:
    end = F.col("ending_sequence_number")
    closed = F.when(F.col("_has_child"), F.coalesce(end, F.lit(fixed.SYNTHETIC_END))).otherwise(end)
    return graph.withColumn("ending_sequence_number", closed).drop("_has_child")


def close_open_parents(pages: DataFrame, ordered: bool = True) -> DataFrame:
    """Catalog where an open shard with a child gets a synthetic end.

    By default the child must be listed after its parent; ``ordered=False`` drops that condition.
    """
    return _close_parents(_with_children(pages, ordered))


def closed_leaf_shards(pages: DataFrame, ordered: bool = True) -> DataFrame:
    """Closed shards without a child: children the listing has not shown yet."""
    graph = _with_children(pages, ordered)
    return graph.filter(is_closed() & ~F.col("_has_child")).drop("_has_child")


def earliest_closed_leaf(pages: DataFrame) -> DataFrame:
    """Per stream, the smallest closed-leaf id: where the next listing should start."""
    return closed_leaf_shards(pages).groupBy("stream").agg(F.min("shard_id").alias("shard_id"))


def graph_stats(pages: DataFrame) -> DataFrame:
    """Per stream: shards and closed leaves."""
    leaf = is_closed() & ~F.col("_has_child")
    return (
        _with_children(pages, ordered=True)
        .groupBy("stream")
        .agg(F.count("*").alias("shard_count"), F.count_if(leaf).alias("closed_leaf_count"))
    )


def last_fetched(pages: DataFrame) -> DataFrame:
    """Per stream, the last shard of the last non-empty page: the resume cursor."""
    return pages.groupBy("stream").agg(F.max_by("shard_id", _listed_at()).alias("shard_id"))


def extend_closed_leaves(
    pages: DataFrame, refresh_pages: DataFrame, siblings: str = "all"
) -> DataFrame:
    """Repair a catalog: add listed children of closed leaves, then children of those.

    ``refresh_pages`` is a later listing, with an optional ``round_no`` (0-based). A child counts
    only if it is listed after one of its parents became a closed leaf. ``siblings="all"`` adds
    every child of a leaf, ``"first"`` the first one listed. Each step moves forward in the
    listing, so the repair ends by itself, however deep the lineage.
    """
    if siblings not in ("first", "all"):
        raise ValueError("siblings must be 'first' or 'all'")
    graph = cut(_with_children(pages, ordered=True))
    round_no = F.col("round_no") if "round_no" in refresh_pages.columns else F.lit(0)
    at = F.struct(*[c.cast("bigint") for c in (round_no, F.col("page_no"), F.col("pos"))])
    start = F.struct(*[F.lit(-1).cast("bigint") for _ in range(3)])
    listed = cut(refresh_pages.select(*SHARD_COLUMNS, at.alias("_at"), _each_parent("_parent")))

    frontier = graph.filter(is_closed() & ~F.col("_has_child")).select(
        "stream", F.col("shard_id").alias("_parent"), start.alias("_leaf_at")
    )
    found = []
    while True:
        children = listed.join(frontier, ["stream", "_parent"]).filter(F.col("_at") > F.col("_leaf_at"))
        if siblings == "first":
            first = F.min_by(F.struct(*[c for c in SHARD_COLUMNS if c != "stream"], "_at"), F.col("_at"))
            children = children.groupBy("stream", "_parent", "_leaf_at").agg(first.alias("s"))
            children = children.select("stream", "s.*")
        added, n = step(children.select(*SHARD_COLUMNS, "_at").distinct())
        if n == 0:
            break
        found.append(added)
        frontier = added.filter(is_closed()).select(
            "stream", F.col("shard_id").alias("_parent"), F.col("_at").alias("_leaf_at")
        )
    catalog = _close_parents(graph)
    if not found:
        return catalog
    others = [c for c in SHARD_COLUMNS if c not in SHARD]
    additions = (
        reduce(DataFrame.unionByName, found)
        .groupBy(*SHARD)
        .agg(F.max_by(F.struct(*others), F.col("_at")).alias("s"))
        .select(*SHARD, "s.*")
    )
    kept = catalog.select(*SHARD_COLUMNS).join(additions.select(*SHARD), SHARD, "left_anti")
    return kept.unionByName(additions)


def lineage_edges(shards: DataFrame) -> DataFrame:
    """(stream, parent_id, child_id) for parents still in the catalog."""
    known = shards.select("stream", F.col("shard_id").alias("parent_id"))
    listed = shards.select(
        "stream",
        F.explode(F.array_distinct(parent_ids())).alias("parent_id"),
        F.col("shard_id").alias("child_id"),
    )
    return listed.join(known, ["stream", "parent_id"], "left_semi")


def child_sets(shards: DataFrame) -> DataFrame:
    """Children of each shard that has any."""
    return (
        lineage_edges(shards)
        .groupBy("stream", F.col("parent_id").alias("shard_id"))
        .agg(F.collect_set("child_id").alias("children"))
    )


def children_hash_cover(shards: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Each parent's smallest starting and largest ending hash key over its children."""
    child = shards.select(
        "stream",
        F.col("shard_id").alias("child_id"),
        sequence_key("starting_hash_key").alias("low"),
        sequence_key("ending_hash_key").alias("high"),
    )
    return (
        (lineage_edges(shards) if edges is None else edges)
        .join(child, ["stream", "child_id"])
        .groupBy("stream", F.col("parent_id").alias("shard_id"))
        .agg(F.count("*").alias("children"), F.min("low").alias("low"), F.max("high").alias("high"))
    )


def open_shards(shards: DataFrame) -> DataFrame:
    """Shards that still take records."""
    return shards.filter(~is_closed())


def leaf_shards(shards: DataFrame) -> DataFrame:
    """Shards that are nobody's parent, neither first nor second."""
    return shards.join(shards.select("stream", _each_parent("shard_id")), SHARD, "left_anti")


def lookup_shard(shards: DataFrame, stream: str, shard_id: str) -> DataFrame:
    """One shard by id."""
    return shards.filter((F.col("stream") == stream) & (F.col("shard_id") == shard_id))


def reopen_leaf_shards(shards: DataFrame, keep_ancestors: bool = True) -> DataFrame:
    """Catalog of a disabled stream: its leaves are reopened so that they are read to the end.

    ``keep_ancestors=False`` leaves out every other shard.
    """
    leaves = leaf_shards(shards).withColumn("ending_sequence_number", F.lit(None).cast("string"))
    if not keep_ancestors:
        return leaves
    parents = shards.select("stream", _each_parent("shard_id"))
    return leaves.unionByName(shards.join(parents, SHARD, "left_semi"))


def inconsistent_shards(shards: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Children, open or closed, of a parent that is still open."""
    parents = open_shards(shards).select("stream", F.col("shard_id").alias("parent_id"))
    return (
        (lineage_edges(shards) if edges is None else edges)
        .join(parents, ["stream", "parent_id"], "left_semi")
        .select("stream", F.col("child_id").alias("shard_id"))
        .distinct()
    )


def closed_shard_violations(
    shards: DataFrame, progress: DataFrame, edges: DataFrame | None = None
) -> DataFrame:
    """Finished shards the catalog contradicts: not closed, childless, or range not covered."""
    finished = progress.filter(F.col("checkpoint") == fixed.SHARD_END).select(*SHARD)
    low, high = sequence_key("starting_hash_key"), sequence_key("ending_hash_key")
    violation = (
        F.when(~is_closed(), "not_closed")
        .when(F.col("children").isNull(), "no_children")
        .when((F.col("low") > low) | (F.col("high") < high), "hash_range_not_covered")
    )
    return (
        shards.join(finished, SHARD, "left_semi")
        .join(children_hash_cover(shards, edges), SHARD, "left")
        .select(*SHARD, violation.alias("violation"))
        .filter(F.col("violation").isNotNull())
    )


HOPS = 8  # levels of a lineage followed in one step


def follow(frontier: DataFrame, edges: DataFrame, up: bool) -> list[DataFrame]:
    """The next ``HOPS`` levels of (stream, shard_id) above or below a frontier; rows may repeat.

    The joins need no shuffle where ``edges`` is hinted for broadcast; what repeats is removed once
    for all levels by the caller.
    """
    at, to = ("child_id", "parent_id") if up else ("parent_id", "child_id")
    levels = []
    for _ in range(HOPS):
        here = frontier.select("stream", F.col("shard_id").alias(at))
        frontier = here.join(edges, ["stream", at]).select("stream", F.col(to).alias("shard_id"))
        levels.append(frontier)
    return levels


def next_levels(frontier: DataFrame, edges: DataFrame, up: bool, seen: DataFrame) -> tuple[DataFrame, int, bool]:
    """The shards of the next ``HOPS`` levels that are not ``seen``, their number, and whether the climb goes on.

    It does not if none of them is in the last of these levels, which saves a step that finds nothing.
    """
    levels = follow(frontier, edges, up)
    tagged = [df.withColumn("_last", F.lit(i == HOPS - 1)) for i, df in enumerate(levels)]
    reached = reduce(DataFrame.unionByName, tagged).groupBy(*SHARD).agg(F.bool_or("_last").alias("_last"))
    new, n, last = step_counting(reached.join(seen, SHARD, "left_anti"), F.col("_last"))
    return new.drop("_last"), n, last > 0


def lineage_depth(shards: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """(stream, shard_id, depth): the longest chain of known ancestors above each shard.

    No chain is longer than the catalog; one that is runs in a circle, and is an error.
    """
    edges = step(lineage_edges(shards))[0] if edges is None else edges
    rooted = edges.select("stream", F.col("child_id").alias("shard_id"))
    level = shards.select(*SHARD).join(rooted, SHARD, "left_anti").distinct()
    found, base, most = [level.withColumn("depth", F.lit(0))], 0, None
    while True:
        below = [
            df.withColumn("depth", F.lit(base + i + 1)) for i, df in enumerate(follow(level, edges, up=False))
        ]
        reached, n, last = step_counting(_deepest(below), F.col("depth") == base + HOPS)
        if n == 0:
            return _deepest(found)
        found.append(reached)
        base += HOPS
        if last == 0:
            return _deepest(found)
        # a shard of the last level has no greater depth in this step
        level = reached.filter(F.col("depth") == base).select(*SHARD)
        if base == 64:
            most = shards.count()
        if most is not None and base > most + HOPS:
            raise RuntimeError("the lineage has a cycle")
        if len(found) % 16 == 0:  # a plan of bounded width
            found = [cut(_deepest(found))]


def _deepest(levels: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, levels).groupBy(*SHARD).agg(F.max("depth").alias("depth"))
