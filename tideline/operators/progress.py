"""Progress rows: one per tracked shard, with the checkpoint reading has reached.

``progress``: stream, shard_id, parent_shard_ids ARRAY<STRING>, checkpoint, owner_switches. A
checkpoint is a sequence number or one of the sentinels TRIM_HORIZON, LATEST, AT_TIMESTAMP and
SHARD_END.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions.ordering import is_number, sequence_key, sequence_order
from tideline.functions.shards import is_closed, parent_ids, shard_creation_time
from tideline.operators import SHARD
from tideline.operators.lineage import (
    closed_shard_violations,
    inconsistent_shards,
    lineage_edges,
    next_levels,
    open_shards,
)
from tideline.operators.reads import apply_start_positions
from tideline.scale import cut, first_per_group, hint_counted, step

PROGRESS_COLUMNS = [*SHARD, "parent_shard_ids", "checkpoint", "owner_switches"]


def position_to_checkpoint(position: str) -> Column:
    """Checkpoint sentinel of a start position; any other position has none."""
    known = position in (fixed.TRIM_HORIZON, fixed.LATEST, fixed.AT_TIMESTAMP)
    return F.lit(position if known else None).cast("string")


def _visit_ancestors(edges: DataFrame, seeds: DataFrame, tracked: DataFrame) -> DataFrame:
    """(stream, shard_id, tracked) of seeds and their ancestors; tracked shards end the climb.

    No shard is climbed from twice, so the climb ends, however deep the lineage.
    """
    mark, n = step(tracked.select(*SHARD).withColumn("tracked", F.lit(True)))
    ends = mark.select("stream", F.col("shard_id").alias("child_id"))
    # edges above tracked shards are not followed
    climbed, _ = step(edges.join(ends, ["stream", "child_id"], "left_anti"))
    visited, total = step(seeds)
    frontier, steps, more = visited, 0, True
    while more:
        frontier, n, more = next_levels(frontier, climbed, True, hint_counted(visited, total))
        visited, total, steps = visited.unionByName(frontier), total + n, steps + 1
        if steps % 16 == 0:  # a plan of bounded width
            visited = cut(visited)
    marked = visited.join(mark, SHARD, "left")
    return cut(marked.select(*SHARD, F.coalesce("tracked", F.lit(False)).alias("tracked")))


def _flow_down(edges: DataFrame, visited: DataFrame) -> DataFrame:
    """Visited shards that are tracked or descend, within the visited set, from one that is."""
    untracked = visited.filter(~F.col("tracked")).select(
        "stream", F.col("shard_id").alias("child_id")
    )
    inner, _ = step(edges.join(untracked, ["stream", "child_id"], "left_semi"))
    reached, total = step(visited.filter("tracked").select(*SHARD))
    frontier, steps, more = reached, 0, True
    while more:
        frontier, n, more = next_levels(frontier, inner, False, hint_counted(reached, total))
        reached, total, steps = reached.unionByName(frontier), total + n, steps + 1
        if steps % 16 == 0:
            reached = cut(reached)
    return reached


def plan_new_progress(
    shards: DataFrame,
    progress: DataFrame,
    position: str,
    inconsistent: DataFrame | None = None,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Progress rows to create so that every open shard is reached from ``position``.

    Untracked open shards get a row. An ancestor gets one when it must be read first: from
    TRIM_HORIZON or AT_TIMESTAMP that is every ancestor up to a tracked shard; from LATEST it is
    every parent of a shard some of whose ancestors are tracked. Descendants of tracked shards
    are read from their start, other shards from ``position``.
    """
    if position not in (fixed.TRIM_HORIZON, fixed.LATEST, fixed.AT_TIMESTAMP):
        raise ValueError(f"unsupported start position {position!r}")
    edges = step(lineage_edges(shards))[0] if edges is None else edges
    seeds = open_shards(shards).select(*SHARD).join(progress, SHARD, "left_anti")
    if inconsistent is not None:
        seeds = seeds.join(inconsistent, SHARD, "left_anti")
    # steps are cut: joins stacked in one stage each hold a page of memory in the same task
    seeds, _ = step(seeds)
    visited = _visit_ancestors(edges, seeds, progress)
    untracked, _ = step(visited.filter(~F.col("tracked")).select(*SHARD))
    wanted_at = position_to_checkpoint(position)
    if position == fixed.LATEST:
        reached = _flow_down(edges, visited)
        below = reached.select("stream", F.col("shard_id").alias("parent_id"))
        children = untracked.select("stream", F.col("shard_id").alias("child_id"))
        own, _ = step(edges.join(children, ["stream", "child_id"], "left_semi"))
        due, _ = step(own.join(below, ["stream", "parent_id"], "left_semi").select("stream", "child_id"))
        parents = own.join(due, ["stream", "child_id"], "left_semi").select(
            "stream", F.col("parent_id").alias("shard_id")
        )
        wanted, _ = step(seeds.unionByName(parents).distinct().join(progress, SHARD, "left_anti"))
        mark = reached.withColumn("_reached", F.lit(True))
        wanted = wanted.join(mark, SHARD, "left").select(
            *SHARD, F.when(F.col("_reached"), fixed.TRIM_HORIZON).otherwise(wanted_at).alias("checkpoint")
        )
    else:
        wanted = untracked.select(*SHARD, wanted_at.alias("checkpoint"))
    return (
        shards.select(*SHARD, parent_ids().alias("parent_shard_ids"))
        .join(wanted, SHARD)
        .select(*PROGRESS_COLUMNS[:-1], F.lit(0).cast("bigint").alias("owner_switches"))
    )


def order_progress_rows(progress: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows by their shard's starting sequence number, then id; unknown shards come last."""
    start = shards.select(*SHARD, sequence_key("starting_sequence_number").alias("_start"))
    return (
        progress.join(start, SHARD, "left")
        .orderBy(F.col("_start").asc_nulls_last(), "shard_id", "stream")
        .drop("_start")
    )


def _orphans(progress: DataFrame, shards: DataFrame) -> DataFrame:
    """Rows whose shard left the catalog; fails if one of their parents is still in it."""
    gone, _ = step(progress.join(shards.select(*SHARD), SHARD, "left_anti"))
    child = gone.select(
        *SHARD, F.explode(F.array_distinct("parent_shard_ids")).alias("parent_id")
    ).join(
        shards.select("stream", F.col("shard_id").alias("parent_id")),
        ["stream", "parent_id"],
        "left_semi",
    )
    contradicted = child.groupBy(*SHARD).agg(F.min("parent_id").alias("_parent"))
    message = F.concat(
        F.lit("parent shard "), F.col("_parent"), F.lit(" is listed but not its child "), "shard_id"
    )
    valid = F.when(F.col("_parent").isNotNull(), F.raise_error(message).cast("boolean"))
    return (
        gone.join(contradicted, SHARD, "left")
        .filter(F.coalesce(valid, F.lit(True)))
        .select(*progress.columns)
    )


def garbage_progress(
    progress: DataFrame, shards: DataFrame, fresh_shards: DataFrame | None = None
) -> DataFrame:
    """Rows to delete because their shard is gone from both catalogs.

    A row whose shard is gone while a listed parent remains means the catalog is torn: the query
    fails when it meets one.
    """
    garbage = _orphans(progress, shards)
    return garbage if fresh_shards is None else _orphans(garbage, fresh_shards)


def finished_progress(
    progress: DataFrame,
    shards: DataFrame,
    now: Column,
    retention: str = fixed.PROGRESS_RETENTION,
    tracked: DataFrame | None = None,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Rows to delete because reading has moved on to the end of every child.

    The shard is at SHARD_END, has children, all of them are tracked at SHARD_END, and the shard
    is at least ``retention`` old; an id without a readable time does not keep a row.
    """
    tracked = progress if tracked is None else tracked
    ended = tracked.filter(F.col("checkpoint") == fixed.SHARD_END)
    child = ended.select("stream", F.col("shard_id").alias("child_id"), F.lit(True).alias("_ended"))
    done = (
        (lineage_edges(shards) if edges is None else edges)
        .join(child, ["stream", "child_id"], "left")
        .groupBy("stream", F.col("parent_id").alias("shard_id"))
        .agg(F.bool_and(F.coalesce("_ended", F.lit(False))).alias("_all"))
        .filter("_all")
    )
    old_at = shard_creation_time() + F.expr(f"INTERVAL {retention}")
    return (
        progress.filter(F.col("checkpoint") == fixed.SHARD_END)
        .filter(F.coalesce(now >= old_at, F.lit(True)))
        .join(done, SHARD, "left_semi")
    )


def processable_shards(shards: DataFrame, progress: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """Tracked, unfinished shards none of whose known parents is still unfinished."""
    unfinished = progress.filter(F.col("checkpoint") != fixed.SHARD_END)
    parents = unfinished.select("stream", F.col("shard_id").alias("parent_id"))
    blocked = (
        (lineage_edges(shards) if edges is None else edges)
        .join(parents, ["stream", "parent_id"], "left_semi")
        .select("stream", F.col("child_id").alias("shard_id"))
    )
    listed = unfinished.join(shards.select(*SHARD), SHARD, "left_semi")
    return listed.join(blocked, SHARD, "left_anti").select(*SHARD, "checkpoint")


def tracked_progress(progress: DataFrame, new_rows: DataFrame) -> DataFrame:
    """Existing rows and newly planned ones; an existing row is never replaced."""
    return progress.unionByName(new_rows.join(progress.select(*SHARD), SHARD, "left_anti"))


def next_progress(progress: DataFrame, new_rows: DataFrame, deletions: DataFrame) -> DataFrame:
    """The following snapshot: create what is absent, then delete."""
    tracked = tracked_progress(progress, new_rows)
    return tracked.join(deletions.select(*SHARD), SHARD, "left_anti")


class SyncResult(NamedTuple):
    """Outcome of a reconciliation: the next snapshot and the actions behind it."""

    progress: DataFrame
    audit: DataFrame


class TornCatalogError(ValueError):
    """The catalog contradicts itself or the progress; ``violations`` holds all the shards."""

    def __init__(self, message: str, violations: DataFrame):
        super().__init__(message)
        self.violations = violations


def _reject(found: DataFrame, message: str) -> None:
    found, n = step(found)
    if n:
        raise TornCatalogError(f"{n} {message}", found)


def sync_progress(
    shards: DataFrame,
    progress: DataFrame,
    position: str,
    now: Column,
    ignore_unexpected_children: bool = False,
    fresh_shards: DataFrame | None = None,
) -> SyncResult:
    """Reconcile progress with the catalog: plan new rows, drop orphans and finished rows.

    A torn catalog (a child of an open parent, or a finished shard that is open, childless or not
    covered by its children) is rejected before anything is derived from it. Finished rows are
    judged against all rows tracked in this pass, deleted orphans included.
    """
    progress = cut(progress)
    edges, _ = step(lineage_edges(shards))
    inconsistent = cut(inconsistent_shards(shards, edges))
    if not ignore_unexpected_children:
        _reject(inconsistent, "shards with an open parent")
    created = cut(plan_new_progress(shards, progress, position, inconsistent, edges))
    tracked = cut(tracked_progress(progress, created))
    orphans = cut(garbage_progress(tracked, shards, fresh_shards))
    _reject(closed_shard_violations(shards, progress, edges), "finished shards the catalog contradicts")
    finished = cut(finished_progress(progress, shards, now, tracked=tracked, edges=edges))
    deletions = orphans.select(*SHARD).unionByName(finished.select(*SHARD))
    actions = [("create", created), ("delete_orphan", orphans), ("delete_finished", finished)]
    audit = reduce(
        DataFrame.unionByName,
        [df.select(F.lit(name).alias("action"), *SHARD, "checkpoint") for name, df in actions],
    )
    return SyncResult(next_progress(progress, created, deletions), audit)


def progress_checkpoints(log: DataFrame, every: int = fixed.CHECKPOINT_EVERY) -> DataFrame:
    """Per shard, the last record at which a checkpoint every ``every`` records falls.

    That record is followed by (count mod every) others, so it is found among the last ``every``
    of its shard; no shard is ever sorted as a whole.
    """
    counts = log.groupBy(*SHARD).agg(F.count("*").alias("_n"))
    newest_first = [c.desc() for c in sequence_order("sequence_number")]
    last = first_per_group(log.select(*SHARD, "sequence_number"), SHARD, newest_first, every)
    return (
        last.join(counts, SHARD)
        .filter(F.col("_rank") == F.col("_n") % every + 1)
        .select(*SHARD, F.col("sequence_number").alias("checkpoint"))
    )


def unprocessed_counts(log: DataFrame, progress: DataFrame, timestamp: Column | None = None) -> DataFrame:
    """Per shard, the records a restart from ``progress`` would read."""
    left = apply_start_positions(log, progress, timestamp)
    return left.groupBy(*SHARD).agg(F.count("*").alias("records"))


def detect_shard_end(progress: DataFrame, shards: DataFrame, log: DataFrame) -> DataFrame:
    """Progress where closed shards with nothing left to read are moved to SHARD_END.

    Nothing is left when the checkpoint has reached the shard's last retained record, when no
    record is retained, or when reading starts after all of them. AT_TIMESTAMP rows keep their
    place, as only a read can tell.
    """
    last = log.groupBy(*SHARD).agg(F.max(sequence_key("sequence_number")).alias("_last"))
    closed = shards.filter(is_closed()).select(*SHARD, F.lit(True).alias("_closed"))
    checkpoint = F.col("checkpoint")
    numeric = is_number(checkpoint) & (sequence_key(checkpoint) >= F.col("_last"))
    nothing_left = F.when(checkpoint == fixed.AT_TIMESTAMP, False).otherwise(
        F.col("_last").isNull() | (checkpoint == fixed.LATEST) | numeric
    )
    end = F.when(F.col("_closed") & nothing_left, fixed.SHARD_END).otherwise(checkpoint)
    return (
        progress.join(closed, SHARD, "left")
        .join(last, SHARD, "left")
        .withColumn("checkpoint", end)
        .select(*progress.columns)
    )
