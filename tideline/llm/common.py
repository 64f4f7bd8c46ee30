"""Word expressions, null-safe keys, and distributed row numbers and components."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tideline.scale import cut, hint_counted, step

BLANK = r"\x20\x09-\x0D"
BLANKS = " \t\n\x0b\x0c\r"
_ROW_BITS = 33  # of monotonically_increasing_id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_list(text: Column) -> Column:
    """Maximal runs of non-blank characters; none for a null text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    none = F.array().cast("array<string>")
    return F.when(bare == "", none).otherwise(F.split(bare, f"[{BLANK}]+"))


def word_count(text: Column) -> Column:
    return F.size(word_list(text)).cast("bigint")


def null_key(c: str | Column) -> Column:
    """A text that joins and groups like ``c`` but is never null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def ranked(df: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """``df`` with its 0-based position in the given order, without one task seeing all rows.

    Range-partitioned sort, stored once; a row's position is its place in its partition plus the
    sizes of the partitions before. The windowed table has one row per partition.
    """
    placed = cut(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    part = F.shiftrightunsigned("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = placed.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return joined.withColumn(name, F.col("_start") + row).drop("_part", "_start", "_place")


ROWS_PER_TASK = 250_000  # of links
BLOCK = 512  # nodes of a large mixed bucket that are compared with as many in a task


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id in ``edges`` (a, b); the component is its smallest id.

    Alternating large-star and small-star steps: each moves a node's links to its smallest
    neighbour, until they form stars. Links are combined per node before they are shuffled. As
    their number is known, few links are kept in few partitions, and hinted for broadcast.
    """
    edges, n = step(_forward(edges.select("a", "b")))
    seen = _fingerprint(edges)
    while True:
        edges = _few(edges, n)
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _forward(_to_smallest(both, n, larger=True))
        edges, n = step(_few(_forward(_to_smallest(_few(large, n), n, larger=False)), n))
        now = _fingerprint(edges)
        if now == seen:
            break
        seen = now
    ids = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component"))
    return step(_few(ids.unionByName(roots).groupBy("id").agg(F.min("component").alias("component")), n))[0]


def _few(df: DataFrame, rows: int) -> DataFrame:
    return df.coalesce(rows // ROWS_PER_TASK + 1)


def _forward(edges: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller end."""
    a, b = F.greatest("a", "b"), F.least("a", "b")
    return edges.filter("a <> b").select(a.alias("a"), b.alias("b")).distinct()


def _to_smallest(edges: DataFrame, rows: int, larger: bool) -> DataFrame:
    """Link each neighbour of ``a`` (the larger ones only, or all) to the smallest around ``a``."""
    least = edges.groupBy("a").agg(F.min("b").alias("_low")).withColumn("_low", F.least("_low", "a"))
    least = hint_counted(_few(least, rows), rows)
    linked = edges.join(least, "a")
    if larger:
        return linked.filter("b > a").select(F.col("b").alias("a"), F.col("_low").alias("b"))
    moved = linked.select(F.col("b").alias("a"), F.col("_low").alias("b"))
    return moved.unionByName(least.select("a", F.col("_low").alias("b")))


def _fingerprint(edges: DataFrame) -> tuple:
    mixed = F.xxhash64("a", "b")
    low = mixed.bitwiseAND(F.lit((1 << 31) - 1))
    return tuple(edges.agg(F.count("*"), F.sum(low), F.bit_xor(mixed)).first())


def leader_pairs(members: DataFrame, best: Column, outside: bool = False) -> DataFrame:
    """(a, b) of each node and its bucket's leader (the node of largest ``best``), if in another component.

    ``members`` is (node, bucket, component, ...); one pair per bucket and node. ``outside`` takes the
    leader from the nodes that are not in the bucket's largest component.
    """
    mixed = members.join(mixed_buckets(members), "bucket")
    able = mixed.filter("component <> _main") if outside else mixed
    leaders = able.groupBy("bucket").agg(F.max_by(F.struct("node", "component"), best).alias("_l"))
    apart = mixed.join(leaders, "bucket").filter(F.col("component") != F.col("_l.component"))
    return apart.select(F.least("node", "_l.node").alias("a"), F.greatest("node", "_l.node").alias("b")).distinct()


def mixed_buckets(members: DataFrame) -> DataFrame:
    """(bucket, _n, _apart, _main): buckets of several components, and their largest one."""
    counts = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    stats = counts.groupBy("bucket").agg(
        F.sum("n").alias("_n"), (F.sum("n") - F.max("n")).alias("_apart"),
        F.max_by("component", F.struct("n", "component")).alias("_main"),
    )
    return stats.filter("_apart > 0")


def cross_pairs(
    members: DataFrame, apart: int, small: int, split: Callable[[DataFrame], DataFrame] | None = None, splits: int = 0,
    value: str | None = None, near: Callable[[Column, Column], Column] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of nodes in different components that share a bucket, and the members still to compare.

    ``members`` is (node, bucket, component, ...). All pairs of a bucket with up to ``small`` nodes, and where
    up to ``apart`` nodes are outside the largest component these with all nodes of the bucket, so
    that the pairs stay in proportion to its size. In other buckets unrelated nodes meet in a
    frequent value: ``split`` deals their members again into finer buckets, ``splits`` times at most. What is
    still that mixed is the second result, for the caller to compare. With ``near``, only pairs for whose
    ``value``s it holds, which are told where they meet, before they are shuffled.
    """
    found, carried = [], [value] if near else []
    for left in range(splits, -1, -1):
        placed = members.join(step(mixed_buckets(members))[0], "bucket")
        direct = (F.col("_n") <= small) | (F.col("_apart") <= apart)
        few = placed.filter(direct)
        odd = few.filter("component <> _main").select("bucket", F.col("node").alias("_o"), F.col("component").alias("_c"), *[F.col(c).alias("_v") for c in carried])
        met = odd.join(few.select("bucket", "node", "component", *carried), "bucket").filter("component <> _c")
        met = met.filter(near(F.col(value), F.col("_v"))) if near else met
        found.append(met.select(F.least("node", "_o").alias("a"), F.greatest("node", "_o").alias("b")))
        many, dealt = placed.filter(~direct), 0
        if left:
            members, dealt = step(split(many.drop("_n", "_apart", "_main")))
        if not dealt:
            rest = many.filter(F.lit(False)) if left else many
            return cut(reduce(DataFrame.unionByName, found).distinct()), rest


def block_links(many: DataFrame, held: DataFrame, weight: Column, links: Callable) -> DataFrame:
    """Links (a, b) among the nodes of large mixed buckets, each compared with all it could be linked to.

    A bucket's nodes are dealt into blocks of about ``BLOCK`` by their summed ``weight``, and each block's
    nodes outside the largest component meet each block in a task of its own: no node is left out, and
    a task's rows are bounded. ``held`` has what ``links`` (a group function over both blocks'
    rows) compares, by node; ``links`` compares an ``odd`` row with the others.
    """
    rows = many.drop("_n", "_apart").join(held, "node")
    sizes = rows.groupBy("bucket").agg(F.ceil(F.sum(weight) / BLOCK).cast("int").alias("_parts"))
    placed = rows.join(sizes, "bucket").withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    odd = placed.filter("component <> _main").withColumns({"_i": F.col("_block"), "odd": F.lit(True)}).withColumn("_j", others)
    every = placed.withColumns({"_j": F.col("_block"), "odd": F.lit(False)}).withColumn("_i", others)
    cells = odd.unionByName(every).drop("_parts", "_block")
    return cut(cells.groupBy("bucket", "_i", "_j").applyInPandas(links, "a bigint, b bigint").distinct())


def block_pairs(many: DataFrame, value: str, near: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs (a, b) of nodes in different components of large mixed buckets, for whose ``value``s ``near`` holds.

    ``many`` is the second result of ``cross_pairs``. Each block of about ``BLOCK`` of a bucket's nodes meets
    the nodes of each block that are outside the largest component, the pairs being told where they meet.
    """
    parts = F.ceil(F.col("_n") / BLOCK).cast("int")
    placed = many.withColumn("_parts", parts).withColumn("_block", F.pmod(F.xxhash64("node"), F.col("_parts")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    odd = placed.filter("component <> _main").select(
        "bucket", F.col("_block").alias("_i"), others.alias("_j"), F.col("node").alias("_o"), F.col("component").alias("_c"), F.col(value).alias("_v")
    )
    every = placed.select("bucket", others.alias("_i"), F.col("_block").alias("_j"), "node", "component", "_main", value)
    met = odd.join(every, ["bucket", "_i", "_j"]).filter("component <> _c and (component = _main or node > _o)")
    met = met.filter(near(F.col(value), F.col("_v")))
    return cut(met.select(F.least("node", "_o").alias("a"), F.greatest("node", "_o").alias("b")).distinct())


def with_component(members: DataFrame, components: DataFrame) -> DataFrame:
    """``members`` with the component of each node: its own where it has no links."""
    known = components.select(F.col("id").alias("node"), F.col("component"))
    rest = [c for c in members.columns if c != "component"]
    joined = members.select(*rest).join(known, "node", "left")
    return cut(joined.select(*rest, F.coalesce("component", "node").alias("component")))
