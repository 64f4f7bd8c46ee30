"""Near copies found by Order MinHash and verified by banded alignment.

A text's k-mers are its windows of ``K`` words, each labelled with how often it occurred before in
the text, so that all are different. One Order MinHash value takes the ``PICKED`` k-mers that are
smallest under a hash and keeps them in the order of the text: it agrees when the texts share both
content and order. ``SKETCHES`` such values per text are the candidate buckets.

Two texts are near copies when their similarity is at least ``MIN_SIMILARITY``: the longest common
subsequence of their labelled k-mers, over the k-mers of both less that. The alignment looks only
at the diagonals that such a similarity allows.

Equal texts are one node; pairs of nodes are compared if ``AGREEING`` of their values agree (all but
1 in 10,000 pairs at the least similarity have as many, and more the more alike they are). A
group of copies is not compared pair by pair but with leaders. Each node is compared with one
bucket's node of smallest doc_id, the one it shares most buckets with; then all nodes of
buckets that still hold several components with the node whose buckets hold the most nodes, the
middle of a group, and with the same among the nodes outside the largest component; at last the
nodes of buckets up to ``SMALL`` with each other, and where ``APART`` nodes at most are still
outside a bucket's largest component, these with all of its nodes. The nodes of larger mixed buckets
are dealt again by their rarest k-mers: two texts of the least similarity have one in common among so
many of each that those behind could not make them similar (the prefix filter of set similarity joins, so no
pair is lost), and texts of one template that are not copies mostly have not. No bucket is dropped or cut short.

Null texts are never copies. Texts without words are copies of equal texts only, shorter texts than
``K`` words of texts with the same words. Rows that share a doc_id are judged by their texts; the
class of a row is the smallest doc_id in its group (null if the group has none). An empty table has
an empty result. Other columns are kept, whatever their names.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tideline.llm.common import connected_components, cross_pairs, leader_pairs, mixed_buckets, with_component
from tideline.scale import cut, join_bounded

K = 5
PICKED = 3
SKETCHES = 24
MIN_SIMILARITY = 0.8
SMALL = 16
APART = 4
AGREEING = 4
NO_ID = -(1 << 63)
_COLUMNS = 1 << 15  # k-mers hashed at once
_VOCABULARY = 1 << 20  # words whose hash a task remembers
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(27))


class _Words(dict):
    """Word to 64-bit hash, remembered for the words seen last."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value


def labelled_kmers(text: str, words: _Words) -> np.ndarray:
    """Hashes of a text's k-mers in order, each different by its occurrence number."""
    found = text.encode("utf-8", "surrogatepass").split()
    if not found:
        return np.zeros(0, np.uint64)
    codes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    if len(codes) < K:
        codes = np.concatenate([codes, np.full(K - len(codes), len(codes), np.uint64)])
    n = len(codes) - K + 1
    kmers = codes[:n].copy()
    for j in range(1, K):
        kmers = kmers * _ODD + codes[j : j + n]
    kmers = _mix(kmers)
    order = np.argsort(kmers, kind="stable")
    ordered = kmers[order]
    again = np.concatenate([[False], ordered[1:] == ordered[:-1]])
    if again.any():
        place = np.arange(n)
        start = np.maximum.accumulate(np.where(again, 0, place))
        number = np.empty(n, np.uint64)
        number[order] = (place - start).astype(np.uint64)
        kmers = np.where(number > 0, _mix(kmers + number * _ODD), kmers)
    return kmers


_SALTS = _mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _ODD) | np.uint64(1)


def order_sketches(kmers: np.ndarray) -> list[int]:
    """The Order MinHash values of labelled k-mers."""
    best_hash = best_at = None
    for start in range(0, len(kmers), _COLUMNS):
        part = kmers[start : start + _COLUMNS]
        hashed = _mix(part[None, :] * _SALTS[:, None])
        at = np.broadcast_to(np.arange(start, start + len(part)), hashed.shape)
        if best_hash is not None:
            hashed, at = np.concatenate([best_hash, hashed], 1), np.concatenate([best_at, at], 1)
        if hashed.shape[1] > PICKED:
            chosen = np.argpartition(hashed, PICKED - 1, axis=1)[:, :PICKED]
            hashed, at = np.take_along_axis(hashed, chosen, 1), np.take_along_axis(at, chosen, 1)
        best_hash, best_at = hashed, at
    in_order = kmers[np.sort(best_at, axis=1)]
    value = _SALTS.copy()
    for column in in_order.T:
        value = _mix(value * _ODD + column)
    return value.astype(np.int64).tolist()


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Aligned k-mers over all k-mers of both; 0 as soon as ``MIN_SIMILARITY`` is out of reach."""
    total = len(a) + len(b)
    least = MIN_SIMILARITY * total / (1 + MIN_SIMILARITY)
    if min(len(a), len(b)) < least - 1e-9 or not total:
        return 0.0
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b, a, sorter=order), len(b) - 1)
    places = order[at]
    shared = np.flatnonzero(b[places] == a)
    band = total - 2 * least  # insertions and deletions that the similarity leaves room for
    path = places[shared]
    path = path[np.abs(path - shared) <= band]
    if len(path) < least - 1e-9:
        return 0.0
    if (np.diff(path) > 0).all():
        common = len(path)
    else:
        tails: list[int] = []
        for j in path.tolist():
            k = bisect_left(tails, j)
            if k == len(tails):
                tails.append(j)
            else:
                tails[k] = j
        common = len(tails)
    return common / (total - common)


def _sketched(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    words = _Words()
    for batch in batches:
        values, sizes = [], []
        for text in batch:
            kmers = labelled_kmers(text, words)
            sizes.append(len(kmers))
            values.append(order_sketches(kmers) if len(kmers) else [])
        yield pd.DataFrame({"kmers": np.array(sizes, np.int64), "sketches": values})


def _profiled(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    words = _Words()
    for batch in batches:
        yield pd.Series([labelled_kmers(text, words).astype(np.uint32).tobytes() for text in batch], dtype=object)


def _similarities(left: pd.Series, right: pd.Series) -> pd.Series:
    return pd.Series(
        [similarity(np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)) for a, b in zip(left, right, strict=True)],
        dtype=float,
    )


def _verified(pairs: DataFrame, nodes: DataFrame, profiles: DataFrame) -> DataFrame:
    """Links among ``pairs`` (a, b) of nodes whose sizes and sketches allow it."""
    one = nodes.select(F.col("node").alias("a"), F.col("kmers").alias("_na"), F.col("sketches").alias("_sa"))
    other = nodes.select(F.col("node").alias("b"), F.col("kmers").alias("_nb"), F.col("sketches").alias("_sb"))
    sized = F.least("_na", "_nb") >= MIN_SIMILARITY * F.greatest("_na", "_nb") - 1e-6
    agreeing = F.size(F.filter(F.zip_with("_sa", "_sb", lambda x, y: x == y), lambda same: same))
    close = pairs.join(one, "a").join(other, "b").filter(sized & (agreeing >= AGREEING)).select("a", "b")
    right = profiles.select(F.col("node").alias("b"), F.col("profile").alias("_right"))
    left = profiles.select(F.col("node").alias("a"), F.col("profile").alias("_left"))
    # small sides last, so that a node with many partners is split over tasks by adaptive execution
    joined = close.join(right, "b").join(left, "a")
    similar = joined.select("a", "b", pandas_udf(_similarities, "double")("_left", "_right").alias("_s"))
    return cut(similar.filter(F.col("_s") >= MIN_SIMILARITY - 1e-9).select("a", "b"))


def _kmer_sets(profiles: pd.Series) -> pd.Series:
    return pd.Series([np.unique(np.frombuffer(profile, np.int32)).tolist() for profile in profiles], dtype=object)


def _by_rare_kmers(many: DataFrame, nodes: DataFrame, profiles: DataFrame) -> DataFrame:
    """(node, component, bucket, kmers, left) of members' rarest k-mers.

    ``left`` counts a text's k-mers from this one on, rarest first; k-mers of one text alone come before
    all others. Similar texts share that many behind the first k-mer that both have.
    """
    own = many.select("node", "component").distinct().join(nodes.select("node", "kmers"), "node").join(profiles, "node")
    each = F.explode(pandas_udf(_kmer_sets, "array<int>")("profile")).alias("bucket")
    listed = cut(own.select("node", "component", "kmers", each))
    shared = listed.groupBy("bucket").agg(F.count("*").alias("_n")).filter("_n > 1")
    frequent = Window.partitionBy("node").orderBy(F.desc("_n"), F.desc("bucket"))
    placed = listed.join(shared, "bucket").withColumn("left", F.row_number().over(frequent))
    first = placed.filter(F.col("left") >= MIN_SIMILARITY * F.col("kmers") - 1e-6)
    return cut(first.select("node", "component", "bucket", "kmers", "left"))


def _rare_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes in different components that share a rare k-mer with enough of them left in both."""
    stats = mixed_buckets(members).select("bucket", "_main")
    odd = members.join(stats, "bucket").filter("component <> _main").select(
        "bucket", F.col("node").alias("_o"), F.col("component").alias("_c"), F.col("kmers").alias("_k"), F.col("left").alias("_l")
    )
    least = MIN_SIMILARITY / (1 + MIN_SIMILARITY) * (F.col("kmers") + F.col("_k")) - 1e-6
    able = (F.col("component") != F.col("_c")) & (F.least("left", "_l") >= least)
    met = odd.join(members, "bucket").filter(able)
    return met.select(F.least("node", "_o").alias("a"), F.greatest("node", "_o").alias("b")).distinct()


def _oldest() -> Column:
    return F.struct(F.coalesce("first_id", F.lit(NO_ID)).alias("id"), "node")


def near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, text_key, class_id, copies, kept).

    One row per input row. ``text_key`` identifies the text, ``copies`` counts the rows with that
    text, ``kept`` marks the rows of the class's smallest doc_id (of the least text_key, where texts share it).
    """
    keyed = docs.select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_key"), "text")
    given = keyed.filter(F.col("text").isNotNull())
    sketch = pandas_udf(_sketched, "kmers bigint, sketches array<bigint>")
    sketched = given.select("doc_id", "text_key", sketch("text").alias("_s")).select("doc_id", "text_key", "_s.*")
    nodes = sketched.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.count("*").alias("copies"),
        F.first("kmers").alias("kmers"), F.first("sketches").alias("sketches"),
    )
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()))
    sketches = nodes.select("node", "first_id", F.posexplode("sketches").alias("t", "value"))
    buckets = sketches.select("node", "first_id", F.xxhash64("t", "value").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n"), F.min(_oldest()).alias("leader")).filter("n > 1")
    members = cut(buckets.join(shared, "bucket").withColumn("component", F.col("node")))
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    members = cut(members.join(weights, "node").select("node", "bucket", "component", "leader", "weight"))

    id_key = F.coalesce(F.col("doc_id"), F.lit(NO_ID)).alias("_id")
    wanted = members.select("node").distinct().join(nodes, "node").select(
        "node", "text_key", F.coalesce("first_id", F.lit(NO_ID)).alias("_id")
    )
    texts = join_bounded(given.select("text_key", id_key, "text"), cut(wanted), ["_id", "text_key"], spread="text")
    profiles = cut(texts.select("node", pandas_udf(_profiled, "binary")("text").alias("profile")).dropDuplicates(["node"]))

    shares = members.groupBy("node", "leader").agg(F.count("*").alias("n"))
    most = F.max_by("leader.node", F.struct("n", -F.col("leader.id"), -F.col("leader.node"))).alias("a")
    pairs = shares.filter("node <> leader.node").groupBy("node").agg(most)
    links = _verified(pairs.select("a", F.col("node").alias("b")), nodes, profiles)
    members = with_component(members.drop("leader"), connected_components(links))
    central = F.struct("weight", "node")
    for outside in (False, True):
        found = _verified(leader_pairs(members, central, outside), nodes, profiles)
        links = cut(links.unionByName(found))
        members = with_component(members, connected_components(links))
    pairs, many = cross_pairs(members.select("node", "component", "bucket"), APART, SMALL)
    pairs = pairs.unionByName(_rare_pairs(_by_rare_kmers(many, nodes, profiles))).distinct()
    links = links.unionByName(_verified(pairs, nodes, profiles))
    component = connected_components(links).withColumnRenamed("id", "node")

    placed = nodes.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    classes = placed.groupBy("component").agg(
        F.min(F.struct(F.col("first_id").isNull().alias("_none"), "first_id", "text_key")).alias("best")
    )
    labels = placed.join(classes, "component").select(
        "text_key", "copies", F.col("best.first_id").alias("class_id"), F.col("best.text_key").alias("best_key")
    )
    rows = keyed.select("doc_id", "text_key")
    joined = rows.join(labels, "text_key", "left")
    null_text = F.col("text_key").isNull()
    first = (F.col("text_key") == F.col("best_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    return joined.select(
        "doc_id",
        "text_key",
        F.when(null_text, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(null_text, F.lit(1)).otherwise(F.col("copies")).cast("bigint").alias("copies"),
        (null_text | first).alias("kept"),
    )


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: of its smallest doc_id."""
    judged = near_copies(docs).filter("kept and text_key is not null")
    keepers = judged.groupBy("doc_id", "text_key").agg(F.count("*").alias("rows"))
    keepers = keepers.select(F.col("doc_id").alias("kept_id"), F.col("text_key").alias("kept_key"), "rows")
    # the row as a struct: its other columns cannot clash with these
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.md5(F.col("text").cast("binary")).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))
    staying = keyed.join(keepers, same)
    once = staying.filter("rows = 1")
    repeated = staying.filter("rows > 1").dropDuplicates(["doc_id", "text_key"])
    without = docs.filter(F.col("text").isNull())
    return once.unionByName(repeated).select("row.*").unionByName(without)
