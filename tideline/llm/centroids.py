"""Centroid clustering in integers, each vector assigned by the threshold algorithm.

Per dimension the centroids are listed by their value. From a vector's own value the lists are walked
outward, nearest value first, in all dimensions at once; a centroid met for the first time gets its exact
distance. The squared gaps at the walks' ends sum up to a bound that no unmet centroid can be under, so
a vector is done when that sum strictly exceeds its best distance: equal distances are all met, and the
smallest number wins. Each round's sums are combined per task and then per centroid; rounds change only
the few centroids, which the driver holds (their number and width are parameters).

Cases: null vectors, and those of another width or with null, NaN or infinite components, are left out.
Components are scaled and floored to integers, which must stay under 2**26 in size, so that distances are
exact; a larger one is an error. Repeated rows count each. Equal starting hashes (repeated or null ids,
null counting as an empty text) are ordered by vector. With fewer vectors than centroids there are as many
centroids as vectors; an empty table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT = 1 << 26
LANES = 4096


def whole_vectors(vectors: pa.Array, width: int | None = None) -> np.ndarray:
    """Which vectors have that width (None: any) and only finite components."""
    sizes = vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    # flatten() leaves out the components of null vectors
    flat = vectors.flatten()
    good = np.isfinite(flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    present = np.maximum(sizes, 0)
    bad = np.bincount(np.repeat(np.arange(len(sizes)), present), ~good, len(sizes))
    return (sizes >= 0 if width is None else sizes == width) & (bad == 0)


def components(vectors: pa.Array, keep: np.ndarray, width: int) -> np.ndarray:
    """The kept vectors as doubles."""
    return vectors.filter(pa.array(keep)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, width)


def quantised(values: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(values * scale)
    if scaled.size and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"a component times {scale} is {LIMIT} or more in size")
    return scaled.astype(np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and squared distance of each row's nearest centroid, by the threshold algorithm."""
    rows, width = x.shape
    k = len(centroids)
    order = np.argsort(centroids, axis=0, kind="stable")  # k x width: the lists
    values = np.take_along_axis(centroids, order, axis=0)
    dims = np.arange(width)
    right = (values[None] < x[:, None]).sum(axis=1) if k <= 64 else np.stack([np.searchsorted(values[:, d], x[:, d]) for d in dims], axis=1)
    left = right - 1
    best = np.full(rows, np.iinfo(np.int64).max)
    chosen = np.full(rows, k)
    met = np.zeros((rows, k), dtype=bool)
    open_ = np.arange(rows)
    far = np.int64(1) << 40
    for _ in range(k):
        l, r, own = left[open_], right[open_], x[open_]
        below = np.where(l >= 0, own - values[np.maximum(l, 0), dims], far)
        above = np.where(r < k, values[np.minimum(r, k - 1), dims] - own, far)
        down = below <= above
        gap = np.where(down, below, above)
        found = order[np.where(down, np.maximum(l, 0), np.minimum(r, k - 1)), dims]
        left[open_], right[open_] = l - down, r + ~down
        seen = np.zeros((len(open_), k), dtype=bool)
        np.put_along_axis(seen, found, True, axis=1)
        at, new = np.nonzero(seen & ~met[open_])
        met[open_] |= seen
        distance = ((own[at] - centroids[new]) ** 2).sum(axis=1)
        who = open_[at]
        # per row the smallest (distance, number) of the newly met
        sort = np.lexsort((new, distance, who))
        who, distance, new = who[sort], distance[sort], new[sort]
        first = np.concatenate([[True], who[1:] != who[:-1]]) if len(who) else np.zeros(0, dtype=bool)
        who, distance, new = who[first], distance[first], new[first]
        better = (distance < best[who]) | ((distance == best[who]) & (new < chosen[who]))
        best[who[better]], chosen[who[better]] = distance[better], new[better]
        open_ = open_[(gap**2).sum(axis=1) <= best[open_]]
        if not len(open_):
            break
    return chosen, best


def _assigned(batches, vector: str, scale: int, centroids: np.ndarray) -> Iterator[tuple]:
    """(batch, kept rows, integers, cluster, distance) in slices of ``LANES`` rows."""
    width = centroids.shape[1]
    for whole in batches:
        for low in range(0, whole.num_rows, LANES):
            batch = whole.slice(low, LANES)
            keep = whole_vectors(batch.column(vector), width)
            if keep.any():
                x = quantised(components(batch.column(vector), keep, width), scale)
                yield (batch, keep, x, *nearest(x, centroids))


def start_centroids(rows: DataFrame, id_: str, vector: str, k: int, width: int, scale: int, salt: str) -> np.ndarray:
    """The ``k`` whole vectors of smallest sha256 of salt and id, in that order."""

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = whole_vectors(batch.column(vector), width)
            x = quantised(components(batch.column(vector), keep, width), scale)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), width).cast(pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(id_).filter(pa.array(keep)), lists], names=["id", "x"])

    whole = rows.select(id_, vector).mapInArrow(integers, f"id {rows.schema[id_].dataType.simpleString()}, x array<bigint>")
    hashed = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    found = whole.orderBy(hashed, "x").limit(k).collect()
    return np.array([r["x"] for r in found], dtype=np.int64).reshape(-1, width)


def cluster_sums(rows: DataFrame, vector: str, scale: int, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Per non-empty cluster: count, summed distance, componentwise sums; a row per task and cluster is shuffled."""
    k, width = centroids.shape

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, inertia = [0] * k, [0] * k
        sums = np.zeros((k, width), dtype=np.int64)
        for _, _, x, cluster, distance in _assigned(batches, vector, scale, centroids):
            for c in np.unique(cluster):
                mine = cluster == c
                counts[c] += int(mine.sum())
                inertia[c] += int(distance[mine].sum(dtype=np.int64))
                sums[c] += x[mine].sum(axis=0)
        used = [c for c in range(k) if counts[c]]
        if used:
            yield pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([counts[c] for c in used], pa.int64()),
                 pa.array([inertia[c] for c in used], pa.int64()), pa.array(sums[used].tolist(), pa.list_(pa.int64()))],
                names=["cluster", "n", "inertia", "sums"],
            )

    parts = rows.select(vector).mapInArrow(partial, "cluster int, n bigint, inertia bigint, sums array<bigint>")
    total = [F.sum(F.col("sums")[d].cast("decimal(38,0)")).alias(f"s{d}") for d in range(width)]
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", "inertia")]
    found = parts.groupBy("cluster").agg(*wide, *total).collect()
    return {r["cluster"]: (int(r["n"]), int(r["inertia"]), [int(r[f"s{d}"]) for d in range(width)]) for r in found}


def cluster_vectors(
    rows: DataFrame, id_: str, vector: str, k: int = 8, width: int = 64, rounds: int = 10, scale: int = 1024, salt: str = "3:"
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid) of every whole vector of ``rows``.

    ``rounds`` times all vectors are assigned and each non-empty cluster's centroid becomes the floor of
    its vectors' mean; then all are assigned once more. ``inertia`` columns are decimals.
    """
    kind = rows.schema[id_].dataType.simpleString()
    schema = f"id {kind}, cluster int, distance bigint"
    centroids = start_centroids(rows, id_, vector, k, width, scale, salt)
    if not len(centroids):
        names = "cluster_inertia decimal(38,0), inertia decimal(38,0), centroid array<bigint>"
        return rows.sparkSession.createDataFrame([], f"{schema}, {names}").withColumnRenamed("id", id_)
    for _ in range(rounds):
        for c, (n, _inertia, sums) in cluster_sums(rows, vector, scale, centroids).items():
            centroids[c] = [s // n for s in sums]
    last = {c: inertia for c, (_, inertia, _sums) in cluster_sums(rows, vector, scale, centroids).items()}

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, keep, _, cluster, distance in _assigned(batches, vector, scale, centroids):
            ids = batch.column(id_).filter(pa.array(keep))
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["id", "cluster", "distance"])

    assigned = rows.select(id_, vector).mapInArrow(assign, schema)
    facts = [(c, str(last.get(c, 0)), str(sum(last.values())), [int(v) for v in centroids[c]]) for c in range(len(centroids))]
    facts = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia string, inertia string, centroid array<bigint>")
    wide = {c: F.col(c).cast("decimal(38,0)") for c in ("cluster_inertia", "inertia")}
    joined = assigned.join(F.broadcast(facts.withColumns(wide)), "cluster")  # one row per centroid
    return joined.select(F.col("id").alias(id_), "cluster", "distance", "cluster_inertia", "inertia", "centroid")

