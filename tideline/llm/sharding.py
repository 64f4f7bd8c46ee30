"""Shards cut along a Hilbert curve through several metadata dimensions.

Each dimension is quantised to ``BITS`` bits: texts by the rank of their value, numbers linearly
between their extremes (sizes by logarithm). Rows are ordered by the index of their cell on the
curve and cut into runs of equal row counts, so that each shard covers a compact block of cells and
the statistics of its files exclude most shards for a filter on any of the dimensions.

Nulls are the first value of their dimension. Rows of one cell are ordered by their values, then
by the given keys; equal rows may take each other's places. An empty table has an empty result.
Input columns named like a result are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tideline.llm.common import null_key, ranked
from tideline.scale import cut, join_bounded

BITS = 6
SHARDS = 8


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text plus 1."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Position of a cell on the Hilbert curve; every coordinate has ``bits`` bits.

    One fold over (bit, dimension) undoes the curve's rotations and reflections, a second takes
    the Gray code of the result, a third interleaves its bits.
    """
    dims = len(cells)
    steps = F.sequence(F.lit(0), F.lit(bits * dims - 1))

    def turn(x: Column, k: Column) -> Column:
        one = F.lit(1).cast("bigint")
        low = F.call_function("shiftleft", one, F.lit(bits - 1) - (k / dims).cast("int")) - 1
        i = k % dims
        mine, first = F.get(x, i), F.get(x, F.lit(0))
        flip = mine.bitwiseAND(low + 1) != 0
        swap = mine.bitwiseXOR(first).bitwiseAND(low)
        return F.transform(
            x,
            lambda v, j: F.when(flip & (j == 0), v.bitwiseXOR(low))
            .when(~flip & ((j == 0) | (j == i)) & (i != 0), v.bitwiseXOR(swap))
            .otherwise(v),
        )

    def gray(x: Column, i: Column) -> Column:
        return F.transform(x, lambda v, j: F.when(j == i, v.bitwiseXOR(F.get(x, i - 1))).otherwise(v))

    point = F.array(*[c.cast("bigint") for c in cells])
    # bits - 1 rounds: the lowest bit has nothing below it to rotate
    turned = F.aggregate(F.slice(steps, 1, (bits - 1) * dims), point, turn)
    if dims > 1:
        turned = F.aggregate(F.sequence(F.lit(1), F.lit(dims - 1)), turned, gray)

    def finish(x: Column) -> Column:
        last = F.get(x, F.lit(dims - 1))
        parity = F.lit(0).cast("bigint")
        for bit in range(1, bits):
            mask = F.lit((1 << bit) - 1).cast("bigint")
            parity = parity.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << bit)) != 0, mask).otherwise(0))
        planes = []
        for bit in range(bits):
            for i in range(dims):
                v = F.get(x, F.lit(i)).bitwiseXOR(parity)
                one = F.shiftright(v, bit).bitwiseAND(F.lit(1))
                planes.append(F.shiftleft(one, bit * dims + dims - 1 - i))
        return reduce(add, planes)

    return F.get(F.transform(F.array(turned), finish), F.lit(0)).cast("bigint")


def _quantised(df: DataFrame, dims: list[str], sizes: list[str], bits: int) -> DataFrame:
    """``df`` with a cell coordinate ``_cell_<dim>`` per dimension."""
    cells = 1 << bits
    texts = [d for d in dims if isinstance(df.schema[d].dataType, StringType)]
    numbers = [d for d in dims if d not in texts]
    for d in texts:
        key = f"_key_{d}"
        values = ranked(df.select(d).distinct(), [F.col(d).asc_nulls_first()], "_rank")
        top = values.agg(F.max("_rank").alias("m")).first()["m"] or 0
        scaled = F.floor(F.col("_rank") * cells / F.lit(top + 1)).alias(f"_cell_{d}")
        coded = values.select(null_key(d).alias(key), scaled)
        df = join_bounded(df.withColumn(key, null_key(d)), coded, [key], "left", spread=df.columns[0]).drop(key)
    def scale(d: str) -> Column:
        x = F.col(d).cast("double")
        return F.log(F.greatest(x, F.lit(0.0)) + 1) if d in sizes else x
    if numbers:
        ends = df.agg(*[f(scale(d)).alias(f"{n}_{d}") for d in numbers for n, f in (("lo", F.min), ("hi", F.max))]).first()
        for d in numbers:
            low, high = ends[f"lo_{d}"], ends[f"hi_{d}"]
            width = (high - low) if low is not None and high > low else 1.0
            place = F.floor((scale(d) - F.lit(low or 0.0)) * (cells / width))
            df = df.withColumn(f"_cell_{d}", F.coalesce(F.least(place, F.lit(cells - 1)), F.lit(0)))
    return df


def curve_order(df: DataFrame, dims: list[str], sizes: list[str] = (), bits: int = BITS) -> DataFrame:
    """``df`` with ``curve``, its cell's index on the Hilbert curve."""
    placed = _quantised(df.drop("curve"), dims, list(sizes), bits)
    cells = [f"_cell_{d}" for d in dims]
    return placed.withColumn("curve", hilbert_index([F.col(c) for c in cells], bits)).drop(*cells)


def cut_runs(
    df: DataFrame, dims: list[str], keys: list[str], sizes: list[str] = (), shards: int = SHARDS
) -> DataFrame:
    """``df`` with ``curve``, ``shard`` and ``slot``; shards' row counts differ by one at most.

    For narrow rows: they are stored once in curve order.
    """
    df = curve_order(df.drop("shard", "slot"), dims, sizes)
    order = ["curve", *[F.col(c).asc_nulls_first() for c in [*dims, *keys]]]
    placed = ranked(df, order, "_at")
    total = placed.agg(F.max("_at").alias("m")).first()["m"]
    n = F.lit((total if total is not None else 0) + 1).cast("bigint")
    shard = F.expr(f"_at * {shards} div {(total if total is not None else 0) + 1}")
    first = F.ceil(shard * n / shards)
    return placed.withColumns({"shard": shard.cast("int"), "slot": (F.col("_at") - first).cast("bigint")}).drop("_at")


def shard_documents(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> DataFrame:
    """Whole documents with ``curve`` and ``shard``, sorted along the curve in each partition.

    Only narrow rows are ranked; the cuts between shards (one row each) are compared with the
    documents, whose texts cross one shuffle. Copies equal in all of order stay in one shard.
    """
    dims, sizes = ["lang", "source", "_size", "doc_id"], ["_size"]
    docs = docs.drop("curve", "shard").withColumn("_size", text_bytes(F.col(text)))
    docs = docs.withColumn("_crc", F.crc32(F.coalesce(F.col(text), F.lit(""))))
    keyed = curve_order(docs, dims, sizes)
    order = [F.coalesce(F.col("curve"), F.lit(0)).alias("a"), null_key("lang").alias("b"), null_key("source").alias("c"),
             F.col("_size").alias("d"), F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("e"), F.col("_crc").alias("f")]
    narrow = ranked(keyed.select(*order), ["a", "b", "c", "d", "e", "f"], "_at")
    total = narrow.agg(F.max("_at").alias("m")).first()["m"]
    if total is None:
        return docs.drop("_size", "_crc").withColumns({"curve": F.lit(0).cast("bigint"), "shard": F.lit(0)})
    starts = [-(-s * (total + 1) // shards) for s in range(1, shards)]
    cuts = narrow.filter(F.col("_at").isin(*starts)).orderBy("_at").collect()  # shards - 1 rows at most
    mine = F.struct(*order)
    shard = F.lit(0)
    for c in cuts:
        at = F.struct(*[F.lit(c[k]).cast("string" if k in "bc" else "bigint").alias(k) for k in "abcdef"])
        shard = shard + (mine >= at).cast("int")
    placed = keyed.withColumn("shard", shard)
    ranged = placed.repartitionByRange("shard", "curve", "source", "_size", "doc_id")
    return ranged.sortWithinPartitions("shard", "curve", "source", "_size", "doc_id").drop("_size", "_crc")
