"""Helpers that keep plans sound on large, skewed inputs.

* ``cut`` ends a lineage with a reliable checkpoint in the cluster's shared folder; ``Stored`` keeps rows there.
* ``join_bounded`` broadcasts the small side only after measuring it, and salts hot keys otherwise.
* ``first_per_group`` takes the first n rows of a group without ever sorting a whole group
  in one task.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024
BROADCAST_ROWS = 200_000  # of identifiers, some hundred bytes each
ROW_OVERHEAD_BYTES = 64
ONE_PASS_ROWS = 100  # times 10^5 input tasks: 10^7 rows of a hot group in its last task
TOP_SLICES = 1024


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    A private folder is made only for a local master that names none.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tideline-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Stored:
    """Rows kept as files below the shared folder, which are smaller than a checkpoint's, to the end of a ``with``."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.path = spark, run_dir(spark, label)

    def __enter__(self) -> Stored:
        return self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def __exit__(self, *error: object) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def step(df: DataFrame) -> tuple[DataFrame, int]:
    """Cut an iteration's (small, id-only) rows; their number is observed as they are written.

    Within ``BROADCAST_ROWS`` the result is hinted for broadcast, so that the next join against
    the edges does not shuffle them; the count bounds its size.
    """
    df, rows, _ = step_counting(df, F.lit(False))
    return df, rows


def step_counting(df: DataFrame, which: Column) -> tuple[DataFrame, int, int]:
    """The same, with the number of the rows for which ``which`` holds."""
    counted = Observation()
    df = cut(df.observe(counted, F.count(F.lit(1)).alias("rows"), F.count_if(which).alias("which")))
    rows, found = counted.get["rows"], counted.get["which"]
    return hint_counted(df, rows), rows, found


def hint_counted(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its known row count allows it."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` with one aggregate and compare with the broadcast bound."""
    width = F.octet_length(F.to_json(F.struct("*"))) + ROW_OVERHEAD_BYTES
    size = df.select(F.sum(width).alias("n")).first()["n"]
    return (size or 0) <= max_bytes


def join_bounded(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    spread: str = "sequence_number",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join a large, possibly skewed frame with a catalog-sized one, unique on ``on``.

    Within the bound the small side is broadcast and the large side is not shuffled. Beyond it,
    keys that hold more than a partition's share of the large side are dealt by ``spread``'s hash
    into as many salts as they hold shares, and only their rows of the small side are repeated.
    A stream, whose keys cannot be counted beforehand, is joined as it is.
    """
    if fits_broadcast(small, max_bytes):
        return big.join(F.broadcast(small), on, how)
    if big.isStreaming:
        return big.join(small, on, how)
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = cut(big.groupBy(*on).agg(F.count("*").alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.filter(F.col("_n") * parts > F.lit(total)).select(
        *on, F.ceil(F.col("_n") * parts / F.lit(max(total, 1))).alias("_salts")
    )
    hot = F.broadcast(hot)  # fewer rows than partitions
    salts = F.coalesce("_salts", F.lit(1))
    salted = big.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64(spread), salts)).drop("_salts")
    repeated = small.join(hot, on, "left")
    repeated = repeated.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1)))
    return salted.join(repeated.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def first_per_group(
    df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "_rank"
) -> DataFrame:
    """First ``n`` rows of each group, ranked in column ``rank``.

    A rank limit is applied by each task to its own rows before they are shuffled, so a group,
    however large, sends at most ``n`` rows per input task. Where that could still be too many
    for one task, a pass over (group, slice of input tasks) comes first.
    """
    if n > ONE_PASS_ROWS:
        sliced = df.withColumn("_slice", F.pmod(F.spark_partition_id(), F.lit(TOP_SLICES)))
        df = _ranked(sliced, [*group, "_slice"], order, n, rank).drop(rank, "_slice")
    return _ranked(df, group, order, n, rank)


def _ranked(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str) -> DataFrame:
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
