"""Corpus pipeline: quality, near copies, benchmark leaks, mixing, sharding.

Every stage takes and returns the columns of ``documents`` (the last adds curve and shard). Rows
with null or empty texts are rejected by the first stage; the others handle them as their operators
say. An empty table passes through all stages. Other columns pass through them, whatever their names; a
``curve`` or ``shard`` of the input is replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import decontaminate, mixing, near_copies, quality, sharding
from tideline.llm.common import table, word_count
from tideline.scale import run_dir


def _carried(docs: DataFrame, *needed: str) -> tuple[str, DataFrame]:
    """What selects a row's own columns again, and rows as a struct beside what an operator needs."""
    return "row.*", docs.select(F.struct("*").alias("row"), *needed)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row, given = _carried(docs, "text", "lang", "source")
    return quality.quality_rules(given).filter("kept").select(row)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_copies.drop_near_copies(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row, given = _carried(docs, "doc_id", "text", "source")
    sized = given.withColumns({"size": word_count(F.col("text")), "draw": mixing.draw_of("doc_id", "text")}).drop("doc_id", "text")
    return mixing.repeat_rows(mixing.mix_sources(sized), ["row"]).select(row)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row, given = _carried(docs.drop("curve", "shard"), "doc_id", "text", "lang", "source")
    return sharding.shard_documents(given).select(row, "curve", "shard")


STAGES = [
    ("quality rules", quality_stage),
    ("near copies", near_copy_stage),
    ("benchmark leaks", benchmark_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]
#: Order MinHash buckets and the tilts of the mix are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    folder = run_dir(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
