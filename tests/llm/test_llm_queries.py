"""Registered queries against their SQL twins, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracles import compare, connect
from tideline.llm import decontaminate, near_copies, quality
from tideline.llm.queries import ORACLES, REGISTRY

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(ORACLES))
def test_twins(spark, name):
    assert compare(spark, connect(SF_DIR), name, REGISTRY[name], ORACLES[name], SF_DIR) is None


def test_every_operator_has_a_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in REGISTRY)
    assert numbers == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        sizes.append(docs.count())
        assert docs.columns[: len(columns)] == columns
        if number == 0:
            kept = quality.quality_rules(before).filter("kept").select("doc_id")
            assert {r[0] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()}
        if number == 1:
            classes = near_copies.near_copies(before.select("doc_id", "text")).collect()
            assert {r["class_id"] for r in classes} == {r["doc_id"] for r in docs.collect()}
        if number == 2:
            leaks = decontaminate.find_leaks(before, spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
            gone = {r["doc_id"] for r in before.collect()} - {r["doc_id"] for r in docs.collect()}
            assert gone == {r["doc_id"] for r in leaks.collect()} and gone
        if number == 3:
            assert max(Counter(r["doc_id"] for r in docs.collect()).values()) == 2
    assert docs.columns == [*columns, "curve", "shard"]
    shards = Counter(r["shard"] for r in docs.collect())
    assert len(shards) == 8 and max(shards.values()) - min(shards.values()) <= 3
    assert 200 > sizes[0] >= sizes[1] > sizes[2] and sizes[3] == sizes[4]


def test_pipeline_on_awkward_tables(spark, tmp_path):
    schema = spark.read.parquet(f"{SF_DIR}/documents.parquet").schema
    long_ = " ".join(f"w{i}" for i in range(30000))
    rows = [(None,) * 5, (1, None, "en", None, 0), (1, "", None, "s", 0), (2, long_, "en", "s", 9), (2, long_, "en", "s", 9)]
    for k, data in enumerate((rows, [])):
        docs = spark.createDataFrame(data, schema)
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, docs, SF_DIR).write.parquet(f"{tmp_path}/{k}-{number}")
            docs = spark.read.parquet(f"{tmp_path}/{k}-{number}")
        assert {r["doc_id"] for r in docs.collect()} == ({2} if data else set())
        assert docs.filter(F.col("shard").isNull()).count() == 0


def test_pipeline_keeps_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    names = ["_id", "_rows", "_text_key", "_kept_key", "_lang", "_source", "_src", "row", "size", "draw", "_size", "copies", "rate", "n_words", "_words"]
    more = docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in names})
    for _, stage in corpus_pipeline.STAGES:
        kept = stage(spark, more, SF_DIR)
        assert kept.columns[: len(more.columns)] == more.columns
        rows = kept.collect()
        assert rows and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names)
        plain = stage(spark, docs, SF_DIR)
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect())
