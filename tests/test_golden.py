"""Known cases: the eleven-shard lineage, page scenarios, progress plans and error rules."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tideline import fixed
from tideline.operators import errors, lineage, progress, reads
from tideline.plans import views

SHARD_SCHEMA = (
    "stream string, shard_id string, parent_shard_id string, adjacent_parent_shard_id string, "
    "starting_sequence_number string, ending_sequence_number string, starting_hash_key string, "
    "ending_hash_key string"
)
PAGE_SCHEMA = SHARD_SCHEMA + ", page_no bigint, pos bigint"
PROGRESS_SCHEMA = (
    "stream string, shard_id string, parent_shard_ids array<string>, checkpoint string, "
    "owner_switches bigint"
)


def shard(id, parent=None, adjacent=None, end="2", low="0", high=fixed.MAX_HASH_KEY, start="1"):
    return ("s", str(id), parent, adjacent, start, end, low, high)


def shards_frame(spark, rows):
    return spark.createDataFrame(rows, SHARD_SCHEMA)


def pages_frame(spark, pages):
    rows = [(*s, p, i) for p, page in enumerate(pages) for i, s in enumerate(page)]
    return spark.createDataFrame(rows, PAGE_SCHEMA)


def progress_frame(spark, rows):
    return spark.createDataFrame([("s", i, parents, c, 0) for i, parents, c in rows], PROGRESS_SCHEMA)


def lineage_of(first, n, leaf_closed, parent_open=False):
    """Shards first+1 .. first+n, each the child of the one before."""
    rows = []
    for i in range(first + 1, first + n + 1):
        end = "2"
        if i == first + n and not leaf_closed:
            end = None
        if i == first + n - 1 and parent_open:
            end = None
        rows.append(shard(i, str(i - 1), end=end))
    return rows


def ids(df):
    return sorted(r["shard_id"] for r in df.collect())


def plan(df):
    return {r["shard_id"]: r["checkpoint"] for r in df.collect()}


@pytest.fixture(scope="module")
def golden(spark):
    """0,1 to 6; 2,3 to 7; 6,7 to 8; 5 to 9,10; 4 stays; open are 4, 8, 9, 10."""
    return shards_frame(
        spark,
        [
            *[shard(i) for i in range(4)],
            shard(4, end=None),
            shard(5),
            shard(6, "0", "1"),
            shard(7, "2", "3"),
            shard(8, "6", "7", end=None),
            shard(9, "5", end=None),
            shard(10, "5", end=None),
        ],
    )


TRIM, LATEST, AT = fixed.TRIM_HORIZON, fixed.LATEST, fixed.AT_TIMESTAMP


@pytest.mark.parametrize(
    "existing, position, expected",
    [
        ("345", LATEST, {"2": LATEST, "6": LATEST, "7": TRIM, "8": TRIM, "9": TRIM, "10": TRIM}),
        ("345", TRIM, dict.fromkeys(["0", "1", "2", "6", "7", "8", "9", "10"], TRIM)),
        ("345", AT, dict.fromkeys(["0", "1", "2", "6", "7", "8", "9", "10"], AT)),
        ("", LATEST, dict.fromkeys(["4", "8", "9", "10"], LATEST)),
        ("", TRIM, dict.fromkeys([str(i) for i in range(11)], TRIM)),
    ],
)
def test_plan_new_progress(spark, golden, existing, position, expected):
    rows = progress_frame(spark, [(i, [], "7") for i in existing])
    assert plan(progress.plan_new_progress(golden, rows, position)) == expected


def test_planning_stacks_few_joins(spark, golden, capsys):
    """Each sort and aggregate of a stage holds a page in the same task, so steps are stored in between."""
    rows = progress_frame(spark, [("5", [], "SHARD_END")])
    progress.plan_new_progress(golden, rows, LATEST).explain()
    progress.garbage_progress(rows, golden, golden).explain()
    assert capsys.readouterr().out.count("Join ") <= 8


def test_plan_keeps_listed_parents_even_if_trimmed(spark):
    shards = shards_frame(spark, [shard("b", "gone", "a", end=None), shard("a")])
    rows = progress.plan_new_progress(shards, progress_frame(spark, []), TRIM).collect()
    parents = {r["shard_id"]: r["parent_shard_ids"] for r in rows}
    assert parents == {"b": ["gone", "a"], "a": []}
    assert {r["owner_switches"] for r in rows} == {0}


def single_stream(spark, sf):
    events = spark.read.parquet(f"/root/testdata/sf{sf}/events.parquet")
    log = views.as_change_log(events, users_per_stream=None)
    return log, views.as_shards(views.as_generations(log)).cache()


def short(shards, df):
    """New rows as {g<gen>b<bucket>: checkpoint}."""
    named = df.join(shards.select("stream", "shard_id", "gen", "bucket"), ["stream", "shard_id"])
    return {f"g{r['gen']}b{r['bucket']}": r["checkpoint"] for r in named.collect()}


def test_sixteen_shard_plans(spark):
    _, shards = single_stream(spark, "0.01")
    assert shards.count() == 16
    g4 = [f"g4b{i}" for i in range(4)]
    latest = {
        "none": dict.fromkeys(g4, LATEST),
        "mid": dict.fromkeys(["g2b2", "g2b3", "g3b0", "g3b1", *g4], TRIM),
        "late": dict.fromkeys(g4, TRIM),
        "partial": {
            **dict.fromkeys(["g3b0", "g4b0", "g4b2"], TRIM),
            **dict.fromkeys(["g2b2", "g4b1", "g4b3"], LATEST),
        },
    }
    counts = {"none": 16, "mid": 8, "late": 4, "partial": 14}
    for profile, expected in latest.items():
        rows = views.as_progress(shards, profile)
        assert short(shards, progress.plan_new_progress(shards, rows, LATEST)) == expected
        for position in (TRIM, AT):
            got = progress.plan_new_progress(shards, rows, position)
            assert plan(got.select("shard_id", "checkpoint")).values() and got.count() == counts[profile]
            assert {r["checkpoint"] for r in got.collect()} == {position}


def test_sixteen_shard_cleanup(spark):
    _, shards = single_stream(spark, "0.01")
    late = views.as_progress(shards, "late")
    now = F.expr(views.NOW)
    done = short(shards, progress.finished_progress(late, shards, now))
    assert sorted(done) == ["g0b0", "g0b1", "g1b0", "g1b1", "g1b2", "g1b3", "g2b0", "g2b2"]
    assert ids(progress.garbage_progress(late, shards, shards)) == ["gone-1", "gone-2"]


def test_garbage_fails_when_a_parent_is_still_listed(spark, golden):
    rows = progress_frame(spark, [("11", ["8"], "5")])
    with pytest.raises(Exception, match="parent shard 8 is listed but not its child 11"):
        progress.garbage_progress(rows, golden).collect()


def test_garbage_needs_both_catalogs(spark, golden):
    rows = progress_frame(spark, [("x", ["gone"], "5"), ("y", ["gone"], "5")])
    fresh = golden.unionByName(shards_frame(spark, [shard("x")]))
    assert ids(progress.garbage_progress(rows, golden, fresh)) == ["y"]


def test_finished_rows_wait_for_age_but_not_for_unreadable_ids(spark):
    ms = 1700000000000
    new, old = f"shardId-{ms:020d}-a", f"shardId-{ms - 7 * 3600 * 1000:020d}-b"
    shards = shards_frame(
        spark, [shard(new), shard("c1", new), shard(old), shard("c2", old), shard("odd"), shard("c3", "odd")]
    )
    rows = progress_frame(
        spark, [(i, [], "SHARD_END") for i in (new, "c1", old, "c2", "odd", "c3")]
    )
    now = F.timestamp_millis(F.lit(ms + 1000))
    assert ids(progress.finished_progress(rows, shards, now)) == sorted([old, "odd"])
    unfinished = rows.filter("shard_id <> 'c2'").unionByName(
        progress_frame(spark, [("c2", [], "12")])
    )
    assert ids(progress.finished_progress(unfinished, shards, now)) == ["odd"]


def test_sync_rejects_torn_catalogs(spark, golden):
    now = F.expr(views.NOW)
    torn = golden.withColumn(
        "ending_sequence_number",
        F.when(F.col("shard_id") != "6", F.col("ending_sequence_number")),
    )
    empty = progress_frame(spark, [])
    with pytest.raises(ValueError, match="open parent"):
        progress.sync_progress(torn, empty, TRIM, now)
    result = progress.sync_progress(torn, empty, TRIM, now, ignore_unexpected_children=True)
    assert "8" not in ids(result.progress)
    open_but_ended = progress_frame(spark, [("4", [], "SHARD_END")])
    with pytest.raises(ValueError, match="contradicts"):
        progress.sync_progress(golden, open_but_ended, TRIM, now)


def test_sync_judges_finished_rows_against_rows_created_in_the_pass(spark, golden):
    rows = progress_frame(spark, [("5", [], "SHARD_END")])
    result = progress.sync_progress(golden, rows, LATEST, F.expr(views.NOW))
    audit = {(r["action"], r["shard_id"]) for r in result.audit.collect()}
    assert ("create", "9") in audit and ("create", "10") in audit
    assert not any(action == "delete_finished" for action, _ in audit)
    assert "5" in ids(result.progress)


# Pages


@pytest.mark.parametrize("parent_open", [False, True])
def test_consistent_listing_needs_no_repair(spark, parent_open):
    pages = pages_frame(spark, [lineage_of(0, 7, False, parent_open)])
    assert lineage.closed_leaf_shards(pages).count() == 0
    catalog = {r["shard_id"]: r["ending_sequence_number"] for r in lineage.close_open_parents(pages).collect()}
    assert len(catalog) == 7 and catalog["7"] is None
    assert catalog["6"] == (fixed.SYNTHETIC_END if parent_open else "2")


def repair(spark, pages, refresh, **kw):
    first = pages_frame(spark, pages)
    second = pages_frame(spark, refresh)
    if "rounds" in kw:
        second = second.withColumn("round_no", F.col("page_no"))
        kw.pop("rounds")
    return lineage.extend_closed_leaves(first, second, **kw)


@pytest.mark.parametrize("parent_open", [False, True])
def test_repair_in_one_round(spark, parent_open):
    got = repair(spark, [lineage_of(0, 7, True, parent_open)], [[shard(8, "7", end=None)]])
    assert ids(got) == [str(i) for i in range(1, 9)]


def test_never_repaired(spark):
    again = [lineage_of(0, 7, True)] * 5
    got = repair(spark, [lineage_of(0, 7, True)], again, rounds=True)
    assert got.count() == 7


def test_three_closed_leaves(spark):
    leaves = [
        "shardId-00000001517312623906-fc3dbd40",
        "shardId-00000001517312607815-45ecd9d9",
        "shardId-00000001517312572197-a2ebf9ee",
    ]
    page = []
    for first, leaf in zip((10, 20, 30), leaves):
        page += lineage_of(first, 6, True) + [shard(leaf, str(first + 6))]
    refresh = [[shard(f"open{i}", leaf, end=None)] for i, leaf in enumerate(reversed(leaves))]
    assert lineage.earliest_closed_leaf(pages_frame(spark, [page])).first()["shard_id"] == leaves[2]
    got = repair(spark, [page], refresh, rounds=True)
    assert got.count() == 24


def test_late_child_after_an_unrelated_page(spark):
    pages = [lineage_of(10, 7, False), lineage_of(20, 7, False), lineage_of(30, 7, True)]
    fixing = [shard(38, "37", end=None)] + lineage_of(38, 8, False)
    got = repair(spark, pages, [lineage_of(39, 7, False), fixing], rounds=True, siblings="first")
    assert got.count() == 22 and "38" in ids(got) and "39" not in ids(got)


def test_late_rounds_count(spark):
    refresh = [[]] * 9 + [[shard(8, "7", end=None)]]
    assert repair(spark, [lineage_of(0, 7, True)], refresh, rounds=True).count() == 8


def test_large_streams_are_repaired(spark):
    pages = [row for k in range(332) for row in lineage_of(100 + 10 * k, 6, False)]
    pages += lineage_of(10, 8, True)
    assert len(pages) == 2000
    child = [[shard(19, "18", end=None)]]
    assert repair(spark, [pages], child).count() == 2001


def test_deep_lineages(spark):
    deep = shards_frame(spark, lineage_of(0, 150, False))
    depth = lineage.lineage_depth(deep).agg(F.max("depth"), F.count("*")).first()
    assert tuple(depth) == (149, 150)
    none = progress_frame(spark, [])
    assert progress.plan_new_progress(deep, none, TRIM).count() == 150
    rows = progress_frame(spark, [("1", [], "SHARD_END")])
    assert progress.plan_new_progress(deep, rows, LATEST).count() == 149


def test_a_circle_is_an_error(spark):
    chain = lineage_of(0, 5, False)
    circle = shards_frame(spark, [shard("x"), shard("a", "x"), *[shard(c, p) for c, p in (("b", "a"), ("c", "b"))]])
    assert lineage.lineage_depth(circle).count() == 4 and len(chain) == 5
    turning = circle.withColumn("adjacent_parent_shard_id", F.when(F.col("shard_id") == "b", "c"))
    with pytest.raises(RuntimeError, match="cycle"):
        lineage.lineage_depth(turning)


def test_second_parents_count(spark):
    merged = shards_frame(spark, [shard("a"), shard("b"), shard("c", "a", end=None)])
    merged = merged.withColumn("adjacent_parent_shard_id", F.when(F.col("shard_id") == "c", "b"))
    assert ids(lineage.leaf_shards(merged)) == ["c"]
    assert lineage.reopen_leaf_shards(merged).filter("ending_sequence_number is null").count() == 1
    pages = merged.withColumns({"page_no": F.lit(0), "pos": F.monotonically_increasing_id()})
    assert lineage.closed_leaf_shards(pages).count() == 0


def test_siblings_and_chains(spark):
    pages = [[shard("a")]]
    refresh = [[shard("b", "a"), shard("c", "a", end=None), shard("d", "b", end=None)]]
    assert ids(repair(spark, pages, refresh, siblings="first")) == ["a", "b", "d"]
    assert ids(repair(spark, pages, refresh)) == ["a", "b", "c", "d"]
    # A child listed before its parent became a leaf is not taken.
    early = [[shard("d", "b", end=None), shard("b", "a")]]
    assert ids(repair(spark, pages, early)) == ["a", "b"]


def test_listing_order_decides(spark):
    backwards = pages_frame(spark, [[shard("c", "p", end=None), shard("p", end=None)]])
    ends = {r["shard_id"]: r["ending_sequence_number"] for r in lineage.close_open_parents(backwards).collect()}
    assert ends["p"] is None
    anyway = lineage.close_open_parents(backwards, ordered=False)
    assert {r["shard_id"]: r["ending_sequence_number"] for r in anyway.collect()}["p"] == fixed.SYNTHETIC_END
    closed = pages_frame(spark, [[shard("c", "p", end=None), shard("p")]])
    assert ids(lineage.closed_leaf_shards(closed)) == ["p"]
    # The last listing of a shard counts.
    relisted = pages_frame(spark, [[shard("p"), shard("c", "p", end=None)], [shard("p")]])
    assert ids(lineage.closed_leaf_shards(relisted)) == ["p"]


def test_violations(spark):
    shards = shards_frame(
        spark,
        [
            shard("open", end=None),
            shard("childless"),
            shard("narrow", low="0", high="100"),
            shard("n1", "narrow", low="0", high="9"),
            shard("n2", "narrow", low="10", high="99"),
            shard("fine", low="5", high="100"),
            shard("f1", "fine", low="5", high="20"),
            shard("f2", "fine", low="21", high="100"),
        ],
    )
    rows = [(i, [], "SHARD_END") for i in ("open", "childless", "narrow", "fine", "absent")]
    found = lineage.closed_shard_violations(shards, progress_frame(spark, rows)).collect()
    assert {r["shard_id"]: r["violation"] for r in found} == {
        "open": "not_closed",
        "childless": "no_children",
        "narrow": "hash_range_not_covered",
    }


def test_order_of_progress_rows(spark):
    shards = shards_frame(spark, [shard("a", start="100"), shard("b", start="99"), shard("c", start="99")])
    rows = progress_frame(spark, [(i, [], "1") for i in ("a", "z", "c", "b", "y")])
    ordered = progress.order_progress_rows(rows, shards).collect()
    assert [r["shard_id"] for r in ordered] == ["b", "c", "a", "y", "z"]


# Reads, metrics, errors

LOG_SCHEMA = "stream string, shard_id string, sequence_number string, arrival_ts timestamp_ntz"


def test_trim_policy(spark):
    log = spark.sql(
        "SELECT 's' AS stream, 'a' AS shard_id, string(id) AS sequence_number, "
        "TIMESTAMP_NTZ '2024-01-01' AS arrival_ts FROM range(98, 103)"
    )
    rows = progress_frame(spark, [("a", [], "9"), ("b", [], "9")])
    assert plan(reads.apply_trim_policy(rows, log)) == {"a": TRIM, "b": "9"}
    assert plan(reads.apply_trim_policy(progress_frame(spark, [("a", [], "98")]), log)) == {"a": "98"}
    assert plan(reads.apply_trim_policy(progress_frame(spark, [("a", [], TRIM)]), log, "fail")) == {"a": TRIM}
    with pytest.raises(Exception, match="unable to read more records"):
        reads.apply_trim_policy(rows, log, "fail").collect()


def test_at_timestamp_rows_need_a_timestamp(spark):
    log = spark.createDataFrame([], LOG_SCHEMA)
    rows = progress_frame(spark, [("a", [], AT)])
    with pytest.raises(Exception, match="timestamp"):
        reads.apply_start_positions(log, rows).collect()


def test_pages_of_a_listing(spark):
    df = spark.createDataFrame([(k,) for k in "abcde"], "name string")
    first = reads.page_after(df, "name", limit=2).collect()
    assert [(r["name"], r["has_more"]) for r in first] == [("a", True), ("b", True)]
    last = reads.page_after(df, "name", "c", 2).collect()
    assert [(r["name"], r["has_more"]) for r in last] == [("d", False), ("e", False)]
    assert reads.page_after(df, "name").count() == 5
    assert reads.page_after(df, "name", "e", 3).count() == 0


@pytest.mark.parametrize("n, clamped", [(50, 50), (10000, 1000), (None, None)])
def test_clamp(n, clamped):
    from tideline.functions.shards import clamp_limit

    assert clamp_limit(n) == clamped


def test_unknown_stream_status_fails(spark):
    from tideline.functions.shards import normalize_stream_status

    df = spark.createDataFrame([("ODD",)], "status string")
    with pytest.raises(Exception, match="unknown stream status ODD"):
        df.select(normalize_stream_status("status")).collect()


def test_error_rules(spark):
    rows = [
        ("GetShardIterator", "TrimmedDataAccess", "x", None, "AFTER_SEQUENCE_NUMBER"),
        ("GetShardIterator", "TrimmedDataAccess", "x", None, "TRIM_HORIZON"),
        ("GetRecords", "Any", "ThrottlingException", "m", None),
        ("GetRecords", "TrimmedDataAccess", None, "m", None),
        ("ListStreams", "ExpiredIterator", None, "m", None),
    ]
    df = spark.createDataFrame(
        rows, "api string, error_type string, error_code string, message string, iterator_type string"
    )
    skip = [(r["target_error"], r["action"], r["message"]) for r in errors.classify_api_errors(df).collect()]
    assert skip == [
        (None, "reread_from_trim_horizon", ""),
        ("ResourceNotFound", "translate", ""),
        ("ProvisionedThroughputExceeded", "translate", "m"),
        ("ExpiredIterator", "translate", "m"),
        ("ExpiredIterator", "pass_through", "m"),
    ]
    retry = errors.classify_api_errors(df, "retry").collect()
    assert [r["action"] for r in retry] == ["stop", "stop", "translate", "stop", "pass_through"]


def test_lag_is_never_negative(spark):
    from tideline.operators.metrics import lag_by_shard

    log = spark.sql(
        "SELECT 's' AS stream, 'a' AS shard_id, '10' AS sequence_number, "
        "TIMESTAMP '2024-01-01 00:00:10' AS arrival_ts UNION ALL "
        "SELECT 's', 'a', '9', TIMESTAMP '2024-01-01 00:00:20'"
    )
    at = lambda s: F.lit(s).cast("timestamp")
    assert lag_by_shard(log, at("2024-01-01 00:00:10.250")).first()["behind_ms"] == 250
    assert lag_by_shard(log, at("2024-01-01 00:00:00")).first()["behind_ms"] == 0
    assert lag_by_shard(log.limit(0), at("2024-01-01")).count() == 0
