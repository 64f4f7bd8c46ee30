"""Attribute values and payloads: every type, both spellings, corrupt input, round trips."""

from __future__ import annotations

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tideline import fixed
from tideline.functions import attributes as A
from tideline.functions import records as R
from tideline.functions.ordering import sequence_key


def decode(spark, *payloads, **kw):
    return R.decode_records(spark.createDataFrame([(p,) for p in payloads], "data string"), **kw)


def image_of(spark, image):
    payload = json.dumps({fixed.BODY: {"NewImage": image}})
    return decode(spark, payload, fields=["new_image"])


def test_every_attribute_type(spark):
    df = image_of(
        spark,
        {
            "s": {"S": "text"},
            "n": {"N": "12345678901234567890123456789012345678.5"},
            "b": {"B": "aGVsbG8="},
            "bb": {"B": "YUdWc2JHOD0="},
            "null": {"NULL": True},
            "yes": {"BOOL": False},
            "ss": {"SS": ["b", "a"]},
            "ns": {"NS": ["1", "2.5"]},
            "bs": {"BS": ["aGk=", "!!"]},
            "m": {"M": {"in ner": {"L": [{"S": "x"}, {"M": {"deep": {"N": "7"}}}]}}},
            "l": {"L": [{"S": "x"}, {"N": "1"}, {"NULL": True}]},
        },
    )
    get = lambda name, type, *a, **k: A.attribute("new_image", name, type, *a, **k)
    row = df.select(
        get("s", "S"),
        get("n", "N"),
        get("n", "N", "decimal(10,2)"),
        get("b", "B"),
        get("bb", "B", double_base64=True),
        get("null", "NULL"),
        get("yes", "BOOL"),
        get("ss", "SS"),
        get("ns", "NS"),
        get("bs", "BS"),
        F.size(get("m", "M")),
        F.size(get("l", "L")),
        get(("m", "in ner", 1, "deep"), "N", "int"),
        get(("l", 0), "S"),
        get("s", "N"),
        get("absent", "S"),
        A.has_attribute("new_image", "null"),
        A.has_attribute("new_image", "absent"),
    ).first()
    assert list(row) == [
        "text",
        "12345678901234567890123456789012345678.5",
        None,
        b"hello",
        b"hello",
        True,
        False,
        ["b", "a"],
        ["1", "2.5"],
        [b"hi", None],
        1,
        3,
        7,
        "x",
        None,
        None,
        True,
        False,
    ]
    with pytest.raises(ValueError):
        A.attribute("new_image", "s", "X")


def test_discovered_types(spark):
    df = image_of(spark, {"a": {"S": "x"}, "b": {"NULL": True}, "c": {"L": []}, "d": {"BOOL": True}})
    found = {(r["name"], r["type"]) for r in A.discover_attributes(df, "new_image").collect()}
    assert found == {("a", "S"), ("b", "NULL"), ("c", "L"), ("d", "BOOL")}


@pytest.mark.parametrize("upper", [False, True])
def test_both_spellings_and_unknown_fields(spark, upper):
    spell = lambda s: (s[0].upper() if upper else s[0].lower()) + s[1:]
    payload = {
        spell("eventID"): "1",
        spell("eventName"): "REMOVE",
        "userIdentity": {"principalId": "x"},
        "somethingNew": [1],
        fixed.BODY: {
            spell("SizeBytes"): 2**63 - 1,
            spell("SequenceNumber"): "300000000000000499659",
            spell("Keys"): {"Id": {"N": "101"}},
            spell("ApproximateCreationDateTime"): 1704067207.179575123,
            "alsoNew": None,
        },
    }
    row = decode(spark, json.dumps(payload)).first()
    assert row["event_id"] == "1" and row["event_name"] == "REMOVE"
    assert row["size_bytes"] == 2**63 - 1
    assert row["sequence_number"] == "300000000000000499659"
    assert row["approximate_creation_ts"].isoformat() == "2024-01-01T00:00:07.179575"
    assert row["new_image"] is None and row["_corrupt"] is None
    assert "userIdentity" not in row.asDict()


def test_creation_time_as_text_or_whole_seconds(spark):
    body = lambda v: json.dumps({fixed.BODY: {"ApproximateCreationDateTime": v}})
    df = decode(spark, body("2024-01-01T00:00:07.5Z"), body(1704067207), body("never"))
    times = [r["approximate_creation_ts"] for r in df.collect()]
    assert [t and t.isoformat() for t in times] == [
        "2024-01-01T00:00:07.500000",
        "2024-01-01T00:00:07",
        None,
    ]


def test_corrupt_payloads_are_kept(spark):
    df = decode(spark, "no json", "[1]", "7", None, "{}", json.dumps({fixed.BODY: 3}))
    assert [r["_corrupt"] for r in df.collect()] == [
        "no json",
        "[1]",
        "7",
        None,
        None,
        json.dumps({fixed.BODY: 3}),
    ]


def test_payload_is_parsed_once_under_a_filter(spark):
    df = decode(spark, "{}").filter("event_name = 'INSERT' AND sequence_number = '1'")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_empty_and_zero_fields_are_left_out(spark):
    df = spark.sql(
        "SELECT '1' AS event_id, string(null) AS event_name, 0L AS size_bytes, '5' AS sequence_number,"
        "map_from_arrays(array(), array()) AS keys"
    )
    df = df.withColumn("keys", A.build_image({"k": (F.lit(None).cast("string"), "S")}))
    text = R.encode_records(df).select(F.col("data").cast("string")).first()[0]
    assert json.loads(text) == {"eventID": "1", fixed.BODY: {"SequenceNumber": "5"}}


SCALARS = {
    "s": ("S", st.text(max_size=8)),
    "n": ("N", st.integers(-(10**30), 10**30).map(str)),
    "b": ("B", st.binary(max_size=8).map(bytearray)),
    "flag": ("BOOL", st.booleans()),
}


@pytest.mark.parametrize("build", [A.build_image, A.build_typed_image])
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(
        st.fixed_dictionaries({k: st.none() | s for k, (_, s) in SCALARS.items()}),
        min_size=1,
        max_size=6,
    )
)
def test_round_trip(spark, build, rows):
    schema = "i int, s string, n string, b binary, flag boolean"
    df = spark.createDataFrame([(i, r["s"], r["n"], r["b"], r["flag"]) for i, r in enumerate(rows)], schema)
    image = build({k: (F.col(k), t) for k, (t, _) in SCALARS.items()})
    sent = df.select("i", F.lit("7").alias("sequence_number"), image.alias("new_image"))
    received = R.decode_records(R.encode_records(sent, ["i"]), keep=["i"])
    values = [A.attribute("new_image", k, t).alias(k) for k, (t, _) in SCALARS.items()]
    got = [tuple(r) for r in received.select("i", *values).orderBy("i").collect()]
    assert got == [(i, r["s"], r["n"], r["b"], r["flag"]) for i, r in enumerate(rows)]


def test_encoded_attributes_of_nested_and_set_types(spark):
    df = spark.range(1).select(
        A.build_image(
            {
                "ss": (F.array(F.lit("b"), F.lit("a")), "SS"),
                "bs": (F.array(F.lit(bytearray(b"hi"))), "BS"),
                "m": (F.create_map(F.lit("k"), A.encode_attribute(F.lit(5), "N")), "M"),
                "l": (F.array(A.encode_attribute(F.lit("x"), "S")), "L"),
                "null": (F.lit(True), "NULL"),
            }
        ).alias("new_image")
    )
    row = df.select(
        A.attribute("new_image", "ss", "SS"),
        A.attribute("new_image", "bs", "BS"),
        A.attribute("new_image", ("m", "k"), "N"),
        A.attribute("new_image", ("l", 0), "S"),
        A.attribute("new_image", "null", "NULL"),
    ).first()
    assert list(row) == [["b", "a"], [b"hi"], "5", "x", True]


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(numbers=st.lists(st.integers(0, 10**60), min_size=1, max_size=20))
def test_sequence_key_orders_like_integers(spark, numbers):
    texts = [("0" * (n % 3) + str(n),) for n in numbers]
    df = spark.createDataFrame(texts, "n string").orderBy(sequence_key("n"))
    assert [int(r["n"]) for r in df.collect()] == sorted(numbers)


def test_delivered_record(spark):
    df = spark.sql("SELECT 'e' AS event_id, '9' AS sequence_number, TIMESTAMP '2024-01-01' AS approximate_creation_ts")
    full = R.to_delivered_record(df).first()
    assert full["sequence_number"] == "9" and full["partition_key"] is None and len(full["data"]) > 0
    assert R.to_delivered_record(df, generate_bytes=False).first()["data"] == b""


def test_operation_kinds_and_identity(spark):
    df = spark.createDataFrame([("INSERT",), ("MODIFY",), ("REMOVE",), ("X",)], "op string")
    kinds = [r[0] for r in df.select(R.operation_kind("op")).collect()]
    assert kinds == ["upsert", "upsert", "delete", None]
    assert R.drop_user_identity(df.withColumn("user_identity", F.lit(1))).columns == ["op"]
