"""Change-record envelopes: JSON payload to columns and back."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tideline import fixed
from tideline.functions.ordering import _col

IMAGE = "map<string,variant>"

# column name -> (payload field, type), envelope level
_ENVELOPE = {
    "event_id": (fixed.EVENT_ID, "string"),
    "event_name": (fixed.EVENT_NAME, "string"),
    "event_version": (fixed.EVENT_VERSION, "string"),
    "event_source": (fixed.EVENT_SOURCE, "string"),
    "aws_region": (fixed.REGION, "string"),
}
# column name -> (payload field, type), body level
_BODY = {
    "size_bytes": (fixed.SIZE_BYTES, "bigint"),
    "sequence_number": (fixed.SEQUENCE_NUMBER, "string"),
    "stream_view_type": (fixed.VIEW_TYPE, "string"),
    "keys": (fixed.KEYS, IMAGE),
    "new_image": (fixed.NEW_IMAGE, IMAGE),
    "old_image": (fixed.OLD_IMAGE, IMAGE),
    "approximate_creation_ts": (fixed.CREATION_TIME, "variant"),
}
CORRUPT = "_corrupt"
VALID = "_valid"


def _spellings(field: str) -> tuple[str, str]:
    """A field name with a lower- and an upper-case initial."""
    return field[0].lower() + field[1:], field[0].upper() + field[1:]


def _lowered(value: Column) -> Column:
    """A variant object as a map by lower-case name, the first of equal names; null for anything else."""
    entries = F.transform(
        F.map_entries(F.try_variant_get(value, "$", IMAGE)),
        lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value")),
    )
    names = F.transform(entries, lambda e: e["key"])
    return F.map_from_entries(F.filter(entries, lambda e, i: F.array_position(names, e["key"]) == i + 1))


def _both(fields: dict[str, tuple[str, str]]) -> list[tuple[str, str]]:
    """(name, type) of every field in both spellings."""
    return [(name, type) for field, type in fields.values() for name in _spellings(field)]


def _unpack(df: DataFrame, struct: Column, fields: list[str], keep: Sequence[str]) -> DataFrame:
    """A struct's fields, renamed by position, as columns.

    A generator rather than a projection: names that differ only in case stay apart, and filters
    on the result are not copied below it, so the payload is parsed once.
    """
    return df.select(*keep, F.inline(F.array(struct)).alias(*fields))


def _first(name: str) -> Column:
    return F.coalesce(f"{name}_lower", f"{name}_upper")


def _named(fields: Column, field: str, type: str) -> Column:
    """A field of a map by lower-case name; structures stay as text where text is wanted."""
    value = F.element_at(fields, field.lower())
    if type == "variant":
        return value
    read = F.try_variant_get(value, "$", type)
    return F.coalesce(read, F.to_json(value)) if type == "string" else read


def _instant(value: Column) -> Column:
    """Epoch seconds with a fraction, or ISO text, to a timestamp; anything else to null."""
    text = F.try_variant_get(value, "$", "string")
    micros = (text.try_cast("decimal(24,9)") * F.lit(1000000)).try_cast("bigint")
    return F.coalesce(F.timestamp_micros(micros), F.try_to_timestamp(text))


def decode_records(
    df: DataFrame, col: str = "data", keep: Sequence[str] = (), fields: Sequence[str] | None = None
) -> DataFrame:
    """JSON payloads to envelope columns, plus the ``keep`` columns of the input.

    Unknown fields, including the user identity, are ignored. A payload is parsed once, for names with
    a lower- or upper-case initial; only one without an event name, a body or a sequence number
    is read again for names in any case. ``_valid`` tells records from other payloads, which are kept
    as text in ``_corrupt`` (null for a null payload). ``fields`` limits what is parsed to the
    columns named.
    """
    wanted = list(fields) if fields is not None else [*_ENVELOPE, *_BODY]
    unknown = set(wanted) - set(_ENVELOPE) - set(_BODY)
    if unknown:
        raise ValueError(f"unknown record fields {sorted(unknown)}")
    outer = {n: spec for n, spec in _ENVELOPE.items() if n in wanted or n == "event_name"}
    inner = {n: spec for n, spec in _BODY.items() if n in wanted or n == "sequence_number"}

    body = ",".join(f"`{name}`:{type}" for name, type in _both(inner))
    parts = [f"`{name}` {type}" for name, type in _both(outer)]
    parts += [f"`{name}` struct<{body}>" for name in _spellings(fixed.BODY)]
    schema = ", ".join([*parts, f"`{CORRUPT}` string"])
    cases = ("lower", "upper")
    envelope = [f"{n}_{case}" for n in outer for case in cases]
    bodies = [f"_body_{case}" for case in cases]
    text = F.col(col).cast("string")
    record = F.from_json(text, schema, {"columnNameOfCorruptRecord": CORRUPT})
    result = _unpack(df.withColumn("_payload", text), record, [*envelope, *bodies, CORRUPT], [*keep, "_payload"])
    carried = [*keep, "_payload", *envelope, CORRUPT]
    result = _unpack(result, _first("_body"), [f"{n}_{case}" for n in inner for case in cases], carried)

    blank = F.coalesce(F.trim("_payload") == "", F.lit(True))
    whole = F.col(CORRUPT).isNull() & ~blank
    unusual = whole & (_first("event_name").isNull() | _first("sequence_number").isNull())
    again = _lowered(F.try_parse_json(F.when(unusual, F.col("_payload"))))
    carried += [f"{n}_{case}" for n in inner for case in cases]
    result = _unpack(result, F.struct(again), ["_outer"], carried)
    named_body = F.element_at("_outer", fixed.BODY.lower())
    result = _unpack(result, F.struct(_lowered(named_body)), ["_inner"], [*carried, "_outer"])

    columns = []
    for n in wanted:
        field, type = outer[n] if n in outer else inner[n]
        value = F.coalesce(_first(n), _named(F.col("_outer" if n in outer else "_inner"), field, type))
        columns.append((_instant(value) if n == "approximate_creation_ts" else value).alias(n))
    named_body = F.element_at("_outer", fixed.BODY.lower())
    odd_body = F.coalesce(F.col("_inner").isNull() & named_body.isNotNull(), F.lit(False))
    odd_body = odd_body & ~F.coalesce(F.is_variant_null(named_body), F.lit(False))
    valid = F.col(CORRUPT).isNull() & ~blank & ~odd_body
    corrupt = F.when(~valid, F.col("_payload")).alias(CORRUPT)
    return result.select(*keep, *columns, corrupt, valid.alias(VALID))


def _filled(df: DataFrame, name: str) -> Column:
    """An image with at least one attribute, in map or struct form; else null."""
    type = df.schema[name].dataType
    if isinstance(type, StructType):
        present = [F.col(f"`{name}`.`{field}`").isNotNull() for field in type.names]
        return F.when(reduce(or_, present, F.lit(False)), F.col(name))
    return F.when(F.size(name) > 0, F.col(name))


def encode_payload(df: DataFrame) -> Column:
    """Compact UTF-8 JSON of a record's columns; null, empty and zero fields are left out.

    Images are maps of variants, or structs of tagged values.
    """

    def have(name: str) -> Column:
        if name in df.columns:
            return F.col(name)
        return F.lit(None).cast("string")

    body = []
    for name, (field, type) in _BODY.items():
        value = have(name)
        if name not in df.columns:
            continue
        if type == IMAGE:
            value = _filled(df, name)
        elif name == "size_bytes":
            value = F.nullif(value.cast("bigint"), F.lit(0).cast("bigint"))
        elif name == "approximate_creation_ts":
            micros = F.unix_micros(value.cast("timestamp")).cast("decimal(24,6)")
            value = (micros / F.lit(1000000)).cast("decimal(24,9)")
        body.append(value.alias(field))
    envelope = [have(name).alias(field) for name, (field, _) in _ENVELOPE.items()]
    record = F.struct(*envelope, F.struct(*body).alias(fixed.BODY))
    return F.encode(F.to_json(record), "UTF-8")


def encode_records(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Envelope columns to a ``data`` payload."""
    return df.select(*keep, encode_payload(df).alias("data"))


def to_delivered_record(
    df: DataFrame, generate_bytes: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Records as delivered: sequence number, payload, null partition key, arrival time.

    ``generate_bytes=False`` skips the payload work and delivers empty bytes.
    """
    data = encode_payload(df) if generate_bytes else F.lit(bytearray())
    return df.select(
        *keep,
        "sequence_number",
        data.alias("data"),
        F.lit(None).cast("string").alias("partition_key"),
        F.col("approximate_creation_ts").alias("approximate_arrival_ts"),
    )


def drop_user_identity(df: DataFrame) -> DataFrame:
    """The identity of the writer never leaves the engine."""
    return df.drop("user_identity", "userIdentity")


def operation_kind(c: Column | str) -> Column:
    """INSERT and MODIFY put an item, REMOVE deletes it; anything else is null."""
    c = _col(c)
    return F.when(c.isin(fixed.INSERT, fixed.MODIFY), "upsert").when(c == fixed.REMOVE, "delete")


def payload_bytes(c: Column | str = "data") -> Column:
    """Payload size in bytes."""
    return F.octet_length(_col(c))
