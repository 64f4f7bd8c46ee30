"""Tagged-union attribute values: reading, flattening and writing.

An item image is ``MAP<STRING, VARIANT>``; each value is an object with one type tag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.fixed import ATTRIBUTE_TYPES
from tideline.functions.ordering import _col

_READ_AS = {
    "S": "string",
    "N": "string",
    "B": "string",
    "NULL": "boolean",
    "BOOL": "boolean",
    "SS": "array<string>",
    "NS": "array<string>",
    "BS": "array<string>",
    "M": "map<string,variant>",
    "L": "array<variant>",
}


def _bytes(text: Column) -> Column:
    return F.try_to_binary(text, F.lit("base64"))


def _tail(path: Sequence[str | int]) -> str:
    """Variant path below a top-level attribute: names step into M, positions into L."""
    steps = (f".L[{p}]" if isinstance(p, int) else f".M['{p}']" for p in path)
    return "$" + "".join(steps)


def attribute(
    image: Column | str,
    name: str | Sequence[str | int],
    type: str,
    as_type: str | None = None,
    double_base64: bool = False,
) -> Column:
    """Read one attribute as one of the ten types; absent or differently typed gives null.

    ``name`` may be a path such as ``("address", "lines", 0)`` through M and L values. Numbers
    stay text unless ``as_type`` asks for a cast, which never fails.
    """
    if type not in ATTRIBUTE_TYPES:
        raise ValueError(f"unknown attribute type {type!r}")
    path = (name,) if isinstance(name, str) else tuple(name)
    item = F.try_element_at(_col(image), F.lit(path[0]))
    value = F.try_variant_get(item, f"{_tail(path[1:])}.{type}", _READ_AS[type])
    if type == "B":
        value = _bytes(value)
        if double_base64:
            value = _bytes(value.cast("string"))
    elif type == "BS":
        value = F.transform(value, _bytes)
    return value.try_cast(as_type) if as_type else value


def has_attribute(image: Column | str, name: str) -> Column:
    """Whether the attribute is present, whatever its type; tells NULL from absent."""
    return F.coalesce(F.map_contains_key(_col(image), F.lit(name)), F.lit(False))


def flatten_image(
    df: DataFrame, image: str, schema: Mapping[str, tuple], keep: Sequence[str] = ()
) -> DataFrame:
    """Typed columns from an image: ``{column: (name_or_path, type[, as_type])}``."""
    return df.select(*keep, *[attribute(image, *spec).alias(c) for c, spec in schema.items()])


def discover_attributes(df: DataFrame, image: str) -> DataFrame:
    """Attribute names and types present in the data, with counts; one aggregate pass."""
    # The outer form keeps the optimizer from testing the image (and decoding it) twice.
    pairs = df.select(F.explode_outer(image).alias("name", "value")).filter("name IS NOT NULL")
    return pairs.groupBy("name", _tag("value").alias("type")).agg(F.count("*").alias("n"))


MAX_ATTRIBUTES = 10_000  # of a schema, which the driver holds; more are an error


def infer_attributes(df: DataFrame, image: str) -> dict[str, tuple]:
    """A schema for ``flatten_image`` from the data: ``{column: (name, type[, as_type])}``, by name.

    An attribute of one type has one column of its name; NULL beside another type adds none, being
    that column's null. One of several types has a column for each, named with the type. Numbers that are
    all whole and fit become bigint, others that fit become double without a change of value, and the
    rest stays text. One aggregate pass with map-side combine; a row per name and type is collected.
    """
    pairs = df.select(F.explode_outer(image).alias("name", "value")).filter("name IS NOT NULL")
    number = F.try_variant_get("value", "$.N", "string")
    exact = number.try_cast("decimal(38,18)") == number.try_cast("double").try_cast("decimal(38,18)")
    found = (
        pairs.select("name", _tag("value").alias("type"), number.alias("number"), F.coalesce(exact, F.lit(False)).alias("exact"))
        .filter(F.col("type") != "")
        .groupBy("name", "type")
        .agg(
            F.bool_and(F.coalesce(F.col("number").rlike("^[+-]?[0-9]+$"), F.lit(False)) & F.col("number").try_cast("bigint").isNotNull()).alias("whole"),
            F.bool_and("exact").alias("exact"),
        )
        .limit(MAX_ATTRIBUTES + 1)
        .collect()
    )
    if len(found) > MAX_ATTRIBUTES:
        raise ValueError(f"more than {MAX_ATTRIBUTES} attributes")
    types: dict[str, dict[str, tuple]] = {}
    for row in sorted(found):
        cast = ("bigint",) if row["whole"] else ("double",) if row["exact"] else ()
        types.setdefault(row["name"], {})[row["type"]] = (row["name"], row["type"], *(cast if row["type"] == "N" else ()))
    schema = {}
    for name, specs in types.items():
        if len(specs) > 1:
            specs.pop("NULL", None)
        for type, spec in specs.items():
            schema[name if len(specs) == 1 else f"{name}_{type}"] = spec
    return schema


def _tag(value: Column | str) -> Column:
    return F.regexp_extract(F.schema_of_variant(value), "^OBJECT<([A-Z]+): ", 1)


def encode_attribute(c: Column | str, type: str) -> Column:
    """Native value to a tagged union; bytes become base64 text, a null value stays null."""
    if type not in ATTRIBUTE_TYPES:
        raise ValueError(f"unknown attribute type {type!r}")
    c = _col(c)
    value = c
    if type == "N":
        value = c.cast("string")
    elif type == "B":
        value = F.base64(c)
    elif type == "BS":
        value = F.transform(c, F.base64)
    elif type in ("M", "L"):
        tagged = F.parse_json(F.to_json(F.struct(c.alias(type))))
        return F.when(c.isNotNull(), tagged)
    return F.when(c.isNotNull(), F.to_variant_object(F.struct(value.alias(type))))


def build_image(attributes: Mapping[str, tuple]) -> Column:
    """Image from ``{name: (column, type)}``; attributes whose column is null are left out."""
    entries = [
        F.struct(F.lit(name).alias("key"), encode_attribute(c, type).alias("value"))
        for name, (c, type) in attributes.items()
    ]
    present = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return F.map_from_entries(present)


def build_typed_image(attributes: Mapping[str, tuple]) -> Column:
    """The same for a fixed set of scalar attributes, as a struct of typed tagged values.

    Encoding takes either form; this one stays in generated code, without variants.
    """
    fields = []
    for name, (c, type) in attributes.items():
        c = _col(c)
        value = {"N": lambda: c.cast("string"), "B": lambda: F.base64(c)}.get(type, lambda: c)()
        fields.append(F.when(c.isNotNull(), F.struct(value.alias(type))).alias(name))
    return F.struct(*fields)
