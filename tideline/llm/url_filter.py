"""URL rules, and a listing of hosts held as a cascade of Bloom filters.

The cascade's first level encodes the listed keys; the second those other keys of the corpus that
the first lets through; the third the listed keys that the second lets through, and so on until a
level lets nothing wrong through. Over the keys of the corpus membership is then exact, and judging
a URL joins nothing. Keys are split into buckets by hash, each with a cascade of its own built in
one task; the filters, about two bits a key, are broadcast in parts of at most ``MAX_BROADCAST``
bytes, each judging the keys of its buckets.

Rules are ``host/path`` texts. A rule fits its host and all subdomains if the URL's path starts
with the rule's path; the longest rule wins, then the first in code-point order.

A null URL and one without ``://`` have empty host and path, fit no rule and are listed only if the
empty host is. Repeated rows are judged each; an empty table has an empty result. Input columns
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tideline.scale import cut

KEYS_PER_BUCKET = 100_000
MAX_BROADCAST = 32 * 1024 * 1024
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FILTERS = "bucket bigint, level int, bits bigint, hashes int, data binary"
_ODD = np.uint64(0x9E3779B97F4A7C15)


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to the path, query or fragment, in lower case."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    return F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The winning rule's text and verdict; null where none fits."""
    rule = verdict = F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: (-len(r[1]), r[1]), reverse=True):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def _positions(h1: np.ndarray, h2: np.ndarray, level, bits, hashes: int) -> Iterator[np.ndarray]:
    start = (h1 ^ (h2 >> np.uint64(7))) + np.asarray(level, np.uint64) * _ODD
    start = (start ^ (start >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    step = h2 | np.uint64(1)
    for k in range(hashes):
        mixed = start + np.uint64(k) * step
        yield (mixed ^ (mixed >> np.uint64(33))) % np.asarray(bits, np.uint64)


def _has(data: np.ndarray, h1, h2, level: int, bits: int, hashes: int) -> np.ndarray:
    found = np.ones(len(h1), bool)
    for at in _positions(h1, h2, level, bits, hashes):
        found &= (data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return found


def build_levels(h1: np.ndarray, h2: np.ndarray, listed: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(bits, hashes, data) of each level for one bucket's keys."""
    inside, outside, levels = np.flatnonzero(listed), np.flatnonzero(~listed), []
    while len(inside):
        rate = 0.5
        if not levels and len(outside):
            rate = min(0.5, max(1e-6, len(inside) / len(outside) * 0.7))
        bits = max(64, int(np.ceil(len(inside) * np.log2(1 / rate) / np.log(2))))
        hashes = max(1, round(np.log2(1 / rate)))
        data = np.zeros(bits // 8 + 1, np.uint8)
        for at in _positions(h1[inside], h2[inside], len(levels), bits, hashes):
            np.bitwise_or.at(data, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        wrong = outside[_has(data, h1[outside], h2[outside], len(levels), bits, hashes)]
        levels.append((bits, hashes, data.tobytes()))
        if len(levels) > 200:
            raise ValueError("a listed and an unlisted key share their 128-bit hash")
        inside, outside = wrong, inside
    return levels


def _built(keys: pd.DataFrame) -> pd.DataFrame:
    h1, h2 = keys["h1"].to_numpy(np.int64).view(np.uint64), keys["h2"].to_numpy(np.int64).view(np.uint64)
    levels = build_levels(h1, h2, keys["listed"].to_numpy(bool))
    rows = [(keys["bucket"].iloc[0], i, *level) for i, level in enumerate(levels)]
    return pd.DataFrame(rows, columns=["bucket", "level", "bits", "hashes", "data"])


def _hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def build_cascade(keys: DataFrame, listed: DataFrame) -> tuple[DataFrame, int]:
    """Filters of all buckets, and the number of buckets.

    ``keys`` (key) are those of the corpus, repeated or not; ``listed`` (key) is any list. Each
    key is one row before it reaches a bucket.
    """
    both = keys.select("key", F.lit(True).alias("here"), F.lit(False).alias("listed")).unionByName(
        listed.select("key", F.lit(False).alias("here"), F.lit(True).alias("listed"))
    )
    universe = both.groupBy("key").agg(F.max("here").alias("here"), F.max("listed").alias("listed")).filter("here")
    h1, h2 = _hashes(F.col("key"))
    universe = cut(universe.select(h1.alias("h1"), h2.alias("h2"), "listed"))
    buckets = universe.count() // KEYS_PER_BUCKET + 1
    dealt = universe.withColumn("bucket", F.pmod(F.col("h1"), F.lit(buckets)))
    return cut(dealt.groupBy("bucket").applyInPandas(_built, _FILTERS)), buckets


class Cascade:
    """The filters of some buckets, tested for many keys at once."""

    def __init__(self, rows: list):
        self.buckets: dict[int, list[tuple[int, int, np.ndarray]]] = {}
        for r in sorted(rows, key=lambda r: (r["bucket"], r["level"])):
            level = (r["bits"], r["hashes"], np.frombuffer(r["data"], np.uint8))
            self.buckets.setdefault(r["bucket"], []).append(level)

    def lists(self, bucket: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        result = np.zeros(len(h1), bool)
        for b in np.unique(bucket):
            alive = np.flatnonzero(bucket == b)
            for i, (bits, hashes, data) in enumerate(self.buckets.get(int(b), ())):
                passed = _has(data, h1[alive], h2[alive], i, bits, hashes)
                alive = alive[passed]
                # whoever passes level i is listed if i is even, until a later level says otherwise
                result[alive] = i % 2 == 0
        return result


def _lists(held: Broadcast) -> Callable:
    @pandas_udf("boolean")
    def lists(bucket: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.Series:
        a, b = h1.to_numpy(np.int64).view(np.uint64), h2.to_numpy(np.int64).view(np.uint64)
        return pd.Series(Cascade(held.value).lists(bucket.to_numpy(np.int64), a, b))

    return lists


def is_listed(df: DataFrame, key: str, cascade: DataFrame, buckets: int, max_bytes: int = MAX_BROADCAST) -> DataFrame:
    """``df`` with ``listed`` for each key; one pass over the rows per broadcast part."""
    size = cascade.agg(F.sum(F.length("data") + F.lit(64))).first()[0] or 0
    parts = size // max_bytes + 1
    h1, h2 = _hashes(F.col(key))
    keyed = df.withColumns({"_h1": h1, "_h2": h2}).withColumn("_bucket", F.pmod(F.col("_h1"), F.lit(buckets)))
    judged = None
    for part in range(parts):
        mine = cascade.filter(F.pmod(F.col("bucket"), F.lit(parts)) == part)
        held = df.sparkSession.sparkContext.broadcast(mine.collect())  # about max_bytes at most

        own = keyed.filter(F.pmod(F.col("_bucket"), F.lit(parts)) == part)
        own = own.withColumn("listed", _lists(held)("_bucket", "_h1", "_h2")).drop("_h1", "_h2", "_bucket")
        judged = own if judged is None else judged.unionByName(own)
    return judged


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule, listed and verdict.

    ``listed`` (key) are blocked hosts; a rule goes before the listing.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "listed", "verdict")]
    split = pages.select(*kept, url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    cascade, buckets = build_cascade(split.select(F.coalesce("host", F.lit("")).alias("key")), listed)
    split = split.withColumns({"host": F.coalesce("host", F.lit("")), "path": F.coalesce("path", F.lit(""))})
    judged = is_listed(split, "host", cascade, buckets)
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("listed"), "block").otherwise("allow")
    return judged.withColumns({"rule": rule, "verdict": F.coalesce(verdict, own)})
