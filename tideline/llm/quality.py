"""Quality rules whose cutoffs follow each language and source.

Every document's measures go into mergeable quantile sketches (logarithmic buckets of relative
width ``2 * ACCURACY``, whose counts add up), one per language, source and measure. A group's quartiles
are blended with those of its language, and these with those of all documents: n documents of its own
weigh n against ``PRIOR`` of the wider group, so small groups lean on it and large ones on themselves.
The quartiles give fences far outside the group's bulk; a document beyond a fence is rejected.

Null texts count as empty, null languages and sources are groups of their own, repeated rows count
each time, an empty table has an empty result. Input columns named like a result are replaced.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.common import BLANK, null_key, word_list
from tideline.scale import cut, join_bounded

SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
ACCURACY = 0.01
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
FENCE = 6.0  # quartile distances
PRIOR = 200  # documents that the wider group weighs against a group's own


class Measure(NamedTuple):
    """A ratio of two counts and the least distance of its fences from the quartiles."""

    name: str
    over: str
    under: str
    margin: float


MEASURES = (
    Measure("symbol_ratio", "n_symbols", "word_chars", 0.10),
    Measure("mean_word", "word_chars", "n_words", 2.0),
    Measure("dup_line_ratio", "n_dup_lines", "n_lines", 0.30),
    Measure("repeat_ratio", "n_repeat_words", "n_words", 0.10),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def _repeated(windows: Column) -> Column:
    """Words inside windows that occur twice or more, given every window's hash."""
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(pairs: Column) -> Column:
        def twin(x: Column, i: Column) -> Column:
            before, after = F.get(pairs, i - 1)["h"], F.get(pairs, i + 1)["h"]
            return F.coalesce(before == x["h"], F.lit(False)) | F.coalesce(after == x["h"], F.lit(False))

        return F.sort_array(F.transform(F.filter(pairs, twin), lambda x: x["i"]))

    starts = F.flatten(F.transform(F.array(placed), again))
    none = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    total = F.aggregate(
        starts,
        none,
        lambda acc, i: F.struct(
            (i + WINDOW).alias("end"), (acc["n"] + i + WINDOW - F.greatest(i, acc["end"])).alias("n")
        ),
    )
    return total["n"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts of each whole text."""
    docs = docs.drop(*COUNTS).select(F.struct("*").alias("row"), F.col(text).alias("_text"))
    text = F.coalesce(F.col("_text"), F.lit(""))
    with_word = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{BLANK}]"))
    docs = docs.select(
        "row",
        word_list(text).alias("_words"),
        with_word.alias("_lines"),
        F.length(F.regexp_replace(text, f"[{BLANK}]+", "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    n = F.size("_words")
    none = F.array().cast("array<bigint>")
    hashes = F.transform(
        F.sequence(F.lit(0), n - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)]),
    )
    docs = docs.select(
        *[c for c in docs.columns if c not in ("_words", "_lines")],
        n.cast("bigint").alias("n_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(n >= WINDOW, hashes).otherwise(none).alias("_windows"),
    )
    windows = F.col("_windows")
    repeats = F.when(F.size(F.array_distinct(windows)) < F.size(windows), _repeated(windows)).otherwise(0)
    counts = F.struct(*[c for c in COUNTS if c != "n_repeat_words"], repeats.cast("bigint").alias("n_repeat_words"))
    # behind a generator, filters on the counts do not copy their expressions
    return docs.select("row", F.inline(F.array(counts))).select("row.*", *COUNTS)


def _failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def _value(m: Measure) -> Column:
    return F.col(m.over) / F.greatest(F.col(m.under), F.lit(1))


def sketch(measured: DataFrame) -> DataFrame:
    """(_lang, _source, measure, bucket, n): the sketches; bucket null holds the zeros."""
    values = F.array(*[F.struct(F.lit(m.name).alias("measure"), _value(m).alias("x")) for m in MEASURES])
    bucket = F.when(F.col("v.x") > 0, F.ceil(F.log("v.x") / F.log(F.lit(GAMMA))).cast("int"))
    return (
        measured.select(null_key("lang").alias("_lang"), null_key("source").alias("_source"), F.explode(values).alias("v"))
        .groupBy("_lang", "_source", "v.measure", bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, measure, _n, _low, _high): size and lower and upper quartile of each group and measure."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "measure")
    upto = group.orderBy(F.col("bucket").asc_nulls_first())
    value = F.when(F.col("bucket").isNull(), 0.0).otherwise(
        F.lit(2.0) * F.pow(F.lit(GAMMA), F.col("bucket")) / (F.lit(GAMMA) + 1)
    )
    placed = merged.select(
        *keys, "measure", value.alias("x"), F.sum("n").over(upto).alias("_upto"), F.sum("n").over(group).alias("_all")
    )
    reached = [F.min(F.when(4 * F.col("_upto") >= q * F.col("_all"), F.col("x"))) for q in (1, 3)]
    return placed.groupBy(*keys, "measure").agg(F.max("_all").alias("_n"), reached[0].alias("_low"), reached[1].alias("_high"))


def _blended(own: DataFrame, wider: DataFrame, keys: list[str], prior: int) -> DataFrame:
    """``own`` quartiles drawn towards those of the group around it, which shares ``keys``."""
    around = wider.select(*keys, F.col("_low").alias("_wide_low"), F.col("_high").alias("_wide_high"))
    drawn = {
        f"_{end}": (F.col("_n") * F.col(f"_{end}") + prior * F.col(f"_wide_{end}")) / (F.col("_n") + prior)
        for end in ("low", "high")
    }
    return own.join(around, keys).withColumns(drawn).drop("_wide_low", "_wide_high")


def fences(sketches: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Per language and source, the accepted range of each measure (_from_*, _to_*)."""
    by_lang = _blended(quartiles(sketches, ["_lang"]), quartiles(sketches, []), ["measure"], prior)
    chosen = _blended(quartiles(sketches, ["_lang", "_source"]), by_lang, ["_lang", "measure"], prior)
    limits = []
    for m in MEASURES:
        reach = F.greatest(FENCE * (F.col("_high") - F.col("_low")), F.lit(m.margin))
        mine = F.col("measure") == m.name
        limits.append(F.max(F.when(mine, F.col("_low") - reach)).alias(f"_from_{m.name}"))
        limits.append(F.max(F.when(mine, F.col("_high") + reach)).alias(f"_to_{m.name}"))
    return chosen.groupBy("_lang", "_source").agg(*limits)


def judge(measured: DataFrame, prior: int = PRIOR) -> DataFrame:
    """Measured documents with ``base_failed`` and ``kept``.

    The sketches describe the documents that pass the base rules; their fences join the documents
    again by language and source (broadcast when measured small, else salted).
    """
    measured = measured.drop("base_failed", "kept").withColumn("base_failed", _failed())
    limits = fences(cut(sketch(measured.filter(~F.col("base_failed")))), prior)
    # the row as a struct: its other columns cannot clash with these
    keyed = measured.select(
        F.struct("*").alias("row"), *COUNTS, "base_failed", null_key("lang").alias("_lang"), null_key("source").alias("_source")
    )
    judged = join_bounded(keyed, limits, ["_lang", "_source"], "left", spread="word_chars")
    inside = reduce(
        and_, [_value(m).between(F.col(f"_from_{m.name}"), F.col(f"_to_{m.name}")) for m in MEASURES]
    )
    kept = ~F.col("base_failed") & F.coalesce(inside, F.lit(True))
    return judged.select("row.*", kept.alias("kept"))


def quality_rules(docs: DataFrame, text: str = "text", prior: int = PRIOR) -> DataFrame:
    """``docs`` with its counts, ``base_failed`` and ``kept``; reads the texts twice.

    Where texts are not wanted in the result, store ``measure(docs)`` without them and ``judge``
    that, which reads them once.
    """
    return judge(measure(docs, text), prior)
