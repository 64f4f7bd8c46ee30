"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and read as code points; their n-grams of 1 to ``MAX_N`` code points are
hashed into ``BUCKETS`` buckets. Training counts the buckets per language on a sample of about
``TRAIN_PER_LANGUAGE`` different labelled texts of each language (all where there are fewer, one at
least), chosen by a hash and counted as often as they occur; the smoothed log probabilities, ``BUCKETS``
floats a language, are broadcast for ``LANGUAGES`` languages at a time, whose best ones are compared. A batch is scored by one gather and one segmented sum over all
its n-grams; long texts are read in pieces, so memory does not follow the longest.

A text that is null or has no letter is ``und`` with score 0, as is every text when nothing could be
learned. The score is the posterior probability of the prediction. Equal probabilities go to the
first language in code-point order. Repeated rows count each in
training. An empty table has an empty result, and as training no languages. Columns named like the results
are replaced; other columns stay as they are, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tideline.scale import cut, join_bounded

MAX_N = 3
BUCKETS = 1 << 16
SMOOTHING = 0.1
TRAIN_PER_LANGUAGE = 3000
LANGUAGES = 256  # scored at once: 64 MB of log probabilities
PIECE = 1 << 18  # code points read at once
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_SHIFT = np.uint32(32 - BUCKETS.bit_length() + 1)


def _pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, text number) of every n-gram, in pieces of bounded size."""
    held, owners, size = [], [], 0
    for number, text in enumerate(texts):
        text = text.lower()
        step = PIECE - MAX_N
        for start in range(0, max(len(text), 1), step):
            points = np.frombuffer(f" {text[start : start + step + MAX_N - 1]} ".encode("utf-32-le", "surrogatepass"), np.uint32)
            held.append(points)
            owners.append(number)
            size += len(points)
            if size >= PIECE:
                yield from _hashed(held, owners)
                held, owners, size = [], [], 0
    if held:
        yield from _hashed(held, owners)


def _hashed(held: list[np.ndarray], owners: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    points = np.concatenate(held)
    owner = np.repeat(np.arange(len(held)), [len(h) for h in held])
    mixed = np.zeros(len(points), np.uint32)
    for n in range(1, MAX_N + 1):
        last = len(points) - n + 1
        if last <= 0:
            break
        mixed = (mixed[:last] + points[n - 1 :]) * _MULTIPLIERS[n - 1]
        whole = owner[:last] == owner[n - 1 :]
        buckets = (mixed ^ (mixed >> np.uint32(15))) * _MULTIPLIERS[3] >> _SHIFT
        yield buckets[whole], np.asarray(owners)[owner[:last][whole]]


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    totals: dict[str, np.ndarray] = {}
    for batch in batches:
        for (lang, times), group in batch.groupby(["lang", "times"]):
            total = totals.setdefault(lang, np.zeros(BUCKETS, np.int64))
            for buckets, _ in _pieces(group["text"].tolist()):
                total += times * np.bincount(buckets, minlength=BUCKETS)
    for lang, total in totals.items():
        yield pd.DataFrame({"lang": [lang], "counts": [total.tobytes()]})


def _summed(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in rows["counts"])
    return pd.DataFrame({"lang": [key[0]], "counts": [zlib.compress(total.tobytes(), 1)]})


def train(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> list:
    """Model rows (lang, counts, docs) from (text, lang), by language; the counts are compressed."""
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("key"))
    texts = cut(labelled.groupBy("lang", "key").agg(F.count("*").alias("times")))
    sizes = cut(texts.groupBy("lang").agg(F.sum("times").alias("docs"), F.count("*").alias("different"), F.min("key").alias("least")))
    draw = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = (draw * F.col("different") < F.lit(float(per_language))) | (F.col("key") == F.col("least"))
    chosen = cut(join_bounded(texts, sizes, ["lang"], spread="key").filter(drawn).select("lang", "key", "times"))
    sample = join_bounded(labelled, chosen, ["lang", "key"], spread="text").dropDuplicates(["lang", "key"]).select("lang", "text", "times")
    # a row per language and task of the sample, whose size is bounded
    counts = sample.mapInPandas(_counted, "lang string, counts binary")
    merged = counts.groupBy("lang").applyInPandas(_summed, "lang string, counts binary")
    return merged.join(F.broadcast(sizes.select("lang", "docs")), "lang").orderBy("lang").collect()


def _matrix(rows: list, total_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities, buckets by languages, and log priors."""
    counts = np.stack([np.frombuffer(zlib.decompress(r["counts"]), np.int64) for r in rows], 1) + SMOOTHING
    docs = np.array([r["docs"] for r in rows], float)
    return np.log(counts / counts.sum(0)).astype(np.float32), np.log(docs / total_docs)


def score(texts: list[str], matrix: np.ndarray, priors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Most probable language of each text, its log weight, and the log of the sum of all weights."""
    total = np.tile(priors, (len(texts), 1))
    for buckets, owner in _pieces(texts):
        if not len(buckets):
            continue
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
        for k in range(matrix.shape[1]):
            sums = np.add.reduceat(matrix[:, k][buckets], starts, dtype=np.float64)
            np.add.at(total[:, k], owner[starts], sums)
    best, top = total.argmax(1), total.max(1)
    return best, top, top + np.log(np.exp(total - top[:, None]).sum(1))


def _scorer(rows: tuple[int, int], total_docs: int, held):
    """UDF that scores texts against the model's rows, all or a block of them."""

    @pandas_udf("lang string, top double, weight double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        low, high = rows
        mine = held.value[low:high]
        names = np.array([r["lang"] for r in mine], object)
        matrix, priors = _matrix(mine, total_docs)
        matrix = np.asfortranarray(matrix)
        for batch in batches:
            best, top, weight = score(batch.tolist(), matrix, priors)
            yield pd.DataFrame({"lang": names[best], "top": top, "weight": weight})

    return scored


def predict(docs: DataFrame, model: list, languages: int = LANGUAGES) -> DataFrame:
    """``docs`` with lang_pred and score, judged by the text alone."""
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if not model:
        return docs.select(*rest, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    held = docs.sparkSession.sparkContext.broadcast(model)
    total_docs = sum(r["docs"] for r in model)
    blocks = [(low, min(low + languages, len(model))) for low in range(0, len(model), languages)]

    readable = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    given = F.when(readable, F.col("text")).otherwise("")
    row = F.struct(*rest).alias("row")  # other columns cannot clash with these
    judged = docs.select(row, readable.alias("readable"), F.array(*[_scorer(b, total_docs, held)(given) for b in blocks]).alias("found"))
    # of equal weights the first block's, which is the first in order
    best = F.reduce("found", F.col("found")[0], lambda a, b: F.when(b["top"] > a["top"], b).otherwise(a))
    odds = F.aggregate("found", F.lit(0.0), lambda a, b: a + F.exp(b["weight"] - best["top"]))
    return judged.select(
        "row.*",
        F.when(F.col("readable"), best["lang"]).otherwise("und").alias("lang_pred"),
        F.when(F.col("readable"), 1.0 / odds).otherwise(0.0).alias("score"),
    )
