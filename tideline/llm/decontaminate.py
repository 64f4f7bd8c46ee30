"""Benchmark passages in documents, found through templates.

A text becomes a row of tokens in which numbers, units (after a number) and names (capitalised
words) are typed placeholders and other words are lower-cased. A capitalised word that starts a
sentence may be either, so a text has two templates: one takes all of these as words, one as names.
Windows of ``WINDOW`` template tokens of the documents are joined by hash with those of the benchmark. A
document and an item that share windows are aligned, token by token, on the diagonals of these; an
aligned run must agree in its slots: one value of the benchmark always stands for one value of the
document and the other way round, so that numbers or names may have been exchanged but not mixed up.

A document leaks an item if such a run has ``MIN_RUN`` tokens or ``MIN_SHARE`` of the item; if a run
that is mixed up has a part of ``2 * MIN_RUN`` tokens that is not; or if runs of a window or more, on
diagonals up to ``WINDOW`` apart and in order, agree in their slots all together and have
``2 * MIN_RUN`` tokens or ``MIN_SHARE`` of the item in sum.

An item shorter than a window leaks only into a document that consists of it. Items without tokens
leak nowhere; equal items are one, under their smallest item_id. Null documents leak nothing,
repeated rows are judged each, texts of any length are taken whole. Windows of the benchmark are broadcast only
when measured small, else both sides are shuffled; the driver sees neither. Each different text is
aligned once, with ``ITEMS`` items or so at a time. An empty table on either side gives an empty result.
Other columns, whatever their names, are no input; ``drop_leaking`` keeps them.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tideline.scale import cut, join_bounded

WINDOW = 8
MIN_RUN = 13
MIN_SHARE = 0.5
MAX_TOKENS = 1_000_000  # of the benchmark, whose windows are broadcast
CHUNK = 1_000_000  # characters whose tokens are held at a time, and one text more
ITEMS = 64  # items that a text is aligned with at a time
#: Unit words and signs, recognised after a number.
UNITS = (
    "% $ € £ mm cm m km mg g kg t ml l s ms min h w kw v a hz n j pa inch inches foot feet yard yards mile miles "
    "ounce ounces pound pounds gallon gallons meter meters metre metres kilometer kilometers gram grams "
    "kilogram kilograms liter liters litre litres second seconds minute minutes hour hours day days week weeks "
    "month months year years percent degree degrees dollar dollars cent cents euro euros"
)
_TOKEN = re.compile(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[%$€£]|[.!?:;\n]")
_STOPS = frozenset(".!?:;\n")
_UNITS = frozenset(UNITS.split())
_STOP, _WORD, _CAPITAL, _NUMBER, _UNIT = range(5)
_VOCABULARY = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = np.array([0, 0, 11, 13, 17], np.uint64) * _ODD


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


_LONGS = ArrayType(LongType())
_FOUND = ("item_id", "item_words", "run", "slots", "changed")


class _Tokens(dict):
    """Token to hash, with its kind in the lowest three bits; remembers the tokens seen last."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _VOCABULARY:
            self.clear()
        lower = token.lower()
        if token in _STOPS:
            kind = _STOP
        elif token[0].isdigit():
            kind = _NUMBER
        elif lower in _UNITS:
            kind = _UNIT
        else:
            kind = _CAPITAL if token[0].isupper() else _WORD
        value = (_hash(lower) & ~7) | kind
        self[token] = value
        return value


class Template(NamedTuple):
    """A text's tokens, and both templates: with first words of sentences as words, and as names."""

    values: np.ndarray
    forms: tuple[np.ndarray, np.ndarray]
    slots: tuple[np.ndarray, np.ndarray]


def canonical(text: str, tokens: _Tokens) -> Template:
    return _template(np.fromiter(map(tokens.__getitem__, _TOKEN.findall(text)), np.uint64), np.zeros(1, np.int64))


def _template(codes: np.ndarray, starts: np.ndarray) -> Template:
    """Both templates of a row of tokens; ``starts`` are the places, among its words, of the texts' first ones."""
    kinds = (codes & np.uint64(7)).astype(np.int8)
    word = kinds != _STOP
    after_stop = np.concatenate([[True], ~word[:-1]])[: len(codes)][word]
    kinds, values = kinds[word], codes[word] & ~np.uint64(7)
    after_number = np.concatenate([[False], kinds[:-1] == _NUMBER])[: len(kinds)]
    after_number[starts[starts < len(kinds)]] = False
    name = kinds == _CAPITAL
    sure = (kinds == _NUMBER) | (name & ~after_stop) | ((kinds == _UNIT) & after_number)
    slots = (sure, sure | name)
    return Template(values, tuple(np.where(s, _SLOTS[kinds], values) for s in slots), slots)


def _short_key(forms: np.ndarray) -> np.ndarray:
    """The hash of all of a text that is shorter than a window."""
    return window_hashes(forms, len(forms)) * _ODD + np.uint64(len(forms))


def text_windows(texts: list[str], tokens: _Tokens) -> list[np.ndarray]:
    """The hashes of each text's windows, or of all of a text that is shorter than one.

    Texts are one row of tokens with a stop behind each; windows over two texts are left out. The
    second template adds the windows in which it differs from the first.
    """
    stop = tokens["\n"]
    codes = [np.fromiter(map(tokens.__getitem__, _TOKEN.findall(t)), np.uint64) for t in texts]
    sizes = np.array([int(((c & np.uint64(7)) != _STOP).sum()) for c in codes], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    all_ = _template(np.concatenate([x for c in codes for x in (c, [np.uint64(stop)])]).astype(np.uint64), starts[sizes > 0])
    owner = np.repeat(np.arange(len(texts)), sizes)
    whole = np.arange(len(owner)) + WINDOW <= ends[owner]
    differ = np.concatenate([[0], np.cumsum(all_.forms[0] != all_.forms[1])])
    hashes, owners = [], []
    for form in (0, 1):
        found = window_hashes(all_.forms[form])
        use = whole[: len(found)]
        if form:
            use = use & (differ[WINDOW:] != differ[:-WINDOW])[: len(found)]
        hashes.append(found[use])
        owners.append(owner[: len(found)][use])
    for i in np.flatnonzero((sizes > 0) & (sizes < WINDOW)).tolist():
        for form in all_.forms:
            hashes.append(_short_key(form[starts[i] : ends[i]]))
            owners.append(np.array([i]))
    owner = np.concatenate(owners)
    placed = np.concatenate(hashes).view(np.int64)[np.argsort(owner, kind="stable")]
    return np.split(placed, np.cumsum(np.bincount(owner, minlength=len(texts)))[:-1])


def window_hashes(forms: np.ndarray, size: int = WINDOW) -> np.ndarray:
    n = len(forms) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = forms[:n].copy()
    for j in range(1, size):
        total = total * _ODD + forms[j : j + n]
    return total ^ (total >> np.uint64(29))


class Run(NamedTuple):
    """Tokens ``start`` to ``end`` of an item that equal those of the document ``shift`` later."""

    start: int
    end: int
    shift: int


def _runs(item: Template, doc: Template, shift: int, form: int) -> Iterator[Run]:
    start, end = max(0, -shift), min(len(item.values), len(doc.values) - shift)
    equal = item.forms[form][start:end] == doc.forms[form][start + shift : end + shift]
    same = np.concatenate([[False], equal, [False]])
    edges = start + np.flatnonzero(same[1:] != same[:-1])
    for lo, hi in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        yield Run(lo, hi, shift)


def _slot_pairs(item: Template, doc: Template, run: Run, form: int) -> tuple[list[int], list[tuple[int, int]]]:
    """Places of a run's slots, and their values in the item and the document."""
    at = run.start + np.flatnonzero(item.slots[form][run.start : run.end])
    return at.tolist(), list(zip(item.values[at].tolist(), doc.values[at + run.shift].tolist(), strict=True))


def _one_to_one(pairs: set[tuple[int, int]]) -> bool:
    return len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs})


def _longest_part(run: Run, at: list[int], pairs: list[tuple[int, int]]) -> Run:
    """The longest part of a run whose slots agree."""
    there, back, held = {}, {}, Counter()
    best, start, left = Run(run.start, run.start, run.shift), run.start, 0
    for k, (x, y) in enumerate(pairs):
        while there.get(x, y) != y or back.get(y, x) != x:
            gone = pairs[left]
            held[gone] -= 1
            if not held[gone]:
                del there[gone[0]], back[gone[1]]
            start, left = at[left] + 1, left + 1
        there[x], back[y] = y, x
        held[x, y] += 1
        end = at[k + 1] if k + 1 < len(at) else run.end
        if end - start > best.end - best.start:
            best = Run(start, end, run.shift)
    return best


def leak(item: Template, doc: Template) -> tuple[int, int, int] | None:
    """(tokens, slots, changed slots) of the largest agreement that is a leak."""
    n, best = len(item.values), None
    enough = MIN_SHARE * n

    def take(tokens: int, pairs: list[tuple[int, int]]) -> None:
        nonlocal best
        best = max(best or (0, 0, 0), (tokens, len(pairs), sum(x != y for x, y in pairs)))

    for form in (0, 1):
        pieces = []
        for shift in _shifts(item, doc, form):
            for run in _runs(item, doc, shift, form):
                at, pairs = _slot_pairs(item, doc, run, form)
                tokens = run.end - run.start
                if _one_to_one(set(pairs)):
                    if tokens >= min(MIN_RUN, enough):
                        take(tokens, pairs)
                    if tokens >= WINDOW:
                        pieces.append((run, pairs))
                elif tokens >= 2 * MIN_RUN:
                    part = _longest_part(run, at, pairs)
                    if part.end - part.start >= 2 * MIN_RUN:
                        take(part.end - part.start, _slot_pairs(item, doc, part, form)[1])
        for tokens, pairs in _chains(pieces):
            if tokens >= min(2 * MIN_RUN, enough):
                take(tokens, pairs)
    return best


def _shifts(item: Template, doc: Template, form: int) -> list[int]:
    """Diagonals on which a window of the item meets the document."""
    size = min(WINDOW, len(item.values))
    if size < WINDOW:
        return [0] if len(item.values) == len(doc.values) and (item.forms[form] == doc.forms[form]).all() else []
    mine, theirs = window_hashes(item.forms[form]), window_hashes(doc.forms[form])
    order = np.argsort(mine, kind="stable")
    low = np.searchsorted(mine[order], theirs, "left")
    many = np.searchsorted(mine[order], theirs, "right") - low
    hit = np.repeat(np.arange(len(theirs)), many)
    entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
    return np.unique(hit - order[entry]).tolist()


def _chains(pieces: list[tuple[Run, list]]) -> Iterator[tuple[int, list]]:
    """Tokens and slots of runs in order on neighbouring diagonals that agree together."""
    pieces = sorted(pieces, key=lambda p: p[0].shift)
    for k, (run, _) in enumerate(pieces):
        if k and run.shift - pieces[k - 1][0].shift <= WINDOW:
            continue
        near = [pieces[k]]
        for p in pieces[k + 1 :]:
            if p[0].shift - near[-1][0].shift > WINDOW:
                break
            near.append(p)
        tokens, slots, known, last = 0, [], set(), None
        for r, pairs in sorted(near, key=lambda p: p[0]):
            after = last is None or (r.start >= last.end and r.start + r.shift >= last.end + last.shift)
            if after and _one_to_one(known | set(pairs)):
                tokens, slots, known, last = tokens + r.end - r.start, slots + pairs, known | set(pairs), r
        yield tokens, slots


def _chunks(texts: pd.Series) -> Iterator[list[str]]:
    """Texts in lists of about ``CHUNK`` characters."""
    some, size = [], 0
    for text in texts:
        some.append(text)
        size += len(text)
        if size >= CHUNK:
            yield some
            some, size = [], 0
    if some:
        yield some


@pandas_udf(_LONGS)
def _windows(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    tokens = _Tokens()
    for texts in batches:
        found = []
        for some in _chunks(texts):
            found += text_windows(some, tokens)
        yield pd.Series(found, dtype=object)


@pandas_udf(StructType([StructField(n, _LONGS) for n in _FOUND]))
def _leaking(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    """The leaked ones of a text's candidate items, as parallel arrays."""
    tokens = _Tokens()
    for texts, ids, items in batches:
        rows = []
        for text, mine, theirs in zip(texts, ids, items, strict=True):
            doc, found = canonical(text, tokens), []
            for item_id, item_text in zip(mine.tolist(), theirs, strict=True):
                item = canonical(item_text, tokens)
                if one := leak(item, doc):
                    found.append((item_id, len(item.values), *one))
            rows.append([[x[k] for x in found] for k in range(len(_FOUND))])
        yield pd.DataFrame(rows, columns=list(_FOUND))


def find_leaks(docs: DataFrame, benchmark: DataFrame, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, text_key, item_id, item_words, run, slots, changed) of every leaked item.

    ``docs`` is (doc_id, text), ``benchmark`` (item_id, text); ``text_key`` tells apart documents
    that share an id. The windows of more than ``max_tokens`` tokens or so are not broadcast.
    """
    items = benchmark.filter(F.col("text").isNotNull()).groupBy("text").agg(F.min("item_id").alias("item_id"))
    items = cut(items.select("item_id", F.col("text").alias("item_text")))
    keyed = docs.filter(F.col("text").isNotNull()).select("doc_id", F.md5(F.col("text").cast("binary")).alias("text_key"), "text")
    listed = cut(items.select("item_id", F.explode(_windows("item_text")).alias("window")))
    windows = keyed.select("text_key", F.explode(_windows("text")).alias("window"))
    shared = join_bounded(windows, listed, ["window"], spread="text_key", max_bytes=64 * max_tokens)
    pairs = cut(shared.select("text_key", "item_id").distinct())

    # a text and its items in one row, as many rows as its items need
    chunks = pairs.groupBy("text_key").agg(F.ceil(F.count("*") / ITEMS).alias("chunks"))
    dealt = join_bounded(pairs, items, ["item_id"], spread="text_key").join(chunks, "text_key")
    dealt = dealt.groupBy("text_key", F.pmod(F.xxhash64("item_id"), F.col("chunks")).alias("chunk")).agg(
        F.collect_list(F.struct("item_id", "item_text")).alias("items")
    )
    texts = join_bounded(keyed.select("text_key", "text"), chunks.select("text_key"), ["text_key"], spread="text")
    texts = texts.groupBy("text_key").agg(F.first("text").alias("text"))
    judged = dealt.join(texts, "text_key").select("text_key", _leaking("text", "items.item_id", "items.item_text").alias("l"))
    leaks = cut(judged.select("text_key", F.inline(F.arrays_zip(*[F.col(f"l.{n}") for n in _FOUND]))))
    ids = keyed.select("doc_id", "text_key")
    return join_bounded(ids, leaks, ["text_key"], spread="doc_id").select("doc_id", "text_key", *_FOUND)


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that leak an item."""
    leaking = find_leaks(docs.select("doc_id", "text"), benchmark).select(
        F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")
    ).distinct()
    # the row as a struct: its other columns cannot clash with these
    keyed = docs.select(F.struct("*").alias("row"), "doc_id", F.md5(F.col("text").cast("binary")).alias("text_key"))
    same = F.col("doc_id").eqNullSafe(F.col("leak_id")) & (F.col("text_key") == F.col("leak_key"))
    return keyed.join(leaking, same, "left_anti").select("row.*")
