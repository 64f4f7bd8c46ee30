"""Exact removal of repeated byte strings by a distributed merge sort of suffixes.

A byte is removed if a string of ``LENGTH`` bytes that covers it also starts earlier: in a smaller
doc_id, or earlier in the same document. Sorting the suffixes of all bytes would be wasteful, so
only suffixes at anchors are sorted. An anchor is a byte whose ``GRAM``-byte hash is the smallest
in some window of ``LENGTH`` bytes; a window's choice depends on its own bytes alone, so equal
windows have equal anchors and meet in the sort. Three passes follow:

1. Map tasks send each other the sorted hashes of their anchors. An anchor whose hash occurs
   nowhere else starts no repeated string and is left out.
2. Map tasks sort the suffixes at the remaining anchors: the ``LENGTH`` bytes from the anchor, then
   the bytes before it, backwards. Equal entries of a task are one, as the earliest of them makes
   the others repeats; a passage that many documents share thus crosses the exchange once per
   task. Sorted runs are front-coded (common prefix length and the rest) and dealt by the
   suffix's first bytes.
3. Each partition merges its runs with a loser tree that carries common prefix lengths: two entries
   are compared from their first unknown byte on. The prefix lengths of the merged order and
   of the backward parts tell which windows around an anchor are equal; all but the first
   repeat. Suffixes whose first bytes are too frequent for one partition are sent window by
   window instead, dealt by the hash of the window.

Null texts are empty; a null doc_id comes before all others. Documents that share a doc_id are
ordered by a hash of their text, and rows equal in both are one document: each returns its
result. Texts shorter than ``LENGTH`` lose nothing. An empty table has an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tideline.scale import cut, join_bounded

LENGTH = 100
GRAM = 32
BEFORE = LENGTH - GRAM  # farthest window start before its anchor
WIDTH = LENGTH + BEFORE
SPAN = BEFORE + 1  # anchors a window chooses from
PIECE = 1 << 20  # bytes of a text read at once
RUN_ANCHORS = 1 << 20
RUN_SUFFIXES = 1 << 17
PART_BYTES = 64 << 20  # of text per partition of an exchange
HOT_FACTOR = 4  # partitions' shares from which the suffixes of one beginning are dealt by window
HOT_LEAST = 4096  # anchors of one hash that are reported as frequent
NO_REPLY = np.uint32(0xFFFFFFFF)
FIRST_ID = -(1 << 63)
_ODD = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every ``GRAM`` bytes, by doubling their length."""
    hashes, size = data.astype(np.uint64) + np.uint64(1), 1
    while size < GRAM:
        factor = np.uint64(pow(_ODD, size, 1 << 64))
        hashes = hashes[:-size] * factor + hashes[size:]
        size *= 2
    return _mix(hashes)


def _sliding(x: np.ndarray, width: int, least: Callable) -> np.ndarray:
    """Minimum or maximum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        x = least(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return least(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all windows."""
    places, hashes = [], []
    for start in range(0, len(data) - LENGTH + 1, PIECE):
        grams = gram_hashes(data[start : start + PIECE + LENGTH - 1])
        smallest = _sliding(grams, SPAN, np.minimum)
        edge = np.zeros(BEFORE, np.uint64)
        around = _sliding(np.concatenate([edge, smallest, edge]), SPAN, np.maximum)
        at = np.flatnonzero(around == grams)
        places.append(at + start)
        hashes.append(grams[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if len(places) == 1:
        return places[0], hashes[0]
    both, first = np.unique(np.concatenate(places), return_index=True)
    return both, np.concatenate(hashes)[first]


def _bytes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)


_BLOB = "part int, key binary, doc binary, place binary, sure binary"
_BLOB_NAMES = [f.split()[0] for f in _BLOB.split(", ")]
# what concerns the documents of one bucket, packed; or, with bucket -1, frequent hashes
_REPLY = "bucket int, n bigint, docs binary, places binary"


def _packed(x: np.ndarray) -> bytes:
    return zlib.compress(x.tobytes(), 1)


def _unpacked(data: bytes, type_) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), type_)


def _document_starts(*ids: np.ndarray) -> tuple[list[int], list[int]]:
    """First and end index of each document in sorted rows."""
    if not len(ids[0]):
        return [], []
    changes = np.zeros(len(ids[0]) - 1, bool)
    for column in ids:
        changes |= column[1:] != column[:-1]
    new = (np.flatnonzero(changes) + 1).tolist()
    return [0, *new], [*new, len(ids[0])]


def _anchor_run(parts: int, keys, docs, places) -> Iterator[tuple]:
    """A run's anchors, sorted, for each partition.

    Anchors that repeat within the run need no answer; one witness, with their number, tells the
    partition of them.
    """
    order = np.argsort(keys, kind="stable")
    keys, docs, places = keys[order], docs[order], places[order]
    same = keys[1:] == keys[:-1]
    again = np.concatenate([[False], same])
    repeats = again | np.concatenate([same, [False]])
    first = np.flatnonzero(~again)
    number = np.diff(np.append(first, len(keys)))
    alone = number == 1
    sent_docs = np.where(alone, docs[first], number)
    sent_places = np.where(alone, places[first], NO_REPLY)
    part = (keys[first] % np.uint64(parts)).astype(np.int64)
    sure = np.flatnonzero(repeats)
    sure_part = _bucket_of(docs[sure], parts)
    for p in np.union1d(part, sure_part).tolist():
        mine, own = part == p, sure[sure_part == p]
        known = docs[own].tobytes() + places[own].tobytes()
        yield p, _packed(keys[first][mine]), _packed(sent_docs[mine]), _packed(sent_places[mine]), zlib.compress(known, 1)


def _send_anchors(parts: int) -> Callable:
    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def flush() -> pd.DataFrame:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            held.clear()
            return pd.DataFrame(list(_anchor_run(parts, *columns)), columns=_BLOB_NAMES)

        for batch in batches:
            for doc, text in zip(batch["doc"], batch["text"], strict=True):
                place, key = anchors(_bytes_of(text))
                held.append((key, np.full(len(place), doc, np.int64), place.astype(np.uint32)))
                size += len(place)
                if size >= RUN_ANCHORS:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return send


def _bucket_of(docs: np.ndarray, parts: int) -> np.ndarray:
    """A document's bucket; of mixed bits, so that evenly spaced ids do not share one."""
    mixed = docs.astype(np.int64).view(np.uint64) * np.uint64(_ODD)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_ODD)
    return ((mixed >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _by_bucket(parts: int, docs: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """(bucket, n, columns packed) of each bucket of documents."""
    bucket = _bucket_of(docs, parts)
    order = np.argsort(bucket, kind="stable")
    ordered = bucket[order]
    for a, b in zip(*_document_starts(ordered), strict=True):
        mine = order[a:b]
        yield int(ordered[a]), b - a, *[_packed(c[mine]) for c in (docs, *columns)]


def _repeated_anchors(parts: int) -> Callable:
    """Places of the anchors whose hash some other anchor has, and frequent hashes."""

    def reply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, docs, places, known_docs, known_places = [], [], [], [], []
        for batch in batches:
            for _, key, doc, place, sure in batch[_BLOB_NAMES].itertuples(index=False, name=None):
                keys.append(_unpacked(key, np.uint64))
                docs.append(_unpacked(doc, np.int64))
                places.append(_unpacked(place, np.uint32))
                known = zlib.decompress(sure)
                n = len(known) // 12
                known_docs.append(np.frombuffer(known, np.int64, n))
                known_places.append(np.frombuffer(known, np.uint32, n, n * 8))
        if not keys:
            return
        key, doc, place = (np.concatenate(c) for c in (keys, docs, places))
        order = np.argsort(key, kind="stable")
        key, doc, place = key[order], doc[order], place[order]
        same = key[1:] == key[:-1]
        again = np.concatenate([[False], same])
        found = (again | np.concatenate([same, [False]])) & (place != NO_REPLY)
        all_docs = np.concatenate([doc[found], *known_docs])
        rows = list(_by_bucket(parts, all_docs, np.concatenate([place[found], *known_places])))
        first = np.flatnonzero(~again)
        if len(first):
            number = np.add.reduceat(np.where(place == NO_REPLY, doc, 1), first)
            often = number >= HOT_LEAST
            rows.append((-1, 0, key[first][often].tobytes(), number[often].astype(np.int64).tobytes()))
        yield pd.DataFrame(rows, columns=["bucket", "n", "docs", "places"])

    return reply


def _gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted places of each document of a bucket."""
    docs, places = [], []
    for batch in batches:
        docs += [_unpacked(x, np.int64) for x in batch["docs"]]
        places += [_unpacked(x, np.uint32) for x in batch["places"]]
    if docs:
        doc, place = np.concatenate(docs), np.concatenate(places)
        order = np.lexsort((place, doc))
        doc, place = doc[order], place[order]
        packed = [(doc[a], place[a:b].tobytes()) for a, b in zip(*_document_starts(doc), strict=True)]
        yield pd.DataFrame(packed, columns=["doc", "places"])


def _hot_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for docs, places in zip(batch["docs"], batch["places"], strict=True):
            yield pd.DataFrame({"key": np.frombuffer(docs, np.int64), "n": np.frombuffer(places, np.int64)})


# Suffix entries -----------------------------------------------------------------------------

_RUN = "part int, n int, prefix binary, rest binary, doc binary, tie binary, place binary"
_RUN_NAMES = [f.split()[0] for f in _RUN.split(", ")]
_ENTRY = WIDTH + 2  # bytes, with the range of window starts
_SPANS = "bucket int, n bigint, docs binary, ties binary, starts binary, ends binary"


def entries_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Rows of bytes: the suffix, what precedes it backwards, first and last window start + 1."""
    padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(LENGTH, np.uint8)])
    around = np.lib.stride_tricks.sliding_window_view(padded, WIDTH)[places]
    rows = np.empty((len(places), _ENTRY), np.uint8)
    rows[:, :LENGTH] = around[:, BEFORE:]
    rows[:, LENGTH:WIDTH] = around[:, :BEFORE][:, ::-1]
    rows[:, WIDTH] = np.maximum(0, LENGTH - (len(data) - places)) + 1
    rows[:, WIDTH + 1] = np.minimum(BEFORE, places) + 1
    return rows


def _sorted_rows(rows: np.ndarray) -> np.ndarray:
    return np.argsort(np.ascontiguousarray(rows).view(f"S{rows.shape[1]}").ravel(), kind="stable")


def prefix_lengths(rows: np.ndarray) -> np.ndarray:
    """Common prefix of each row with the one before; 0 for the first."""
    lengths = np.zeros(len(rows), np.int64)
    if len(rows) > 1:
        differ = rows[1:] != rows[:-1]
        lengths[1:] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return lengths


def front_coded(rows: np.ndarray) -> tuple[bytes, bytes]:
    """Prefix lengths of sorted rows, and their remaining bytes."""
    lengths = prefix_lengths(rows)
    rest = rows[np.arange(rows.shape[1]) >= lengths[:, None]]
    return _packed(lengths.astype(np.uint8)), _packed(rest)


def decoded(n: int, prefix: bytes, rest: bytes, width: int = _ENTRY) -> tuple[np.ndarray, np.ndarray]:
    """Rows and prefix lengths of a front-coded run."""
    lengths = _unpacked(prefix, np.uint8).astype(np.int64)
    own = np.arange(width) >= lengths[:, None]
    rows = np.zeros((n, width), np.uint8)
    rows[own] = _unpacked(rest, np.uint8)
    source = np.maximum.accumulate(np.where(own, np.arange(n)[:, None], 0), axis=0)
    return np.take_along_axis(rows, source, 0), lengths


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    total = np.zeros(len(rows), np.uint64)
    for column in rows.T:
        total = total * np.uint64(_ODD) + column + np.uint64(1)
    return _mix(total)


def _runs(rows, docs, ties, places, key, parts: int) -> Iterator[tuple]:
    """Front-coded sorted runs, one per partition, of rows that are all different."""
    order = _sorted_rows(rows)
    part = (key[order] % np.uint64(parts)).astype(np.int64)
    for p in np.unique(part).tolist():
        mine = order[part == p]
        yield p, len(mine), *front_coded(rows[mine]), _packed(docs[mine]), _packed(ties[mine]), _packed(places[mine])


def _collapsed(rows, docs, ties, places) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the earliest of equal rows, and of the others."""
    order = np.lexsort((places, ties, docs))
    order = order[_sorted_rows(rows[order])]
    again = prefix_lengths(rows[order]) == rows.shape[1]
    return order[~again], order[again]


def _single_windows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One row for each window of the given rows, blank outside it, and the row it comes from."""
    low, high = rows[:, WIDTH].astype(int) - 1, rows[:, WIDTH + 1].astype(int) - 1
    source = np.repeat(np.arange(len(rows)), high - low + 1)
    shift = np.concatenate([np.arange(a, b + 1) for a, b in zip(low, high, strict=True)])
    single = rows[source]
    single[:, :LENGTH][np.arange(LENGTH) >= LENGTH - shift[:, None]] = 0
    single[:, LENGTH:WIDTH][np.arange(BEFORE) >= shift[:, None]] = 0
    single[:, WIDTH] = single[:, WIDTH + 1] = shift + 1
    return single, source


def _sent(rows, docs, ties, places, key, parts: int) -> Iterator[tuple]:
    """Runs of the earliest of equal rows; the spans of the others, as runs without entries."""
    first, others = _collapsed(rows, docs, ties, places)
    yield from _runs(rows[first], docs[first], ties[first], places[first], key[first], parts)
    low, high = rows[others, WIDTH].astype(np.int64) - 1, rows[others, WIDTH + 1].astype(np.int64) - 1
    place = places[others].astype(np.int64)
    spans = _by_bucket(parts, docs[others], ties[others], place - high, place + LENGTH - low)
    for bucket, _, *columns in spans:
        yield bucket, 0, *columns, b""


def _send_suffixes(parts: int, hot: Broadcast) -> Callable:
    """Sorted runs of the suffixes at repeated anchors; those of hot anchors window by window."""

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        size = 0

        def flush() -> pd.DataFrame:
            rows, docs, ties, places = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            key = _hash_rows(rows[:, :GRAM])
            moved = np.isin(key, hot.value)  # of the same hash as anchors have
            calm = np.flatnonzero(~moved)
            sent = list(_sent(rows[calm], docs[calm], ties[calm], places[calm], key[calm], parts))
            moved = np.flatnonzero(moved)
            for chunk in np.array_split(moved, 1 + len(moved) // 4096) if len(moved) else ():
                single, source = _single_windows(rows[chunk])
                each = chunk[source]
                sent += _sent(single, docs[each], ties[each], places[each], _hash_rows(single), parts)
            return pd.DataFrame(sent, columns=_RUN_NAMES)

        for batch in batches:
            for doc, tie, text, packed in zip(batch["doc"], batch["tie"], batch["text"], batch["places"], strict=True):
                data = _bytes_of(text)
                all_places = np.unique(np.frombuffer(packed, np.uint32)).astype(np.int64)
                # texts that share a doc_id share its places
                all_places = all_places[all_places <= len(data) - GRAM]
                for places in np.array_split(all_places, 1 + len(all_places) // RUN_SUFFIXES):
                    n = len(places)
                    rows = entries_at(data, places)
                    held.append((rows, np.full(n, doc, np.int64), np.full(n, tie, np.int64), places.astype(np.uint32)))
                    size += n
                    if size >= RUN_SUFFIXES:
                        yield flush()
                        size = 0
        if size:
            yield flush()

    return send


# Merging -----------------------------------------------------------------------------------


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Order of all entries as (run, index), and each one's common prefix with the one before.

    ``runs`` are (sorted strings of one width, prefix lengths). A loser tree: ``known[r]`` is the
    common prefix of run r's head with the string that last won on its path, so of two heads the
    one with the longer prefix is the smaller, and only equal ones are compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    heads: list[bytes | None] = [strings[0] if strings else None for strings, _ in runs] + [None] * (size - len(runs))
    known = [0] * size
    at = [0] * size
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix becomes the one it shares with the winner."""
        x, y = heads[a], heads[b]
        if y is None:
            return a, b
        if x is None:
            return b, a
        if known[a] != known[b]:
            return (a, b) if known[a] > known[b] else (b, a)
        skip = known[a]
        p, q = x[skip:], y[skip:]
        if p == q:
            known[b] = len(x)
            return a, b
        bits = (int.from_bytes(p, "big") ^ int.from_bytes(q, "big")).bit_length()
        common = skip + (len(p) * 8 - bits) // 8
        if p < q:
            known[b] = common
            return a, b
        known[a] = common
        return b, a

    winners = list(range(size)) * 2
    for node in range(size - 1, 0, -1):
        left = winners[2 * node] if 2 * node < size else 2 * node - size
        right = winners[2 * node + 1] if 2 * node + 1 < size else 2 * node + 1 - size
        winners[node], losers[node] = play(left, right)
    best = winners[1] if size > 1 else 0

    order, shared = [], []
    while heads[best] is not None:
        strings, prefixes = runs[best]
        order.append((best, at[best]))
        shared.append(known[best])
        at[best] += 1
        if at[best] < len(strings):
            heads[best], known[best] = strings[at[best]], prefixes[at[best]]
        else:
            heads[best] = None
        node = (best + size) // 2
        while node:
            best, losers[node] = play(best, losers[node])
            node //= 2
    return order, shared


def repeats(rows: np.ndarray, shared: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last window start before the anchor that repeats, per sorted entry; -1 for none.

    ``shared`` are the common prefixes of neighbours, ``rank`` the entries' places in the corpus.
    """
    n = len(rows)
    low, high = np.full(n, -1), np.full(n, -1)
    forward = np.minimum(shared, LENGTH)
    back_order = _sorted_rows(np.concatenate([rows[:, LENGTH:WIDTH], np.ones((n, 1), np.uint8)], 1))
    back_shared = np.minimum(prefix_lengths(rows[back_order, LENGTH:WIDTH]), BEFORE)
    back_place = np.empty(n, np.int64)
    back_place[back_order] = np.arange(n)
    reach = np.maximum(forward, np.append(forward[1:], 0))
    back_reach = np.maximum(back_shared, np.append(back_shared[1:], 0))[back_place]
    live = np.flatnonzero((reach >= LENGTH - BEFORE) & (reach + back_reach >= LENGTH))
    live = live[np.argsort(rank[live])]
    first, last = rows[live, WIDTH].astype(np.int64) - 1, rows[live, WIDTH + 1].astype(np.int64) - 1
    for shift in range(BEFORE + 1):
        inside = np.flatnonzero((first <= shift) & (shift <= last))
        if not len(inside):
            continue
        own = live[inside]
        ahead = np.cumsum(forward < LENGTH - shift)[own]
        behind = np.cumsum(back_shared < shift)[back_place[own]]
        window = ahead * np.int64(n + 1) + behind
        _, starts = np.unique(window, return_index=True)
        again = np.ones(len(own), bool)
        again[starts] = False
        mine = own[again]
        low[mine] = np.where(low[mine] < 0, shift, low[mine])
        high[mine] = shift
    return low, high


def _merge_parts(parts: int) -> Callable:
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, all_rows, all_docs, all_ties, all_places, base, spans = [], [], [], [], [], [0], []
        for batch in batches:
            for part, n, prefix, rest, doc, tie, place in batch[_RUN_NAMES].itertuples(index=False, name=None):
                if n == 0:  # spans decided by the sender, which are on their way to their bucket
                    spans.append((part, 0, prefix, rest, doc, tie))
                    continue
                rows, lengths = decoded(n, prefix, rest)
                flat = rows.tobytes()
                runs.append(([flat[i * _ENTRY : (i + 1) * _ENTRY] for i in range(n)], lengths.tolist()))
                all_rows.append(rows)
                all_docs.append(_unpacked(doc, np.int64))
                all_ties.append(_unpacked(tie, np.int64))
                all_places.append(_unpacked(place, np.uint32))
                base.append(base[-1] + n)
        if runs:
            order, shared = merge_runs(runs)
            index = np.fromiter((base[r] + i for r, i in order), np.int64, len(order))
            rows, docs, ties, places = (np.concatenate(c)[index] for c in (all_rows, all_docs, all_ties, all_places))
            rank = np.empty(len(rows), np.int64)
            rank[np.lexsort((places, ties, docs))] = np.arange(len(rows))
            low, high = repeats(rows, np.array(shared), rank)
            found = np.flatnonzero(low >= 0)
            place = places[found].astype(np.int64)
            spans += _by_bucket(parts, docs[found], ties[found], place - high[found], place + LENGTH - low[found])
        if spans:
            yield pd.DataFrame(spans, columns=["bucket", "n", "docs", "ties", "starts", "ends"])

    return merge


def _joined_spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Removed runs of each document of a bucket: its spans, joined where they touch."""
    columns: list[list[np.ndarray]] = [[], [], [], []]
    for batch in batches:
        for held, name in zip(columns, ("docs", "ties", "starts", "ends"), strict=True):
            held += [_unpacked(x, np.int64) for x in batch[name]]
    if not columns[0]:
        return
    docs, ties, starts, ends = (np.concatenate(c) for c in columns)
    order = np.lexsort((starts, ties, docs))
    docs, ties, starts, ends = docs[order], ties[order], starts[order], ends[order]
    rows = []
    for a, b in zip(*_document_starts(docs, ties), strict=True):
        start, end = starts[a:b], np.maximum.accumulate(ends[a:b])
        new = np.concatenate([[True], start[1:] > end[:-1]])
        last = np.append(np.flatnonzero(new)[1:] - 1, b - a - 1)
        rows.append((docs[a], ties[a], start[new].tolist(), end[last].tolist()))
    yield pd.DataFrame(rows, columns=["doc", "tie", "starts", "ends"])


def _kept_digest(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    digests = []
    for text, a, b in zip(texts, starts, ends, strict=True):
        data, kept, at = text.encode("utf-8", "surrogatepass"), hashlib.sha256(), 0
        for x, y in zip(a, b, strict=True):
            kept.update(data[at:x])
            at = y
        kept.update(data[at:])
        digests.append(kept.hexdigest())
    return pd.Series(digests, dtype=object)


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, doc, tie, text); ``tie`` is 0 unless different texts share the doc_id."""
    text = F.coalesce(F.col("text"), F.lit(""))
    doc = F.coalesce(F.col("doc_id"), F.lit(FIRST_ID)).cast("bigint")
    keyed = docs.select("doc_id", doc.alias("doc"), text.alias("text"))
    hashed = keyed.select("doc", F.xxhash64("text").alias("h")).groupBy("doc").agg(F.min("h").alias("a"), F.max("h").alias("b"))
    shared = cut(hashed.filter("a <> b").select("doc", F.lit(True).alias("_shared")))
    if shared.isEmpty():
        return keyed.withColumn("tie", F.lit(0).cast("bigint"))
    marked = join_bounded(keyed, shared, ["doc"], "left", spread="text")
    tie = F.when(F.col("_shared"), F.xxhash64("text")).otherwise(F.lit(0))
    return marked.withColumn("tie", tie.cast("bigint")).drop("_shared")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) to (doc_id, n_bytes, n_removed, n_spans, kept_sha256, starts, ends).

    ``starts`` and ``ends`` are the removed runs of bytes, none of which touch.
    """
    spark = docs.sparkSession
    keyed = _identified(docs)
    long_ = keyed.filter(F.octet_length("text") >= LENGTH).select("doc", "tie", "text")
    size = long_.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(size // PART_BYTES) + 1)

    anchor_runs = long_.select("doc", "text").mapInPandas(_send_anchors(parts), _BLOB).repartition(parts, "part")
    replies = cut(anchor_runs.mapInPandas(_repeated_anchors(parts), _REPLY))
    total = replies.agg(F.sum("n")).first()[0] or 0
    frequent = replies.filter("bucket < 0").mapInPandas(_hot_hashes, "key bigint, n bigint")
    hot = frequent.filter(F.col("n") * parts > F.lit(HOT_FACTOR * total)).select("key").collect()
    # each has more than HOT_FACTOR partitions' share, so there are fewer than partitions
    keys = spark.sparkContext.broadcast(np.array([r[0] for r in hot], np.int64).view(np.uint64))
    places = replies.filter("bucket >= 0").repartition(parts, "bucket").mapInPandas(_gathered, "doc bigint, places binary")

    sent = long_.join(places, "doc").mapInPandas(_send_suffixes(parts, keys), _RUN)
    spans = sent.repartition(parts, "part").mapInPandas(_merge_parts(parts), _SPANS)
    joined_spans = "doc bigint, tie bigint, starts array<bigint>, ends array<bigint>"
    removed = cut(spans.repartition(parts, "bucket").mapInPandas(_joined_spans, joined_spans))
    joined = join_bounded(keyed, removed, ["doc", "tie"], "left", spread="text")

    none = F.array().cast("array<bigint>")
    length = F.aggregate(
        F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("bigint"), lambda total, n: total + n
    )
    bytes_ = F.octet_length("text").cast("bigint").alias("n_bytes")
    digest = pandas_udf(_kept_digest, "string")("text", "starts", "ends")
    cleaned = joined.filter(F.col("starts").isNotNull()).select(
        "doc_id", bytes_, length.alias("n_removed"), F.size("starts").cast("bigint").alias("n_spans"),
        digest.alias("kept_sha256"), "starts", "ends",
    )
    whole = joined.filter(F.col("starts").isNull()).select(
        "doc_id", bytes_, F.lit(0).cast("bigint").alias("n_removed"), F.lit(0).cast("bigint").alias("n_spans"),
        F.sha2("text", 256).alias("kept_sha256"), none.alias("starts"), none.alias("ends"),
    )
    return cleaned.unionByName(whole)
