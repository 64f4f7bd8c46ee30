"""Scoring texts by online logistic mixing of hashed-context bit predictors.

A text is coded byte by byte, each byte bit by bit, A-Z lower-cased, with an end mark. Three predictors give
each bit's odds from counts over all training documents: the bytes that followed the last two and the
last three bytes (hashed), and the words that continue the current word. Their logits are summed with
weights that a gate chooses by the bit, and that are refined after every byte by the coding error, anew
in each ``SEGMENT`` bytes of a text. The summed log probabilities of the
bits are the text's score; divided by its bytes, its total bits per byte.

The byte tables have a fixed size (21 MB, broadcast). The words grow with the corpus: they are sorted
in ranges, where the words with a common beginning are neighbours, so that the counts of every beginning
are range sums; only the first and last word of each range need sums from other ranges. Documents are
stored in blocks of about ``BLOCK_BYTES``, which ask the ranges for the paths of their distinct words. What
is exchanged is packed: a compressed table per block, per range, and per block and range. A range that
many blocks ask is repeated for portions of them. Words that make up a ``1 / HOT_SHARE`` of the tokens, at
most ``HOT_SHARE`` of them, are broadcast instead.

Cases: a null text counts as empty, an empty text is its end alone. A null id counts as an empty text in
the choice of training rows. Repeated rows are scored alike, each. Without training documents every bit
costs as the untrained mix says. Very long texts are scored whole, segment by segment. An empty table
gives an empty result. Only the named columns are read, so others may have any name.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tideline.scale import cut, run_dir

SEGMENT = 2048  # bytes over which the mixing weights are refined
BLOCK_BYTES = 4 << 20
CHUNK = 1 << 20  # of text, whose bytes are counted together
COUNTED = 1 << 31  # bytes that are counted in 32 bits
LANES = 1024  # segments that are mixed side by side
WORD_BYTES = 24  # of a word that the word predictor looks at
HOT_SHARE = 50_000
RANGE_BYTES = 16 << 20  # of text, for each range of sorted words
ASKED_WORDS = 4_000_000  # of all blocks, that one copy of a range answers
FLUSH = 500_000
ORDER_BITS = (14, 16)  # of the hashed contexts of two and three bytes
OFFSETS = np.cumsum([0] + [1 << b for b in ORDER_BITS])
SLOTS = int(OFFSETS[-1])
SCALE = 8  # of stored logits
_STEP = np.float32(1 / SCALE)
PRIOR = 0.4
RATE = 0.02
START = (0.2, 0.45, 0.6)  # weights of the predictors before refinement
STEPS = 64
END = b"\x00"  # a zero byte in a text is coded as 255, which no text holds

BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1)
_SIGN = np.where(BITS == 1, 1, -1).astype(np.int8)
#: Bits of a byte whose word node is used: not below the three zero bits that all other separators share.
WORD_MASK = np.array([[not (j >= 3 and b < 32) for j in range(8)] for b in range(256)])
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Signs of a byte's logits in a word's path, whose nodes after a word are those of a blank; 0 where unused.
_LEADING = 8 - np.frexp(np.arange(256))[1]  # zero bits before the first one bit of a byte
_WORD_SIGN = np.where(WORD_MASK, _SIGN[np.where(_BLANK | (np.arange(256) == 0), 32, np.arange(256))], 0).astype(np.int8)
_WORD_SIGNS = _WORD_SIGN.view(np.int64).reshape(-1)  # eight at once


def coded(text: str | None) -> bytes:
    """The bytes that are scored, without the end mark."""
    return (text or "").encode("utf-8", "replace").lower().replace(END, b"\xff")


def _logit(one: np.ndarray, total: np.ndarray) -> np.ndarray:
    p = (one + PRIOR) / (total + 2 * PRIOR)
    return np.clip(np.rint(SCALE * np.log(p / (1 - p))), -127, 127).astype(np.int8)


_LOGITS = _logit(np.arange(256), np.maximum(np.arange(256), np.arange(256)[:, None])).reshape(-1)  # by total and ones


def contexts(one: np.ndarray, two: np.ndarray, three: np.ndarray) -> list[np.ndarray]:
    """Slots of the contexts of the last two and of the last three bytes; ``one`` is the last byte."""
    both = one.astype(np.uint32) | (two.astype(np.uint32) << 8)
    all_ = both | (three.astype(np.uint32) << 16)
    second = ((both * np.uint32(40503)) & np.uint32(0xFFFF)) >> (16 - ORDER_BITS[0])
    third = (all_ * np.uint32(2654435761)) >> np.uint32(32 - ORDER_BITS[1])
    return [second.astype(np.int32), third.astype(np.int32) + np.int32(OFFSETS[1])]


def _padded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts with three zero bytes before and the end mark behind, and the places of their first bytes."""
    sizes = np.array([len(t) + 4 for t in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) + 3
    return np.frombuffer(b"".join(b"\0\0\0" + t + END for t in texts), dtype=np.uint8), starts


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def _rows(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _word_edges(apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and stop, given the places that are apart from them."""
    edges = np.flatnonzero(apart[1:] != apart[:-1]) + 1
    return edges[::2], edges[1::2]


def numbered_words(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """The words of all texts by number, the distinct words, and the words per text."""
    data = np.frombuffer(b"".join(b" " + t + b" " for t in texts), dtype=np.uint8)
    blank = _BLANK[data]
    begin, stop = _word_edges(blank)
    bounds = np.concatenate([[0], np.cumsum(stop - begin)])
    words = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(data[~blank])])
    found = words.dictionary_encode()
    ends = np.cumsum(np.fromiter((len(t) + 2 for t in texts), np.int64, len(texts)))
    counts = np.diff(np.searchsorted(begin, ends), prepend=0)
    return found.indices.to_numpy(), found.dictionary.cast(pa.binary()), counts


def _objects(words: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return words.to_numpy(zero_copy_only=False).tolist()


def in_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, blob): neighbouring rows, about ``BLOCK_BYTES`` of text together."""
    number, size, held = TaskContext.get().partitionId() << 32, 0, []

    def emit() -> pa.RecordBatch:
        return _rows(block=pa.array([number], pa.int64()), blob=pa.array([packed(pa.Table.from_batches(held))], pa.binary()))

    for batch in batches:
        low = 0
        for i, text in enumerate(batch.column("text")):
            length = len(text.as_py() or "")
            if size and size + length > BLOCK_BYTES:
                if i > low:
                    held.append(batch.slice(low, i - low))
                yield emit()
                number, size, held, low = number + 1, 0, [], i
            size += length
        held.append(batch.slice(low))
    if any(b.num_rows for b in held):
        yield emit()


def _joined(blobs: list, column: str) -> np.ndarray:
    """A column of packed tables, one after another."""
    kind = np.int8 if column == "p" else np.int64
    return np.concatenate([np.zeros(0, dtype=kind), *(unpacked(bytes(b)).column(column).to_numpy() for b in blobs)])


def _unblocked(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    for batch in batches:
        for block, blob in zip(batch.column("block"), batch.column("blob")):
            yield block.as_py(), unpacked(blob.as_py())


# Gathering


def _count_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nonzero counts of (slot, byte) over a task's training texts, emitted before they could overflow."""
    counts, counted = np.zeros(SLOTS * 256, dtype=np.uint32), 0

    def add(texts: list[bytes]) -> None:
        data, starts = _padded(texts)
        real = np.ones(len(data), dtype=bool)
        for k in (1, 2, 3):
            real[starts - k] = False
        real = np.flatnonzero(real[3:]) + 3
        for slots in contexts(data[real - 1], data[real - 2], data[real - 3]):
            np.add.at(counts, slots * 256 + data[real], np.uint32(1))

    def emit() -> Iterator[pa.RecordBatch]:
        at = np.flatnonzero(counts)
        for low in range(0, len(at), FLUSH):
            part = at[low : low + FLUSH]
            yield pa.RecordBatch.from_arrays(
                [pa.array((part >> 8).astype(np.int32)), pa.array((part & 255).astype(np.int32)), pa.array(counts[part].astype(np.int64))],
                names=["slot", "byte", "n"],
            )
        counts[:] = 0

    held, size = [], 0
    for _, table in _unblocked(batches):
        training = table.filter(pc.invert(table.column("held_out")))
        for text in training.column("text").to_pylist():
            code = coded(text)
            if counted + size + len(code) >= COUNTED:
                if held:
                    add(held)
                yield from emit()
                held, size, counted = [], 0, 0
            held.append(code)
            size += len(code) + 1
            if size > CHUNK:
                add(held)
                held, size, counted = [], 0, counted + size
    if held:
        add(held)
    yield from emit()


def byte_table(blocks: DataFrame) -> np.ndarray:
    """Logits of every node of every slot: a row of 256 numbers for each of the ``SLOTS``."""
    found = blocks.mapInArrow(_count_bytes, "slot int, byte int, n bigint")
    counts = found.groupBy("slot", "byte").agg(F.sum("n").alias("n"))
    rows = counts.groupBy("slot").agg(F.collect_list("byte").alias("bytes"), F.collect_list("n").alias("ns"))

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree = np.zeros((batch.num_rows, 512), dtype=np.float64)
            lists, ns = batch.column("bytes"), batch.column("ns")
            at = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            np.add.at(tree, (at, 256 + lists.flatten().to_numpy()), ns.flatten().to_numpy())
            for level in range(7, -1, -1):
                low, high = 1 << level, 2 << level
                tree[:, low:high] = tree[:, 2 * low : 2 * high : 2] + tree[:, 2 * low + 1 : 2 * high : 2]
            inner = np.arange(1, 256)
            logits = np.zeros((batch.num_rows, 256), dtype=np.int8)
            logits[:, 1:] = _logit(tree[:, 2 * inner + 1], tree[:, inner])
            blobs = pa.array([row.tobytes() for row in logits], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("slot"), blobs], names=["slot", "row"])

    table = np.zeros((SLOTS, 256), dtype=np.int8)
    for slot, row in rows.mapInArrow(nodes, "slot int, row binary").collect():  # SLOTS rows at most
        table[slot] = np.frombuffer(row, dtype=np.int8)
    return table


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n, n_train): every word with a blank behind it, counted by task."""
    held, size = [], 0

    def summed() -> pa.Table:
        sums = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum"), ("n_train", "sum")])
        return pa.table([sums.column("token"), sums.column("n_sum"), sums.column("n_train_sum")], schema=_WORDS)

    for _, table in _unblocked(batches):
        texts = [coded(t) for t in table.column("text").to_pylist()]
        numbers, tokens, counts = numbered_words(texts)
        trained = np.repeat(~table.column("held_out").to_numpy().astype(bool), counts)
        n, n_train = (np.bincount(v, minlength=len(tokens)) for v in (numbers, numbers[trained]))
        tokens = pc.binary_join_element_wise(tokens, pa.scalar(b" "), pa.scalar(b""))
        held.append(pa.table([tokens, pa.array(n), pa.array(n_train)], schema=_WORDS))
        size += len(tokens)
        if size > 2 * FLUSH:
            held = [summed()]
            size = held[0].num_rows
            if size > FLUSH:
                yield from held[0].to_batches()
                held, size = [], 0
    if held:
        yield from summed().to_batches()


def _shared(beginnings: np.ndarray) -> np.ndarray:
    """The leading bits that each word shares with the one before; -1 for the first."""
    apart = beginnings[1:] ^ beginnings[:-1]
    at = (apart != 0).argmax(axis=1)
    byte = apart[np.arange(len(apart)), at]
    bits = np.where(byte == 0, 8 * beginnings.shape[1], 8 * at + _LEADING[byte])
    return np.concatenate([[-1], bits]).astype(np.int16)


def _end_sums(shared: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """For k = 0, 1, ...: the count of the first k bits of a range's first and of its last word."""
    width = 8 * WORD_BYTES
    first = np.concatenate([[width], np.minimum.accumulate(shared[1:])])
    last = np.concatenate([[width], np.minimum.accumulate(shared[:0:-1])])
    ends = np.zeros((2, width + 1), dtype=np.int64)
    np.add.at(ends[0], first, counts)
    np.add.at(ends[1], last, counts[::-1])
    return np.cumsum(ends[:, ::-1], axis=1)[:, ::-1]


def _beginnings(tokens: list[bytes]) -> np.ndarray:
    return np.array(tokens, dtype=f"S{WORD_BYTES}").view(np.uint8).reshape(len(tokens), WORD_BYTES)


_NONE = np.zeros(8 * WORD_BYTES + 1, dtype=np.int64)
Outside = dict[int, tuple[np.ndarray, np.ndarray]]


def _packed_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, blob) of a task's sorted words."""
    words = pa.Table.from_batches(list(batches), _WORDS)
    if words.num_rows:
        yield _rows(part=pa.array([TaskContext.get().partitionId()], pa.int32()), blob=pa.array([packed(words)], pa.binary()))


_WORDS = pa.schema([("token", pa.binary()), ("n", pa.int64()), ("n_train", pa.int64())])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range's first and last word, with the counts of their beginnings inside it, and its totals."""
    for batch in batches:
        for part, blob in zip(batch.column("part"), batch.column("blob")):
            words = unpacked(blob.as_py())
            tokens, trained = _objects(words.column("token")), words.column("n_train").to_numpy()
            ends = _end_sums(_shared(_beginnings(tokens)), trained)
            first, last = [pa.array([sums.tolist()], pa.list_(pa.int64())) for sums in ends]
            totals = [pc.sum(words.column("n")).as_py(), int(trained.sum()), int((trained > 0).sum())]
            n, n_train, known = [pa.array([v], pa.int64()) for v in totals]
            low, high = [pa.array([t], pa.binary()) for t in (tokens[0], tokens[-1])]
            yield _rows(part=pa.array([part.as_py()], pa.int32()), first=low, last=high, first_sums=first, last_sums=last, n=n, n_train=n_train, known=known)


_EDGES = "part int, first binary, last binary, first_sums array<bigint>, last_sums array<bigint>, n bigint, n_train bigint, known bigint"


def _common(a: bytes, b: bytes) -> int:
    """Leading bits that two words' beginnings share."""
    bits = np.unpackbits(_beginnings([a, b]), axis=1)
    apart = bits[0] != bits[1]
    return int(apart.argmax()) if apart.any() else len(apart)


def _outside(edges: list) -> Outside:
    """Per partition, the counts that the beginnings of its first and last word have in other ones."""
    edges = sorted(edges, key=lambda e: e["part"])
    k = np.arange(len(_NONE))
    within = [_common(e["first"], e["last"]) for e in edges]
    shared = [_common(a["last"], b["first"]) for a, b in zip(edges, edges[1:])]
    left, right = [_NONE] * len(edges), [_NONE] * len(edges)
    for i in range(1, len(edges)):
        onward = np.where(within[i - 1] >= k, left[i - 1], 0)
        left[i] = np.where(shared[i - 1] >= k, np.array(edges[i - 1]["last_sums"]) + onward, 0)
    for i in range(len(edges) - 2, -1, -1):
        onward = np.where(within[i + 1] >= k, right[i + 1], 0)
        right[i] = np.where(shared[i] >= k, np.array(edges[i + 1]["first_sums"]) + onward, 0)
    return {e["part"]: (left[i], right[i]) for i, e in enumerate(edges)}


def sorted_ranges(words: DataFrame, parts: int) -> DataFrame:
    """(part, blob) of ``words`` (token, n, n_train): consecutive ranges, a row each."""
    ranges = words.select(*_WORDS.names).repartitionByRange(parts, "token").sortWithinPartitions("token")
    return cut(ranges.mapInArrow(_packed_range, "part int, blob binary"))


def paths(words: pa.Table, part: int, outside: Outside) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """A range's words, their training counts, and the logits in favour of each of their bits.

    A word without its later bits is left out of the sums, as no other word begins with all of it.
    """
    tokens, counts = _objects(words.column("token")), words.column("n_train").to_numpy()
    shared, ends = _shared(_beginnings(tokens)), 8 * path_sizes(tokens)
    favour = np.zeros((8 * WORD_BYTES, len(tokens)), dtype=np.int8)
    left, right = outside[part]
    at, held, before = np.arange(len(tokens)), counts, None
    for k in range(8 * WORD_BYTES + 1):
        longer = ends >= k
        if not longer.all():
            at, held, shared, ends, before = at[longer], held[longer], shared[longer], ends[longer], before[longer]
        if not len(at):
            break
        first = np.flatnonzero(shared < k)
        sums = np.add.reduceat(held, first)
        sums[0] += left[k]
        sums[-1] += right[k]
        now = np.repeat(sums, np.diff(np.append(first, len(at))))
        if k:
            logits = _LOGITS.take(np.minimum(before, 255) * 256 + np.minimum(now, 255))
            many = np.flatnonzero(before > 255)
            logits[many] = _logit(now[many], before[many])
            favour[k - 1, at] = logits
        before = now
    return tokens, counts, np.ascontiguousarray(favour.T)


def path_sizes(tokens: list[bytes]) -> np.ndarray:
    return np.minimum(np.fromiter(map(len, tokens), np.int64, len(tokens)), WORD_BYTES)


def _chosen(sizes: np.ndarray, counts: np.ndarray, favour: np.ndarray, at: np.ndarray) -> tuple[bytes, bytes]:
    """Counts and concatenated paths of the words at some places, given the paths' sizes."""
    used = np.arange(8 * WORD_BYTES) < 8 * sizes[at][:, None]
    return packed(pa.table({"c": counts[at]})), packed(pa.table({"p": favour[at][used]}))


def rare_words(distinct: pa.Array, often: dict[bytes, int]) -> list[bytes]:
    """A block's distinct words sorted, with a blank behind them, less the frequent ones."""
    return sorted(w + b" " for w in _objects(distinct) if w not in often)


# Scoring


class Mixer:
    """Scores runs of bytes, given the byte table and the paths of the words (per place of ``data``)."""

    def __init__(self, table: np.ndarray, data: np.ndarray, path_at: np.ndarray, paths: np.ndarray):
        self.table, self.data, self.path_at = table.reshape(-1), data, path_at
        self.paths = np.ascontiguousarray(paths).view(np.int64).reshape(-1)  # eight logits each

    def score(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Summed log2 probabilities of the runs, each mixed with its own weights."""
        result = np.zeros(len(starts))
        order = np.argsort(-sizes, kind="stable")
        for low in range(0, len(order), LANES):
            lanes = order[low : low + LANES]
            result[lanes] = self._run(starts[lanes], sizes[lanes])
        return result

    def _run(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        lanes, steps = len(starts), int(sizes[0])
        weights = np.empty((3, 8, lanes), dtype=np.float32)
        weights[:] = np.array(START, dtype=np.float32)[:, None, None]
        total = np.zeros(lanes)
        active = np.searchsorted(-sizes, -np.arange(steps), side="left")  # lanes longer than each step
        for begin in range(0, steps, STEPS):
            end = min(steps, begin + STEPS)
            n = int(active[begin])
            if n < weights.shape[2]:
                weights = weights[:, :, :n].copy()
            moved, dot = np.empty((3, 8, n), dtype=np.float32), np.empty((8, n), dtype=np.float32)
            places = starts[:n] + np.arange(begin, end)[:, None]  # steps x lanes
            logits, bits = self._logits(np.minimum(places, len(self.data) - 1))
            for t in range(end - begin):
                a = int(active[begin + t])
                x, w, m, error = logits[t, :, :, :a], weights[:, :, :a], moved[:, :, :a], dot[:, :a]
                np.multiply(w, x, out=m)
                np.add(m[0], m[1], out=error)
                error += m[2]
                np.maximum(error, -12, out=error)
                np.minimum(error, 12, out=error)
                np.negative(error, out=error)
                np.exp(error, out=error)
                error += 1
                np.divide(1, error, out=error)
                np.subtract(bits[t, :, :a], error, out=error)
                np.multiply(error, np.float32(RATE), out=m[0])
                np.abs(error, out=error)
                np.subtract(1, error, out=error)
                total[:a] += np.log2(np.multiply.reduce(error, axis=0))
                x *= m[0]
                w += x
        return total

    def _logits(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Logits (step, predictor, bit, lane) for a one bit, and the bits (step, bit, lane)."""
        data, (steps, lanes) = self.data, places.shape
        byte = data.take(places)
        rows = [s * 256 for s in contexts(data.take(places - 1), data.take(places - 2), data.take(places - 3))]
        path = self.paths.take(self.path_at.take(places)).view(np.int8) * _WORD_SIGNS.take(byte).view(np.int8)
        path = path.reshape(steps, lanes, 8)  # without a word zero
        found = np.empty((steps, 3, 8, lanes), dtype=np.float32)
        bits = np.empty((steps, 8, lanes), dtype=np.float32)
        tree = byte.astype(np.int32) | 256
        for j in range(8):
            node = tree >> (8 - j)
            for k, row in enumerate(rows):
                np.multiply(self.table.take(row + node), _STEP, out=found[:, k, j])
            np.multiply(path[:, :, j], _STEP, out=found[:, 2, j])
            bits[:, j] = (byte >> (7 - j)) & 1
        return found, bits


def _word_places(
    data: np.ndarray, texts: list[bytes], known: dict[bytes, int], offsets: np.ndarray, words: tuple | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Per place, the row of its word's path (-1: none); and the words of all texts, by number.

    ``words`` is ``numbered_words`` of the texts, if they were numbered before.
    """
    begin, stop = _word_edges(_BLANK[data] | (data == 0))
    found, distinct, _ = words or numbered_words(texts)
    at = pc.index_in(distinct, value_set=pa.array(list(known), pa.binary())).to_numpy()
    numbers = np.fromiter(known.values(), np.int32, len(known))[at][found]
    path_at = np.full(len(data), -1, dtype=np.int32)
    length = np.minimum(stop - begin + 1, WORD_BYTES)  # the blank behind it included
    rows = offsets[numbers].astype(np.int32)
    for k in range(WORD_BYTES):
        longer = np.flatnonzero(length > k)
        begin, rows, length = begin[longer], rows[longer], length[longer]
        path_at[begin + k] = rows + np.int32(k)
    return path_at, numbers


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) of ``docs`` (doc_id, held_out, text).

    ``base_score`` is the log10 probability by smoothed word frequencies, ``score`` that of the mix.
    """
    spark = docs.sparkSession
    path, seen = run_dir(spark, "blocks"), Observation()
    size, trained = F.sum(F.length("text")), F.count_if(~F.col("held_out"))
    rows = docs.select("doc_id", "held_out", "text").observe(seen, size.alias("size"), trained.alias("ends"))
    rows.mapInArrow(in_blocks, "block bigint, blob binary").write.parquet(path)
    blocks, ends = spark.read.parquet(path), seen.get["ends"]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (seen.get["size"] or 0) // RANGE_BYTES)

    table = byte_table(blocks)
    words = blocks.mapInArrow(_count_words, "token binary, n bigint, n_train bigint")
    ranges = sorted_ranges(words.groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_train").alias("n_train")), parts)
    edges = sorted(ranges.mapInArrow(_edges, _EDGES).collect())  # a row per range
    n_train, distinct = sum(e["n_train"] for e in edges) + ends, sum(e["known"] for e in edges) + (ends > 0)
    outside = spark.sparkContext.broadcast(_outside(edges))
    often = sum(e["n"] for e in edges) // HOT_SHARE + 1

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, blob in zip(batch.column("part"), batch.column("blob")):
                words = unpacked(blob.as_py())
                at = np.flatnonzero(words.column("n").to_numpy() >= often)
                if len(at):
                    tokens, counts, favour = paths(words, part.as_py(), outside.value)
                    c, path = _chosen(path_sizes(tokens), counts, favour, at)
                    names = packed(pa.table({"token": pa.array([tokens[i] for i in at], pa.binary())}))
                    yield _rows(**{k: pa.array([v], pa.binary()) for k, v in (("token", names), ("c", c), ("path", path))})

    hot = ranges.mapInArrow(frequent, "token binary, c binary, path binary").collect()  # HOT_SHARE words at most
    names = [t for r in hot for t in unpacked(bytes(r["token"])).column("token").to_pylist()]
    hot = (
        {t[:-1]: i for i, t in enumerate(names)}, path_sizes(names),
        _joined([r["c"] for r in hot], "c"), _joined([r["path"] for r in hot], "p"),
    )
    shared = spark.sparkContext.broadcast((table, *hot))
    bounds = [bytes(e["first"]) for e in edges]
    numbers = [e["part"] for e in edges]

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in _unblocked(batches):
            distinct = numbered_words([coded(t) for t in rows.column("text").to_pylist()])[1]
            tokens = rare_words(distinct, shared.value[1])
            low = 0
            while low < len(tokens):
                k = bisect_right(bounds, tokens[low]) - 1
                high = bisect_left(tokens, bounds[k + 1]) if k + 1 < len(bounds) else len(tokens)
                blob = packed(pa.table({"token": pa.array(tokens[low:high], pa.binary())}))
                yield _rows(part=pa.array([numbers[k]], pa.int32()), block=pa.array([block], pa.int64()),
                            n=pa.array([high - low], pa.int64()), tokens=pa.array([blob], pa.binary()))
                low = high

    wanted = run_dir(spark, "wanted")
    blocks.mapInArrow(asked, "part int, block bigint, n bigint, tokens binary").write.parquet(wanted)
    wanted = spark.read.parquet(wanted)
    copies = wanted.groupBy("part").agg(F.floor(F.sum("n") / ASKED_WORDS + 1).alias("copies"))  # a row per range
    portion = F.pmod(F.xxhash64("block"), F.col("copies"))
    asking = wanted.join(F.broadcast(copies), "part").select("part", portion.alias("portion"), "block", "tokens")
    each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1))
    answering = ranges.join(F.broadcast(copies), "part").select("part", each.alias("portion"), "blob")

    def answer(asking: pa.Table, answering: pa.Table) -> pa.Table:
        told = []
        if asking.num_rows:
            words = unpacked(answering.column("blob")[0].as_py())
            tokens, counts, favour = paths(words, answering.column("part")[0].as_py(), outside.value)
            wanted = [unpacked(blob.as_py()).column("token") for blob in asking.column("tokens")]
            places = pc.index_in(pa.concat_arrays([c for w in wanted for c in w.chunks]), value_set=words.column("token").combine_chunks())
            sizes, bounds = path_sizes(tokens), np.cumsum([len(w) for w in wanted])
            told = [_chosen(sizes, counts, favour, at) for at in np.split(places.to_numpy(), bounds[:-1])]
        columns = [pa.array(list(v), pa.binary()) for v in zip(*told)] or [pa.array([], pa.binary())] * 2
        return pa.table([asking.column("block"), asking.column("part"), *columns], names=["block", "part", "c", "path"])

    keys = ("part", "portion")
    told = asking.groupBy(*keys).cogroup(answering.groupBy(*keys))
    told = told.applyInArrow(answer, "block bigint, part int, c binary, path binary")

    def score(block: pa.Table, told: pa.Table) -> pa.Table:
        table, often, often_sizes, often_counts, often_paths = shared.value
        rows = pa.concat_tables([unpacked(b.as_py()) for b in block.column("blob")])
        ids, texts = rows.select(["doc_id", "held_out"]), [coded(t) for t in rows.column("text").to_pylist()]
        words = numbered_words(texts)
        rare = rare_words(words[1], often)
        told = told.sort_by("part")  # the ranges' order, so that of the words
        counts = np.concatenate([often_counts, _joined(told.column("c").to_pylist(), "c")])
        favours = np.concatenate([often_paths, _joined(told.column("path").to_pylist(), "p"), np.zeros(8, dtype=np.int8)])
        favours = favours.reshape(-1, 8)  # the last row is for places without a word
        lengths = np.concatenate([often_sizes, path_sizes(rare)])
        known = often | {t[:-1]: i for i, t in enumerate(rare, len(often))}
        data, starts = _padded(texts)
        sizes = np.array([len(t) + 1 for t in texts], dtype=np.int64)
        path_at, numbers = _word_places(data, texts, known, np.cumsum(lengths) - lengths, words)

        pieces = -(-sizes // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), pieces)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        low = starts[owner] + number * SEGMENT
        size = np.minimum(sizes[owner] - number * SEGMENT, SEGMENT)
        bits = np.bincount(owner, Mixer(table, data, path_at, favours).score(low, size), len(texts))

        n_words = words[2]
        document = np.repeat(np.arange(len(texts)), n_words)
        c = counts[numbers].astype(np.float64)
        under = np.log10(n_train + 0.1 * (distinct + 1))
        base = np.bincount(document, np.log10(c + 0.1) - under, len(texts)) + np.log10(ends + 0.1) - under
        n_known = np.bincount(document, c > 0, len(texts)).astype(np.int64) + (ends > 0)
        return pa.table({
            "doc_id": ids.column("doc_id"), "held_out": ids.column("held_out"), "n_tokens": n_words + 1, "n_known": n_known,
            "train_tokens": np.full(len(texts), n_train), "base_score": base, "score": bits * np.log10(2), "bits_per_byte": -bits / sizes,
        })

    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held_out boolean, n_tokens bigint, n_known bigint, "
        "train_tokens bigint, base_score double, score double, bits_per_byte double"
    )
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(score, schema)
