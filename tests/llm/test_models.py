"""Whitening, context mixing, centroids, and the training of languages, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import centroids as C
from tideline.llm import context_mixing as M
from tideline.llm import language_id, mixing
from tideline.llm import whitening as W
from tideline.llm.common import word_count

VECTORS = "vec_id bigint, embedding array<float>, n string, component string, x string"


def vectors_of(spark, rows):
    return spark.createDataFrame([(i, v, "n", "c", "x") for i, v in rows], VECTORS)


# Whitening


@pytest.mark.parametrize("kind", ["random", "graded", "repeated values", "zero columns", "clustered", "Wilkinson", "few rows", "one column"])
def test_directions_are_singular_vectors(kind):
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(80, 24)))[0]
    a = {
        "random": rng.normal(size=(80, 24)),
        "graded": rng.normal(size=(80, 24)) * 10.0 ** -np.arange(24),
        "repeated values": q @ np.diag([3] * 8 + [2] * 8 + [1] * 8),
        "zero columns": np.hstack([rng.normal(size=(80, 20)), np.zeros((80, 4))]),
        "clustered": q @ np.diag(1 + 1e-9 * np.arange(24)) @ np.linalg.qr(rng.normal(size=(24, 24)))[0],
        "Wilkinson": np.linalg.cholesky(np.diag(np.abs(np.arange(-12, 12)) + 40.0) + np.diag(np.ones(23), 1) + np.diag(np.ones(23), -1)).T,
        "few rows": rng.normal(size=(5, 24)),
        "one column": rng.normal(size=(9, 1)),
    }[kind]
    r = np.linalg.qr(a, mode="r")
    r = np.vstack([r, np.zeros((a.shape[1] - len(r), a.shape[1]))])
    values, directions = W.right_directions(r, 24)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    want = want[want > 1e-22 * want[0]]
    assert len(values) == len(want) and np.abs(values / want - 1).max() < 1e-11
    assert np.abs(directions.T @ directions - np.eye(len(values))).max() < 1e-10
    assert np.abs(a.T @ (a @ directions) - directions * values).max() < 1e-11 * values[0]


def test_no_directions_without_variance():
    assert len(W.right_directions(np.zeros((4, 4)), 4)[0]) == 0


def test_whitened_vectors(spark):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(900 + i, base[0].tolist()) for i in range(40)]  # copies are fitted once
    bad = [(-1, None), (-2, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (-3, [float("nan")] * 6), (-4, [float("inf")] * 6), (-5, [])]
    got = W.whiten(vectors_of(spark, rows + bad), "vec_id", "embedding", limit=4).collect()
    x = {i: np.floor(64 * np.float64(np.float32(v))).astype(np.int64) + 1_000_000 for i, v in rows}
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = (n * fit - sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    assert Counter(r["vec_id"] for r in got) == {i: 4 for i, _ in rows}
    sign = {}
    for r in got:
        k = r["component"] - 1
        y = n * x[r["vec_id"]] - sums
        want = float((y / n) @ vectors[:, k] / math.sqrt(values[k]))
        sign.setdefault(k, math.copysign(1, want * r["whitened"]))
        assert r["n"] == n and int(r["deviation"]) == int((y**2).sum())
        assert abs(sign[k] * r["whitened"] - want) < 1e-8
        assert abs(r["explained"] / (values[k] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9


def test_whitening_of_awkward_tables(spark):
    assert W.whiten(vectors_of(spark, []), "vec_id", "embedding").count() == 0
    assert W.whiten(vectors_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]), "vec_id", "embedding").count() == 0
    mixed = [(i, [float(i), float(i * i % 7)]) for i in range(8)] + [(20 + i, [float(i)]) for i in range(5)]
    got = W.whiten(vectors_of(spark, mixed), "vec_id", "embedding").collect()
    assert Counter(r["vec_id"] for r in got) == {i: 2 if i < 20 else 1 for i, _ in mixed}
    assert {r["n"] for r in got if r["vec_id"] >= 20} == {5}


def test_exact_deviations_beyond_longs():
    x = np.array([[2**40, 5], [-(2**40), 9]])
    y = W.deviations(x, 2**30, [7, 8])
    assert [[int(v) for v in row] for row in y] == [[2**70 - 7, 5 * 2**30 - 8], [-(2**70) - 7, 9 * 2**30 - 8]]
    assert W.squared_norms(y) == [sum(int(v) ** 2 for v in row) for row in y]


# Centroids


@pytest.mark.parametrize("width,k,spread", [(3, 5, 4), (8, 30, 50), (1, 4, 3), (16, 90, 9)])
def test_nearest_is_exact_with_ties(width, k, spread):
    rng = np.random.default_rng(width)
    x, c = rng.integers(-spread, spread, (400, width)), rng.integers(-spread, spread, (k, width))
    chosen, distance = C.nearest(x, c)
    every = ((x[:, None] - c[None]) ** 2).sum(2)
    assert (chosen == every.argmin(1)).all() and (distance == every.min(1)).all()


def test_clusters(spark):
    rng = random.Random(5)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() for _ in range(4)]) for i in range(150)]
    rows += [(7, rows[7][1]), (None, [0.5] * 4)]
    bad = [(500, None), (501, [1.0] * 3), (502, [1.0, None, 1.0, 1.0]), (503, [float("nan")] * 4), (504, [float("-inf")] * 4)]
    got = C.cluster_vectors(vectors_of(spark, rows + bad), "vec_id", "embedding", k=5, width=4, rounds=4).collect()
    x = [tuple(math.floor(1024 * float(np.float32(c))) for c in v) for _, v in rows]
    starts = sorted(range(len(rows)), key=lambda i: (hashlib.sha256(f"3:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest(), x[i]))
    centroids = [list(x[i]) for i in starts[:5]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(centroids)) for v in x]

    for _ in range(4):
        assigned = [c for _, c in assign()]
        for k in range(5):
            mine = [v for v, c in zip(x, assigned) if c == k]
            if mine:
                centroids[k] = [sum(column) // len(mine) for column in zip(*mine)]
    final = assign()
    total = sum(d for d, _ in final)
    want = Counter((rows[i][0], c, d, sum(e for e, f in final if f == c), total, tuple(centroids[c])) for i, (d, c) in enumerate(final))
    assert Counter((r["vec_id"], r["cluster"], r["distance"], int(r["cluster_inertia"]), int(r["inertia"]), tuple(r["centroid"])) for r in got) == want


def test_clusters_of_small_tables(spark):
    assert C.cluster_vectors(vectors_of(spark, []), "vec_id", "embedding", width=2).count() == 0
    few = C.cluster_vectors(vectors_of(spark, [(1, [1.0, 2.0]), (2, [3.0, 4.0])]), "vec_id", "embedding", width=2).collect()
    assert {(r["vec_id"], r["distance"], int(r["inertia"])) for r in few} == {(1, 0, 0), (2, 0, 0)}
    with pytest.raises(Exception, match="or more in size"):
        C.cluster_vectors(vectors_of(spark, [(1, [1e30, 2.0])]), "vec_id", "embedding", width=2).collect()


# Context mixing


def test_word_paths_are_counts_of_beginnings(spark):
    rng = random.Random(2)
    words = {"".join(rng.choice("abé{\x01") for _ in range(rng.randrange(1, 7))) for _ in range(120)} | {"x" * 40, "x" * 41, "z"}
    rows = [(w.encode() + b" ", 9, rng.randrange(4)) for w in words]
    table = spark.createDataFrame(rows, "token binary, n bigint, n_train bigint")
    ranges = M.sorted_ranges(table, 7)
    edges = sorted(ranges.mapInArrow(M._edges, M._EDGES).collect())
    assert len(edges) > 3 and sum(e["n_train"] for e in edges) == sum(r[2] for r in rows)
    outside = M._outside(edges)
    as_bits = lambda t: "".join(f"{b:08b}" for b in t[: M.WORD_BYTES])
    seen = 0
    for part, blob in ranges.collect():
        tokens, counts, favour = M.paths(M.unpacked(bytes(blob)), part, outside)
        for token, path in zip(tokens, favour):
            bits = as_bits(token)
            sums = [sum(n for t, _, n in rows if as_bits(t).startswith(bits[:k])) for k in range(len(bits) + 1)]
            want = M._logit(np.array(sums[1:], dtype=float), np.array(sums[:-1], dtype=float))
            assert (path[: len(bits)] == want).all()
            seen += 1
    assert seen == len(rows)


def docs_of(spark, texts, held=()):
    rows = [(i, i in held, t, "e", "c") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id bigint, held_out boolean, text string, token string, c string")


def test_base_scores_and_cases(spark):
    texts = ["The cat sat", "the dog\tsat  on the mat", None, "", "Zebra the", "the cat sat", "x\x00y \x01 é", "a " * 3000]
    got = {r["doc_id"]: r for r in M.score_documents(docs_of(spark, texts, held={4, 5})).collect()}
    lowered = [(t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")) for t in texts]
    tokens = [[w for w in __import__("re").split("[ \t-\r]+", t) if w] + [None] for t in lowered]
    counts = Counter(w for i, t in enumerate(tokens) for w in t if i not in (4, 5))
    total, kinds = sum(counts.values()), len(counts)
    for i, mine in enumerate(tokens):
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in mine)
        r = got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(mine), sum(counts[w] > 0 for w in mine), total, i in (4, 5))
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["score"] < 0 and r["bits_per_byte"] > 0
    assert got[0]["score"] == got[5]["score"]  # equal when lower-cased, trained on or not
    assert M.score_documents(docs_of(spark, [])).count() == 0
    assert M.score_documents(docs_of(spark, ["ab"], held={0})).first()["score"] < 0  # nothing to learn from


def test_probabilities_sum_to_one(spark, monkeypatch):
    """Over all continuations by one byte, of texts whose words and contexts were learned."""
    texts = ["ab abc abd b", "abc ab", "ab\nab"]
    words = Counter(w for t in texts for w in M.coded(t).split())
    probe = [bytes([b]) for b in range(256)]
    tails = [b"ab" + p for p in probe]
    known = sorted({w for t in tails for w in t.replace(b"\x00", b" ").split()} | set(words))
    rows = [(w + b" ", 1, words.get(w, 0)) for w in known]
    ranges = M.sorted_ranges(spark.createDataFrame(rows, "token binary, n bigint, n_train bigint"), 3)
    outside = M._outside(sorted(ranges.mapInArrow(M._edges, M._EDGES).collect()))
    path = {}
    for part, blob in ranges.collect():
        tokens, _, favour = M.paths(M.unpacked(bytes(blob)), part, outside)
        path |= {t[:-1]: f[: 8 * min(len(t), M.WORD_BYTES)] for t, f in zip(tokens, favour)}
    table = np.random.default_rng(1).integers(-40, 40, size=(M.SLOTS, 256)).astype(np.int8)
    names = list(path)
    lengths = np.array([len(path[w]) // 8 for w in names])
    paths = np.concatenate([*(path[w] for w in names), np.zeros(8, dtype=np.int8)]).reshape(-1, 8)
    number, total = {w: i for i, w in enumerate(names)}, 0.0
    for tail in tails:  # the byte 0 is the end mark
        data = np.frombuffer(b"\0\0\0" + tail + b"\0", dtype=np.uint8)
        text = [tail.split(b"\0")[0]]
        at, _ = M._word_places(data, text, number, np.cumsum(lengths) - lengths)
        mixer = M.Mixer(table, data, at, paths)
        both = mixer.score(np.array([3, 3]), np.array([2, 3]))
        total += 2.0 ** (both[1] - both[0])
    assert abs(total - 1) < 1e-4


def blocks_of(texts, held):
    tables = [pa.table({"doc_id": [i], "held_out": [h], "text": [t]}) for i, (t, h) in enumerate(zip(texts, held))]
    for i, table in enumerate(tables):
        yield pa.RecordBatch.from_pydict({"block": [i], "blob": [M.packed(table)]})


def test_counting_is_bounded_in_memory():
    """A task's counts of bytes are held once, and those of its texts' bytes are not held densely beside them."""
    tracemalloc.start()
    found = pa.Table.from_batches(M._count_bytes(blocks_of(["ab ab " * 1000], [False])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(found.column("n").to_pylist()) == 2 * 6001
    assert peak < 120e6


def test_counts_in_parts(monkeypatch):
    """Counts that are emitted in between sum up to those of all texts."""
    rng = random.Random(6)
    texts = [" ".join("".join(rng.choice("abÉ\x00") for _ in range(rng.randrange(1, 4))) for _ in range(30)) for _ in range(40)] + [None, "", "  "]
    held = [rng.random() < 0.2 for _ in texts]
    words = Counter(w for t in texts for w in M.coded(t).split())
    trained = Counter(w for t, h in zip(texts, held) if not h for w in M.coded(t).split())
    results = []
    for chunk, counted, flush in ((1 << 20, 1 << 31, 500_000), (100, 400, 7)):
        for name, value in (("CHUNK", chunk), ("COUNTED", counted), ("FLUSH", flush)):
            monkeypatch.setattr(M, name, value)
        sums = Counter()
        for batch in M._count_bytes(blocks_of(texts, held)):
            for row in batch.to_pylist():
                sums[row["slot"], row["byte"]] += row["n"]
        results.append(sums)
        n, n_train = Counter(), Counter()
        for batch in M._count_words(blocks_of(texts, held)):
            for row in batch.to_pylist():
                n[row["token"]] += row["n"]
                n_train[row["token"]] += row["n_train"]
        assert n == {w + b" ": k for w, k in words.items()} and +n_train == {w + b" ": k for w, k in trained.items()}
    assert results[0] == results[1]


def test_learned_text_scores_better(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoinshr") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    said = lambda n: " ".join(rng.choice(words) for _ in range(n))
    texts = [said(80) for _ in range(60)] + ["".join(rng.choice("qwxzjkvbp") for _ in range(400))]
    got = M.score_documents(docs_of(spark, texts, held={58, 59, 60})).collect()
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[58]["bits_per_byte"] < 2 < 5 < by_id[60]["bits_per_byte"]
    assert by_id[58]["score"] > by_id[58]["base_score"] * 1.2


# Mixing and languages


def test_a_source_of_equal_rows_meets_its_target(spark):
    rows = [(1, "one two three", "a")] * 1000 + [(i, "x " * (i % 9 + 1), "b") for i in range(2, 400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    sized = df.select("doc_id", "source", word_count(F.col("text")).alias("size"), mixing.draw_of("doc_id", "text").alias("draw"))
    numbered = mixing.numbered_draws(sized)
    assert numbered.filter("source = 'a'").select("draw").distinct().count() > 990
    assert numbered.drop("draw").exceptAll(sized.drop("draw")).count() == 0 == sized.count() - numbered.count()
    mixed = mixing.mix_sources(numbered, weights=(1.0, 1.0), share=1.0)
    got = {r["source"]: r for r in mixed.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()}
    assert all(abs(r["taken"] - r["target"]) <= 9 for r in got.values())
    again = mixing.mix_sources(mixing.numbered_draws(sized.repartition(5)), weights=(1.0, 1.0), share=1.0)
    assert mixed.select("doc_id", "copies").exceptAll(again.select("doc_id", "copies")).count() == 0


def test_repeated_texts_do_not_lose_their_language(spark):
    rows = [("the same text again", "en")] * 500 + [(f"texte numero {i}", "fr") for i in range(30)]
    model = language_id.train(spark.createDataFrame(rows, "text string, lang string"), per_language=3)
    assert [(r["lang"], r["docs"]) for r in model] == [("en", 500), ("fr", 30)]
    whole = language_id.train(spark.createDataFrame([rows[0]] * 7, "text string, lang string"))
    assert whole[0]["docs"] == 7


def test_any_number_of_languages(spark):
    rows = [(" ".join(chr(0x4E00 + 40 * k + j) for j in range(12)), f"l{k:03d}") for k in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string")
    model = language_id.train(df)
    got = language_id.predict(df, model, languages=128).collect()
    assert len(model) == 300 and all(r["lang_pred"] == r["lang"] for r in got)
    one = language_id.predict(df.limit(20), model, languages=512).collect()
    few = language_id.predict(df.limit(20), model, languages=7).collect()
    assert [r["lang_pred"] for r in one] == [r["lang_pred"] for r in few]
    assert all(abs(a["score"] - b["score"]) < 1e-9 for a, b in zip(one, few))
