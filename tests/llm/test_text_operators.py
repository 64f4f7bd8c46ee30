"""Dealt operators against brute force, and on awkward tables."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideline.llm import (
    chat,
    common,
    decontaminate,
    fuzzy_lines,
    language_id,
    mixing,
    near_copies,
    quality,
    sharding,
    suffix_dedup,
    url_filter,
)
from tideline.llm.common import connected_components, ranked, word_count
from tideline.scale import shared_dir

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # names that results use
    "size bigint, target string, kept string, shard string, rule string, score string, n_words string"
)
WORDS = "the of and to in that it is was he for on are with as his they be at one have this from".split()


def rows(texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return [
        (i, t, ("en", "de", None)[k % 3], ("s1", "s2", None, "s3")[k % 4], 0, 9, "x", "x", "x", "x", "x", "x")
        for k, (i, t) in enumerate(zip(ids, texts, strict=True))
    ]


def sentence(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 60)) for _ in range(n))


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in any column, empty and very long texts, repeated rows, equal ids, clashing names."""
    rng = random.Random(1)
    long_ = sentence(rng, 20000)
    texts = [None, "", " \n\t", "x", long_, long_, sentence(rng, 50), sentence(rng, 50), "é€𝄞 " * 30, "1 2 3"]
    ids = [None, 1, 1, 2, 3, 4, 5, None, 7, 7]
    data = rows(texts, ids)
    data += [data[6], data[6], (None,) * 12]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


# 10 quality ------------------------------------------------------------------------------


def counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = set()
    for i, w in enumerate(windows):
        if often[w] > 1:
            covered.update(range(i, i + 5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)), len(covered),
    )


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_counts(spark):
    rng = random.Random(2)
    texts = [None, "", "a b c d e f a b c d e f", "a\n\na\n \nb", "#*$%&|<>" * 3, "\x0b a\x0cb\rc "]
    texts += [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(rows(texts), SCHEMA)
    got = {r["doc_id"]: tuple(r[n] for n in NAMES) for r in quality.quality_rules(df).collect()}
    assert got == {i: counts(t) for i, t in enumerate(texts)}


def test_quality_verdict(spark, awkward, empty):
    rng = random.Random(3)
    texts = [sentence(rng, rng.randint(20, 80)) for _ in range(300)]
    texts += [" ".join(w + "###***" for w in sentence(rng, 40).split()), "too short"]
    data = [(i, t, "en", "s", 0, *["x"] * 7) for i, t in enumerate(texts)]
    data = [(*r[:5], 9, *r[6:]) for r in data]
    got = quality.quality_rules(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r["doc_id"] for r in got if not r["kept"]} == {300, 301}
    assert quality.quality_rules(empty).count() == 0
    judged = quality.quality_rules(awkward)
    assert judged.count() == awkward.count()
    assert not judged.filter("text is null and kept").count()


def test_fences_move_smoothly(spark):
    """One document more moves a small group's fences a little, whatever its size."""
    rng = random.Random(21)
    wide = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(40)), "en", "a", 0, *["x"] * 7) for i in range(400)]
    wide = [(*r[:5], 9, *r[6:]) for r in wide]
    seen = []
    for n in (0, 1, 198, 199, 200, 201, 2000):
        own = [(1000 + i, " ".join("w" * 12 for _ in range(40)), "en", "b", 0, 9, *["x"] * 6) for i in range(n)]
        measured = quality.measure(spark.createDataFrame(wide + own, SCHEMA)).withColumn("base_failed", F.lit(False))
        limits = {r["_source"]: r for r in quality.fences(quality.sketch(measured)).collect()}
        seen.append(limits["=b"]["_to_mean_word"] if n else None)
    assert max(abs(b - a) for a, b in zip(seen[2:5], seen[3:6], strict=True)) < 0.2
    assert 14 <= seen[6] < 18 and seen[6] < seen[2]


# 1 mixing --------------------------------------------------------------------------------


def mixed_of(df):
    sized = df.withColumns({"size": word_count(F.col("text")), "draw": mixing.draw_of("doc_id", "text")})
    return mixing.mix_sources(sized)


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, target, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while True:
        left = total - sum(target.values())
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / share > 2 * sizes[s] + 1e-9] if share else []
        if not over:
            return target | {s: left * weight[s] / share for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
            open_.remove(s)


def test_mixing(spark):
    rng = random.Random(4)
    data = []
    for i in range(3000):
        s = rng.choice(["a", "b", "c", "d", None, "big", "big", "big"])
        data.append((i, sentence(rng, int(rng.paretovariate(1.2) * 8) % 700), "en", s, 0, 9, *["x"] * 6))
    df = spark.createDataFrame(data, SCHEMA)
    got = mixed_of(df).collect()
    assert [r["doc_id"] for r in got] != [] and len(got) == len(data)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
    want = brute_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s], rel=1e-9)
        assert taken[s] == pytest.approx(want[s], rel=0.03)
    again = {r["doc_id"]: r["taken"] for r in mixed_of(df.repartition(5)).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in got}


def test_mixing_awkward(awkward, empty):
    got = mixed_of(awkward).collect()
    assert len(got) == awkward.count()
    assert all(r["taken"] <= 2 * r["size"] for r in got)
    assert mixed_of(empty).count() == 0


# 5 sharding ------------------------------------------------------------------------------


@pytest.mark.parametrize(("dims", "bits"), [(1, 4), (2, 4), (3, 3), (4, 2)])
def test_hilbert_curve(spark, dims, bits):
    df = spark.range(1 << (dims * bits))
    cells = [F.shiftright("id", bits * i).bitwiseAND(F.lit((1 << bits) - 1)) for i in range(dims)]
    got = df.select(F.array(*cells).alias("c"), sharding.hilbert_index(cells, bits).alias("h")).orderBy("h").collect()
    assert [r["h"] for r in got] == list(range(len(got)))
    for a, b in zip(got, got[1:], strict=False):
        assert sum(abs(x - y) for x, y in zip(a["c"], b["c"], strict=True)) == 1


def runs_of(df):
    narrow = df.select("doc_id", "lang", "source", sharding.text_bytes(F.col("text")).alias("size"))
    return sharding.cut_runs(narrow, ["lang", "source", "size", "doc_id"], [], sizes=["size"])


def test_sharding(spark, awkward, empty):
    rng = random.Random(5)
    df = spark.createDataFrame(rows([sentence(rng, rng.randint(0, 90)) for _ in range(203)]), SCHEMA)
    for table, n in ((df, 203), (awkward, awkward.count())):
        slots = defaultdict(list)
        for r in runs_of(table).collect():
            slots[r["shard"]].append(r["slot"])
        sizes = [len(slots[s]) for s in range(8)]
        assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        whole = sharding.shard_documents(table)
        assert whole.count() == n and set(table.columns) <= set(whole.columns)
    by_doc = {r["doc_id"]: r["shard"] for r in runs_of(df).collect()}
    assert by_doc == {r["doc_id"]: r["shard"] for r in sharding.shard_documents(df).collect()}
    assert runs_of(empty).count() == 0 and sharding.shard_documents(empty).count() == 0


# 8 chats ---------------------------------------------------------------------------------


def brute_fold(events):
    messages = {}
    for seq, message, kind, role, text in sorted(events):
        if kind == "regenerate":
            messages = {m: v for m, v in messages.items() if m <= message}
        r, t = messages.get(message, (None, ""))
        t = t + (text or "") if kind == "delta" else (text or "")
        messages[message] = (role if role is not None else r, t)
    return [(r or "", t) for _, (r, t) in sorted(messages.items())]


def test_chat_fold(spark):
    rng = random.Random(6)
    tricky = ["<|end|>\n", "&lt;", "&", "<", "[INST]", "</s>", "é\n", "", None, "a<|turn|>user<|text|>x"]
    data, want = [], {}
    for c in range(40):
        events = [
            (seq, rng.randint(0, 4), rng.choice(["message", "delta", "delta", "edit", "regenerate"]),
             rng.choice(["user", "assistant", "sy&stem<|"]), rng.choice(tricky))
            for seq in range(rng.randint(1, 25))
        ]
        want[c] = brute_fold(events)
        data += [(c, *e) for e in events]
    df = spark.createDataFrame(data, "conv_id bigint, seq bigint, message bigint, kind string, role string, text string")
    formatted = chat.format_conversations(df)
    for r in chat.read_back(formatted).collect():
        assert [(t["role"], t["text"]) for t in r["turns"]] == want[r["conv_id"]]
        assert r["loss_texts"] == [t for role, t in want[r["conv_id"]] if role == "assistant"]
        assert "[INST]" not in r["formatted"] and "</s>" not in r["formatted"]
    assert formatted.count() == sum(1 for m in want.values() if m)


def test_chat_rows(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    data = [(1, 0, "user", None), (1, 0, "user", None), (1, 1, "assistant", "é" * 99999), (None, 0, None, "x"), (2, None, "assistant", "")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(chat.logged(spark.createDataFrame(data, schema)))).collect()}
    assert [t["text"] for t in got[1]["turns"]] == ["", "", "é" * 99999]
    assert got[None]["turns"][0]["role"] == "" and got[2]["loss_texts"] == [""]
    assert chat.format_conversations(chat.logged(spark.createDataFrame([], schema))).count() == 0


# 3 URLs ----------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = [
        None, "", "nothing", "http://", "http://X.NET", "http://x.net/", "https://net/a", "http://a.EXAMPLE.net/en/1?x",
        "http://example.net/en", "http://b.example.com/de/1", "http://example.com/den", "http://a.org/fr/#x", "http://org/fr/",
        "http://notnet/", "ftp://u@h.net:80/p?q/#", "http://a.org?fr/", "x://y://z.net/",
    ]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    listed = spark.createDataFrame([("notnet",), ("elsewhere",), ("",)], "key string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.filter_urls(pages, listed).collect()}
    want = {}
    for i, url in enumerate(urls):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.lower()
        fits = [
            (len(t), t, v)
            for v, t in url_filter.RULES
            if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/") :])
        ]
        rule = max(fits)[1] if fits else None
        want[i] = (host, path, rule, max(fits)[2] if fits else ("block" if host in ("notnet", "") else "allow"))
    assert got == want
    assert url_filter.filter_urls(pages.limit(0), listed).count() == 0
    assert not url_filter.filter_urls(pages, listed.limit(0)).filter("listed").count()


def test_cascade_is_exact(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "KEYS_PER_BUCKET", 3000)
    keys = spark.range(20000).select(F.concat(F.lit("h"), F.col("id")).alias("key"))
    listed = spark.range(0, 40000, 7).select(F.concat(F.lit("h"), F.col("id")).alias("key"))
    cascade, buckets = url_filter.build_cascade(keys.unionByName(keys), listed)
    assert buckets > 1
    for limit in (url_filter.MAX_BROADCAST, 4000):
        judged = url_filter.is_listed(keys, "key", cascade, buckets, limit)
        got = {r["key"] for r in judged.filter("listed").collect()}
        assert got == {f"h{i}" for i in range(0, 20000, 7)} and judged.count() == 20000


# 4 languages -----------------------------------------------------------------------------


def test_language(spark, awkward, empty):
    rng = random.Random(7)
    alphabets = {"aa": "abcdefg ", "bb": "efghijk ", "cc": "жзийк "}
    data = []
    for i in range(300):
        lang = rng.choice(list(alphabets))
        data.append(("".join(rng.choice(alphabets[lang]) for _ in range(80)) + "efg", lang))
    df = spark.createDataFrame(data, "text string, lang string")
    model = language_id.train(df)
    judged = language_id.predict(df.withColumn("score", F.lit(0)), model).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in judged) / len(judged) > 0.97
    assert all(0 <= r["score"] <= 1 for r in judged)
    got = language_id.predict(awkward, model).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in r["text"] or ""))
    assert language_id.train(empty.select("text", "lang")) == []
    assert language_id.predict(empty, model).count() == 0
    assert {r["lang_pred"] for r in language_id.predict(awkward, []).collect()} == {"und"}


def test_language_pieces(monkeypatch):
    text = ["abcd" * 50, "x", "öab" * 70]
    whole = Counter((o, b) for bs, os in language_id._pieces(text) for b, o in zip(bs.tolist(), os.tolist(), strict=True))
    assert sum(whole.values()) > 1000 and {o for o, _ in whole} == {0, 1, 2}


# 2 decontamination -----------------------------------------------------------------------


def leaks_of(spark, docs, items):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string")
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    return {(r["doc_id"], r["item_id"]): r for r in decontaminate.find_leaks(d, b).collect()}


def test_leaks(spark):
    rng = random.Random(8)
    filler = lambda n: sentence(rng, n).replace("0", "o")
    item = "If Anna buys 3 apples for 5 euros each and gives 3 apples to Bob, how many euros did Anna spend in all?"
    exchanged = item.replace("Anna", "Carla").replace("Bob", "Dirk").replace("3", "12").replace("5", "7")
    mixed_up = item.replace("Anna buys", "Carla buys").replace("3 apples for", "12 apples for")
    docs = [filler(60), f"{filler(30)}. {item} {filler(20)}", f"{filler(9)}.\n{exchanged}", mixed_up, None, "", item[:40], "short item", "a short item"]
    items = [item, "Short item", None, "", item, "..."]
    got = leaks_of(spark, docs, items)
    assert set(got) == {(1, 0), (2, 0), (7, 1)}
    assert got[(2, 0)]["changed"] > 0 and got[(1, 0)]["changed"] == 0
    assert leaks_of(spark, docs, [None]) == {}


def test_leak_parts_and_drop(spark, awkward, empty):
    rng = random.Random(9)
    items = [sentence(rng, 30) for _ in range(25)]
    docs = [sentence(rng, 40) for _ in range(30)] + [sentence(rng, 20) + "\n" + items[k] for k in range(0, 25, 3)]
    want = {(30 + n, k) for n, k in enumerate(range(0, 25, 3))}
    d = spark.createDataFrame(rows(docs), SCHEMA)
    b = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    for limit in (decontaminate.MAX_TOKENS, 300):
        found = decontaminate.find_leaks(d, b, limit).collect()
        assert {(r["doc_id"], r["item_id"]) for r in found} == want
    left = decontaminate.drop_leaking(d, b)
    assert {r["doc_id"] for r in left.collect()} == set(range(30)) and left.columns == d.columns
    assert decontaminate.drop_leaking(awkward, b).count() == awkward.count()
    assert decontaminate.drop_leaking(empty, b).count() == 0


def test_leaks_in_parts(spark):
    """Runs mixed up at one place, exchanged first names, and altered words leak; short mix-ups do not."""
    rng = random.Random(22)
    words = [rng.choice("ab cd ef gh ij kl mn op".split()) + "x" * (k % 11) for k in range(70)]
    words[10] = words[30] = words[60] = "17"
    passage = " ".join(words)
    once = " ".join(words[:30] + ["18"] + words[31:])
    names = "Tom has 5 apples today. Tom gives Ann 3 apples. Ann keeps 3 apples at home. Tom eats 2 apples alone."
    other = names.replace("Tom", "Eve").replace("Ann", "Kim")
    mixed = names.replace("Tom has", "Eve has").replace("Tom eats", "Zoe eats").replace("Ann keeps", "Eve keeps")
    altered = " ".join("zz" if k % 10 == 9 else w for k, w in enumerate(words))
    inserted = " ".join(w for k, v in enumerate(words) for w in ([v, "zz"] if k % 12 == 11 else [v]))
    docs = [once, other, mixed, altered, inserted, "some other words " * 30]
    assert {(d, i) for d, i in leaks_of(spark, docs, [passage, names])} == {(0, 0), (1, 1), (3, 0), (4, 0)}


def test_windows_of_texts_at_a_time():
    """Texts taken together have the windows that each has alone."""
    rng, tokens = random.Random(24), decontaminate._Tokens()
    words = "Tom Ann 3 12 km apples . ? \n the of for He".split(" ")
    texts = ["", "km", "3", " ".join(words), *(" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(60))]
    together = decontaminate.text_windows(texts, tokens)
    assert len(together) == len(texts)
    for text, found in zip(texts, together, strict=True):
        one = decontaminate.canonical(text, tokens)
        if len(one.values) < decontaminate.WINDOW:
            want = {h for f in one.forms if len(f) for h in decontaminate._short_key(f).view(np.int64).tolist()}
        else:
            want = {h for f in one.forms for h in decontaminate.window_hashes(f).view(np.int64).tolist()}
        assert set(found.tolist()) == want
    assert [len(x) for x in decontaminate.text_windows(["", ""], tokens)] == [0, 0]


def brute_leak(item, doc):
    """Whether a text leaks an item, over all diagonals and all stretches, without hashes."""

    def tokens(text, initial):
        out, before, number = [], True, False
        for t in re.findall(r"[^\W\d_]+|\d+(?:[.,]\d+)*|[%$€£]|[.!?:;\n]", text):
            if t in ".!?:;\n":
                before = True
                continue
            unit = t.lower() in decontaminate.UNITS.split()
            kind = "#" if t[0].isdigit() else "u" if unit and number else "N" if t[0].isupper() and not unit and (initial or not before) else None
            out.append((kind, t.lower()))
            before, number = False, t[0].isdigit()
        return out

    def agree(pairs):
        return all((x == v) == (y == w) for x, y in pairs for v, w in pairs)

    for initial in (False, True):
        a, b = tokens(item, initial), tokens(doc, initial)
        same = lambda x, y: x[0] == y[0] and (x[0] is not None or x[1] == y[1])
        if 0 < len(a) < 8:
            if len(a) == len(b) and all(map(same, a, b)) and agree([(x[1], y[1]) for x, y in zip(a, b, strict=True) if x[0]]):
                return True
            continue
        for shift in range(-len(a) + 1, len(b)):
            run = []
            for i in range(len(a) + 1):
                j = i + shift
                if i < len(a) and 0 <= j < len(b) and same(a[i], b[j]):
                    run.append((a[i], b[j]))
                    continue
                part = lambda lo, hi: agree({(x[1], y[1]) for x, y in run[lo:hi] if x[0]})  # noqa: B023, E731
                if len(run) >= 8 and len(run) >= min(13, len(a) / 2) and part(0, len(run)):
                    return True
                if len(run) >= 26 and any(part(lo, lo + 26) for lo in range(len(run) - 25)):
                    return True
                run = []
    return False


def test_leaks_against_brute_force(spark):
    rng = random.Random(23)
    vocabulary = "he she buys sells Anna Bob Carla 3 5 12 km apples . ? the of for each".split()
    draw = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [" ".join(draw(rng.choice((4, 9, 16, 24, 40)))) for _ in range(25)]
    docs = []
    for _ in range(80):
        copy = rng.choice(items).split()
        swap = dict(zip(("Anna", "Bob", "3", "5"), rng.choice((("Dora", "Eli", "8", "9"), ("Bob", "Anna", "5", "3"), ("Eli", "Eli", "8", "8"))), strict=True))
        copy = [swap.get(w, w) for w in copy] if rng.random() < 0.6 else copy
        if rng.random() < 0.4:
            copy[rng.randrange(len(copy))] = rng.choice(("7", "Ida", "word"))
        docs.append(" ".join(copy if rng.random() < 0.3 else draw(rng.randint(0, 12)) + copy + draw(rng.randint(0, 12))))
    got = leaks_of(spark, docs, items)
    missed = [(d, i) for d, t in enumerate(docs) for i, x in enumerate(items) if items.index(x) == i and brute_leak(x, t) and (d, i) not in got]
    assert not missed and len(got) > 30
    for d, i in set(got) - {(d, i) for d, t in enumerate(docs) for i, x in enumerate(items) if brute_leak(x, t)}:
        words = got[d, i]  # several runs in sum
        assert words["run"] >= min(26, words["item_words"] / 2) and words["run"] >= 16


# 9 near copies ---------------------------------------------------------------------------


def brute_classes(docs):
    words = near_copies._Words()
    kmers = {i: near_copies.labelled_kmers(t, words) for i, t in docs if t is not None}
    parent = {i: i for i, _ in docs}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = list(kmers)
    text = dict(docs)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            if text[a] == text[b] or near_copies.similarity(kmers[a], kmers[b]) >= near_copies.MIN_SIMILARITY:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: root(i) for i, _ in docs}


def edited(rng, text, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = "new" + str(rng.randint(0, 10**6))
    return " ".join(words)


def test_similarity_is_edit_sensitive():
    words = near_copies._Words()
    rng = random.Random(10)
    parts = [sentence(rng, 50) for _ in range(4)]
    one = near_copies.labelled_kmers(" ".join(parts), words)
    assert near_copies.similarity(one, one) == 1.0
    swapped = near_copies.labelled_kmers(" ".join([parts[2], parts[3], parts[0], parts[1]]), words)
    assert len(np.intersect1d(one, swapped)) > 180 and near_copies.similarity(one, swapped) == 0.0
    assert len(set(near_copies.labelled_kmers("a b c d e " * 30, words).tolist())) == 146


@pytest.mark.parametrize("oldest", [True, False])
def test_near_copies(spark, oldest):
    rng = random.Random(11)
    passage = sentence(rng, 60)
    docs = []
    for _ in range(4):
        base = sentence(rng, 150)
        docs += [base] + [edited(rng, base, rng.choice([0, 1, 2, 3, 8])) for _ in range(25)]
    docs += [sentence(rng, 40) + " " + passage + " " + sentence(rng, 40) for _ in range(60)]
    docs += ["a b", "a  b", "a b c", "", "", " ", None, None]
    docs = list(enumerate(docs)) if oldest else list(zip(range(len(docs), 0, -1), docs, strict=True))
    rng.shuffle(docs)
    got = near_copies.near_copies(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).collect()
    want = brute_classes(docs)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert {r["doc_id"] for r in got if r["kept"]} == set(want.values())


def test_near_copies_of_a_template(spark, monkeypatch):
    """Pairs just over the similarity that share most buckets with all documents of their template."""
    monkeypatch.setattr(common, "BLOCK", 16)
    rng = random.Random(18)
    template, docs = sentence(rng, 300), []
    for _ in range(40):
        shared = sentence(rng, 20)
        docs += [f"{template} {shared} {sentence(rng, 30)}" for _ in range(2)]
    docs = list(enumerate(docs))
    rng.shuffle(docs)
    got = near_copies.near_copies(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)).collect()
    want = brute_classes(docs)
    assert len(set(want.values())) == 40
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_near_copies_of_one_large_template(spark):
    """Texts of one template, some just over and most under the similarity: few pairs are compared, none is missed."""
    rng = random.Random(19)
    template = sentence(rng, 120)
    texts = [edited(rng, template, rng.choice([4, 5, 8])) for _ in range(150)]
    texts += [edited(rng, t, 1) for t in texts[:30]]
    words = near_copies._Words()
    kmers = [near_copies.labelled_kmers(t, words) for t in texts]
    rows = [(i, i, 0, len(k), bytearray(k.astype(np.uint32).tobytes())) for i, k in enumerate(kmers)]
    nodes = spark.createDataFrame(rows, "node bigint, component bigint, bucket bigint, kmers bigint, profile binary")
    placed = near_copies._by_rare_kmers(nodes.select("node", "component", "bucket"), nodes.select("node", "kmers"), nodes.select("node", "profile"))
    pairs = {tuple(r) for r in near_copies._rare_pairs(placed).collect()}
    near = {(a, b) for b in range(len(texts)) for a in range(b) if near_copies.similarity(kmers[a], kmers[b]) >= near_copies.MIN_SIMILARITY}
    assert len(near) >= 30 and near <= pairs and len(pairs) < 4 * len(texts)
    got = near_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == brute_classes(list(enumerate(texts)))


def test_near_copies_awkward(awkward, empty):
    assert near_copies.near_copies(awkward.select("doc_id", "text")).count() == awkward.count()
    left = near_copies.drop_near_copies(awkward)
    texts = [r["text"] for r in left.collect() if r["text"] is not None]
    assert len(texts) == len(set(texts)) and left.columns == awkward.columns
    assert left.filter("text is null").count() == awkward.filter("text is null").count()
    assert near_copies.near_copies(empty.select("doc_id", "text")).count() == 0


# 7 repeats -------------------------------------------------------------------------------


def brute_removal(docs):
    seen, out = set(), {}
    for i, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for at in range(len(data) - 99):
            w = data[at : at + 100]
            if w in seen:
                gone[at : at + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out[i] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_repeats(spark, monkeypatch, hot):
    if hot:  # every frequent beginning is dealt again
        monkeypatch.setattr(suffix_dedup, "HOT_FACTOR", 0.01)
        monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 2)
        monkeypatch.setattr(suffix_dedup, "RUN_SUFFIXES", 64)
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdé \n\0") for _ in range(n))
    passages = [noise(rng.choice([99, 100, 120, 250])) for _ in range(5)]
    docs = []
    for i in range(200):
        kind = rng.randrange(6)
        text = [
            lambda: noise(rng.randint(0, 300)),
            lambda: noise(rng.randint(0, 80)) + rng.choice(passages) + noise(rng.randint(0, 80)),
            lambda: "a" * rng.randint(90, 400),
            lambda: "ab" * rng.randint(40, 200) + rng.choice(passages),
            lambda: rng.choice(passages)[: rng.randint(1, 150)] + rng.choice(passages)[-110:],
            lambda: docs[-1][1] if docs else None,
        ][kind]()
        docs.append((i * 7 - 50, text))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute_removal(docs)


def test_repeats_awkward(awkward, empty):
    got = suffix_dedup.remove_repeats(awkward.select("doc_id", "text")).collect()
    assert len(got) == awkward.count()
    for r in got:
        assert r["n_removed"] == sum(b - a for a, b in zip(r["starts"], r["ends"], strict=True)) <= r["n_bytes"]
    assert suffix_dedup.remove_repeats(empty.select("doc_id", "text")).count() == 0


def test_buckets_of_spaced_ids():
    """Evenly spaced ids are dealt over all buckets."""
    for gap in (1, 200, 1000, 1 << 20):
        sizes = np.bincount(suffix_dedup._bucket_of(np.arange(-10_000, 10_000) * gap, 200), minlength=200)
        assert sizes.min() > 50 and sizes.max() < 160


def test_merge_of_runs():
    rng = random.Random(13)
    runs = []
    for _ in range(9):
        strings = sorted({bytes(rng.choice(b"ab") for _ in range(12)) for _ in range(rng.randint(0, 40))})
        shared = [0] + [next((k for k in range(12) if a[k] != b[k]), 12) for a, b in zip(strings, strings[1:], strict=False)]
        runs.append((strings, shared[: len(strings)]))
    order, known = suffix_dedup.merge_runs(runs)
    merged = [runs[r][0][i] for r, i in order]
    assert merged == sorted(x for strings, _ in runs for x in strings)
    for k in range(1, len(merged)):
        assert known[k] == next((j for j in range(12) if merged[k][j] != merged[k - 1][j]), 12)


def test_front_coding_round_trip():
    rng = np.random.default_rng(14)
    table = rng.integers(0, 2, (200, suffix_dedup._ENTRY)).astype(np.uint8)
    table[:, :90] = 7
    table = table[suffix_dedup._sorted_rows(table)]
    back, _ = suffix_dedup.decoded(len(table), *suffix_dedup.front_coded(table))
    assert (back == table).all()


# 6 lines ---------------------------------------------------------------------------------


def normal(line):
    return re.sub(r"[\W_]+", " ", line.lower()).strip()


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_lines(spark, awkward, empty):
    rng = random.Random(15)
    bases = [sentence(rng, 40) for _ in range(8)]
    docs = []
    for i in range(60):
        lines = []
        for _ in range(rng.randint(1, 6)):
            line = rng.choice(bases) if rng.random() < 0.5 else sentence(rng, 30)
            if rng.random() < 0.3:
                line = edited(rng, line, 1)
            lines.append(rng.choice([line, line.upper(), line + "!!", "--"]))
        docs.append((i, "\n".join(lines)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    judged = fuzzy_lines.fuzzy_lines(df)
    got = {r["doc_id"]: r["removed"] for r in judged.collect()}
    hashes = {(r["doc"], r["line_no"]): r["simhash"] for r in fuzzy_lines.hashed_lines(fuzzy_lines._keyed(df)).collect()}
    places = [(i, k, normal(x)) for i, t in docs for k, x in enumerate(t.split("\n")) if normal(x)]
    parent = list(range(len(places)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, (i, k, a) in enumerate(places):
        for y in range(x):
            j, m, b = places[y]
            apart = bin((hashes[i, k] ^ hashes[j, m]) & (1 << 64) - 1).count("1")
            if a == b or (apart <= 3 and edit_distance(a.split(), b.split()) <= 0.1 * max(len(a.split()), len(b.split()))):
                lo, hi = sorted((root(x), root(y)))
                parent[hi] = lo
    want = {i: [] for i, _ in docs}
    for x, (i, k, _) in enumerate(places):
        if root(x) != x:
            want[i].append(k)
    assert got == want
    cleaned = {r["doc_id"]: r["text"] for r in fuzzy_lines.without_lines(df, judged).collect()}
    for i, t in docs:
        assert cleaned[i] == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in want[i])
    assert fuzzy_lines.fuzzy_lines(awkward.select("doc_id", "text")).count() == awkward.count()
    assert fuzzy_lines.fuzzy_lines(empty.select("doc_id", "text")).count() == 0


def test_lines_of_mixed_buckets(spark, monkeypatch):
    """Large buckets of unlike lines give what small ones do."""
    rng = random.Random(19)
    stem, docs = sentence(rng, 60), []
    for i in range(150):
        docs.append((i, " ".join([stem] + [f"{i % 50}x{rng.randint(0, 2)}" for _ in range(rng.randint(1, 12))])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    results = []
    for small, apart in ((10**6, 10**6), (2, 1)):
        monkeypatch.setattr(fuzzy_lines, "SMALL", small)
        monkeypatch.setattr(fuzzy_lines, "APART", apart)
        monkeypatch.setattr(common, "BLOCK", 64)
        results.append({r["doc_id"]: r["removed"] for r in fuzzy_lines.fuzzy_lines(df).collect()})
    assert results[0] == results[1]


def test_hash_of_all_words(spark):
    """Lines of any length have the majority bits of all their words."""
    rng = random.Random(20)
    lines = [sentence(rng, n) for n in (1, 9, 32, 33, 64, 65, 129)] + ["same " * 300 + sentence(rng, 20)]
    df = spark.createDataFrame([(0, "\n".join(lines))], "doc_id bigint, text string")
    got = {r["line_no"]: r["simhash"] for r in fuzzy_lines.hashed_lines(fuzzy_lines._keyed(df)).collect()}
    words = sorted({w for x in lines for w in normal(x).split()})
    made = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h"))
    codes = {r["w"]: r["h"] & (1 << 64) - 1 for r in made.collect()}
    for k, line in enumerate(lines):
        all_ = [codes[w] for w in normal(line).split()]
        want = sum(1 << p for p in range(64) if 2 * sum(h >> p & 1 for h in all_) > len(all_))
        assert got[k] & (1 << 64) - 1 == want


def test_line_similarity_counts_characters(spark):
    line = "one letter is wrong in this line of words"
    typo, other = line.replace("wrong", "wrung"), line.replace("wrong in this", "right at that")
    lines = list(enumerate((line, typo, other)))
    nodes = spark.createDataFrame([(i, 0) for i, _ in lines], "node bigint, simhash bigint")
    texts = spark.createDataFrame(lines, "node bigint, norm string")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a bigint, b bigint")
    assert {tuple(r) for r in fuzzy_lines._verified(pairs, nodes, texts).collect()} == {(0, 1)}


def test_texts_of_near_hashes_only(spark):
    """Texts are fetched for the pairs of near hashes, not for all lines that share a bucket."""
    nodes = spark.createDataFrame([(0, 0), (1, 7), (2, 255)], "node bigint, simhash bigint")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (1, 2)], "a bigint, b bigint")
    asked = []

    def texts(near):
        asked.extend(tuple(r) for r in near.collect())
        return spark.createDataFrame([(0, "one line of words"), (1, "one line of word")], "node bigint, norm string")

    assert {tuple(r) for r in fuzzy_lines._verified(pairs, nodes, texts).collect()} == {(0, 1)}
    assert asked == [(0, 1)]


def test_pairs_told_where_they_meet(spark):
    """Of the pairs that share a bucket, only those of near hashes leave it."""
    rows = [(0, 5, 0, 0), (1, 5, 1, 3), (2, 5, 2, 255)]
    members = spark.createDataFrame(rows, "node bigint, bucket bigint, component bigint, simhash bigint")
    pairs, rest = common.cross_pairs(members, 64, 16, fuzzy_lines._by_quarters, 1, "simhash", fuzzy_lines._near)
    assert {tuple(r) for r in pairs.collect()} == {(0, 1)} and rest.count() == 0


def test_distance_without_common_ends(spark):
    rng = random.Random(21)
    pick = lambda n: [rng.choice(("a", "b", "ab", "ba", "aab")) for _ in range(n)]
    lines = []
    for _ in range(120):
        head, tail = pick(rng.randint(0, 12)), pick(rng.randint(0, 12))
        lines += [" ".join(head + pick(rng.randint(0, 2)) + tail) or "a" for _ in range(2)]
    nodes = spark.createDataFrame([(i, 0) for i in range(len(lines))], "node bigint, simhash bigint")
    texts = spark.createDataFrame(list(enumerate(lines)), "node bigint, norm string")
    every = [(i, i + 1) for i in range(0, len(lines), 2)] + [(i, i + 2) for i in range(0, 60)]
    pairs = spark.createDataFrame(every, "a bigint, b bigint")
    want = {(a, b) for a, b in every if edit_distance(lines[a], lines[b]) <= 0.1 * max(len(lines[a]), len(lines[b])) + 1e-9}
    assert 20 < len(want) < len(every) - 20
    assert {tuple(r) for r in fuzzy_lines._verified(pairs, nodes, texts).collect()} == want


def test_pairs_of_buckets_once(spark):
    """Near hashes of near lengths meet, once over all buckets of blocks, and in one quarter of a bucket at least."""
    rng = random.Random(22)
    rows = []
    for i in range(60):
        base = rng.getrandbits(64)
        for _ in range(4):
            flipped = base ^ sum(1 << p for p in rng.sample(range(64), rng.randint(0, 3)))
            rows.append((len(rows), flipped - (flipped >> 63 << 64), rng.choice((40, 41, 50))))
    nodes = spark.createDataFrame(rows, "node bigint, simhash bigint, length int")
    want = sorted(
        (a, b) for a, x, n in rows for b, y, m in rows
        if a < b and bin((x ^ y) & (1 << 64) - 1).count("1") <= 3 and min(n, m) >= max(n, m) - max(n, m) // 10
    )
    members = fuzzy_lines._buckets(nodes)
    once = fuzzy_lines._meeting(members, lambda a, b, bucket: fuzzy_lines._first_shared(a, b) == fuzzy_lines._choice(bucket))
    assert len(want) > 60 and sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in fuzzy_lines._meeting(fuzzy_lines._by_quarters(members)).distinct().collect()) == want


def test_block_pairs(spark, monkeypatch):
    """Blocks of large mixed buckets meet all pairs of different components whose values are near."""
    monkeypatch.setattr(common, "BLOCK", 7)
    rng = random.Random(23)
    rows = [(i, i % 2, 0 if rng.random() < 0.4 else i, rng.randint(0, 60)) for i in range(60)]
    members = spark.createDataFrame(rows, "node bigint, bucket bigint, component bigint, v int")
    near = lambda x, y: F.abs(x - y) <= 3
    pairs, many = common.cross_pairs(members, 1, 2, value="v", near=near)
    got = sorted(tuple(r) for r in common.block_pairs(many, "v", near).collect())
    want = sorted((a, b) for a, k, c, v in rows for b, m, d, w in rows if a < b and k == m and c != d and abs(v - w) <= 3)
    assert pairs.count() == 0 and len(want) > 50 and got == want


def test_lines_without_leftovers(spark):
    """Rows of buckets leave nothing behind, and checkpoints hold only lines that may have a near one."""
    rng = random.Random(24)
    docs = []
    for i in range(1500):
        words = [f"{rng.getrandbits(40):x}" for _ in range(9)]
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(words[::-1]))]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    folder = Path(shared_dir(spark).removeprefix("file://"))
    kept = lambda: sum(p.stat().st_size for p in folder.rglob("*") if p.is_file())
    before, folders = kept(), {p.name for p in folder.glob("lines-*")}
    assert fuzzy_lines.fuzzy_lines(df).filter(F.size("removed") > 0).count() == 0
    assert kept() - before < 1_500_000 and {p.name for p in folder.glob("lines-*")} == folders


# helpers ---------------------------------------------------------------------------------


def test_components(spark):
    rng = random.Random(16)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(i, i + 1) for i in range(400, 460)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    got = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: root(x) for x in linked}


def test_ranked(spark):
    got = ranked(spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v")).repartition(7), ["v"], "at").collect()
    assert [r["v"] for r in sorted(got, key=lambda r: r["at"])] == sorted(r["v"] for r in got)
    assert sorted(r["at"] for r in got) == list(range(1000))


def test_held_out_rule(spark):
    got = spark.range(50).select("id", (F.crc32(F.col("id").cast("string")) % 4 == 2).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)
