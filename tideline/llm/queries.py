"""Registered queries of the dealt operators; thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm import (
    centroids, chat, context_mixing, decontaminate, fuzzy_lines, language_id, mixing, near_copies, quality, sharding,
    suffix_dedup, url_filter, whitening,
)
from tideline.llm.common import table, word_count
from tideline.scale import cut

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    REGISTRY[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"), mixing.draw_of("doc_id", "text").alias("draw")
    )
    mixed = mixing.mix_sources(cut(mixing.numbered_draws(docs)))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")


@query
def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark").select("item_id", "text"))
    return leaks.drop("text_key")


#: Words in the names of hosts that the registered query lists as blocked.
LISTED_TERMS = "spam|casino|pills|adult|bets|ads"


@query
def op3_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.select(F.coalesce(url_filter.url_host(F.col("url")), F.lit("")).alias("key")).distinct()
    listed = listed.filter(F.col("key").rlike(rf"(^|[.-])({LISTED_TERMS})([.-]|$)"))
    return url_filter.filter_urls(pages, listed).select("page_id", "host", "path", "rule", "verdict", "listed")


@query
def op4_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (F.crc32(text_id) % 4 == 2).alias("held_out")
    )
    model = language_id.train(docs.filter(~F.col("held_out")).select("text", "lang"))
    return language_id.predict(docs.drop("lang"), model).select("doc_id", "held_out", "lang_pred", "score")


@query
def op5_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "doc_id", "lang", "source", sharding.text_bytes(F.col("text")).alias("size"), F.crc32(text).alias("text_crc32")
    )
    cut_ = sharding.cut_runs(cut(narrow), ["lang", "source", "size", "doc_id"], ["text_crc32"], sizes=["size"])
    return cut_.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


@query
def op6_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = fuzzy_lines.fuzzy_lines(docs)
    return judged.select("doc_id", "n_lines", F.size("removed").cast("bigint").alias("n_removed"), "removed")


@query
def op7_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).drop("starts", "ends")


@query
def op8_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    formatted = chat.format_conversations(chat.logged(rows.unionByName(probe)))
    told = chat.read_back(formatted)
    turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    learned = F.array_join("loss_texts", "")
    return told.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op9_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_copies.near_copies(docs).select("doc_id", "class_id", "copies", "kept")


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality.judge(cut(quality.measure(docs).drop("text"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op11_whiten_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return white.withColumn("deviation", F.col("deviation").cast("bigint"))


@query
def op12_mix_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.crc32(text_id) % 10 == 0).alias("held_out"), "text")
    return context_mixing.score_documents(docs)


@query
def op13_cluster_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = centroids.cluster_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    listed = F.array_join(F.transform("centroid", lambda v: v.cast("string")), ",")
    return clustered.select(
        "vec_id", "cluster", "distance", F.col("cluster_inertia").cast("bigint").alias("cluster_inertia"),
        F.col("inertia").cast("bigint").alias("inertia"), F.sha2(listed, 256).alias("centroid_sha256"),
    )



# SQL twins (DuckDB) of the queries that SQL can express.

_REST = "CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
_HOST = f"translate(regexp_extract(rest, '^[^/?#]*'), '{url_filter.UPPER}', '{url_filter.LOWER}')"

_OP3 = f"""
WITH cut_ AS (SELECT page_id, coalesce({_REST}, '') AS rest FROM pages),
split_ AS (SELECT page_id, {_HOST} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut_),
rules(verdict, name, prefix, rule) AS (VALUES ('block', 'net', '/', 'net/'), ('allow', 'example.net', '/en/', 'example.net/en/'),
  ('block', 'example.com', '/de/', 'example.com/de/'), ('allow', 'org', '/fr/', 'org/fr/')),
best AS (
  SELECT page_id, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS verdict
  FROM split_ s JOIN rules r ON (s.host = r.name OR ends_with(s.host, '.' || r.name)) AND starts_with(s.path, r.prefix)
  GROUP BY page_id)
SELECT s.page_id, s.host, s.path, b.rule,
  coalesce(b.verdict, CASE WHEN regexp_matches(s.host, '(^|[.-])({LISTED_TERMS})([.-]|$)') THEN 'block' ELSE 'allow' END) AS verdict,
  regexp_matches(s.host, '(^|[.-])({LISTED_TERMS})([.-]|$)') AS listed
FROM split_ s LEFT JOIN best b USING (page_id)"""


def _escaped(column: str) -> str:
    for plain, entity in chat.ENTITIES:
        column = f"replace({column}, '{plain}', '{entity}')"
    return column


_MARKS = len(chat.TURN) + len(chat.TEXT) + len(chat.END)
_OP8 = f"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({_MARKS} + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""

_BLANKS = r"[\x20\x09-\x0D]+"
_MEASURES = " UNION ALL ".join(
    f"SELECT doc_id, lang, source, '{m.name}' AS measure, {m.over} / CAST(greatest({m.under}, 1) AS DOUBLE) AS x, "
    f"{m.margin} AS margin FROM counted"
    for m in quality.MEASURES
)


def _quartiles(name: str, keys: str) -> str:
    """Lower and upper quartile of each group's sketch."""
    return f"""
{name}_c AS (SELECT {keys} measure, any_value(margin) AS margin, bucket, sum(n) AS n FROM sketch GROUP BY {keys} measure, bucket),
{name}_u AS (SELECT *, sum(n) OVER (PARTITION BY {keys} measure ORDER BY bucket NULLS FIRST) AS upto,
  sum(n) OVER (PARTITION BY {keys} measure) AS total,
  coalesce(2.0 * pow({quality.GAMMA}, bucket) / ({quality.GAMMA} + 1), 0) AS v FROM {name}_c),
{name} AS (SELECT {keys} measure, max(total) AS total, min(v) FILTER (4 * upto >= total) AS low,
  min(v) FILTER (4 * upto >= 3 * total) AS high FROM {name}_u GROUP BY {keys} measure)"""


_OP10 = f"""
WITH words AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_BLANKS}'), lambda w: w <> '') AS ws,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls
  FROM documents),
places AS (SELECT doc_id, unnest(range(1, len(ws) - 3)) AS i FROM words WHERE len(ws) >= 5),
windows AS (SELECT p.doc_id, p.i, count(*) OVER (PARTITION BY p.doc_id, list_slice(w.ws, p.i, p.i + 4)) AS n
  FROM places p JOIN words w USING (doc_id)),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, (VALUES (0), (1), (2), (3), (4)) o(k) WHERE n > 1 GROUP BY doc_id),
counted AS (
  SELECT w.doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
    len(ws) < {quality.MIN_WORDS} OR 100 * coalesce(c.n, 0) > {quality.MAX_REPEAT_PERCENT} * len(ws) AS base_failed
  FROM words w LEFT JOIN covered c USING (doc_id)),
measures AS ({_MEASURES}),
sketch AS (
  SELECT m.lang, m.source, measure, any_value(margin) AS margin,
    CASE WHEN x > 0 THEN CAST(ceil(ln(x) / ln({quality.GAMMA})) AS INTEGER) END AS bucket, count(*) AS n
  FROM measures m JOIN counted USING (doc_id) WHERE NOT base_failed GROUP BY ALL),
{_quartiles("own", "lang, source,")},
{_quartiles("by_lang", "lang,")},
{_quartiles("everything", "")},
around AS (
  SELECT l.lang, l.measure, (l.total * l.low + {quality.PRIOR} * e.low) / (l.total + {quality.PRIOR}) AS low,
    (l.total * l.high + {quality.PRIOR} * e.high) / (l.total + {quality.PRIOR}) AS high
  FROM by_lang l JOIN everything e ON e.measure = l.measure),
chosen AS (
  SELECT o.lang, o.source, o.measure, (o.total * o.low + {quality.PRIOR} * a.low) / (o.total + {quality.PRIOR}) AS low,
    (o.total * o.high + {quality.PRIOR} * a.high) / (o.total + {quality.PRIOR}) AS high
  FROM own o JOIN around a ON a.lang IS NOT DISTINCT FROM o.lang AND a.measure = o.measure),
outside AS (
  SELECT DISTINCT doc_id FROM measures m JOIN chosen c
    ON c.lang IS NOT DISTINCT FROM m.lang AND c.source IS NOT DISTINCT FROM m.source AND c.measure = m.measure
  WHERE x < low - greatest({quality.FENCE} * (high - low), margin) OR x > high + greatest({quality.FENCE} * (high - low), margin))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM outside) AS kept
FROM counted"""

ORACLES: dict[str, str] = {"op3_filter_urls": _OP3, "op8_format_chats": _OP8, "op10_quality_rules": _OP10}
