"""SQL twins of the registered queries, over the same given tables (DuckDB dialect)."""

from __future__ import annotations

from tideline.plans import views

NOW = "TIMESTAMP '2024-01-31 00:00:00'"
HALF = "TIMESTAMP '2024-01-16 00:00:00'"
BUCKETS = str(list(views.BUCKETS))


def _id(gen: str, bucket: str, no: str) -> str:
    return (
        f"'shardId-' || printf('%020d', CAST({views.FIRST_DAY_MS} + ({gen}) * {views.GENERATION_MS} AS BIGINT))"
        f" || '-' || printf('%08d', CAST({no} * 8 + {bucket} AS BIGINT))"
    )


def _log(name: str, stream_no: str) -> str:
    return f"""
{name}_g AS (
  SELECT *, {stream_no} AS stream_no,
         CAST(least(4, (day(ts) - 1) // 6) AS BIGINT) AS gen
  FROM events),
{name}_b AS (SELECT *, user_id % {BUCKETS}[gen + 1] AS bucket FROM {name}_g),
{name} AS (
  SELECT 's' || CAST(stream_no AS VARCHAR) AS stream, stream_no, gen, bucket,
         {_id('gen', 'bucket', 'stream_no')} AS shard_id,
         event_id + {views.SEQUENCE_OFFSET} AS seq,
         CAST(event_id + {views.SEQUENCE_OFFSET} AS VARCHAR) AS sequence_number,
         CASE WHEN event_type IN ('signup', 'purchase') THEN 'INSERT'
              WHEN event_type IN ('view', 'click') THEN 'MODIFY' ELSE 'REMOVE' END AS event_name,
         user_id AS key_id, ts AS arrival_ts,
         CASE WHEN event_type <> 'error' THEN event_type END AS new_event_type,
         CASE WHEN event_type <> 'error' THEN value END AS new_value,
         CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS new_k
  FROM {name}_b)"""


LOG = _log("log", f"user_id // {views.USERS_PER_STREAM}")
ONE_STREAM = _log("one", "CAST(0 AS BIGINT)")

# Catalog; shards_t, shards_o, shards_g, shards_n are its variants.
SHARDS = (
    LOG
    + f""",
generations AS (
  SELECT stream, stream_no, gen, min(seq) AS lo, max(seq) AS hi FROM log GROUP BY ALL),
buckets AS (SELECT *, unnest(range({BUCKETS}[gen + 1])) AS bucket FROM generations),
shards AS (
  SELECT stream, stream_no, gen, bucket, lo, hi, (lo + hi) // 2 AS middle,
         {_id('gen', 'bucket', 'stream_no')} AS shard_id,
         CASE WHEN gen IN (1, 4) THEN {_id('gen - 1', '(bucket % 2)', 'stream_no')}
              WHEN gen > 0 THEN {_id('gen - 1', 'bucket', 'stream_no')} END AS parent_shard_id,
         CASE WHEN gen = 3 THEN {_id('gen - 1', '(bucket + 2)', 'stream_no')} END AS adjacent_parent_shard_id,
         CAST(lo AS VARCHAR) AS starting_sequence_number,
         CASE WHEN gen < 4 THEN CAST(hi AS VARCHAR) END AS ending_sequence_number,
         '0' AS starting_hash_key,
         '340282366920938463463374607431768211455' AS ending_hash_key
  FROM buckets),
shards_t AS (SELECT * FROM shards WHERE gen > 0),
shards_o AS (SELECT * REPLACE (CASE WHEN gen <> 3 THEN ending_sequence_number END AS ending_sequence_number) FROM shards),
shards_g AS (SELECT * FROM shards WHERE gen < 4),
shards_n AS (SELECT * REPLACE (CASE WHEN gen = 4 AND bucket % 2 = 1 THEN '170141183460469231731687303715884105727'
                                    ELSE ending_hash_key END AS ending_hash_key) FROM shards)"""
)


def _edges(source: str, name: str = "edges") -> str:
    return f"""
{name} AS (
  SELECT DISTINCT c.stream, p.shard_id AS parent_id, c.shard_id AS child_id
  FROM {source} c JOIN {source} p
    ON c.stream = p.stream AND p.shard_id IN (c.parent_shard_id, c.adjacent_parent_shard_id))"""


def _pages(source: str, name: str = "pages", mixed: bool = False) -> str:
    rank = "[0, 2, 6, 10, 12][gen + 1] + bucket"
    if mixed:
        rank = f"CASE WHEN stream_no % 2 = 1 THEN 15 - ({rank}) ELSE {rank} END"
    return f"""
{name} AS (SELECT *, {rank} AS ord, ({rank}) // {views.PAGE} AS page_no FROM {source}),
{name}_graph AS (
  SELECT p.*, (SELECT max(c.ord) FROM {name} c
               WHERE c.stream = p.stream AND p.shard_id IN (c.parent_shard_id, c.adjacent_parent_shard_id)) AS child_ord
  FROM {name} p)"""


PARENTS = "concat_ws(',', parent_shard_id, adjacent_parent_shard_id)"


def _profile(profile: str, where: str, source: str) -> str:
    def rows(condition: str, checkpoint: str) -> str:
        return (
            f"SELECT stream, shard_id, {PARENTS} AS parents, {checkpoint} AS checkpoint "
            f"FROM {source} WHERE ({where}) AND ({condition})"
        )

    middle = "CAST(middle AS VARCHAR)"
    if profile == "mid":
        parts = [rows("gen = 1", "'SHARD_END'"), rows("gen = 2 AND bucket < 2", middle)]
    elif profile == "partial":
        parts = [rows("gen = 2 AND bucket = 0", middle)]
    else:
        parts = [
            rows("gen < 3 OR (gen = 3 AND bucket = 0)", "'SHARD_END'"),
            rows("gen = 3 AND bucket = 1", middle),
            f"SELECT stream, 'gone-' || n, 'gone-parent-' || n, 'SHARD_END' "
            f"FROM {source}, (VALUES ('1'), ('2')) v(n) WHERE ({where}) AND gen = 0 AND bucket = 0",
        ]
    return " UNION ALL ".join(parts)


def _mixed(source: str = "shards") -> str:
    parts = [
        _profile(p, f"stream_no % 4 = {i}", source)
        for i, p in ((1, "mid"), (2, "late"), (3, "partial"))
    ]
    return f"progress AS ({' UNION ALL '.join(parts)})"


READING = f"""
reading AS (
  SELECT stream, shard_id, {PARENTS} AS parents,
         CASE WHEN gen = 0 THEN 'SHARD_END' WHEN gen = 1 THEN 'TRIM_HORIZON'
              WHEN gen = 2 THEN CAST(middle AS VARCHAR) WHEN gen = 3 THEN 'AT_TIMESTAMP'
              WHEN bucket = 0 THEN 'LATEST' ELSE CAST(middle AS VARCHAR) END AS checkpoint
  FROM shards WHERE NOT (gen = 4 AND bucket = 3))"""


def _plan(position: str, source: str = "shards", torn: bool = False) -> str:
    """New progress rows ``plan`` from catalog ``source``, rows ``progress`` and ``position``."""
    not_torn = (
        f"""AND NOT EXISTS (SELECT 1 FROM edges e JOIN {source} p ON p.stream = e.stream
          AND p.shard_id = e.parent_id WHERE p.ending_sequence_number IS NULL
          AND e.stream = s.stream AND e.child_id = s.shard_id)"""
        if torn
        else ""
    )
    visited = f"""
seeds AS (
  SELECT stream, shard_id FROM {source} s WHERE ending_sequence_number IS NULL
    AND NOT EXISTS (SELECT 1 FROM progress l WHERE l.stream = s.stream AND l.shard_id = s.shard_id)
    {not_torn}),
visited AS (
  SELECT stream, shard_id, false AS tracked FROM seeds
  UNION
  SELECT e.stream, e.parent_id, EXISTS (SELECT 1 FROM progress l WHERE l.stream = e.stream AND l.shard_id = e.parent_id)
  FROM visited v JOIN edges e ON e.stream = v.stream AND e.child_id = v.shard_id
  WHERE NOT v.tracked)"""
    if position != "LATEST":
        plan = f"SELECT DISTINCT stream, shard_id, '{position}' AS checkpoint FROM visited WHERE NOT tracked"
        rest = ""
    else:
        rest = """,
reached AS (
  SELECT stream, shard_id FROM visited WHERE tracked
  UNION
  SELECT e.stream, e.child_id FROM reached r JOIN edges e ON e.stream = r.stream AND e.parent_id = r.shard_id
  JOIN visited v ON v.stream = e.stream AND v.shard_id = e.child_id AND NOT v.tracked),
due AS (
  SELECT DISTINCT v.stream, v.shard_id FROM visited v
  JOIN edges e ON e.stream = v.stream AND e.child_id = v.shard_id
  JOIN reached r ON r.stream = e.stream AND r.shard_id = e.parent_id
  WHERE NOT v.tracked),
wanted AS (
  SELECT stream, shard_id FROM seeds
  UNION
  SELECT e.stream, e.parent_id FROM due d JOIN edges e ON e.stream = d.stream AND e.child_id = d.shard_id
  WHERE NOT EXISTS (SELECT 1 FROM progress l WHERE l.stream = e.stream AND l.shard_id = e.parent_id))"""
        plan = """SELECT w.stream, w.shard_id,
          CASE WHEN r.shard_id IS NOT NULL THEN 'TRIM_HORIZON' ELSE 'LATEST' END AS checkpoint
          FROM wanted w LEFT JOIN reached r ON r.stream = w.stream AND r.shard_id = w.shard_id"""
    return f"""{visited}{rest},
plan AS (
  SELECT p.stream, p.shard_id, {PARENTS} AS parents, p.checkpoint
  FROM ({plan}) p JOIN {source} s ON s.stream = p.stream AND s.shard_id = p.shard_id)"""


FINISHED = f"""
finished AS (
  SELECT g.* FROM tested g
  WHERE g.checkpoint = 'SHARD_END'
    AND ({NOW} >= make_timestamp(CAST(TRY_CAST(split_part(g.shard_id, '-', 2) AS BIGINT) * 1000 AS BIGINT)) + INTERVAL 6 HOURS
         OR TRY_CAST(split_part(g.shard_id, '-', 2) AS BIGINT) IS NULL)
    AND EXISTS (SELECT 1 FROM edges e WHERE e.stream = g.stream AND e.parent_id = g.shard_id)
    AND NOT EXISTS (
      SELECT 1 FROM edges e LEFT JOIN tracked t ON t.stream = e.stream AND t.shard_id = e.child_id
      WHERE e.stream = g.stream AND e.parent_id = g.shard_id
        AND coalesce(t.checkpoint, '') <> 'SHARD_END'))"""

ORPHANS = """
orphans AS (
  SELECT * FROM tracked t
  WHERE NOT EXISTS (SELECT 1 FROM shards s WHERE s.stream = t.stream AND s.shard_id = t.shard_id))"""


def _with(*parts: str) -> str:
    ctes, select = parts[:-1], parts[-1]
    return "WITH RECURSIVE " + ",".join(ctes) + "\n" + select


def _latest(where: str = "true", source: str = "log") -> str:
    return f"""
    SELECT stream, key_id, x.new_event_type, x.new_value, x.new_k FROM (
      SELECT stream, key_id, arg_max({{'event_name': event_name, 'new_event_type': new_event_type,
        'new_value': new_value, 'new_k': new_k}}, seq) AS x
      FROM {source} WHERE {where} GROUP BY stream, key_id)
    WHERE x.event_name <> 'REMOVE'"""


SKEWED = LOG + f""",
skewed AS (
  SELECT * REPLACE (CASE WHEN seq % 10 > 0 THEN 's0' ELSE stream END AS stream,
                    CASE WHEN seq % 10 > 0 THEN {_id('0', '0', '0')} ELSE shard_id END AS shard_id,
                    CASE WHEN seq % 10 > 0 AND seq % 2 = 0 THEN 0 ELSE key_id END AS key_id)
  FROM log)"""

ROW = "SELECT stream, shard_id, parents, checkpoint, CAST(0 AS BIGINT) AS owner_switches FROM "
CATALOG = "stream, shard_id, parent_shard_id, adjacent_parent_shard_id, ending_sequence_number"
RECORD = "stream, shard_id, sequence_number"

MATERIALIZED = _with(LOG, _latest())
UNTIL = "seq <= 104500"

#: Generations from which an open shard descends: none is missing from there on.
_TRACKED = """
tracked AS (SELECT g.stream, g.gen FROM generations g JOIN generations h ON h.stream = g.stream AND h.gen >= g.gen
  GROUP BY ALL HAVING count(*) = 5 - g.gen)"""

_POSITIONED = """
  SELECT l.stream, l.shard_id, l.sequence_number, l.arrival_ts, l.event_name
  FROM log l JOIN reading r ON r.stream = l.stream AND r.shard_id = l.shard_id
  WHERE r.checkpoint = 'TRIM_HORIZON'
     OR (r.checkpoint = 'AT_TIMESTAMP' AND l.arrival_ts >= {half})
     OR l.seq {op} TRY_CAST(r.checkpoint AS BIGINT)"""


def _positioned(op: str = ">") -> str:
    return _POSITIONED.format(half=HALF, op=op)


# What a stored log held when half of it was written and its first week was gone.
_HELD = f"""
held AS (
  SELECT stream, shard_id, min(seq) AS oldest, max(seq) AS newest FROM log
  WHERE arrival_ts < {HALF} AND arrival_ts >= {NOW} - INTERVAL 576 HOURS GROUP BY ALL)"""


def _started(where: str) -> str:
    """Records of a stream after start positions resolved against ``held``."""
    return f"""
  SELECT l.stream, l.shard_id, l.sequence_number, l.event_name
  FROM log l LEFT JOIN reading r ON r.stream = l.stream AND r.shard_id = l.shard_id
  LEFT JOIN held h ON h.stream = l.stream AND h.shard_id = l.shard_id
  WHERE {where} AND (r.shard_id IS NULL OR r.checkpoint = 'TRIM_HORIZON'
     OR (r.checkpoint = 'AT_TIMESTAMP' AND l.arrival_ts >= {HALF})
     OR (r.checkpoint = 'LATEST' AND (h.newest IS NULL OR l.seq > h.newest))
     OR (TRY_CAST(r.checkpoint AS BIGINT) < h.oldest)
     OR l.seq > TRY_CAST(r.checkpoint AS BIGINT))"""


def _decoded(columns: str) -> str:
    return _with(LOG, f"SELECT {columns} FROM log")


# Number, API, error, matched by code, policy, reported error, action.
_RULES = """
  (1, 'DescribeStream', 'InternalServerError', false, 'any', 'ServiceError', 'translate'),
  (2, 'DescribeStream', 'ResourceNotFound', false, 'any', 'ResourceNotFound', 'translate'),
  (3, 'DescribeStream', 'ThrottlingException', true, 'any', 'LimitExceeded', 'translate'),
  (4, 'GetRecords', 'ExpiredIterator', false, 'any', 'ExpiredIterator', 'translate'),
  (5, 'GetRecords', 'InternalServerError', false, 'any', 'ServiceError', 'translate'),
  (6, 'GetRecords', 'LimitExceeded', false, 'any', 'ProvisionedThroughputExceeded', 'translate'),
  (7, 'GetRecords', 'ResourceNotFound', false, 'any', 'ResourceNotFound', 'translate'),
  (8, 'GetRecords', 'ThrottlingException', true, 'any', 'ProvisionedThroughputExceeded', 'translate'),
  (9, 'GetRecords', 'TrimmedDataAccess', false, 'skip', 'ExpiredIterator', 'translate'),
  (10, 'GetRecords', 'TrimmedDataAccess', false, 'retry', 'UnableToReadMoreRecords', 'stop'),
  (11, 'GetShardIterator', 'InternalServerError', false, 'any', 'ServiceError', 'translate'),
  (12, 'GetShardIterator', 'ResourceNotFound', false, 'skip', 'ResourceNotFound', 'translate'),
  (13, 'GetShardIterator', 'ResourceNotFound', false, 'retry', 'UnableToReadMoreRecords', 'stop'),
  (14, 'GetShardIterator', 'ThrottlingException', true, 'any', 'ProvisionedThroughputExceeded', 'translate'),
  (15, 'GetShardIterator', 'TrimmedDataAccess', false, 'skip', NULL, 'reread_from_trim_horizon'),
  (16, 'GetShardIterator', 'TrimmedDataAccess', false, 'retry', 'UnableToReadMoreRecords', 'stop'),
  (17, 'ListStreams', 'InternalServerError', false, 'any', 'ServiceError', 'translate'),
  (18, 'ListStreams', 'ResourceNotFound', false, 'any', 'ServiceError', 'translate'),
  (19, 'ListStreams', 'ThrottlingException', true, 'any', 'LimitExceeded', 'translate')"""


def _errors(policy: str) -> str:
    kinds = "['" + "', '".join(views.ERRORS) + "']"
    apis = "['" + "', '".join(views.APIS) + "']"
    again = "r.action = 'reread_from_trim_horizon' AND e.iterator_type = 'TRIM_HORIZON'"
    return f"""
WITH raw AS (SELECT *, {kinds}[(event_id // 5) % 7 + 1] AS kind FROM events),
errors AS (
  SELECT 'req-' || event_id AS request_id, {apis}[event_id % 5 + 1] AS api,
         CASE WHEN kind = 'Throttled' THEN 'ClientError' ELSE kind END AS error_type,
         CASE WHEN kind = 'Throttled' THEN 'ThrottlingException' ELSE kind || 'Exception' END AS error_code,
         CASE WHEN event_type <> 'view' THEN event_type ELSE '' END AS message,
         CAST(CASE WHEN kind = 'InternalServerError' THEN 500 ELSE 400 END AS INTEGER) AS status,
         CASE WHEN (event_id // 35) % 2 = 0 THEN 'TRIM_HORIZON' ELSE 'AFTER_SEQUENCE_NUMBER' END AS iterator_type
  FROM raw),
every_rule(no, api, error, by_code, policy, target, action) AS (VALUES {_RULES}),
rules AS (SELECT * FROM every_rule WHERE policy IN ('any', '{policy}'))
SELECT e.*,
       CASE WHEN {again} THEN 'ResourceNotFound' WHEN r.no IS NULL THEN e.error_type ELSE r.target END AS target_error,
       CASE WHEN {again} THEN 'translate' ELSE coalesce(r.action, 'pass_through') END AS action
FROM errors e LEFT JOIN rules r
  ON r.api = e.api AND r.error = CASE WHEN r.by_code THEN e.error_code ELSE e.error_type END"""


_SYNC = (
    SHARDS,
    _edges("shards"),
    _mixed(),
    _plan("LATEST"),
    "tracked AS (SELECT * FROM progress UNION ALL SELECT * FROM plan)",
    ORPHANS,
    "tested AS (SELECT * FROM progress)",
    FINISHED,
)


def _violations() -> str:
    torn = """
    torn AS (SELECT * REPLACE (CASE WHEN NOT (gen = 1 AND bucket = 1) THEN ending_sequence_number END AS ending_sequence_number)
             FROM shards_n WHERE NOT (gen = 4 AND bucket % 2 = 0)),
    cover AS (SELECT e.stream, e.parent_id AS shard_id, min(CAST(c.starting_hash_key AS UHUGEINT)) AS low,
                     max(CAST(c.ending_hash_key AS UHUGEINT)) AS high
              FROM edges e JOIN torn c ON c.stream = e.stream AND c.shard_id = e.child_id GROUP BY ALL)"""
    edges = _edges("torn")
    head, cover = torn.split("cover AS", 1)
    return _with(
        SHARDS,
        head.rstrip().rstrip(","),
        edges,
        " cover AS" + cover,
        """
    SELECT * FROM (
      SELECT s.stream, s.shard_id,
        CASE WHEN s.ending_sequence_number IS NULL THEN 'not_closed'
             WHEN c.shard_id IS NULL THEN 'no_children'
             WHEN c.low > CAST(s.starting_hash_key AS UHUGEINT) OR c.high < CAST(s.ending_hash_key AS UHUGEINT)
             THEN 'hash_range_not_covered' END AS violation
      FROM torn s LEFT JOIN cover c ON c.stream = s.stream AND c.shard_id = s.shard_id
      WHERE s.gen <= 3)
    WHERE violation IS NOT NULL""",
    )


def _repair(first: bool) -> str:
    pick = "QUALIFY row_number() OVER (PARTITION BY stream, parent_id ORDER BY ord) = 1" if first else ""
    return _with(
        SHARDS,
        _pages("shards", "refresh"),
        f"""listed AS (SELECT *, unnest([parent_shard_id, adjacent_parent_shard_id]) AS parent_id FROM refresh),
        candidates AS (SELECT * FROM listed WHERE parent_id IS NOT NULL {pick})""",
        """
    added AS (
      SELECT c.stream, c.shard_id FROM candidates c JOIN shards p
        ON p.stream = c.stream AND p.shard_id = c.parent_id WHERE p.gen = 2
      UNION
      SELECT c.stream, c.shard_id FROM candidates c JOIN added a
        ON a.stream = c.stream AND a.shard_id = c.parent_id)""",
        f"""
    SELECT {CATALOG} FROM shards s
    WHERE gen < 3 OR EXISTS (SELECT 1 FROM added a WHERE a.stream = s.stream AND a.shard_id = s.shard_id)""",
    )


_TAGS = {
    "key_id": "N",
    "event_type": "S",
    "value": "N",
    "raw": "B",
    "large": "BOOL",
    "nothing": "NULL",
    "tags": "SS",
    "numbers": "NS",
    "blobs": "BS",
    "detail": "M",
    "parts": "L",
}

_OPEN = "ending_sequence_number IS NULL"
_NO_CHILD = """NOT EXISTS (SELECT 1 FROM {t} c WHERE c.stream = s.stream
          AND s.shard_id IN (c.parent_shard_id, c.adjacent_parent_shard_id))"""
_STATUS = "['ACTIVE', 'CREATING', 'ACTIVE', 'ACTIVE', 'ACTIVE'][stream_no % 5 + 1]"
_HEADS = "FROM shards WHERE gen = 0 AND bucket = 0"

ORACLES: dict[str, str] = {
    # replay
    "materialize_table": MATERIALIZED,
    "materialize_until": _with(LOG, _latest(UNTIL)),
    "materialize_onto_base": MATERIALIZED,
    "compare_tables": _with(
        LOG,
        f"older AS ({_latest(UNTIL)}), newer AS ({_latest()})",
        """SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM older EXCEPT SELECT * FROM newer)
        UNION ALL
        SELECT *, 'right' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM newer EXCEPT SELECT * FROM older)""",
    ),
    "dedupe_replayed": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "replay_order": _with(
        SHARDS,
        """SELECT stream, shard_id, sequence_number, event_name, CAST(nullif(gen, 0) - 1 AS INTEGER) AS depth,
        row_number() OVER (PARTITION BY stream ORDER BY gen, shard_id, seq) - 1 AS place FROM log""",
    ),
    "materialize_skewed": _with(SKEWED, _latest(source="skewed")),
    "limit_skewed": _with(
        SKEWED,
        f"""SELECT {RECORD} FROM skewed QUALIFY row_number() OVER
        (PARTITION BY stream, shard_id ORDER BY seq) <= 5000""",
    ),
    "lookup_item": _with(LOG, _latest("stream = 's0' AND key_id = 7")),
    # records
    "decode_records": _decoded(
        """'ev-' || sequence_number AS event_id, event_name, '1.1' AS event_version, sequence_number,
        CAST(64 AS BIGINT) AS size_bytes, 'NEW_IMAGE' AS stream_view_type, arrival_ts AS created,
        CAST(CASE WHEN new_value IS NULL THEN 0 ELSE 11 END AS BIGINT) AS attributes,
        true AS no_old_image, true AS valid"""
    ),
    "decode_odd_payloads": _with(
        LOG,
        "valid AS (SELECT *, seq % 50 NOT IN (1, 2, 3, 4) AS valid FROM log)",
        """SELECT sequence_number AS number, CASE WHEN valid THEN 'ev-' || sequence_number END AS event_id,
        CASE WHEN valid THEN event_name END AS event_name, CASE WHEN valid THEN sequence_number END AS sequence_number,
        CASE WHEN valid THEN new_value END AS new_value, valid FROM valid""",
    ),
    "decode_stored": _decoded("'ev-' || sequence_number AS event_id, event_name, sequence_number"),
    "attribute_values": _decoded(
        """sequence_number, new_event_type AS s, new_value AS n, new_event_type AS b,
        CASE WHEN new_value IS NOT NULL THEN true END AS is_null, new_value > 20 AS flag,
        CASE WHEN new_event_type IS NOT NULL THEN array_to_string(list_sort(['tag', new_event_type]), ',') END AS ss,
        CAST(new_k AS VARCHAR) AS ns, new_event_type AS bs,
        CAST(CASE WHEN new_value IS NOT NULL THEN 1 END AS BIGINT) AS m_size,
        CAST(CASE WHEN new_value IS NOT NULL THEN 2 END AS BIGINT) AS l_size,
        new_value IS NOT NULL AS has_nothing, false AS has_absent"""
    ),
    "encode_attribute_types": _decoded(
        """sequence_number, new_event_type AS s, new_value AS n, new_event_type AS b,
        CASE WHEN new_value IS NOT NULL THEN true END AS is_null, new_value > 20 AS flag,
        CASE WHEN new_event_type IS NOT NULL THEN array_to_string(list_sort(['tag', new_event_type]), ',') END AS ss,
        CAST(new_k AS VARCHAR) AS ns, new_event_type AS bs, new_k AS m_number, new_event_type AS l_first,
        new_k AS l_second, CAST(CASE WHEN new_value IS NOT NULL THEN 10 ELSE 0 END AS BIGINT) AS attributes"""
    ),
    "flatten_image": _decoded(
        """sequence_number, event_name, new_event_type, new_value, new_k,
        new_event_type AS first_part, new_k AS second_part"""
    ),
    "discover_attributes": _with(
        LOG,
        "SELECT name, type, count(*) AS n FROM log, (VALUES "
        + ", ".join(f"('{a}', '{t}')" for a, t in _TAGS.items())
        + ") v(name, type) WHERE new_value IS NOT NULL GROUP BY ALL",
    ),
    "encode_roundtrip": _decoded(
        f"""{RECORD}, 'ev-' || sequence_number AS event_id, event_name, key_id AS size_bytes,
        arrival_ts AS created, key_id, new_event_type, new_value, new_event_type AS raw,
        new_value > 20 AS large"""
    ),
    "delivered_record": _decoded(
        f"{RECORD}, event_name, CAST(NULL AS VARCHAR) AS partition_key, arrival_ts"
    ),
    "delivered_without_bytes": _decoded(f"{RECORD}, CAST(0 AS BIGINT) AS bytes"),
    "operation_kind": _with(
        LOG,
        """SELECT stream, CASE WHEN event_name = 'REMOVE' THEN 'delete' ELSE 'upsert' END AS kind,
        count(*) AS n FROM log GROUP BY ALL""",
    ),
    # lineage
    "catalog_assemble": _with(SHARDS, f"SELECT {CATALOG} FROM shards"),
    "collect_all_pages": _with(SHARDS, f"SELECT {CATALOG} FROM shards WHERE stream = 's1'"),
    "shard_edges": _with(SHARDS, _edges("shards_t"), "SELECT * FROM edges"),
    "child_sets": _with(
        SHARDS,
        _edges("shards"),
        """SELECT stream, parent_id AS shard_id, string_agg(child_id, ',' ORDER BY child_id) AS children
        FROM edges GROUP BY ALL""",
    ),
    "children_hash_cover": _with(
        SHARDS,
        _edges("shards_n"),
        """SELECT e.stream, e.parent_id AS shard_id, count(*) AS children,
        CAST(max(CAST(c.ending_hash_key AS UHUGEINT)) AS VARCHAR) AS max_ending_hash_key
        FROM edges e JOIN shards_n c ON c.stream = e.stream AND c.shard_id = e.child_id GROUP BY ALL""",
    ),
    "leaf_shards": _with(
        SHARDS, f"SELECT stream, shard_id FROM shards s WHERE {_NO_CHILD.format(t='shards')}"
    ),
    "open_shards": _with(SHARDS, f"SELECT stream, shard_id FROM shards WHERE {_OPEN}"),
    "lookup_shard": _with(
        SHARDS,
        f"""SELECT {CATALOG} FROM shards
        WHERE stream = 's0' AND shard_id = 'shardId-00000001704585600000-00000001'""",
    ),
    "lineage_depth": _with(
        SHARDS,
        _edges("shards"),
        """
    chain AS (
      SELECT stream, shard_id, 0 AS depth FROM shards s
      WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.stream = s.stream AND e.child_id = s.shard_id)
      UNION
      SELECT e.stream, e.child_id, c.depth + 1 FROM chain c JOIN edges e
        ON e.stream = c.stream AND e.parent_id = c.shard_id)""",
        "SELECT stream, shard_id, CAST(max(depth) AS BIGINT) AS depth FROM chain GROUP BY ALL",
    ),
    "normalize_shards": _with(
        SHARDS,
        """SELECT stream, shard_id, parent_shard_id, CAST(NULL AS VARCHAR) AS adjacent_parent_shard_id,
        starting_sequence_number, ending_sequence_number, starting_hash_key, ending_hash_key FROM shards""",
    ),
    "creation_time": _with(
        SHARDS,
        "SELECT stream, shard_id, TIMESTAMP '2024-01-01' + INTERVAL 6 DAYS * gen AS created FROM shards",
    ),
    "last_fetched": _with(
        SHARDS,
        _pages("shards", mixed=True),
        "SELECT stream, arg_max(shard_id, ord) AS shard_id FROM pages GROUP BY ALL",
    ),
    "graph_stats": _with(
        SHARDS,
        _pages("shards_g", mixed=True),
        """SELECT stream, count(*) AS shard_count,
        count(*) FILTER (ending_sequence_number IS NOT NULL AND NOT coalesce(child_ord > ord, false)) AS closed_leaf_count
        FROM pages_graph GROUP BY ALL""",
    ),
    "earliest_closed_leaf": _with(
        SHARDS,
        _pages("shards_g", mixed=True),
        """SELECT stream, min(shard_id) AS shard_id FROM pages_graph
        WHERE ending_sequence_number IS NOT NULL AND NOT coalesce(child_ord > ord, false) GROUP BY ALL""",
    ),
    "close_open_parents": _with(
        SHARDS,
        _pages("shards_o", mixed=True),
        """SELECT stream, shard_id, parent_shard_id, adjacent_parent_shard_id,
        CASE WHEN child_ord > ord THEN coalesce(ending_sequence_number, '9223372036854775807')
             ELSE ending_sequence_number END AS ending_sequence_number FROM pages_graph""",
    ),
    "close_open_parents_any_order": _with(
        SHARDS,
        _pages("shards_o", mixed=True),
        """SELECT stream, shard_id, parent_shard_id, adjacent_parent_shard_id,
        CASE WHEN child_ord IS NOT NULL THEN coalesce(ending_sequence_number, '9223372036854775807')
             ELSE ending_sequence_number END AS ending_sequence_number FROM pages_graph""",
    ),
    "closed_leaves": _with(
        SHARDS,
        _pages("shards_g", mixed=True),
        f"""SELECT {CATALOG} FROM pages_graph
        WHERE ending_sequence_number IS NOT NULL AND NOT coalesce(child_ord > ord, false)""",
    ),
    "extend_closed_leaves": _repair(first=False),
    "extend_closed_leaves_first": _repair(first=True),
    "reopen_leaves": _with(
        SHARDS,
        f"""SELECT stream, shard_id, parent_shard_id, adjacent_parent_shard_id,
        CAST(NULL AS VARCHAR) AS ending_sequence_number FROM shards_g s
        WHERE {_NO_CHILD.format(t='shards_g')}""",
    ),
    "reopen_leaves_keep_ancestors": _with(
        SHARDS,
        f"""SELECT stream, shard_id, parent_shard_id, adjacent_parent_shard_id,
        CASE WHEN NOT ({_NO_CHILD.format(t='shards_g')}) THEN ending_sequence_number END AS ending_sequence_number
        FROM shards_g s""",
    ),
    "inconsistent_shards": _with(
        SHARDS,
        _edges("shards_o"),
        """SELECT DISTINCT e.stream, e.child_id AS shard_id FROM edges e JOIN shards_o p
        ON p.stream = e.stream AND p.shard_id = e.parent_id WHERE p.ending_sequence_number IS NULL""",
    ),
    "closed_shard_violations": _violations(),
    # positioned reads
    "read_trim_horizon": _with(LOG, f"SELECT {RECORD} FROM log"),
    "read_latest": _with(
        LOG,
        f"""half AS (SELECT stream, shard_id, max(seq) AS newest FROM log WHERE arrival_ts < {HALF} GROUP BY ALL)""",
        """SELECT l.stream, l.shard_id, l.sequence_number FROM log l
        JOIN half h ON h.stream = l.stream AND h.shard_id = l.shard_id WHERE l.seq > h.newest""",
    ),
    "read_at_timestamp": _with(LOG, f"SELECT {RECORD} FROM log WHERE arrival_ts >= {HALF}"),
    "read_at_sequence": _with(LOG, f"SELECT {RECORD} FROM log WHERE seq >= 100000"),
    "read_after_sequence": _with(LOG, f"SELECT {RECORD} FROM log WHERE seq > 100000"),
    "read_after_checkpoint": _with(
        SHARDS, READING, f"SELECT {RECORD}, arrival_ts FROM ({_positioned()})"
    ),
    "read_at_checkpoint": _with(
        SHARDS, READING, f"SELECT {RECORD}, arrival_ts FROM ({_positioned('>=')})"
    ),
    "read_stored_log": _with(
        SHARDS,
        READING,
        f"""SELECT {RECORD}, event_name FROM ({_positioned()}) QUALIFY row_number() OVER
        (PARTITION BY stream, shard_id ORDER BY CAST(sequence_number AS BIGINT)) <= 50""",
    ),
    "read_stored_log_at_timestamp": _with(
        LOG, f"SELECT {RECORD}, arrival_ts FROM log WHERE arrival_ts >= {HALF}"
    ),
    "limit_per_shard": _with(
        LOG,
        f"""SELECT {RECORD} FROM log QUALIFY row_number() OVER
        (PARTITION BY stream, shard_id ORDER BY seq) <= 25""",
    ),
    "limit_per_shard_clamped": _with(
        ONE_STREAM,
        f"""SELECT {RECORD} FROM one QUALIFY row_number() OVER
        (PARTITION BY stream, shard_id ORDER BY seq) <= 1000""",
    ),
    "limit_per_shard_large": _with(
        ONE_STREAM,
        f"""SELECT {RECORD} FROM one QUALIFY row_number() OVER
        (PARTITION BY stream, shard_id ORDER BY seq) <= 5000""",
    ),
    "read_stored_after_sequence": _with(LOG, f"SELECT {RECORD} FROM log WHERE seq > 100000"),
    "retention_stored": _with(
        LOG, f"SELECT {RECORD}, arrival_ts FROM log WHERE arrival_ts >= {NOW} - INTERVAL 48 HOURS"
    ),
    "retention_filter": _with(
        LOG, f"SELECT {RECORD}, arrival_ts FROM log WHERE arrival_ts >= {NOW} - INTERVAL 48 HOURS"
    ),
    "oldest_retained": _with(
        LOG,
        f"""SELECT stream, shard_id, CAST(min(seq) AS VARCHAR) AS oldest_retained FROM log
        WHERE arrival_ts >= {NOW} - INTERVAL 384 HOURS GROUP BY ALL""",
    ),
    "trim_gaps": _with(
        SHARDS,
        READING,
        f"""SELECT r.stream, r.shard_id, r.checkpoint, CAST(o.n AS VARCHAR) AS oldest_retained
        FROM reading r JOIN (SELECT stream, shard_id, min(seq) AS n FROM log
          WHERE arrival_ts >= {NOW} - INTERVAL 384 HOURS GROUP BY ALL) o
        ON o.stream = r.stream AND o.shard_id = r.shard_id WHERE TRY_CAST(r.checkpoint AS BIGINT) < o.n""",
    ),
    "trim_skip": _with(
        SHARDS,
        READING,
        f"""SELECT r.stream, r.shard_id, r.parents,
        CASE WHEN TRY_CAST(r.checkpoint AS BIGINT) < o.n THEN 'TRIM_HORIZON' ELSE r.checkpoint END AS checkpoint,
        CAST(0 AS BIGINT) AS owner_switches
        FROM reading r LEFT JOIN (SELECT stream, shard_id, min(seq) AS n FROM log
          WHERE arrival_ts >= {NOW} - INTERVAL 384 HOURS GROUP BY ALL) o
        ON o.stream = r.stream AND o.shard_id = r.shard_id""",
    ),
    # progress
    "plan_new_progress_latest": _with(
        SHARDS, _edges("shards"), _mixed(), _plan("LATEST"), ROW + "plan"
    ),
    "plan_new_progress_trim": _with(
        SHARDS, _edges("shards"), _mixed(), _plan("TRIM_HORIZON"), ROW + "plan"
    ),
    "plan_new_progress_timestamp": _with(
        SHARDS, _edges("shards"), _mixed(), _plan("AT_TIMESTAMP"), ROW + "plan"
    ),
    "plan_new_progress_torn": _with(
        SHARDS,
        _edges("shards_o"),
        _mixed("shards_o"),
        _plan("TRIM_HORIZON", "shards_o", torn=True),
        ROW + "plan",
    ),
    "order_progress_rows": _with(
        SHARDS,
        _mixed(),
        """SELECT p.stream, p.shard_id, p.parents, p.checkpoint, CAST(0 AS BIGINT) AS owner_switches,
        row_number() OVER (ORDER BY s.lo NULLS LAST, p.shard_id, p.stream) - 1 AS place
        FROM progress p LEFT JOIN shards s ON s.stream = p.stream AND s.shard_id = p.shard_id""",
    ),
    "garbage_progress": _with(
        SHARDS, _mixed(), "tracked AS (SELECT * FROM progress)", ORPHANS, ROW + "orphans"
    ),
    "finished_progress": _with(
        SHARDS,
        _edges("shards"),
        _mixed(),
        "tracked AS (SELECT * FROM progress), tested AS (SELECT * FROM progress)",
        FINISHED,
        ROW + "finished",
    ),
    "processable_shards": _with(
        SHARDS,
        _edges("shards"),
        _mixed(),
        _plan("TRIM_HORIZON"),
        """tracked AS (SELECT * FROM progress UNION ALL SELECT * FROM plan),
        unfinished AS (SELECT * FROM tracked WHERE checkpoint <> 'SHARD_END')""",
        """SELECT u.stream, u.shard_id, u.checkpoint FROM unfinished u
        WHERE EXISTS (SELECT 1 FROM shards s WHERE s.stream = u.stream AND s.shard_id = u.shard_id)
          AND NOT EXISTS (SELECT 1 FROM edges e JOIN unfinished p ON p.stream = e.stream AND p.shard_id = e.parent_id
            WHERE e.stream = u.stream AND e.child_id = u.shard_id)""",
    ),
    "next_progress": _with(
        SHARDS,
        _edges("shards"),
        f"""late AS ({_profile('late', 'true', 'shards')}), tracked AS (SELECT * FROM late),
        tested AS (SELECT * FROM late), partial AS ({_profile('partial', 'true', 'shards')})""",
        FINISHED,
        """combined AS (SELECT * FROM partial UNION ALL SELECT * FROM late l WHERE NOT EXISTS
          (SELECT 1 FROM partial p WHERE p.stream = l.stream AND p.shard_id = l.shard_id)),
        remaining AS (SELECT * FROM combined c WHERE NOT EXISTS
          (SELECT 1 FROM finished f WHERE f.stream = c.stream AND f.shard_id = c.shard_id))""",
        ROW + "remaining",
    ),
    "sync_progress": _with(
        *_SYNC,
        """remaining AS (SELECT * FROM tracked t
          WHERE NOT EXISTS (SELECT 1 FROM orphans o WHERE o.stream = t.stream AND o.shard_id = t.shard_id)
            AND NOT EXISTS (SELECT 1 FROM finished f WHERE f.stream = t.stream AND f.shard_id = t.shard_id))""",
        ROW + "remaining",
    ),
    "sync_audit": _with(
        *_SYNC,
        """SELECT 'create' AS action, stream, shard_id, checkpoint FROM plan
        UNION ALL SELECT 'delete_orphan', stream, shard_id, checkpoint FROM orphans
        UNION ALL SELECT 'delete_finished', stream, shard_id, checkpoint FROM finished""",
    ),
    "stored_progress": _with(
        SHARDS,
        f"""late AS ({_profile('late', 'true', 'shards')}), partial AS ({_profile('partial', 'true', 'shards')}),
        combined AS (SELECT * FROM partial UNION ALL SELECT * FROM late l WHERE NOT EXISTS
          (SELECT 1 FROM partial p WHERE p.stream = l.stream AND p.shard_id = l.shard_id))""",
        ROW + "combined",
    ),
    "progress_checkpoints": _with(
        LOG,
        """SELECT stream, shard_id, CAST(max(seq) AS VARCHAR) AS checkpoint FROM (
          SELECT *, row_number() OVER (PARTITION BY stream, shard_id ORDER BY seq) AS n FROM log)
        WHERE n % 10 = 0 GROUP BY ALL""",
    ),
    "unprocessed_counts": _with(
        SHARDS,
        READING,
        f"SELECT stream, shard_id, count(*) AS records FROM ({_positioned()}) GROUP BY ALL",
    ),
    "detect_shard_end": _with(
        SHARDS,
        f"""SELECT s.stream, s.shard_id, {PARENTS} AS parents,
        CASE WHEN s.ending_sequence_number IS NOT NULL AND r.half_seq = r.seq THEN 'SHARD_END'
             ELSE CAST(r.half_seq AS VARCHAR) END AS checkpoint,
        CAST(0 AS BIGINT) AS owner_switches
        FROM shards s JOIN (SELECT stream, shard_id, max(seq) FILTER (arrival_ts < {HALF}) AS half_seq,
          max(seq) AS seq FROM log GROUP BY ALL) r ON r.stream = s.stream AND r.shard_id = s.shard_id
        WHERE r.half_seq IS NOT NULL""",
    ),
    # streams, metrics, errors
    "stream_status": _with(
        SHARDS,
        f"SELECT * FROM (SELECT stream AS arn, {_STATUS} AS status {_HEADS}) WHERE status = 'ACTIVE'",
    ),
    "list_streams": _with(
        SHARDS,
        f"""after AS (SELECT stream AS stream_name {_HEADS} AND stream > 's0')""",
        """SELECT stream_name, (SELECT count(*) > 3 FROM after) AS has_more FROM after
        ORDER BY stream_name LIMIT 3""",
    ),
    "describe_stream": _with(
        SHARDS,
        """after AS (SELECT * FROM shards WHERE stream = 's1' AND shard_id > 'shardId-00000001704585600000-00000009')""",
        f"""SELECT stream AS stream_name, {_STATUS} AS stream_status, shard_id, parent_shard_id,
        (SELECT count(*) > 5 FROM after) AS has_more FROM after ORDER BY shard_id LIMIT 5""",
    ),
    "describe_disabled_stream": _with(
        SHARDS,
        f"""SELECT stream AS stream_name, 'ACTIVE' AS stream_status, shard_id,
        CASE WHEN NOT ({_NO_CHILD.format(t='shards_g')}) THEN ending_sequence_number END AS ending_sequence_number,
        false AS has_more FROM shards_g s WHERE stream = 's2'""",
    ),
    "summarize_streams": _with(
        SHARDS,
        f"""SELECT stream AS stream_name, stream AS stream_arn, any_value({_STATUS}) AS stream_status,
        TIMESTAMP '2024-01-01' AS creation_ts, 'PROVISIONED' AS stream_mode, 'NONE' AS encryption_type,
        CAST(24 AS BIGINT) AS retention_hours, count(*) AS open_shard_count,
        count(*) FILTER ({_OPEN}) AS open_shards, CAST(0 AS BIGINT) AS consumer_count
        FROM shards GROUP BY stream HAVING count(*) FILTER (gen = 0 AND bucket = 0) > 0""",
    ),
    "lag_by_shard": _with(
        LOG,
        f"""SELECT stream, shard_id, greatest(epoch_us({NOW}) // 1000 - epoch_us(arg_max(arrival_ts, seq)) // 1000, 0) AS behind_ms
        FROM log GROUP BY ALL""",
    ),
    "throughput_by_shard": _with(
        LOG,
        """SELECT stream, shard_id, time_bucket(INTERVAL 6 HOURS, arrival_ts, TIMESTAMP '2024-01-01') AS window_start,
        count(*) AS records, CAST(sum(length(sequence_number)) AS BIGINT) AS bytes FROM log GROUP BY ALL""",
    ),
    "classify_api_errors_skip": _errors("skip"),
    "classify_api_errors_retry": _errors("retry"),
    # streaming
    "stream_materialize": MATERIALIZED,
    "stream_resume": MATERIALIZED,
    "stream_latest": _with(LOG, f"SELECT {RECORD}, event_name FROM log WHERE arrival_ts >= {HALF}"),
    "stream_stateful_latest": MATERIALIZED,
    "stream_dedupe": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "stream_drain": _with(
        SHARDS,
        f"""SELECT l.stream, l.shard_id, l.sequence_number, l.event_name FROM log l JOIN shards_g s
        ON s.stream = l.stream AND s.shard_id = l.shard_id""",
    ),
    "stream_dedupe_bounded": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "stream_limited": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "stream_from_progress": _with(SHARDS, READING, _HELD, f"SELECT {RECORD}, event_name FROM ({_started('true')})"),
    "stream_trim_skip": _with(
        SHARDS,
        READING,
        _HELD,
        """SELECT r.stream, r.shard_id, r.checkpoint, CAST(h.oldest AS VARCHAR) AS oldest_retained
        FROM reading r JOIN held h ON h.stream = r.stream AND h.shard_id = r.shard_id
        WHERE TRY_CAST(r.checkpoint AS BIGINT) < h.oldest""",
    ),
    "stream_delivered": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "stream_process": _with(
        SHARDS,
        """SELECT l.stream, l.shard_id, count(*) AS records,
        coalesce(max(l.seq) >= max(CAST(s.ending_sequence_number AS BIGINT)), false) AS ended
        FROM log l JOIN shards s ON s.stream = l.stream AND s.shard_id = l.shard_id GROUP BY ALL""",
    ),
    "sharded_source_replay": _with(
        SHARDS,
        READING,
        f"""SELECT l.stream, l.shard_id, l.sequence_number, l.arrival_ts, l.event_name
        FROM log l LEFT JOIN reading r ON r.stream = l.stream AND r.shard_id = l.shard_id
        WHERE r.shard_id IS NULL OR r.checkpoint = 'TRIM_HORIZON'
          OR (r.checkpoint = 'AT_TIMESTAMP' AND l.arrival_ts >= {HALF}) OR l.seq > TRY_CAST(r.checkpoint AS BIGINT)""",
    ),
    "sharded_source_stream": _with(
        SHARDS,
        READING,
        f"""SELECT l.stream, l.shard_id, l.sequence_number, l.arrival_ts, l.event_name
        FROM log l LEFT JOIN reading r ON r.stream = l.stream AND r.shard_id = l.shard_id
        WHERE r.shard_id IS NULL OR r.checkpoint = 'TRIM_HORIZON'
          OR (r.checkpoint = 'AT_TIMESTAMP' AND l.arrival_ts >= {HALF}) OR l.seq > TRY_CAST(r.checkpoint AS BIGINT)""",
    ),
    # commits, cycles and live state
    "progress_two_writers": _with(
        SHARDS,
        f"""late AS ({_profile('late', 'true', 'shards')}), partial AS ({_profile('partial', 'true', 'shards')}),
        combined AS (SELECT * REPLACE ('SHARD_END' AS checkpoint) FROM partial UNION ALL SELECT * FROM late l
          WHERE NOT EXISTS (SELECT 1 FROM partial p WHERE p.stream = l.stream AND p.shard_id = l.shard_id)),
        written AS (""" + ROW + "combined)",
        "SELECT *, CAST(3 AS BIGINT) AS versions FROM written",
    ),
    "read_in_cycles": _with(
        SHARDS,
        _TRACKED,
        "sums AS (SELECT stream, shard_id, max(seq) AS last, count(*) AS records, CAST(sum(seq) AS BIGINT) AS numbers FROM log GROUP BY ALL)",
        """SELECT s.stream, s.shard_id,
        CASE WHEN s.gen < 4 THEN 'SHARD_END' ELSE coalesce(CAST(u.last AS VARCHAR), 'TRIM_HORIZON') END AS checkpoint,
        coalesce(records, 0) AS records, coalesce(numbers, 0) AS numbers, true AS after_parents, true AS within_limit,
        CAST(CASE WHEN s.gen < 4 THEN 1 ELSE 0 END AS BIGINT) AS ends
        FROM shards s JOIN tracked t ON t.stream = s.stream AND t.gen = s.gen
        LEFT JOIN sums u ON u.stream = s.stream AND u.shard_id = s.shard_id""",
    ),
    "stream_lag": _with(
        LOG,
        f"""SELECT stream, shard_id, greatest(epoch_us({NOW}) // 1000 - epoch_us(arg_max(arrival_ts, seq)) // 1000, 0) AS behind_ms
        FROM log GROUP BY ALL""",
    ),
    "stream_throughput": _with(
        LOG,
        """windows AS (SELECT stream, shard_id, time_bucket(INTERVAL 6 HOURS, arrival_ts, TIMESTAMP '2024-01-01') AS window_start,
          count(*) AS records, CAST(sum(length(sequence_number)) AS BIGINT) AS bytes FROM log GROUP BY ALL)""",
        """SELECT * FROM windows
        WHERE window_start + INTERVAL 6 HOURS <= (SELECT max(arrival_ts) FROM log) - INTERVAL 1 HOUR""",
    ),
    "stream_dedupe_late": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "stream_dedupe_runs": _with(LOG, f"SELECT {RECORD}, event_name FROM log"),
    "stream_compact_buckets": MATERIALIZED,
    "stream_forgetful_latest": MATERIALIZED,
    "read_indexed": _with(
        SHARDS,
        """first AS (SELECT min((stream, shard_id)) AS f FROM (SELECT stream, shard_id FROM shards WHERE gen < 3 OR gen = 3
          UNION ALL SELECT stream, 'gone-1' FROM shards))""",
        f"SELECT {RECORD}, true AS fewer_files FROM log, first WHERE stream = f[1] AND shard_id = f[2]",
    ),
    "flatten_inferred": _with(
        LOG,
        """SELECT sequence_number, key_id AS id, new_event_type AS kind, new_value AS value,
        CASE WHEN key_id % 2 = 0 THEN new_k END AS "mixed_N", CASE WHEN key_id % 2 <> 0 THEN CAST(new_k AS VARCHAR) END AS "mixed_S" FROM log""",
    ),
}
ORACLES["stream_checkpoints"] = ORACLES["progress_checkpoints"]
