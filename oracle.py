"""DuckDB SQL with the results of ``queries.py``, over the same tables."""

from __future__ import annotations

RUN_TS = "2024-06-01T00:00:00Z"
OLD_TS = "2024-05-01T00:00:00Z"


def num(c: str) -> str:
    return f"CASE WHEN {c} = floor({c}) THEN CAST(CAST({c} AS BIGINT) AS VARCHAR) ELSE CAST({c} AS VARCHAR) END"


def ts(c: str) -> str:
    return f"replace(CAST({c} AS VARCHAR), ' ', 'T') || 'Z'"


K = "CAST(o_orderkey AS VARCHAR)"
HASHED = "sha256(CAST(o_custkey AS VARCHAR))"


def order_text(custkey: str, status: str, price: str | None = num("o_totalprice"), extra: str = "") -> str:
    """JSON text of an order with the given JSON for its customer and status."""
    priced = f" || ',\"o_totalprice\":' || {price}" if price else ""
    return (
        f"'{{{extra}\"o_custkey\":' || {custkey} || ',\"o_orderdate\":\"' || {ts('o_orderdate')} || '\"'"
        f" || ',\"o_orderkey\":' || {K}{priced} || ',\"status\":' || {status} || '}}'"
    )


CUSTKEY = "CAST(o_custkey AS VARCHAR)"
STATUS = "'{\"code\":\"' || o_orderstatus || '\",\"priority\":\"' || o_orderpriority || '\"}'"
CODE = "'{\"code\":\"' || o_orderstatus || '\"}'"
HASHED_JSON = f"'\"' || {HASHED} || '\"'"
ORDER_TEXT = order_text(HASHED_JSON, CODE)
STAMP = (
    "'{\"_sdc_natural_key\":' || nk || ',\"_sdc_surrogate_key\":\"' || sk || "
    f"'\",\"_sdc_timestamp\":\"{RUN_TS}\"'"
)
KEYED = (
    "k AS (SELECT *, sha256(text) AS sk FROM t), "
    f"u AS (SELECT *, sha256(text || {STAMP} || ',' || substr(text, 2)) AS uk FROM k)"
)
# Transformed orders: o_orderkey, o_orderstatus, nk, text, sk, uk.
ORDERS = f"WITH t AS (SELECT *, {K} AS nk, {ORDER_TEXT} AS text FROM orders WHERE o_orderkey <> 0), {KEYED}"
TRANSFORMED = f"""{ORDERS}
SELECT nk AS key, text, sk AS _sdc_surrogate_key, '{RUN_TS}' AS _sdc_timestamp,
       uk AS _sdc_unique_key, nk AS _sdc_natural_key FROM u"""

EVENT_TEXT = (
    "'{\"event_id\":' || CAST(event_id AS VARCHAR) || ',\"event_type\":\"' || event_type || '\"'"
    " || ',\"props\":{\"k\":' || json_extract_string(props, '$.k') || '}'"
    f" || ',\"ts\":\"' || {ts('ts')} || '\",\"user_id\":' || CAST(user_id AS VARCHAR)"
    f" || ',\"value\":' || {num('value')} || '}}'"
)
EVENTS = f"""WITH t AS (SELECT CAST(event_id AS VARCHAR) AS nk, event_id, {EVENT_TEXT} AS text
                       FROM events WHERE event_id <> 0), {KEYED}"""

BOOKMARK = f"""
SELECT 'orders' AS stream, nk AS key,
       CASE WHEN o_orderkey % 3 = 0 THEN sk ELSE sha256('stale' || nk) END AS surrogate_key,
       '{OLD_TS}' AS last_seen, '{OLD_TS}' AS last_emitted
FROM u WHERE o_orderkey % 3 <> 2
UNION ALL
SELECT 'orders', CAST(top + i AS VARCHAR), sha256('gone' || CAST(top + i AS VARCHAR)), '{OLD_TS}', NULL
FROM (SELECT max(o_orderkey) AS top FROM orders), range(1, 101) AS r(i)"""

# Outcomes of the run over orders; ``o`` adds them to the transformed orders and the key that fails.
OUTCOMES = f"""{ORDERS}, o AS (
  SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'filtered_bookmark'
                 WHEN o_orderstatus NOT IN ('O', 'F') THEN 'schema_validation_failed'
                 ELSE 'emitted' END AS outcome FROM u)"""
ADVANCED = f"""
SELECT 'orders' AS stream, nk AS key,
       CASE WHEN outcome = 'schema_validation_failed' THEN sha256('stale' || nk) ELSE sk END AS surrogate_key,
       CASE WHEN outcome = 'schema_validation_failed' THEN '{OLD_TS}' ELSE '{RUN_TS}' END AS last_seen,
       CASE WHEN outcome = 'emitted' THEN '{RUN_TS}' ELSE '{OLD_TS}' END AS last_emitted
FROM o WHERE NOT (outcome = 'schema_validation_failed' AND o_orderkey % 3 = 2)
UNION ALL
SELECT 'orders', CAST(top + i AS VARCHAR), sha256('gone' || CAST(top + i AS VARCHAR)), '{OLD_TS}', NULL
FROM (SELECT max(o_orderkey) AS top FROM orders), range(1, 101) AS r(i)"""
RAW_KEY_0 = f"(SELECT {ORDER_TEXT} FROM orders WHERE o_orderkey = 0)"

# Paths of drifting events.
PATHS = """p AS (
  SELECT event_id AS ord, 'event_id' AS path, 'number' AS type, NULL AS format FROM events
  UNION ALL SELECT event_id, 'ts', 'string', 'date-time' FROM events
  UNION ALL SELECT event_id, 'user_id', 'number', NULL FROM events
  UNION ALL SELECT event_id, 'event_type', 'string', NULL FROM events WHERE event_id % 50 <> 2
  UNION ALL SELECT event_id, 'value', CASE WHEN event_id % 50 = 0 THEN 'string' ELSE 'number' END, NULL FROM events
  UNION ALL SELECT event_id, 'props', CASE WHEN event_id % 50 = 1 THEN 'number' ELSE 'object' END, NULL FROM events
  UNION ALL SELECT event_id, 'props.k', 'number', NULL FROM events WHERE event_id % 50 <> 1)"""


def first_types(where: str = "TRUE") -> str:
    return f"""f AS (
  SELECT path, CASE WHEN bool_or(type = 'object') THEN 'object' ELSE arg_min(type, ord) END AS type,
         nullif(arg_min(coalesce(format, ''), ord), '') AS format
  FROM p WHERE {where} GROUP BY path)"""


DRIFT_CATALOG = f"""WITH {PATHS}, {first_types('ord <> 0')}, c AS (
  SELECT path, type, TRUE AS nullable, format, CAST(NULL AS BIGINT) AS min_length FROM f
  UNION ALL SELECT '_sdc_natural_key', type, FALSE, NULL, NULL FROM f WHERE path = 'event_id'
  UNION ALL SELECT '_sdc_surrogate_key', 'string', FALSE, NULL, 1
  UNION ALL SELECT '_sdc_unique_key', 'string', FALSE, NULL, 1
  UNION ALL SELECT '_sdc_timestamp', 'string', TRUE, 'date-time', NULL)"""
CATALOG_ROWS = f"{DRIFT_CATALOG} SELECT 'events' AS stream, * FROM c"
PLAIN_CATALOG_ROWS = CATALOG_ROWS.replace("event_id % 50", "-1 * 1")

DIGITS = "(CAST(o_orderkey % 9 + 1 AS VARCHAR) || rtrim(CAST(o_orderkey % 7 + 2 AS VARCHAR), '0'))"


def number_texts(text: str) -> str:
    return f"SELECT o_orderkey, t AS typed, t AS json, t AS typed_key, t AS json_key FROM (SELECT o_orderkey, {text} AS t FROM orders)"


LONG_HASH = "'{\"id\":' || CAST(o_orderkey AS VARCHAR) || ',\"n\":\"' || sha256(CAST(1000000000000000000 + o_orderkey AS VARCHAR)) || '\"}'"

DAY = "substr(CAST(o_orderdate AS VARCHAR), 1, 10)"
DATES = f"""WITH d AS (SELECT o_orderkey, CASE o_orderkey % 6
    WHEN 0 THEN {ts('o_orderdate')}
    WHEN 1 THEN {DAY}
    WHEN 2 THEN substr({DAY}, 1, 8) || '31'
    WHEN 3 THEN {DAY} || 'T25:00:00Z'
    WHEN 4 THEN {DAY} || 'T23:59:59.123456789+02:00'
    ELSE {DAY} || ' 00:00:00' END AS v FROM orders),
  x AS (SELECT *,
    regexp_matches(v, '^\\d{{4}}-\\d\\d-\\d\\dT([01]\\d|2[0-3]):[0-5]\\d:[0-5]\\d(\\.\\d+)?(Z|[+-]([01]\\d|2[0-3]):[0-5]\\d)$')
      AND try_cast(substr(v, 1, 10) AS DATE) IS NOT NULL AS is_date_time,
    regexp_matches(v, '^\\d{{4}}-\\d\\d-\\d\\d$') AND try_cast(v AS DATE) IS NOT NULL AS is_date FROM d)"""

URLS = """WITH s AS (SELECT CAST(page_id AS VARCHAR) AS stream, url, split_part(url, '#', 1) AS address FROM pages),
b AS (SELECT *, split_part(address, '?', 1) AS base, substr(url, length(address) + 1) AS fragment,
             substr(address, length(split_part(address, '?', 1)) + 2) AS query FROM s),
w AS (SELECT stream, unnest(string_split(query, '&')) AS part,
             generate_subscripts(string_split(query, '&'), 1) AS i FROM b),
v AS (SELECT stream, i, url_decode(replace(split_part(part, '=', 1), '+', ' ')) AS name,
             url_decode(replace(substr(part, length(split_part(part, '=', 1)) + 2), '+', ' ')) AS value
      FROM w WHERE part <> ''),
a AS (SELECT stream, n, i, name, value FROM v, range(1, 4) AS r(n) WHERE name <> 'page'
      UNION ALL SELECT stream, n, 0, 'page', CAST(n + 1 AS VARCHAR) FROM s, range(1, 4) AS r(n)),
e AS (SELECT stream, n, string_agg(replace(url_encode(name), '%20', '+') || '=' ||
             replace(url_encode(value), '%20', '+'), '&' ORDER BY name, i) AS query FROM a GROUP BY stream, n)
SELECT stream, 0 AS page_no, url FROM s
UNION ALL SELECT b.stream, n, base || '?' || e.query || fragment FROM b JOIN e ON b.stream = e.stream"""

CHAIN = """WITH RECURSIVE pages_of AS (SELECT DISTINCT o_orderkey // 100 AS n FROM orders),
c AS (SELECT stream, root, root AS n, CAST(0 AS BIGINT) AS page_no
      FROM (VALUES ('s1'), ('s2')) AS s(stream), (VALUES (CAST(0 AS BIGINT)), (7)) AS r(root)
      WHERE root IN (SELECT n FROM pages_of)
      UNION ALL
      SELECT c.stream, c.root, p.n, c.page_no + 1 FROM c JOIN pages_of p
        ON p.n = CASE WHEN c.stream = 's2' AND c.n % 5 = 4 THEN c.n - 4 ELSE c.n + 1 END
      WHERE c.stream = 's1' OR c.page_no < 4)
SELECT stream, 'http://h/orders?page=' || CAST(root AS VARCHAR) AS root, page_no,
       'http://h/orders?page=' || CAST(n AS VARCHAR) AS url FROM c"""

EMITTED = """SELECT nk AS o_orderkey, sk AS _sdc_surrogate_key, uk AS _sdc_unique_key FROM o"""

ORACLE = {
    "csv_scan": """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
        CASE c_custkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'a, "b"' || chr(10) || c_name ELSE c_name END AS c_name,
        CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""",
    "jsonl_scan": """SELECT CASE WHEN event_id % 100 <> 13 THEN event_id END AS event_id,
        CASE WHEN event_id % 100 <> 13 THEN event_type END AS event_type,
        CASE WHEN event_id % 100 <> 13 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k
        FROM events WHERE event_id % 100 NOT IN (10, 11, 12, 14)""",
    "api_response_normalise": """SELECT c_custkey AS page_no,
        CAST(CASE c_custkey % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 0 END AS BIGINT) AS n_records FROM customer""",
    "api_records_explode": """SELECT c_custkey AS page_no, CAST(pos AS BIGINT) AS pos, c_custkey, c_name
        FROM customer, (VALUES (0), (2)) AS p(pos)
        WHERE c_custkey % 3 = 0 OR (c_custkey % 3 = 1 AND pos = 0)""",
    "api_records_path": """SELECT stream, o_orderkey // 100 AS page_no, o_orderkey
        FROM orders, (VALUES ('s1'), ('s2')) AS s(stream)""",
    "page_urls": URLS,
    "pages_until_empty": """SELECT stream, page_no FROM (
        SELECT CAST(c_nationkey AS VARCHAR) AS stream, c_custkey AS page_no,
          min(CASE WHEN c_custkey % 7 = 6 THEN c_custkey END) OVER (PARTITION BY c_nationkey) AS last
        FROM customer) WHERE last IS NULL OR page_no <= last""",
    "first_page_only": """SELECT CAST(c_nationkey AS VARCHAR) AS stream, min(c_custkey) AS page_no
        FROM customer GROUP BY c_nationkey""",
    "page_chain": CHAIN,
    "read_bookmark": f"{ORDERS} {BOOKMARK}",
    "write_bookmark": f"""{ORDERS}, b AS ({BOOKMARK})
        SELECT key, CAST(1 AS BIGINT) AS version FROM b WHERE last_emitted IS NULL
        UNION ALL SELECT key, 2 FROM b""",
    "read_catalog": CATALOG_ROWS,
    "write_catalog": f"""{DRIFT_CATALOG} SELECT path, type, CAST(1 AS BIGINT) AS version FROM c WHERE path NOT LIKE '%.%'
        UNION ALL SELECT path, type, 2 FROM c""",
    "catalog_document": CATALOG_ROWS,
    "discover_ns_ord": CATALOG_ROWS,
    "jsonl_rejects": """SELECT CASE event_id % 100 WHEN 11 THEN 'not json' WHEN 12 THEN '[1]' ELSE '5' END AS raw,
        CASE event_id % 100 WHEN 11 THEN 'is not JSON, or over the limits of a VARIANT' ELSE 'is not an object' END AS reason,
        count(*) AS n FROM events WHERE event_id % 100 IN (11, 12, 14) GROUP BY 1, 2""",
    "csv_rejects": "SELECT c_custkey || ',short' AS raw FROM customer WHERE c_custkey % 10 = 0",
    "stream_csv": """SELECT CAST(c_custkey AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS nation, 'a, b' AS note
        FROM customer WHERE c_custkey % 10 <> 0""",
    "two_streams_one_store": f"""SELECT 'orders' AS stream, nk AS key, sk AS surrogate_key FROM ({ORDERS} SELECT * FROM u)
        UNION ALL SELECT 'events', nk, sk FROM ({EVENTS} SELECT * FROM u)""",
    "check_multiple_of": """SELECT o_orderkey AS ord, concat_ws('; ',
        CASE WHEN o_orderkey % 7 <> 0 THEN 'big: breaks multipleOf 7' END,
        CASE WHEN o_orderkey % 5 <> 0 THEN 'small: breaks multipleOf 5e-12' END) AS errors FROM orders""",
    "get_path": f"""SELECT o_orderkey AS ord, o_orderstatus AS code, CAST(NULL AS VARCHAR) AS absent,
        CAST(NULL AS VARCHAR) AS below_scalar, {STATUS} AS status FROM orders""",
    "set_path": f"""SELECT o_orderkey AS ord, {order_text(CUSTKEY,
        "'{\"code\":\"' || o_orderstatus || '!\",\"priority\":\"' || o_orderpriority || '\"}'",
        extra="\"a\":{\"b\":' || " + K + " || '},")} AS text FROM orders""",
    "drop_paths": f"SELECT o_orderkey AS ord, {order_text(CUSTKEY, CODE, price=None)} AS text FROM orders",
    "hash_sensitive": f"""SELECT o_orderkey AS ord, {order_text(HASHED_JSON,
        "'{\"code\":\"' || o_orderstatus || '\",\"priority\":\"' || sha256(o_orderpriority) || '\"}'")} AS text FROM orders""",
    "key_string": f"""SELECT o_orderkey AS ord, {K} AS whole, {num('o_totalprice')} AS fraction,
        CAST(CAST(round(o_totalprice * 100) AS BIGINT) * 10000 AS VARCHAR) AS large,
        o_orderstatus AS string, '' AS absent FROM orders""",
    "canonical_text": f"SELECT event_id AS ord, {EVENT_TEXT} AS text FROM events",
    "natural_key": """SELECT conv_id * 1000 + turn AS ord,
        '{"conv":' || CAST(conv_id AS VARCHAR) || ',"turn":' || CAST(turn AS VARCHAR) || '}' AS natural_key,
        '{"conv":' || CAST(conv_id AS VARCHAR) || ',"turn":' || CAST(turn AS VARCHAR) || '}' AS key
        FROM conversations""",
    "surrogate_key": f"{EVENTS} SELECT nk AS key, sk AS _sdc_surrogate_key FROM u",
    "run_timestamp": f"{EVENTS} SELECT nk AS key, '{RUN_TS}' AS _sdc_timestamp FROM u",
    "unique_key": f"{EVENTS} SELECT nk AS key, uk AS _sdc_unique_key FROM u",
    "transform_records": TRANSFORMED,
    "transform_json_records": TRANSFORMED,
    "require_key": """SELECT o_orderkey AS ord, o_orderkey % 4 = 1 OR (o_orderkey % 4 = 0 AND o_orderkey % 8 <> 0) AS ok
        FROM orders""",
    "changed_only": f"{ORDERS} SELECT nk AS key, sk AS _sdc_surrogate_key FROM u WHERE o_orderkey % 3 <> 0",
    "validate_records": """SELECT CAST(event_id AS VARCHAR) AS key, CASE event_id % 50
        WHEN 0 THEN 'value: type is not number|null' WHEN 1 THEN 'props: type is not object|null' ELSE '' END AS errors
        FROM events WHERE event_id <> 0""",
    "check_type": """SELECT event_id AS ord, event_id % 50 <> 0 AS is_number, event_id % 50 = 0 AS is_string,
        TRUE AS is_integer, event_id % 50 <> 1 AS is_object,
        CASE WHEN event_id % 50 <> 2 THEN TRUE END AS is_present_string FROM events""",
    "check_min_length": "SELECT event_id AS ord, length(event_type) >= 6 AS ok FROM events",
    "check_format": f"{DATES} SELECT o_orderkey, is_date_time, is_date FROM x",
    "check_properties": "SELECT event_id AS ord FROM events WHERE CAST(json_extract_string(props, '$.k') AS INT) <= 50",
    "check_catalog_keywords": """
        SELECT 'required' AS keyword, count(*) AS n_invalid FROM events
        UNION ALL SELECT 'enum', count(*) FILTER (event_type NOT IN ('click', 'view')) FROM events
        UNION ALL SELECT 'const', count(*) FILTER (event_type <> 'click') FROM events
        UNION ALL SELECT 'minimum', count(*) FILTER (value < 10) FROM events
        UNION ALL SELECT 'maximum', count(*) FILTER (value > 10) FROM events
        UNION ALL SELECT 'exclusiveMinimum', count(*) FILTER (user_id <= 8) FROM events
        UNION ALL SELECT 'exclusiveMaximum', count(*) FILTER (user_id >= 8) FROM events
        UNION ALL SELECT 'multipleOf', count(*) FILTER (user_id % 4 <> 0) FROM events
        UNION ALL SELECT 'maxLength', count(*) FILTER (length(event_type) > 5) FROM events
        UNION ALL SELECT 'pattern', count(*) FILTER (event_type NOT LIKE 'c%') FROM events
        UNION ALL SELECT 'additionalProperties', count(*) FROM events""",
    "check_items": """SELECT l_orderkey AS ord FROM lineitem GROUP BY l_orderkey
        HAVING count(*) BETWEEN 2 AND 5 AND max(CAST(l_quantity AS INT)) <= 45""",
    "number_text_small": number_texts(f"'0.' || repeat('0', CAST(o_orderkey % 297 + 3 AS INT)) || {DIGITS}"),
    "number_text_large": number_texts(f"{DIGITS} || repeat('0', CAST(o_orderkey % 277 + 25 - length({DIGITS}) AS INT))"),
    "hash_large_integers": f"SELECT o_orderkey AS ord, {LONG_HASH} AS typed, {LONG_HASH} AS json FROM orders WHERE o_orderkey <> 0",
    "objects_only": "SELECT event_id AS ord, event_id % 5 > 2 AS ok FROM events",
    "temporal_kind": f"""{DATES} SELECT o_orderkey,
        CASE WHEN is_date_time THEN 'date-time' WHEN is_date THEN 'date' END AS kind FROM x""",
    "bookmark_lookup": f"""{ORDERS} SELECT nk AS key, CASE o_orderkey % 3 WHEN 0 THEN sk
        WHEN 1 THEN sha256('stale' || nk) END AS previous_surrogate_key FROM u""",
    "unseen_keys": f"""SELECT CAST(top + i AS VARCHAR) AS key, '{OLD_TS}' AS last_seen
        FROM (SELECT max(o_orderkey) AS top FROM orders), range(1, 101) AS r(i)""",
    "infer_paths": f"WITH {PATHS} SELECT ord, path, type, format FROM p",
    "merge_schemas": f"""WITH {PATHS}, {first_types()}
        SELECT path, type, TRUE AS nullable, format FROM f WHERE path <> 'user_id'
        UNION ALL SELECT 'user_id', 'string', FALSE, NULL UNION ALL SELECT 'gone', 'boolean', FALSE, NULL""",
    "discover_catalog": CATALOG_ROWS,
    "run_metrics": f"""{OUTCOMES} SELECT count(*) + 1 AS processed,
        count(*) FILTER (outcome = 'emitted') AS emitted,
        count(*) FILTER (outcome = 'filtered_bookmark') AS filtered_bookmark,
        count(*) FILTER (outcome = 'schema_validation_failed') AS schema_validation_failed,
        CAST(1 AS BIGINT) AS transform_failed,
        count(*) FILTER (outcome <> 'emitted') + 1 AS not_emitted_total FROM o""",
    "fold_updates": f"""SELECT 'orders' AS stream, CAST(o_custkey AS VARCHAR) AS key,
        arg_max(sha256({K}), o_orderkey) AS surrogate_key, max({ts('o_orderdate')}) AS last_seen,
        max(CASE WHEN o_orderstatus = 'F' THEN {ts('o_orderdate')} END) AS last_emitted
        FROM orders GROUP BY o_custkey""",
    "advance_bookmark": f"{OUTCOMES} {ADVANCED}",
    "route_outcomes": f"{OUTCOMES} SELECT o_orderkey AS ord, outcome FROM o UNION ALL SELECT 0, 'transform_failed'",
    "bookmark_updates": f"""{OUTCOMES} SELECT nk AS key, sk AS surrogate_key, '{RUN_TS}' AS ts,
        outcome = 'emitted' AS emitted FROM o WHERE outcome <> 'schema_validation_failed'""",
    "schema_messages": f"""{DRIFT_CATALOG}, d AS (SELECT path AS property, CASE
          WHEN path = 'props' THEN '{{"properties":{{"k":{{"type":["number","null"]}}}},"type":["object","null"]}}'
          WHEN min_length = 1 THEN '{{"minLength":1,"type":"string"}}'
          ELSE '{{' || CASE WHEN format IS NULL THEN '' ELSE '"format":"' || format || '",' END
            || '"type":' || CASE WHEN nullable THEN '["' || type || '","null"]' ELSE '"' || type || '"' END || '}}'
          END AS definition FROM c WHERE path <> 'props.k')
        SELECT stream, 'SCHEMA' AS type, '["_sdc_unique_key","_sdc_surrogate_key"]' AS key_properties,
          property, definition FROM d, (VALUES ('events'), ('copy')) AS s(stream)""",
    "record_messages": f"""{OUTCOMES} SELECT 'orders' AS stream, '{{"type":"RECORD","record":' || {STAMP}
        || ',"_sdc_unique_key":"' || uk || '",' || substr(text, 2) || ',"stream":"orders"}}' AS message
        FROM o WHERE outcome = 'emitted'""",
    "rejects": f"""{OUTCOMES} SELECT outcome, nk AS key, text AS raw,
        'status.code: is not one of the allowed values' AS errors FROM o WHERE outcome = 'schema_validation_failed'
        UNION ALL SELECT 'transform_failed', NULL, {RAW_KEY_0}, 'unique key is missing or empty'""",
    "run_discover": CATALOG_ROWS,
    "run_extract": f"{OUTCOMES} {EMITTED} WHERE outcome = 'emitted'",
    "run_extract_bookmark": f"{OUTCOMES} {ADVANCED}",
    "run_extract_next_pages": f"""SELECT {K} AS key, sha256('{{"o_orderkey":' || {K} || ',"o_orderstatus":"' || o_orderstatus
        || '","o_totalprice":' || {num('o_totalprice')} || '}}') AS surrogate_key FROM orders WHERE o_orderkey <> 0""",
    "run_extract_query_pages": """SELECT CAST(c_custkey AS VARCHAR) AS key, sha256('{"c_custkey":' || CAST(c_custkey AS VARCHAR)
        || ',"c_name":"' || c_name || '"}') AS surrogate_key FROM customer WHERE c_custkey <> 0
        AND c_custkey < 20 * ((SELECT max(c_custkey) // 20 FROM customer) - 1)""",
    "run_extract_bare_array": """SELECT CAST(n_nationkey AS VARCHAR) AS key, sha256('{"n_name":"' || n_name
        || '","n_nationkey":' || CAST(n_nationkey AS VARCHAR) || '}') AS surrogate_key FROM nation WHERE n_nationkey <> 0""",
    "run_refresh": f"{OUTCOMES} {EMITTED} WHERE o_orderstatus IN ('O', 'F')",
    "stream_changes": f"""{EVENTS} SELECT nk AS key, sk AS surrogate_key,
        NOT (event_id % 3 < 2 AND event_id // 3 % 10 = 0) AS emitted_when_last_seen FROM u""",
    "stream_changes_deltas": f"""{EVENTS} SELECT nk AS key, sk AS surrogate_key, event_id % 3 < 2 AS seen,
        event_id % 3 = 0 AS emitted FROM u""",
    "stream_discover": PLAIN_CATALOG_ROWS,
}
EVENT_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
COMBINED = {
    "allOf": "value BETWEEN 10 AND 90",
    "anyOf": "event_type = 'click' OR length(event_type) <= 4",
    "oneOf": "(user_id % 2 = 0) <> (user_id % 3 = 0)",
    "not": "user_id % 5 <> 0",
    "nested": f"{EVENT_K} <= 10 OR {EVENT_K} >= 90",
    "minProperties": "event_id % 4 + 1 >= 2",
    "maxProperties": "event_id % 4 + 1 <= 2",
    "uniqueItems": "event_id % 3 <> event_id % 5 AND event_id % 3 <> event_id % 7 AND event_id % 5 <> event_id % 7",
    "items": "event_id % 5 <= 3 AND (event_id % 7 <= 3 OR event_id % 7 = 6)",
}
ORACLE["check_combinators"] = " UNION ALL ".join(
    f"SELECT '{name}' AS name, count(*) FILTER ({ok}) AS n_valid, count(*) FILTER (NOT ({ok})) AS n_invalid FROM events"
    for name, ok in COMBINED.items()
)
ORACLE["discover_rejects"] = """WITH b AS (
        SELECT CASE event_id % 100 WHEN 11 THEN 'not json' WHEN 12 THEN '[1]' ELSE '5' END AS raw FROM events
        WHERE event_id % 100 IN (11, 12, 14))
    SELECT raw, CASE raw WHEN 'not json' THEN 'is not JSON, or over the limits of a VARIANT' ELSE 'is not an object' END AS reason,
           count(*) AS n, sum(count(*)) OVER ()::BIGINT AS n_all FROM b GROUP BY raw"""
ORACLE["api_rejects"] = """SELECT CASE c_custkey % 10 WHEN 3 THEN CAST(c_custkey AS VARCHAR) ELSE '"' || c_name || '"' END AS raw,
    'is not an object' AS errors FROM customer WHERE c_custkey % 10 IN (3, 4)"""
ORACLE["csv_scan_split"] = ORACLE["csv_scan"]
CUSTOMER_TEXT = """'{"c_custkey":"' || c_custkey || '","c_mktsegment":"' || c_mktsegment || '","c_name":"' || CASE c_custkey % 10
    WHEN 0 THEN '' WHEN 1 THEN 'a, \\"b\\"\\n' || c_name ELSE c_name END || '","c_nationkey":"' || c_nationkey || '"}'"""
ORACLE["run_extract_many"] = f"""SELECT * FROM ({OUTCOMES} {ADVANCED})
    UNION ALL SELECT 'events', nk, sk, '{RUN_TS}', '{RUN_TS}' FROM ({EVENTS} SELECT * FROM u)
    UNION ALL SELECT 'customers', CAST(c_custkey AS VARCHAR), sha256({CUSTOMER_TEXT}), '{RUN_TS}', '{RUN_TS}' FROM customer"""
ORACLE["bookmark_lookup_filtered"] = ORACLE["bookmark_lookup"]
ORACLE["run_metrics_observed"] = ORACLE["run_metrics"]
