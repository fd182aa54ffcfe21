"""DuckDB SQL computing, straight from the tables, what each query must return.

The oracle never sees messages: it derives records from the source tables,
so a wrong split, parse or route shows up as a difference.
"""

from __future__ import annotations

# Java line terminators in RE2 syntax (same set as functions.text).
_TERM = r"\r\n|[\n\r\x{2028}\x{2029}\x{85}]"


def _lines(text: str) -> str:
    return (
        f"CASE WHEN strlen({text}) = 0 THEN []::VARCHAR[] ELSE "
        f"regexp_split_to_array(regexp_replace({text}, '({_TERM})$', ''), '{_TERM}') END"
    )


_HEADER_ITEMS = """
SELECT o_orderkey, o_orderstatus, l_linenumber, l_quantity, l_extendedprice, l_returnflag
FROM orders JOIN lineitem ON l_orderkey = o_orderkey"""

_FAILING = """
SELECT o_orderkey FROM orders
WHERE o_orderkey % 97 = 0 AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""

_PLAIN = "concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)"

_ITEM = """'<item><l_linenumber>' || l_linenumber || '</l_linenumber><l_quantity>' || l_quantity || '</l_quantity><l_extendedprice>'
 || l_extendedprice || '</l_extendedprice><l_returnflag>' || l_returnflag || '</l_returnflag></item>'"""


def _processed(target: str) -> str:
    """Good records, dead letters in ``target`` and the archive of F7."""
    return f"""
WITH m AS (
  SELECT o_orderkey, count(l_orderkey) AS n,
         '<order><header><o_orderkey>' || o_orderkey || '</o_orderkey><o_orderstatus>' || o_orderstatus || '</o_orderstatus></header>'
         || coalesce(string_agg({_ITEM}, '' ORDER BY {_ITEM}), '') || '</order>' AS whole
  FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus),
p AS (SELECT o_orderkey, o_orderkey % 97 = 0 AND n > 0 AS failed,
             CASE WHEN o_orderkey % 97 = 0 THEN left(whole, length(whole) - 20) ELSE whole END AS payload FROM m)
SELECT 'good' AS kind, o_orderkey, l_linenumber, l_quantity, CAST(NULL AS VARCHAR) AS payload, CAST(NULL AS VARCHAR) AS error, CAST(NULL AS VARCHAR) AS reply_to
FROM p JOIN lineitem ON l_orderkey = o_orderkey WHERE NOT failed
UNION ALL SELECT '{target}', o_orderkey, NULL, NULL, payload, 'UNCLOSED_SPLIT', 'QM1/ORDERS.ACK/COA+COD' FROM p WHERE failed
UNION ALL SELECT 'archive', o_orderkey, NULL, NULL, payload, NULL, NULL FROM p"""


_SEGMENTED = """
SELECT doc_id, CASE WHEN doc_id % 10 = 0 AND length(text) > 1024
                    THEN left(text, CAST(1024 * (ceil(length(text) / 1024.0) - 1) AS BIGINT)) ELSE text END AS text,
       CASE WHEN doc_id % 10 = 0 THEN 'INCOMPLETE_GROUP' END AS error
FROM documents WHERE length(text) > 0"""


def _released(messages: str, key: str) -> str:
    """Group states of ``messages`` (key, no, last, payload, broken), by definition."""
    return f"""
WITH m AS ({messages}),
g AS (
  SELECT {key}, bool_or(n_payloads > 1) AS clash, bool_or(broken) AS broken, count(*) AS n, min(no) AS lo, max(no) AS hi,
         count(*) FILTER (last) AS n_last, max(no) FILTER (last) AS last_at
  FROM (SELECT {key}, no, bool_or(last) AS last, bool_or(broken) AS broken, count(DISTINCT payload) AS n_payloads FROM m GROUP BY {key}, no) GROUP BY {key}),
s AS (
  SELECT {key}, clash, CASE WHEN clash THEN 'CONFLICTING_MESSAGES'
                            WHEN lo = 1 AND hi = n AND n_last = 1 AND last_at = n AND NOT broken THEN NULL ELSE 'INCOMPLETE_MESSAGE_GROUP' END AS error FROM g)
SELECT DISTINCT {key}, CAST(no AS INTEGER) AS msg_seq, last AS last_in_group, payload, CASE WHEN broken THEN 'INCOMPLETE_GROUP' ELSE error END AS error
FROM m JOIN s USING ({key})"""


def _turn_groups(segments: bool) -> str:
    broken = "conv_id % 19 = 0 AND turn = 1 AND length(text) >= 2" if segments else "false"
    return _released(f"""
  SELECT conv_id, no, last, CASE WHEN broken THEN left(said, length(said) // 2) ELSE said END AS payload, broken FROM (
    SELECT conv_id, turn + 1 AS no, turn = max(turn) OVER (PARTITION BY conv_id) AND conv_id % 13 <> 0 AS last, {broken} AS broken,
           unnest(list_concat([text], CASE WHEN turn = 0 AND conv_id % 7 = 0 THEN [text] ELSE [] END,
                              CASE WHEN turn = 0 AND conv_id % 17 = 0 THEN [text || '!'] ELSE [] END)) AS said
    FROM conversations) WHERE NOT (conv_id % 11 = 0 AND no = 2)""", "conv_id")


_FILES = """
SELECT s_suppkey, CASE WHEN n <= 400 THEN value END AS value, n AS n_bytes, CASE WHEN n > 400 THEN 'FILE_TOO_LARGE' END AS error
FROM (SELECT s_suppkey, repeat(s_name, s_suppkey % 50) || chr(10) AS value, CAST(strlen(s_name) * (s_suppkey % 50) + 1 AS BIGINT) AS n FROM supplier)"""

def _confirmations(given_up: str) -> str:
    """Reports of the orders' dead letters, on time or not; ``given_up``: when
    what is not confirmed comes out."""
    return f"""
WITH r AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, kind,
         CAST(CASE WHEN kind = 'COA' AND o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + 1
                   WHEN kind = 'COD' AND o_orderkey % 4 <> 1 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) END AS DATE) AS came
  FROM orders, (VALUES ('COA'), ('COD')) AS t(kind))
SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, kind, strftime(d, '%Y-%m-%d') AS put, CASE WHEN came <= d + 7 THEN strftime(came, '%Y-%m-%d') END AS confirmed
FROM r WHERE came <= d + 7 OR ({given_up})"""


ORACLE: dict[str, str] = {
    "file_messages": _FILES,
    "confirmations": _confirmations("true"),
    "stream_confirmations": _confirmations("d + 7 < (SELECT least(max(d), max(came)) FROM r)"),
    "xml_file_records": """
WITH f AS (
  SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, c_nationkey % 5 = 0 AS broken,
         concat_ws(chr(10), '<root><header>', '  <nation>' || c_nationkey || '</nation>', '</header>', '', '') AS head,
         concat_ws(chr(10), '  <customer>', '    <key>' || c_custkey || '</key>', '  </customer>', '</root>') AS item
  FROM customer)
SELECT c_nationkey, head || item AS value, CAST(NULL AS VARCHAR) AS error FROM f WHERE NOT broken
UNION ALL
SELECT DISTINCT c_nationkey, CAST(NULL AS VARCHAR), 'HEADER_MISSING' FROM f WHERE broken""",
    "stream_file_messages": _FILES,
    "message_groups": _turn_groups(True),
    "stream_message_groups": _turn_groups(False),
    "message_groups_orders": _released("""
  SELECT l_orderkey AS o_orderkey, l_linenumber AS no, l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) AS last,
         l_partkey || '|' || l_quantity AS payload, false AS broken FROM lineitem""", "o_orderkey"),
    "xml_revenue_by_status": """
SELECT o_orderstatus, count(*) AS n_items,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS sum_qty,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS revenue
FROM orders JOIN lineitem ON l_orderkey = o_orderkey
GROUP BY o_orderstatus""",
    "xml_split": """
SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity, l_extendedprice, l_returnflag FROM lineitem""",
    "xml_header_enrich": _HEADER_ITEMS,
    "xml_whole": r"""
SELECT page_id, 0 AS pos,
       CASE WHEN ends_with(n, chr(10)) THEN n ELSE n || chr(10) END AS value
FROM (SELECT page_id, regexp_replace(html, '\r\n?', chr(10), 'g') AS n FROM pages WHERE strlen(html) > 0)""",
    "xml_split_pages": r"""
SELECT page_id, CAST(generate_subscripts(m, 1) - 1 AS INTEGER) AS pos, unnest(m) AS value, CAST(NULL AS VARCHAR) AS error
FROM (SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\s(?:[^>]*[^/>])?)?>.*?</li>') AS m FROM pages)""",
    "xml_spans": """
SELECT doc_id, CAST(u.pos AS INTEGER) AS pos, u.value AS value, CAST(NULL AS VARCHAR) AS error
FROM documents, unnest([
  {'pos': 0, 'value': '<line n=''1''><![CDATA[<line>' || replace(coalesce(text, ''), ']]>', ']] >') || '</line>]]></line>'},
  {'pos': 1, 'value': '<line>' || doc_id || '</line>'}]) AS t(u)
WHERE doc_id % 11 <> 0
UNION ALL
SELECT doc_id, NULL, NULL, 'UNCLOSED_SPAN' FROM documents WHERE doc_id % 11 = 0""",
    "split_lines": f"""
SELECT doc_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS value
FROM (SELECT doc_id, {_lines('text')} AS l FROM documents)""",
    "split_lines_encoding": f"""
SELECT conv_id, turn, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos, unnest(l) AS value
FROM (SELECT conv_id, turn, {_lines('text')} AS l FROM conversations)""",
    "fixed_width_columns": "SELECT event_id, event_type, value FROM events",
    "json_whole": """
SELECT event_id, 0 AS pos, CAST(json(props) AS VARCHAR) AS value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k
FROM events""",
    "json_split": """
SELECT l_orderkey AS o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem""",
    "json_split_scalars": """
SELECT p_partkey, 0 AS pos, CAST(to_json(p_name) AS VARCHAR) AS value FROM part
UNION ALL SELECT p_partkey, 1 AS pos, CAST(p_size AS VARCHAR) AS value FROM part
UNION ALL SELECT p_partkey, 2 AS pos, 'null' AS value FROM part
UNION ALL SELECT p_partkey, 3 AS pos, '{"brand":' || CAST(to_json(p_brand) AS VARCHAR) || '}' AS value FROM part""",
    "json_exact_numbers": """
SELECT o_orderkey, pos, CAST((10000000000 + o_orderkey) || '.' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS DECIMAL(38,12)) AS number
FROM orders, (VALUES (0), (1)) AS t(pos)""",
    "json_lexemes": """
SELECT p_partkey, CAST(u.pos AS INTEGER) AS pos, u.value AS value, CAST(NULL AS VARCHAR) AS error
FROM part, unnest([{'pos': 0, 'value': '"{' || p_partkey || '}"'}, {'pos': 1, 'value': '"[1"'}, {'pos': 2, 'value': p_size || '.50'},
                   {'pos': 3, 'value': '1e' || p_size || '00'}, {'pos': 4, 'value': '"a \\" ],' || p_partkey || '"'},
                   {'pos': 5, 'value': '{"k":[0.10,"' || p_size || '}"]}'}]) AS t(u)
WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0
UNION ALL
SELECT p_partkey, NULL, CASE WHEN p_partkey % 5 = 0 THEN '{''vals'':[' || p_partkey || ']}' ELSE '{"vals":[' || p_partkey || '}' END, 'BAD_JSON'
FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0""",
    "custom_splitter_faults": """
WITH k AS (
  SELECT route, p_partkey, string_split(p_name, ' ') AS w,
         CASE WHEN p_partkey % 5 = 0 THEN 'NULL_PAYLOAD' WHEN p_partkey % 7 = 0 THEN 'BAD_RECORDS' WHEN p_partkey % 11 = 0 THEN 'NULL_RECORD' END AS error
  FROM part, (VALUES ('expression'), ('python'), ('udtf')) AS r(route))
SELECT route, p_partkey, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS value, CAST(NULL AS VARCHAR) AS error FROM k WHERE error IS NULL
UNION ALL SELECT route, p_partkey, NULL, CASE error WHEN 'BAD_RECORDS' THEN 'oops' WHEN 'NULL_RECORD' THEN '["a",null]' END, error FROM k WHERE error IS NOT NULL""",
    "parse_malformed": """
SELECT o_orderkey, CASE WHEN ok THEN o_custkey END AS json_cust, CASE WHEN NOT ok THEN '{"c":' || o_custkey END AS json_corrupt,
       CASE WHEN ok THEN o_custkey END AS xml_cust, CASE WHEN NOT ok THEN '<o><c>' || o_custkey || '</c>' END AS xml_corrupt,
       o_orderkey AS fixed_key, CASE WHEN ok THEN o_custkey END AS fixed_cust
FROM (SELECT *, o_orderkey % 97 <> 0 AS ok FROM orders)""",
    "split_dispatch": """
SELECT 'XML' AS fmt, l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM lineitem
UNION ALL SELECT 'JSON' AS fmt, l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM lineitem
UNION ALL SELECT 'FIXED_WIDTH' AS fmt, l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM lineitem""",
    "custom_splitter": """
SELECT p_partkey, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS value
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
    "custom_splitter_python": """
SELECT p_partkey, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS value
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
    "custom_splitter_udtf": """
SELECT p_partkey, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS value
FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""",
    "assemble_segments": _SEGMENTED,
    "report_correlation_value": f"""
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderkey AS VARCHAR) ELSE {_PLAIN} END AS value
FROM orders""",
    "dead_letter_backout": _processed("QM1/ORDERS.BACKOUT"),
    "dead_letter_error_queue": _processed("QMERR/ORDERS.ERR"),
    "dead_letter_target": f"""
SELECT 'default' AS config, o_orderkey, 'QM1' AS target_qmgr, 'ORDERS.BACKOUT' AS target_queue FROM ({_FAILING})
UNION ALL SELECT 'backout' AS config, o_orderkey, 'QM1' AS target_qmgr, 'ORDERS.BO' AS target_queue FROM ({_FAILING})
UNION ALL SELECT 'error' AS config, o_orderkey, 'QM1' AS target_qmgr, 'ORDERS.ERR' AS target_queue FROM ({_FAILING})
UNION ALL SELECT 'error_qmgr' AS config, o_orderkey, 'QMERR' AS target_qmgr, 'ORDERS.ERR' AS target_queue FROM ({_FAILING})""",
    "ack_request": f"""
SELECT o_orderkey, 'QM1' AS reply_to_qmgr, 'ORDERS.ACK' AS reply_to_queue, 'COA,COD' AS report
FROM ({_FAILING})""",
    "queue_roundtrip": f"SELECT o_orderkey, {_PLAIN} AS value FROM orders",
    "parallel_scan": f"SELECT o_orderkey, {_PLAIN} AS value FROM orders",
    "archive_fanout": f"""
SELECT archive, strftime(o_orderdate, '%Y%m%d%H%M%S') || '_' || CAST(o_orderkey AS VARCHAR) || '_MQ_ORDERS' AS archive_name, CAST(o_orderkey AS VARCHAR) AS msg_id,
       8 AS msg_type, {_PLAIN} AS payload
FROM orders, (VALUES ('a1'), ('a2')) AS t(archive)""",
    "archive_name": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d%H%M%S') || '_' || CAST(o_orderkey AS VARCHAR) || '_MQ_ORDERS' AS archive_name
FROM orders""",
    "kafka_shape": f"SELECT 'orders' AS topic, CAST(o_orderkey AS VARCHAR) AS key, {_PLAIN} AS value FROM orders",
    "stream_queue_scan": _HEADER_ITEMS,
    "stream_drain_available_now": f"SELECT o_orderkey, {_PLAIN} AS value FROM orders",
    "stream_mq_source": _HEADER_ITEMS,
    "stream_commit_replay": _HEADER_ITEMS,
    "stream_consume_by_moving": f"SELECT o_orderkey, {_PLAIN} AS value, 1::BIGINT AS n_seen, 1::BIGINT AS n_kept FROM orders",
    "stream_batch_writer": _HEADER_ITEMS,
    "stream_assemble_segments": _SEGMENTED,
}
