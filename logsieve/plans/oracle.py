"""SQL that works out each query's answer from the base tables with formulas of its own:
no JSON, CEF or time text is parsed here, the values are taken from the columns."""

from __future__ import annotations

from logsieve.schema import LOG_COLUMNS

# Destination host of each message of `log_messages`, and what it matches.
_HOSTS = """
hosts AS (
    SELECT *,
        CASE WHEN event_id % 7 <> 0 THEN user_id % 50
             WHEN event_id % 14 = 0 THEN user_id % 25 END AS tool_no,
        CASE WHEN event_id % 14 = 0 THEN 'tool' || (user_id % 25) || '.example.com'
             WHEN event_id % 7 = 0 THEN ''
             WHEN event_id % 2 = 0 THEN '  TOOL' || (user_id % 50) || '.EXAMPLE.COM '
             ELSE 'tool' || (user_id % 50) || '.example.com' END AS host_text,
        strftime(ts, '%Y-%m-%d %H:%M:%S.%g') AS ts_text
    FROM events
)"""

_MATCHED = f"""{_HOSTS},
matched AS (
    SELECT hosts.*, n_nationkey, n_name, r_name,
        CAST(CAST(n_nationkey / 10.0 AS FLOAT) AS DOUBLE) AS score
    FROM hosts
    JOIN nation ON n_nationkey = tool_no
    JOIN region ON r_regionkey = n_regionkey
    WHERE n_regionkey IN (0, 1, 3)
)"""

# Every 13th message has one more than the largest number of 64 bits, which becomes 0.
_CENTS = "CASE WHEN event_id % 13 = 4 THEN '0' ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR) END"
_LOG_ID = "CASE WHEN event_id % 11 = 5 THEN CAST(18446744073709551615 - event_id AS VARCHAR) ELSE CAST(event_id AS VARCHAR) END"

# What each event's text in `number_text` is worth, and whether it is whole.
_WHOLE = "event_id * 1000 + user_id"
_NUMBERS = f"""
numbers AS (
    SELECT *, CASE event_id % 8
        WHEN 0 THEN {_WHOLE} WHEN 4 THEN {_WHOLE}
        WHEN 6 THEN CASE event_id % 24 WHEN 6 THEN 18446744073709551615 - user_id WHEN 14 THEN 18446744073709551616 + user_id END
        WHEN 3 THEN CASE WHEN event_id % 16 = 3 THEN user_id ELSE -user_id END END AS whole
    FROM events
)"""


def _uint(limit: int, kind: str = "BIGINT") -> str:
    return f"CAST(CASE WHEN whole BETWEEN 0 AND {limit} THEN whole ELSE 0 END AS {kind})"


_IPV4 = """CASE event_id % 4
        WHEN 0 THEN CASE WHEN event_id % 300 < 256
            THEN '10.0.' || (user_id % 256) || '.' || (event_id % 300) ELSE '0.0.0.0' END
        WHEN 1 THEN '192.168.' || (user_id % 256) || '.1'
        ELSE '0.0.0.0' END"""

_CEF_OK = "event_id % 17 <> 0"
_VENDOR = "CASE WHEN event_id % 5 = 0 THEN 'Ven|dor' ELSE 'Ven' END"
_SEVERITY = "CASE WHEN event_id % 13 = 0 THEN 0 ELSE event_id % 11 END"
_CEF_LINE = """(CASE WHEN event_id % 5 = 0 THEN 'CEF:0|Ven\\|dor|' ELSE 'CEF:0|Ven|' END
    || event_type || '|1.0|' || event_id || '|user ' || user_id || '|'
    || CASE WHEN event_id % 13 = 0 THEN 'High' ELSE CAST(event_id % 11 AS VARCHAR) END || '|'
    || CASE WHEN event_id % 7 = 0 THEN 'src=1.1.1.1 ' ELSE '' END
    || 'src=10.0.0.' || (event_id % 256) || ' dst=10.1.0.' || user_id
    || ' msg=a b\\=c request=http://x/?a=' || user_id || '&c=d ')"""
_CEF_LINE_JSON = f"""replace({_CEF_LINE}, '\\', '\\\\')"""

# Milliseconds, date and clock of each event's text in `time_text`.
_TIMES = """
times AS (
    SELECT event_id, event_id % 8 AS shape, ts,
        date_trunc('day', ts) AS day_start, date_trunc('second', ts) AS second_start
    FROM events
)"""

# A cell's line breaks are line feeds once it is read.
_LINES = "replace({}, chr(13) || chr(10), chr(10))"

_KEYED = """
keyed AS (
    SELECT event_id, CASE event_id % 8
        WHEN 4 THEN 'TOOL' || user_id || '.EXAMPLE.COM'
        WHEN 5 THEN ''
        WHEN 6 THEN ' ' || chr(9) || ' '
        WHEN 7 THEN ' tool' || user_id || '.example.com' || chr(9)
        ELSE 'tool' || user_id || '.example.com' END AS tool_url,
        'tool' || user_id || '.example.com' AS key
    FROM events
)"""

_CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _customer_cells() -> str:
    """Filled cells of `customer_rows`, one row each."""
    parts = []
    for name in _CUSTOMER_COLUMNS:
        blank = " WHERE c_custkey % 5 <> 0 AND c_mktsegment <> ''" if name == "c_mktsegment" else ""
        parts.append(
            f"SELECT c_custkey, '{name}' AS k, CAST({name} AS VARCHAR) AS v FROM customer{blank}"
        )
    return " UNION ALL ".join(parts)


def _log_projection() -> str:
    known = {
        "log_id": _LOG_ID,
        "date": "strftime(ts, '%Y-%m-%d')",
        "eventtime": "ts_text",
        "time": "CASE WHEN event_id % 10 = 3 THEN '12:34:56' ELSE strftime(ts, '%H:%M:%S') END",
        "tool_id": "CAST(n_nationkey AS BIGINT)",
        "tool_name": "n_name",
        "tool_url": "host_text",
        "tool_score": "score",
        "tool_ai_category": "r_name",
        "sessionid": "'s-' || user_id",
        "duration": "user_id * 3",
        "srcip": "CASE WHEN event_id % 300 < 256 THEN '10.0.' || (user_id % 256) || '.' || "
        "(event_id % 300) ELSE '0.0.0.0' END",
        "srcport": "CASE WHEN event_id * 7 % 70000 < 65536 THEN event_id * 7 % 70000 ELSE 0 END",
        "dstip": "'0.0.0.0'",
        "dstname": "CASE WHEN event_id % 7 = 0 THEN '' ELSE host_text END",
        "app": "props",
        "action": "event_type",
        "proto": "CASE WHEN event_id % 300 < 256 THEN event_id % 300 ELSE 0 END",
        "sentbyte": _CENTS,
    }
    absent = {"text": "''", "uint64": "'0'"}
    known = {c.name: known.get(c.name) or absent.get(c.kind, "CAST(0 AS BIGINT)") for c in LOG_COLUMNS}
    return f"WITH {_MATCHED} SELECT {', '.join(f'{sql} AS {c}' for c, sql in known.items())} FROM matched"


def _violations() -> str:
    """Breaches of the kept dirty messages: the time, the address, and the two numbers."""
    whole_breach = """CASE event_id % 8
        WHEN 1 THEN 'not_integer' WHEN 2 THEN 'not_integer' WHEN 7 THEN 'not_integer'
        WHEN 6 THEN 'out_of_range' END"""
    number_text = f"""CASE event_id % 8
        WHEN 0 THEN CAST({_WHOLE} AS VARCHAR) WHEN 1 THEN CAST(value AS VARCHAR)
        WHEN 2 THEN (user_id % 10) || 'e3'
        WHEN 3 THEN CASE WHEN event_id % 16 = 3 THEN '+' ELSE '-' END || user_id
        WHEN 4 THEN '  ' || ({_WHOLE}) || chr(9)
        WHEN 6 THEN CASE event_id % 24 WHEN 6 THEN CAST(18446744073709551615 - user_id AS VARCHAR)
            WHEN 14 THEN CAST(18446744073709551616 + user_id AS VARCHAR) ELSE '99999999999999999999' || user_id END
        ELSE event_type END"""
    negative = "(event_id % 16 = 11 AND user_id > 0)"
    return f"""
    WITH kept AS (
        SELECT events.*, {whole_breach} AS breach, {number_text} AS number_text, {_LOG_ID} AS log_id
        FROM events JOIN nation ON n_nationkey = user_id % 25
        WHERE n_regionkey IN (0, 1, 3)
    )
    SELECT log_id, 'eventtime' AS "column", 'junk ' || strftime(ts, '%H:%M:%S') AS raw,
        'bad_time' AS rule FROM kept WHERE event_id % 8 = 4
    UNION ALL
    SELECT log_id, 'dstip', CASE WHEN event_id % 4 = 2 THEN '::1'
        ELSE '10.0.' || (user_id % 256) || '.' || (event_id % 300) END, 'not_ipv4'
    FROM kept WHERE event_id % 4 = 2 OR (event_id % 4 = 0 AND event_id % 300 >= 256)
    UNION ALL
    SELECT log_id, 'sentbyte', number_text, coalesce(breach, 'out_of_range')
    FROM kept WHERE (breach IS NOT NULL AND event_id % 24 <> 6) OR {negative}
    UNION ALL
    SELECT log_id, 'dstport', number_text, coalesce(breach, 'out_of_range')
    FROM kept WHERE breach IS NOT NULL OR {negative}
        OR (event_id % 4 = 0 AND {_WHOLE} > 65535)"""


def all_sql() -> dict[str, str]:
    return {
        "enrich_ai_tools": f"""WITH {_MATCHED}
            SELECT {_LOG_ID} AS log_id, ts_text AS eventtime, CAST(n_nationkey AS BIGINT) AS tool_id,
                n_name AS tool_name, host_text AS tool_url, r_name AS tool_ai_category,
                score AS tool_score, {_CENTS} AS sentbyte
            FROM matched""",
        "log_projection": _log_projection(),
        "json_parse": """
            SELECT event_id AS log_id,
                CAST(CASE WHEN event_id % 9 = 0 THEN 0 ELSE 1 END AS BIGINT) AS ok,
                CASE WHEN event_id % 9 = 0 THEN '' ELSE event_type END AS action
            FROM events""",
        "json_text": """
            SELECT conv_id, turn, 'role' AS k, role AS v FROM conversations
            UNION ALL SELECT conv_id, turn, 'text', text FROM conversations""",
        "url_coalesce": f"WITH {_KEYED} SELECT event_id AS log_id, tool_url FROM keyed",
        "url_key": f"""WITH {_KEYED}
            SELECT key, count(*) AS n FROM keyed WHERE event_id % 8 NOT IN (5, 6) GROUP BY key""",
        "has_ai_filter": """
            SELECT CAST(n_nationkey AS BIGINT) AS id,
                CAST(CASE WHEN n_regionkey IN (0, 1, 3) THEN 1 ELSE 0 END AS BIGINT) AS has_ai
            FROM nation
            UNION ALL
            SELECT s_suppkey + 1000, 1 FROM supplier WHERE s_suppkey % 10 <> 0""",
        "tools_lookup": """
            WITH versions AS (
                SELECT CAST(n_nationkey AS BIGINT) AS nation, CAST(n_nationkey AS BIGINT) AS id,
                    n_name AS name, -1 AS changed FROM nation
                UNION ALL
                SELECT s_nationkey, s_suppkey + 1000, s_name, s_suppkey % 7
                FROM supplier WHERE s_suppkey % 10 <> 0
            )
            SELECT 'tool' || nation || '.example.com' AS key,
                arg_max(id, changed * 10000000000 + id) AS id,
                arg_max(name, changed * 10000000000 + id) AS name
            FROM versions GROUP BY nation""",
        "tools_latest": """
            WITH versions AS (
                SELECT s_suppkey, s_acctbal + v AS score,
                    1704067200 + (s_suppkey + v) % 3 * 86400 + s_suppkey AS changed
                FROM supplier, (VALUES (0), (1), (2)) AS t(v)
            )
            SELECT s_suppkey AS tool_id, 'tool' || s_suppkey || '.example.com' AS url,
                arg_max(score, changed) AS score,
                strftime(make_timestamp(max(changed) * 1000000), '%Y-%m-%d %H:%M:%S.%g') AS updated
            FROM versions GROUP BY s_suppkey""",
        "drop_audit": f"""WITH {_HOSTS}
            SELECT CASE WHEN event_id % 9 = 0 THEN 'bad_json' WHEN tool_no IS NULL THEN 'no_url'
                WHEN tool_no >= 25 THEN 'no_match'
                WHEN tool_no % 25 IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 1, 3))
                THEN 'kept' ELSE 'not_ai' END AS reason, count(*) AS n
            FROM hosts GROUP BY 1""",
        "reconcile": f"""WITH {_HOSTS}, sums AS (
                SELECT count(*) AS read, count(*) FILTER (event_id % 9 = 0) AS rejected,
                    count(*) FILTER (event_id % 9 <> 0 AND tool_no IN
                        (SELECT n_nationkey FROM nation WHERE n_regionkey IN (0, 1, 3))) AS kept
                FROM hosts)
            SELECT read, kept, rejected, read - kept - rejected AS dropped FROM sums""",
        "violations": _violations(),
        "to_uint": f"""WITH {_NUMBERS}
            SELECT event_id, {_uint(2**8 - 1)} AS as_uint8, {_uint(2**16 - 1)} AS as_uint16,
                {_uint(2**32 - 1)} AS as_uint32, {_uint(2**64 - 1, "VARCHAR")} AS as_uint64
            FROM numbers""",
        "to_float": f"""WITH {_NUMBERS}
            SELECT event_id, CAST(CASE event_id % 8 WHEN 1 THEN value
                WHEN 2 THEN user_id % 10 * 1000.0 WHEN 5 THEN 0.0 WHEN 7 THEN 0.0
                WHEN 6 THEN coalesce(CAST(CAST(whole AS VARCHAR) AS DOUBLE), CAST('99999999999999999999' || user_id AS DOUBLE))
                ELSE CAST(whole AS DOUBLE) END AS DOUBLE) AS value
            FROM numbers""",
        "to_ipv4": f"SELECT event_id, {_IPV4} AS value FROM events",
        "event_time": f"""WITH {_TIMES}, instants AS (
                SELECT event_id, CASE shape WHEN 0 THEN ts WHEN 1 THEN second_start + INTERVAL 5 HOUR
                    WHEN 2 THEN day_start WHEN 3 THEN second_start WHEN 5 THEN day_start
                    WHEN 6 THEN second_start WHEN 7 THEN ts END AS instant
                FROM times)
            SELECT event_id, coalesce(strftime(instant, '%Y-%m-%d %H:%M:%S.%g'), '') AS eventtime
            FROM instants""",
        "event_date_time": f"""WITH {_TIMES}
            SELECT event_id, CASE WHEN shape = 4 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS date,
                CASE WHEN shape = 4 THEN '' WHEN shape IN (2, 5) THEN '00:00:00'
                    ELSE strftime(ts, '%H:%M:%S') END AS time
            FROM times""",
        "cef_header": f"""
            SELECT event_id, {_VENDOR} AS vendor, event_type AS product, '1.0' AS version,
                CAST(event_id AS VARCHAR) AS signature_id, 'user ' || user_id AS name,
                CASE WHEN event_id % 13 = 0 THEN 'High' ELSE CAST(event_id % 11 AS VARCHAR) END
                    AS severity
            FROM events WHERE {_CEF_OK}""",
        "cef_severity": f"SELECT event_id, {_SEVERITY} AS severity FROM events WHERE {_CEF_OK}",
        "cef_extensions": f"""
            SELECT event_id, 'src' AS k, '10.0.0.' || (event_id % 256) AS v FROM events WHERE {_CEF_OK}
            UNION ALL SELECT event_id, 'dst', '10.1.0.' || user_id FROM events WHERE {_CEF_OK}
            UNION ALL SELECT event_id, 'msg', 'a b=c' FROM events WHERE {_CEF_OK}
            UNION ALL SELECT event_id, 'request', 'http://x/?a=' || user_id || '&c=d'
            FROM events WHERE {_CEF_OK}""",
        "cef_extension_text": """
            SELECT page_id, rtrim(html, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))
                AS msg, '10.0.0.1' AS dst FROM pages""",
        "cef_json": f"""
            WITH fixed AS (
                SELECT *, '{{"device_vendor":"' || {_VENDOR} || '","device_product":"' || event_type
                    || '","signature_id":"' || event_id || '",' AS head,
                    '":' || ({_SEVERITY}) || ',"src":"10.0.0.' || (event_id % 256)
                    || '","dst":"10.1.0.' || user_id || '","name":"user ' || user_id || '"' AS tail
                FROM events WHERE {_CEF_OK})
            SELECT event_id,
                head || '"severity' || tail || ',"raw_log":"' || {_CEF_LINE_JSON} || '"}}' AS payload,
                head || '"Severity' || tail
                    || ',"timestamp":"0001-01-01T00:00:00Z","raw_log":""}}' AS legacy
            FROM fixed""",
        "cef_dlq": f"""
            SELECT event_id, '{{"error":"parse_failed","line":' || event_id || ',"raw":"bad '
                || {_CEF_LINE_JSON} || '"}}' AS letter
            FROM events WHERE event_id % 17 = 0""",
        "row_to_map": _customer_cells(),
        "map_to_json": f"""
            WITH cells AS ({_customer_cells()})
            SELECT c_custkey, '{{' || string_agg('"' || k || '":"' || v || '"', ',' ORDER BY k) || '}}'
                AS payload
            FROM cells GROUP BY c_custkey""",
        "parquet_to_map": " UNION ALL ".join(
            f"""SELECT p_partkey, '{c}' AS k, CAST({c} AS VARCHAR) AS v FROM part
                WHERE CAST({c} AS VARCHAR) <> ''"""
            for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
        ),
        "normalize_header": """
            SELECT p_partkey, regexp_replace(lower(p_name || p_brand || p_type), '[^a-z0-9]', '', 'g')
                AS normalized
            FROM part""",
        "header_report": " UNION ALL ".join(
            f"""SELECT CAST({i} AS BIGINT) AS pos, '{c}' AS header,
                '{c.replace("_", "")}' AS normalized,
                count(*) FILTER ({c} IS NOT NULL AND CAST({c} AS VARCHAR) <> ''
                    {"AND c_custkey % 5 <> 0" if c == "c_mktsegment" else ""}) AS non_empty_rows
                FROM customer"""
            for i, c in enumerate(_CUSTOMER_COLUMNS, 1)
        ),
        "route_by_extension": """
            SELECT page_id, CASE WHEN page_id % 5 < 2 THEN 'cef' WHEN page_id % 5 = 2 THEN 'csv'
                WHEN page_id % 5 = 3 THEN 'parquet' ELSE 'unsupported' END AS route
            FROM pages""",
        "row_count": "SELECT count(*) AS n FROM lineitem",
        "window_counts": """
            SELECT strftime(time_bucket(INTERVAL 30 SECOND, ts), '%Y-%m-%d %H:%M:%S.%g')
                AS window_start, count(*) AS n
            FROM events GROUP BY 1""",
        "enriched_window_counts": f"""WITH {_MATCHED}
            SELECT strftime(time_bucket(INTERVAL 30 SECOND, ts), '%Y-%m-%d %H:%M:%S.%g')
                AS window_start, count(*) AS n
            FROM matched GROUP BY 1""",
        "csv_dialect": """
            SELECT 'documents' AS source, doc_id AS id, text FROM documents
            UNION ALL SELECT 'pages', page_id, html FROM pages""",
        "csv_scan": f"""
            WITH texts AS (
                SELECT 'documents' AS source, doc_id AS id, {_LINES.format("text")} AS text FROM documents
                UNION ALL SELECT 'pages', page_id, {_LINES.format("html")} FROM pages)
            SELECT source, id, nullif(text, '') AS text FROM texts""",
        "parse_metrics": """
            SELECT count(*) AS processed, count(*) FILTER (event_id % 17 = 0) AS failed FROM events""",
        "logs_by_month": """
            SELECT CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) AS yyyymm, count(*) AS n
            FROM orders GROUP BY 1""",
        "retention": """
            SELECT CASE WHEN o_orderkey % 10 <> 0 THEN CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) END
                AS yyyymm, count(*) AS n
            FROM orders WHERE o_orderdate >= DATE '2001-08-01' - INTERVAL 90 DAY
                AND (o_orderkey % 10 = 0 OR CAST(strftime(o_orderdate, '%Y%m') AS BIGINT) >= 200105)
            GROUP BY 1""",
    }
