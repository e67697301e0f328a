"""DuckDB SQL oracles for the registered queries.

``CTES`` restates the test-data mapping of ``crowdpulse.sources.testmap`` in
SQL, written independently of the Spark operators; each oracle is
``WITH <needed ctes> <body>``. Ratios are cast to DOUBLE and rounded values go
through DECIMAL(38,10) first, as on the Spark side.
"""

from __future__ import annotations

WINDOW_SQL = "INTERVAL 1 HOUR"
SPAN_SQL = "INTERVAL 2 HOUR"

# name -> (dependencies, SQL)
CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev_k": ((), """
SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events"""),
    "pe_base": (("ev_k",), """
SELECT CAST(e.event_id AS VARCHAR) AS event_id,
       CAST(e.user_id AS VARCHAR) AS session_id,
       CAST(e.user_id AS VARCHAR) AS user_id,
       e.ts AS "timestamp",
       CASE e.event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'buffer_start'
            WHEN 'purchase' THEN 'buffer_end' WHEN 'signup' THEN 'video_start'
            ELSE CASE e.k % 10 WHEN 0 THEN 'video_end' WHEN 1 THEN 'ad_start' WHEN 2 THEN 'ad_end'
                 ELSE 'heartbeat' END END AS event_type,
       'ch-' || CAST(e.user_id % 25 AS VARCHAR) AS content_id,
       r.r_name AS region,
       CASE e.k % 4 WHEN 0 THEN 'smart_tv' WHEN 1 THEN 'mobile' WHEN 2 THEN 'web' WHEN 3 THEN 'tablet' END AS device,
       CASE e.k % 3 WHEN 0 THEN 'cdn-a' WHEN 1 THEN 'cdn-b' WHEN 2 THEN 'cdn-c' END AS cdn,
       CAST(floor(e.value * 100) AS INTEGER) AS bitrate_kbps,
       e.k * 100 AS buffer_length_ms,
       CASE WHEN e.event_type = 'error' THEN 'E' || CAST(e.k AS VARCHAR) END AS error_code,
       CASE WHEN e.k % 7 = 0 THEN 'v2' END AS schema_version,
       CASE WHEN e.k % 7 = 0 THEN CASE e.k % 3 WHEN 0 THEN 'wifi' WHEN 1 THEN 'cellular' WHEN 2 THEN 'ethernet' END
            END AS network_type,
       e.k
FROM ev_k e LEFT JOIN region r ON r.r_regionkey = e.user_id % 5"""),
    # the feed as delivered: exact replays (k >= 95) and 3 s re-sends (90 <= k < 95)
    "pe_feed": (("pe_base",), """
SELECT * FROM pe_base
UNION ALL SELECT * FROM pe_base WHERE k >= 95
UNION ALL SELECT * REPLACE ("timestamp" + INTERVAL 3 SECOND AS "timestamp")
          FROM pe_base WHERE k >= 90 AND k < 95"""),
    "player_events": (("pe_feed",), """
SELECT * EXCLUDE (k) FROM pe_feed"""),
    # the feed after JSON parse + required-field filter: k = 13 (malformed) and
    # k = 17 (no cdn) are dropped, k = 19 loses its bitrate, times are in ms
    "pe_parsed": (("pe_feed",), """
SELECT * REPLACE (date_trunc('millisecond', "timestamp") AS "timestamp",
                  CASE WHEN k = 19 THEN NULL ELSE bitrate_kbps END AS bitrate_kbps)
FROM pe_feed WHERE k NOT IN (13, 17)"""),
    "markers": (("ev_k",), """
SELECT CAST(event_id AS VARCHAR) AS marker_id,
       'ch-' || CAST(event_id % 25 AS VARCHAR) AS channel,
       'splice_insert' AS splice_command,
       k AS event_id_scte,
       TRUE AS out_of_network,
       (epoch_us(ts) * 9) // 100 AS pts_time,
       ts AS wallclock,
       (k % 31) * 30 AS duration_s,
       CASE k % 10 WHEN 0 THEN 'program_boundary' WHEN 1 THEN 'blackout' ELSE 'commercial' END AS break_type
FROM ev_k WHERE event_type = 'signup'"""),
    "ad_decisions": ((), """
SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) || '-'
       || CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS decision_id,
       CAST(l.l_orderkey AS VARCHAR) AS marker_id,
       'ch-' || CAST(l.l_orderkey % 25 AS VARCHAR) AS channel,
       l.l_linenumber AS slot_index,
       CAST(l.l_partkey AS VARCHAR) AS creative_id,
       CAST(l.l_suppkey AS VARCHAR) AS advertiser_id,
       s.s_name AS advertiser_name,
       l.l_extendedprice AS price_cpm_brl,
       CAST(l.l_shipdate AS TIMESTAMP) AS served_ts
FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey"""),
    "content_metadata": ((), """
SELECT ' ch-' || CAST(n.n_nationkey AS VARCHAR) || ' ' AS content_id,
       n.n_name AS title, r.r_name AS genre,
       TIMESTAMP '2024-01-01 00:00:00' + n.n_nationkey * INTERVAL 1 DAY AS rights_window_start,
       TIMESTAMP '2024-01-01 00:00:00' + (n.n_nationkey + 20) * INTERVAL 1 DAY AS rights_window_end,
       [r.r_name, 'AMERICA'] AS rights_territories,
       TIMESTAMP '2023-12-01 00:00:00' AS updated_at
FROM nation n LEFT JOIN region r ON r.r_regionkey = n.n_regionkey"""),
    "content_versions": (("content_metadata",), """
SELECT * FROM content_metadata
UNION ALL
SELECT content_id, title || ' (v2)' AS title, genre, rights_window_start, rights_window_end, rights_territories,
       TIMESTAMP '2024-01-15 00:00:00'
         + CAST(regexp_extract(trim(content_id), '(\\d+)$', 1) AS INTEGER) * INTERVAL 1 HOUR AS updated_at
FROM content_metadata"""),
    # Silver (A1) on the mapping: exact CCV, hour windows, 2 h span
    "ev_dedup": (("player_events",), """
SELECT DISTINCT * FROM player_events"""),
    "ev_marked": (("ev_dedup", "markers"), f"""
SELECT e.*, COALESCE(m.marker_id, 'conteudo_regular') AS marker_key
FROM ev_dedup e LEFT JOIN markers m
  ON e.content_id = m.channel AND e."timestamp" >= m.wallclock AND e."timestamp" <= m.wallclock + {SPAN_SQL}"""),
    "silver": (("ev_marked",), f"""
SELECT time_bucket({WINDOW_SQL}, "timestamp") AS window_start,
       time_bucket({WINDOW_SQL}, "timestamp") + {WINDOW_SQL} AS window_end,
       COALESCE(region, 'unknown') AS region, COALESCE(device, 'unknown') AS device, cdn,
       marker_key AS marker_id,
       CAST(COUNT(DISTINCT session_id) AS BIGINT) AS ccv,
       CAST(ROUND(CAST(AVG(bitrate_kbps) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_bitrate_kbps,
       CAST(ROUND(CAST(AVG(buffer_length_ms) AS DECIMAL(38,10)), 4) AS DOUBLE) AS avg_buffer_length_ms,
       CAST(SUM(CASE WHEN error_code IS NOT NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) AS error_rate,
       CAST(SUM(CASE WHEN event_type IN ('buffer_start') THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)
         AS rebuffering_ratio,
       CAST(COUNT(*) AS BIGINT) AS event_count,
       CAST(SUM(CASE WHEN error_code IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM ev_marked
GROUP BY 1, 2, 3, 4, 5, 6"""),
}


def with_ctes(body: str, *needed: str) -> str:
    """``WITH`` the transitive closure of ``needed`` CTEs (dependency order)."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    body = body.strip()
    if not order:
        return body
    parts = ",\n".join(f"{n} AS ({CTES[n][1]}\n)" for n in order)
    if body[:5].upper() == "WITH ":
        return f"WITH {parts},\n{body[5:]}"
    return f"WITH {parts}\n{body}"
