"""DuckDB SQL for the same adapter, used as the independent correctness
oracle.  Written as plain window/aggregate SQL (ROW_NUMBER for "latest"),
deliberately not the same formulation as the Spark operators."""

GEO = """geo AS (
  SELECT c.c_custkey AS user_id, n.n_name AS country
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)"""

MEDIA_ID = ("CASE WHEN e.event_id % 50 = 19 THEN 'unlisted-' || CAST(e.event_id % 10 AS VARCHAR) "
            "WHEN e.event_id % 50 <> 9 THEN CAST(e.event_id % 10 AS VARCHAR) END")
PERCENT = "CASE WHEN e.event_id % 20 <> 4 THEN CAST(json_extract_string(e.props, '$.k') AS DOUBLE) / 100.0 END"


def _text(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%dT%H:%M:%S.%g')"


RECEIVED = f"""CASE WHEN e.event_id % 101 = 5 THEN '0-' || {_text('e.ts')} || 'Z'
              WHEN e.event_id % 103 = 6 THEN {_text("e.ts + INTERVAL '330 minutes'")} || '+05:30'
              ELSE {_text('e.ts')} || 'Z' END"""
COPY_RECEIVED = f"""CASE WHEN e.event_id % 3 = 0 THEN {_text("e.ts + INTERVAL '1 day'")} || 'Z'
              WHEN e.event_id % 3 = 1 THEN '0-' || {_text('e.ts')} || 'Z' ELSE {RECEIVED} END"""

# Silver visitor events: each event once, as first landed (its copies come a day later).
SILVER_EVENTS = f"""silver_events AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_key,
         {MEDIA_ID} AS media_id,
         CASE WHEN e.event_type = 'error' THEN NULL ELSE CAST(e.user_id AS VARCHAR) END AS visitor_key,
         CASE WHEN e.event_id % 101 <> 5 THEN date_trunc('millisecond', e.ts) END AS received_at,
         CASE WHEN e.event_id % 101 = 5 THEN NULL
              WHEN e.event_id % 103 = 6 THEN CAST(e.ts + INTERVAL '330 minutes' AS DATE)
              ELSE CAST(e.ts AS DATE) END AS date,
         '192.0.2.' || CAST(e.event_id % 256 AS VARCHAR) AS ip,
         g.country AS country,
         {PERCENT} AS percent_viewed
  FROM events e LEFT JOIN geo g ON e.user_id = g.user_id
)"""

# Bronze visitor events as landed: each event, plus a copy landed the next
# day for events in the last two hours of a day.
BRONZE_EVENTS = f"""api_rows AS (
  SELECT CAST(e.event_id AS VARCHAR) AS event_key,
         {RECEIVED} AS received_at,
         {COPY_RECEIVED} AS copy_received_at,
         {MEDIA_ID} AS media_id,
         CASE WHEN e.event_type = 'error' THEN NULL ELSE CAST(e.user_id AS VARCHAR) END AS visitor_key,
         g.country AS country,
         {PERCENT} AS percent_viewed,
         e.event_type AS browser,
         CAST(e.ts AS DATE) AS load_date,
         hour(e.ts) >= 22 AS relanded
  FROM events e LEFT JOIN geo g ON e.user_id = g.user_id
), bronze_events AS (
  SELECT event_key, received_at, media_id, visitor_key, country, percent_viewed, browser, load_date
  FROM api_rows
  UNION ALL
  SELECT event_key, copy_received_at, media_id, visitor_key, country, percent_viewed, browser,
         load_date + 1
  FROM api_rows WHERE relanded
)"""

# Ingestion model: arrival = ts + value hours; the previous run was on 2024-01-15, this run, dated 2024-02-01, is
# served every event.
PREVIOUS_RUN_EPOCH = 1705276800.0
INGEST = f"""api AS (
  SELECT {MEDIA_ID} AS media_id,
         CAST(e.event_id AS VARCHAR) AS event_key,
         {RECEIVED} AS received_at,
         epoch_us(e.ts) / 1e6 + e.value * 3600 AS arrival
  FROM events e
), processed AS (
  SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS media_id FROM part
), prev_cand AS (
  SELECT * FROM api WHERE arrival <= {PREVIOUS_RUN_EPOCH}
), cand AS (
  SELECT * FROM api
), prev_cp AS (
  SELECT p.media_id,
         MAX(CASE WHEN COALESCE(c.received_at, '') <> '' THEN c.received_at END) AS last_event_received_at,
         TIMESTAMP '2024-01-15 00:00:00' AS last_ingested_at
  FROM processed p LEFT JOIN prev_cand c ON p.media_id = c.media_id
  GROUP BY p.media_id
), new_ev AS (
  SELECT c.* FROM cand c LEFT JOIN prev_cp p ON c.media_id = p.media_id
  WHERE COALESCE(p.last_event_received_at, '') = '' OR COALESCE(c.received_at, '') = ''
     OR c.received_at > p.last_event_received_at
), newest AS (
  SELECT media_id, MAX(received_at) AS nx FROM new_ev
  WHERE COALESCE(received_at, '') <> '' GROUP BY media_id
), cp2 AS (
  SELECT COALESCE(o.media_id, p.media_id) AS media_id,
         CASE WHEN p.media_id IS NULL OR n.nx IS NULL THEN o.last_event_received_at
              WHEN NULLIF(o.last_event_received_at, '') IS NULL OR n.nx > o.last_event_received_at
                THEN n.nx
              ELSE o.last_event_received_at END AS last_event_received_at,
         CASE WHEN p.media_id IS NOT NULL THEN TIMESTAMP '2024-02-01 00:00:00'
              ELSE o.last_ingested_at END AS last_ingested_at
  FROM prev_cp o FULL OUTER JOIN processed p ON o.media_id = p.media_id
  LEFT JOIN newest n ON p.media_id = n.media_id
)"""

SILVER_MEDIA = """landed_media AS (
  SELECT CAST(l.l_partkey AS VARCHAR) AS media_id,
         CASE WHEN l.l_partkey % 5 IN (1, 2) THEN 'Untitled' ELSE p.p_name END AS title,
         'https://media.example.test/s/' || CAST(l.l_orderkey AS VARCHAR) || '-'
             || CAST(l.l_linenumber AS VARCHAR) AS url,
         l.l_extendedprice AS duration_seconds,
         o.o_orderdate AS created_at,
         CASE WHEN o.o_orderstatus = 'P' THEN NULL ELSE o.o_orderdate END AS updated_at,
         CAST(date_trunc('month', l.l_shipdate) AS DATE) AS load_date,
         CAST(l.l_quantity * 10 AS BIGINT) AS load_count,
         CAST(l.l_quantity AS BIGINT) AS play_count,
         l.l_discount AS play_rate,
         l.l_tax * 100 AS hours_watched,
         l.l_tax AS engagement,
         CAST(l.l_linenumber AS BIGINT) AS visitors,
         CAST(l.l_orderkey * 8 + l.l_linenumber AS BIGINT) AS ingest_seq
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
), silver_media AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY media_id, load_date ORDER BY ingest_seq DESC) AS rn
    FROM landed_media) WHERE rn = 1
)"""

MEDIA_LATEST = """media_latest AS (
  SELECT media_id, title, url, created_at, duration_seconds FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY media_id
        ORDER BY updated_at DESC NULLS LAST, load_date DESC NULLS LAST,
                 duration_seconds DESC NULLS LAST, title DESC NULLS LAST,
                 url DESC NULLS LAST, created_at DESC NULLS LAST) AS rn
    FROM silver_media) WHERE rn = 1
)"""

PLAY_RATE = """play_rate_latest AS (
  SELECT media_id, play_rate FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY media_id
        ORDER BY load_date DESC NULLS LAST) AS rn
    FROM silver_media) WHERE rn = 1
)"""

CHANNEL_MAP = """channel_map AS (
  SELECT CAST(p_partkey AS VARCHAR) AS media_id, p_brand AS channel
  FROM part WHERE p_type <> 'ECONOMY' AND p_partkey % 5 NOT IN (1, 2)
)"""

DIM_MEDIA = """dim_media AS (
  SELECT m.media_id, m.title, m.url, COALESCE(c.channel, 'Unknown') AS channel, m.created_at,
         m.duration_seconds
  FROM media_latest m LEFT JOIN channel_map c ON m.media_id = c.media_id
)"""

DIM_VISITOR = """dim_visitor AS (
  SELECT visitor_key AS visitor_id, ip AS ip_address, country FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY visitor_key
        ORDER BY received_at DESC NULLS LAST, event_key DESC NULLS LAST) AS rn
    FROM silver_events) WHERE rn = 1
)"""

DAILY = """daily AS (
  SELECT media_id, visitor_key AS visitor_id, date,
         COUNT(event_key) AS play_count,
         MAX(percent_viewed) AS watched_percent,
         SUM(percent_viewed) AS percent_viewed_sum
  FROM silver_events
  WHERE visitor_key IS NOT NULL AND date IS NOT NULL
  GROUP BY media_id, visitor_key, date
)"""

FACT = """fact AS (
  SELECT d.media_id, d.visitor_id, d.date, d.play_count, r.play_rate,
         d.percent_viewed_sum * COALESCE(m.duration_seconds, 0.0) AS total_watch_time,
         d.watched_percent
  FROM daily d
  LEFT JOIN media_latest m ON d.media_id = m.media_id
  LEFT JOIN play_rate_latest r ON d.media_id = r.media_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# The full star schema as CTEs, in dependency order.
STAR = (GEO, SILVER_EVENTS, SILVER_MEDIA, MEDIA_LATEST, PLAY_RATE, CHANNEL_MAP, DIM_MEDIA,
        DIM_VISITOR, DAILY, FACT)
