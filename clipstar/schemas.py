"""Landed (Bronze) record layouts and the schemas of the curated tables.

FIXED VALUES: the field names below are the video host's API field names
and must stay exactly as written for landed JSON to parse.
"""

# One JSON object per media per day: the media metadata and its stats.
MEDIA_SNAPSHOT_DDL = (
    "media STRUCT<id: BIGINT, hashed_id: STRING, type: STRING, archived: BOOLEAN, "
    "name: STRING, duration: DOUBLE, created: STRING, updated: STRING, status: STRING, "
    "tags: ARRAY<STRING>, project: STRUCT<id: BIGINT, hashed_id: STRING, name: STRING>, "
    "share_link: STRUCT<hashed_id: STRING, url: STRING, visibility: STRING>>, "
    "stats STRUCT<load_count: BIGINT, play_count: BIGINT, play_rate: DOUBLE, "
    "hours_watched: DOUBLE, engagement: DOUBLE, visitors: BIGINT>, "
    # Written by landing: its number, which rises from landing to landing, and the record's place in it.
    "landing BIGINT, ingest_seq BIGINT"
)

# One visitor play event; the API returns pages (JSON arrays) of these.
VISITOR_EVENT_DDL = (
    "received_at STRING, event_key STRING, ip STRING, country STRING, region STRING, "
    "city STRING, lat DOUBLE, lon DOUBLE, org STRING, percent_viewed DOUBLE, "
    "visitor_key STRING, user_agent_details STRUCT<browser: STRING, browser_version: STRING, "
    "platform: STRING, mobile: BOOLEAN>, media_id STRING, media_name STRING, "
    "media_url STRING, thumbnail STRUCT<url: STRING, width: BIGINT, height: BIGINT>"
)

# Raw dataset folder names under the landing root.
MEDIA_DATASET = "media_stats"
EVENT_DATASET = "visitor_stats"
PARTITION_COLUMN = "load_date"

# What reading a record in its file adds: its text where it could not be read as declared, and the file.
AUDIT_DDL = "malformed STRING, file STRING"
QUARANTINE_COLUMNS = ["file", "load_date", "malformed"]

# Curated tables by name.  ``batch`` is the landing batch that wrote the row.
TABLES = {
    "bronze_media_stats": f"{MEDIA_SNAPSHOT_DDL}, load_date DATE, {AUDIT_DDL}, batch STRING",
    "bronze_visitor_events": f"{VISITOR_EVENT_DDL}, load_date DATE, {AUDIT_DDL}, batch STRING",
    "silver_media_stats": (
        "media_id STRING, title STRING, url STRING, duration_seconds DOUBLE, created_at TIMESTAMP_NTZ, "
        "updated_at TIMESTAMP_NTZ, load_count BIGINT, play_count BIGINT, play_rate DOUBLE, hours_watched DOUBLE, "
        "engagement DOUBLE, visitors BIGINT, landing BIGINT, ingest_seq BIGINT, load_date DATE"),
    "silver_visitor_events": (
        "event_key STRING, media_id STRING, visitor_key STRING, received_at TIMESTAMP_NTZ, ip STRING, "
        "country STRING, percent_viewed DOUBLE, date DATE"),
    "fact_base": (
        "media_id STRING, visitor_id STRING, play_count BIGINT, watched_percent DOUBLE, "
        "percent_viewed_sum DOUBLE, date DATE"),
    "fact_media_engagement": (
        "media_id STRING, visitor_id STRING, play_count BIGINT, play_rate DOUBLE, total_watch_time DOUBLE, "
        "watched_percent DOUBLE, date DATE"),
    # Sums of a day's facts by media, from which the marts are made.
    "mart_days": (
        "media_id STRING, date DATE, fact_rows BIGINT, plays BIGINT, watch_time DOUBLE, watched_sum DOUBLE, "
        "watched_count BIGINT"),
    "dim_media": "media_id STRING, title STRING, url STRING, channel STRING, created_at TIMESTAMP_NTZ",
    "dim_visitor": "visitor_id STRING, ip_address STRING, country STRING",
}

# States from which the dimensions are maintained.  Of a media's rows, those of a version before one that was picked
# anew no longer count.
MEDIA_STATE_DDL = (
    "media_id STRING, dim_pick STRUCT<updated_at: TIMESTAMP_NTZ, load_date: DATE, duration_seconds: DOUBLE, "
    "title: STRING, url: STRING, created_at: TIMESTAMP_NTZ>, "
    "rate_pick STRUCT<load_date: DATE, play_rate: DOUBLE>, version BIGINT, anew BOOLEAN"
)
FACT_VISITORS_DDL = "visitor_id STRING"
# Per media and 32,768 days a bitmap of the days it has facts on.
MEDIA_DAYS_DDL = "media_id STRING, span BIGINT, days BINARY"
VISITOR_STATE_DDL = (
    "visitor_key STRING, pick STRUCT<received_at: TIMESTAMP_NTZ, event_key: STRING, ip: STRING, country: STRING>"
)

CHECKPOINT_DDL = "media_id STRING, last_event_received_at STRING, last_ingested_at TIMESTAMP_NTZ"
