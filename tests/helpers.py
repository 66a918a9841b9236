"""Hand-built landed records (own values; shapes follow the API)."""
from __future__ import annotations

import datetime as dt

from clipstar.schemas import MEDIA_SNAPSHOT_DDL, VISITOR_EVENT_DDL

MEDIA = "m-alpha"


# FIXED VALUES: the API's field names.
def snapshot(media_id=MEDIA, load_date="2025-03-02", updated="2025-03-02T09:00:00+00:00",
             name="harbour walk", duration=640.5, play_rate=0.21, url="https://v.example.test/s/a",
             ingest_seq=None):
    media = {"id": 7, "hashed_id": media_id, "type": "Video", "archived": False, "name": name,
             "duration": duration, "created": "2025-01-15T08:00:00+00:00", "updated": updated,
             "status": "ready", "tags": ["demo"],
             "project": {"id": 3, "hashed_id": "p-one", "name": "Demos"},
             "share_link": {"hashed_id": "s-1", "url": url, "visibility": "public"}}
    stats = {"load_count": 400, "play_count": 120, "play_rate": play_rate,
             "hours_watched": 12.5, "engagement": 0.4, "visitors": 300}
    return {"media": media, "stats": stats, "landing": None, "ingest_seq": ingest_seq, "load_date": dt.date.fromisoformat(load_date)}


def event(key, received_at, visitor, pv, media_id=MEDIA, ip="198.51.100.10", country="NZ",
          load_date="2025-03-02"):
    return {"received_at": received_at, "event_key": key, "ip": ip, "country": country,
            "region": None, "city": None, "lat": None, "lon": None, "org": None,
            "percent_viewed": pv, "visitor_key": visitor,
            "user_agent_details": {"browser": "Firefox", "browser_version": "130",
                                   "platform": "Linux", "mobile": False},
            "media_id": media_id, "media_name": None, "media_url": None, "thumbnail": None,
            "load_date": dt.date.fromisoformat(load_date)}


def snapshots_df(spark, rows):
    return spark.createDataFrame(rows, f"{MEDIA_SNAPSHOT_DDL}, load_date DATE")


def events_df(spark, rows):
    return spark.createDataFrame(rows, f"{VISITOR_EVENT_DDL}, load_date DATE")
