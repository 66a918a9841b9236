"""A stream over a landing zone that was written at once meets the days in their order."""
import datetime as dt

from clipstar.plans import landed, stream_queries
from clipstar.plans.star import Star
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET
from clipstar.sources.landing import land_json
from tests.helpers import event, events_df, snapshot, snapshots_df


def test_of_an_event_the_earliest_landing_wins_whichever_file_was_written_first(spark, tmp_root, monkeypatch):
    for day, visitor in (("04", "later"), ("03", "late"), ("02", "first")):
        land_json(events_df(spark, [
            event("e1", f"2025-03-{day}T01:00:00.000Z", visitor, 0.5, load_date=f"2025-03-{day}"),
            event(f"only-{day}", f"2025-03-{day}T02:00:00.000Z", "v", 0.5, load_date=f"2025-03-{day}")]), tmp_root, EVENT_DATASET)
    land_json(snapshots_df(spark, [snapshot()]), tmp_root, MEDIA_DATASET)
    monkeypatch.setattr(landed, "landing_root", lambda *_: tmp_root)
    monkeypatch.setattr(stream_queries, "FILES_PER_TRIGGER", 1)
    rows = {r.event_key: r for r in stream_queries._run_stream(Star(spark, "unused")).read("silver_visitor_events").collect()}
    assert rows.keys() == {"e1", "only-02", "only-03", "only-04"}
    assert (rows["e1"].visitor_key, rows["e1"].date) == ("first", dt.date(2025, 3, 2))
