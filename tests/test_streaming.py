"""Streaming paths on small landed files."""
from clipstar.plans.build import Curated
from clipstar.sources.landing import land_json
from clipstar.streaming.events import bounded_silver_stream, event_stream, start_event_stream
from tests.helpers import event, events_df


def _landing(spark, root):
    rows = [event("e1", "2025-03-01T10:00:00.000Z", "v1", 0.2, load_date="2025-03-01"),
            event("e2", "2025-03-01T11:00:00.000Z", "v2", 0.4, load_date="2025-03-01"),
            event("e1", "2025-03-01T10:00:00.000Z", "v1", 0.2, load_date="2025-03-02"),
            event("e3", "2025-03-02T09:00:00.000Z", "v1", 0.6, load_date="2025-03-02")]
    land_json(events_df(spark, rows), root, "visitor_stats")


def test_exact_stream_dedups_across_batches(spark, tmp_root):
    _landing(spark, f"{tmp_root}/land")
    q = start_event_stream(spark, f"{tmp_root}/land", f"{tmp_root}/cur", f"{tmp_root}/ck", max_files_per_trigger=1)
    q.awaitTermination()
    cur = Curated.current(spark, f"{tmp_root}/cur")
    assert sorted(r.event_key for r in cur.read("silver_visitor_events").collect()) == ["e1", "e2", "e3"]
    fb = {(r.visitor_id, str(r.date)): r.play_count for r in cur.read("fact_base").collect()}
    assert fb == {("v1", "2025-03-01"): 1, ("v2", "2025-03-01"): 1, ("v1", "2025-03-02"): 1}


def test_bounded_state_stream_dedups_within_delay(spark, tmp_root):
    _landing(spark, f"{tmp_root}/land")
    out = bounded_silver_stream(event_stream(spark, f"{tmp_root}/land", max_files_per_trigger=1),
                                "2 days")
    q = out.writeStream.format("parquet").option("path", f"{tmp_root}/bounded") \
        .option("checkpointLocation", f"{tmp_root}/ck2").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted(r.event_key for r in spark.read.parquet(f"{tmp_root}/bounded").collect())
    assert got == ["e1", "e2", "e3"]
