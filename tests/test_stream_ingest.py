"""Streamed ingestion against the checkpoint, and the state store's daily aggregate."""
from clipstar.sources.landing import land_json, read_visitor_events
from clipstar.sources.tables import load_checkpoint
from clipstar.streaming.events import bounded_daily, event_stream, write_closed
from clipstar.streaming.ingest import IngestSink, start_ingest_stream
from tests.helpers import event, events_df


def test_each_micro_batch_meets_the_checkpoint_before_it(spark, tmp_root):
    media = spark.createDataFrame([("m1",), ("m2",)], "media_id string")
    at = [f"{tmp_root}/{x}" for x in ("served", "cp", "landing", "ck")]

    def run():
        start_ingest_stream(spark, at[0], media, at[1], at[2], at[3]).awaitTermination()
        return ({r.media_id: r.last_event_received_at for r in load_checkpoint(spark, at[1]).collect()},
                sorted(r.event_key for r in read_visitor_events(spark, at[2]).collect()))
    day = lambda d, *rows: [event(k, t, "v", 0.1, media_id=m, load_date=d) for k, t, m in rows]
    a, b = ("a", "2025-02-10T00:00:00.000Z", "m1"), ("b", "2025-02-12T00:00:00.000Z", "m1")
    late, other = ("late", "2025-02-11T00:00:00.000Z", "m1"), ("x", "2025-02-11T00:00:00.000Z", "m9")
    land_json(events_df(spark, day("2025-02-12", a, b, other)), at[0], "visitor_stats")
    assert run() == ({"m1": b[1], "m2": None}, ["a", "b"])
    c = ("c", "2025-02-20T00:00:00.000Z", "m1")
    land_json(events_df(spark, day("2025-02-21", a, b, late, c)), at[0], "visitor_stats")
    assert run() == ({"m1": c[1], "m2": None}, ["a", "b", "c"])
    # A replay of the last micro-batch finds its number committed.
    sink = IngestSink(spark, media, at[1], at[2], at[3])
    version = sink.saved.newest()[1]
    sink(read_visitor_events(spark, at[0]), 1)
    assert sink.saved.newest()[1] == version


def test_days_are_given_out_once_when_closed(spark, tmp_root):
    rows = [event("e1", "2025-03-01T10:00:00.000Z", "v1", 0.2), event("e2", "2025-03-01T11:00:00.000Z", "v2", 0.4),
            event("e1", "2025-03-01T10:00:00.000Z", "v1", 0.2), event("e3", "2025-03-02T09:00:00.000Z", "v1", 0.6),
            event("e4", "no time", "v1", 0.6), event(None, "2025-03-01T11:00:00.000Z", "v1", 0.6),
            event("end", "2025-04-01T00:00:00.000Z", "v1", 0.1)]
    land_json(events_df(spark, rows), f"{tmp_root}/land", "visitor_stats")
    days = bounded_daily(event_stream(spark, f"{tmp_root}/land"), "2 days")
    for _ in range(2):  # nothing more the second time
        write_closed(days, f"{tmp_root}/days", f"{tmp_root}/ck").awaitTermination()
    got = sorted((str(r.date), r.plays, r.watched_percent) for r in spark.read.parquet(f"{tmp_root}/days").collect())
    assert got == [("2025-03-01", 2, 0.4), ("2025-03-02", 1, 0.6)]
