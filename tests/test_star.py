"""Silver and Gold operators on hand-built records (reference cases + N1-N10)."""
import datetime as dt

from pyspark.sql import functions as F

from clipstar.operators import dims, fact, marts, silver
from tests.helpers import MEDIA, event, events_df, snapshot, snapshots_df


def test_flatten_snapshot(spark):
    s = silver.silver_media_stats(snapshots_df(spark, [snapshot()])).collect()
    assert len(s) == 1
    r = s[0]
    assert (r.media_id, r.title, r.url, r.duration_seconds, r.play_count) == (
        MEDIA, "harbour walk", "https://v.example.test/s/a", 640.5, 120)
    assert r.load_date == dt.date(2025, 3, 2)
    assert r.updated_at == dt.datetime(2025, 3, 2, 9, 0)


def test_latest_snapshot_and_channel_mapping(spark):
    rows = [snapshot(load_date="2025-03-01", updated="2025-03-01T09:00:00+00:00", name="old"),
            snapshot(load_date="2025-03-02", updated="2025-03-02T23:10:00+00:00", name="new")]
    sm = silver.silver_media_stats(snapshots_df(spark, rows))
    d = dims.dim_media(sm, channel_mapping={MEDIA: "Vimeo"}).collect()
    assert [(r.title, r.channel) for r in d] == [("new", "Vimeo")]


def test_default_channel_when_unmapped(spark):
    sm = silver.silver_media_stats(snapshots_df(spark, [snapshot()]))
    assert dims.dim_media(sm, channel_mapping={}).first().channel == "Unknown"
    assert dims.dim_media(sm, channel_mapping={"other": "X"}).first().channel == "Unknown"


def test_channel_mapping_as_table_and_json(spark):
    from clipstar.functions.channel import mapping_from_json
    sm = silver.silver_media_stats(snapshots_df(spark, [snapshot(), snapshot(media_id="m-beta")]))
    table = mapping_from_json(spark, '{"m-alpha": "Web"}')
    got = {r.media_id: r.channel for r in dims.dim_media(sm, channel_mapping=table).collect()}
    assert got == {"m-alpha": "Web", "m-beta": "Unknown"}
    big = {f"k{i}": "Z" for i in range(1500)} | {"m-beta": "Big"}
    got = {r.media_id: r.channel for r in dims.dim_media(sm, channel_mapping=big).collect()}
    assert got == {"m-alpha": "Unknown", "m-beta": "Big"}


def test_null_updated_sorts_last(spark):
    rows = [snapshot(load_date="2025-03-05", updated=None, name="no-update"),
            snapshot(load_date="2025-03-01", updated="2025-03-01T09:00:00+00:00", name="dated")]
    sm = silver.silver_media_stats(snapshots_df(spark, rows))
    assert dims.dim_media(sm).first().title == "dated"
    # play_rate follows load_date only: the newer (undated) snapshot wins there.
    rows[0] = snapshot(load_date="2025-03-05", updated=None, play_rate=0.9)
    sm = silver.silver_media_stats(snapshots_df(spark, rows))
    assert dims.latest_play_rate(sm).first().play_rate == 0.9


def test_dedup_by_event_key(spark):
    ev = [event("e1", "2025-03-02T01:13:57.000Z", "v-a", 0.5),
          event("e1", "2025-03-02T01:13:57.000Z", "v-a", 0.5, load_date="2025-03-03"),
          event("e2", "2025-03-02T02:00:00.000Z", "v-a", 0.2),
          event(None, "2025-03-02T02:00:00.000Z", "v-a", 0.2)]
    assert silver.silver_visitor_events(events_df(spark, ev)).count() == 2


def test_latest_visitor_attributes(spark):
    ev = [event("e1", "2025-03-02T01:00:00.000Z", "v-a", 0.1, ip="198.51.100.1", country="NZ"),
          event("e2", "2025-03-02T05:00:00.000Z", "v-a", 0.2, ip="198.51.100.2", country="AU")]
    d = dims.dim_visitor(silver.silver_visitor_events(events_df(spark, ev))).collect()
    assert [(r.visitor_id, r.ip_address, r.country) for r in d] == [("v-a", "198.51.100.2", "AU")]


def _fact(spark, ev, snaps=None):
    sm = silver.silver_media_stats(snapshots_df(spark, snaps or [
        snapshot(duration=1000.0, play_rate=0.05)]))
    se = silver.silver_visitor_events(events_df(spark, ev))
    return fact.fact_media_engagement(se, sm)


def test_fact_grain_and_measures(spark):
    ev = [event("e1", "2025-03-02T01:00:00.000Z", "v-a", 0.10),
          event("e2", "2025-03-02T02:00:00.000Z", "v-a", 0.30),
          event("e3", "2025-03-03T01:00:00.000Z", "v-a", 0.50)]
    rows = {(r.date.isoformat(), r.visitor_id): r for r in _fact(spark, ev).collect()}
    d1, d2 = rows[("2025-03-02", "v-a")], rows[("2025-03-03", "v-a")]
    assert (d1.play_count, d1.watched_percent, round(d1.total_watch_time, 6), d1.play_rate) == (
        2, 0.30, 400.0, 0.05)
    assert (d2.play_count, d2.watched_percent) == (1, 0.50)


def test_malformed_timestamp_drops_from_fact(spark):
    ev = [event("e1", "not-a-time", "v-a", 0.1), event("e2", "", "v-a", 0.1),
          event("e3", "2025-03-02T01:00:00.000Z", "v-a", 0.1)]
    se = silver.silver_visitor_events(events_df(spark, ev))
    assert se.where(F.col("date").isNull()).count() == 2
    assert _fact(spark, ev).count() == 1


def test_date_is_the_written_date(spark):
    ev = [event("e1", "2025-03-02T23:30:00-05:00", "v-a", 0.1)]
    r = silver.silver_visitor_events(events_df(spark, ev)).first()
    assert r.date == dt.date(2025, 3, 2)
    assert r.received_at == dt.datetime(2025, 3, 3, 4, 30)


def test_null_visitor_one_dim_row_not_in_fact(spark):
    ev = [event("e1", "2025-03-02T01:00:00.000Z", None, 0.1, country="NZ"),
          event("e2", "2025-03-02T03:00:00.000Z", None, 0.1, country="FJ"),
          event("e3", "2025-03-02T01:00:00.000Z", "v-a", 0.1)]
    d = dims.dim_visitor(silver.silver_visitor_events(events_df(spark, ev))).collect()
    assert sorted((r.visitor_id or "", r.country) for r in d) == [("", "FJ"), ("v-a", "NZ")]
    assert [r.visitor_id for r in _fact(spark, ev).collect()] == ["v-a"]


def test_unknown_and_null_media(spark):
    ev = [event("e1", "2025-03-02T01:00:00.000Z", "v-a", 0.4, media_id="m-missing"),
          event("e2", "2025-03-02T01:00:00.000Z", "v-a", 0.4, media_id=None)]
    rows = _fact(spark, ev).collect()
    assert len(rows) == 2
    assert all(r.total_watch_time == 0.0 and r.play_rate is None for r in rows)
    sm = silver.silver_media_stats(snapshots_df(spark, [snapshot()]))
    by_media = marts.engagement_by_media(_fact(spark, ev), dims.dim_media(sm))
    assert by_media.count() == 0


def test_all_null_percent_keeps_plays(spark):
    ev = [event("e1", "2025-03-02T01:00:00.000Z", "v-a", None),
          event("e2", "2025-03-02T02:00:00.000Z", "v-a", None)]
    r = _fact(spark, ev).first()
    assert (r.play_count, r.total_watch_time, r.watched_percent) == (2, None, None)


def test_ties_resolve_the_same_way(spark):
    same = "2025-03-02T09:00:00+00:00"
    rows = [snapshot(name="b", updated=same), snapshot(name="a", updated=same)]  # of one day
    for order in (rows, rows[::-1]):
        sm = silver.silver_media_stats(snapshots_df(spark, order).repartition(3))
        assert dims.dim_media(sm).first().title == "b"
    ev = [event("e2", "2025-03-02T01:00:00.000Z", "v-a", 0.1, ip="198.51.100.2"),
          event("e1", "2025-03-02T01:00:00.000Z", "v-a", 0.1, ip="198.51.100.1")]
    d = dims.dim_visitor(silver.silver_visitor_events(events_df(spark, ev))).first()
    assert d.ip_address == "198.51.100.2"


def test_title_collision_merges_and_unweighted_average(spark):
    snaps = [snapshot(media_id="m1", name="same"), snapshot(media_id="m2", name="same")]
    ev = [event("e1", "2025-03-02T01:00:00.000Z", "v-a", 0.2, media_id="m1"),
          event("e2", "2025-03-02T01:00:00.000Z", "v-b", 1.0, media_id="m2"),
          event("e3", "2025-03-02T02:00:00.000Z", "v-b", 1.0, media_id="m2")]
    f = _fact(spark, ev, snaps)
    sm = silver.silver_media_stats(snapshots_df(spark, snaps))
    rows = marts.engagement_by_media(f, dims.dim_media(sm)).collect()
    assert [(r.title, r.plays) for r in rows] == [("same", 3)]
    k = marts.kpi_summary(f).first()
    assert (k.total_plays, k.unique_visitors, k.avg_watched_percent) == (3, 2, 60.0)


def test_kpi_filled_on_empty_fact(spark):
    empty = _fact(spark, [event("e1", "bad", "v-a", 0.1)])
    assert tuple(marts.kpi_summary_filled(empty).first()) == (0, 0, 0, 0)


def test_top_countries_plans_take_ordered(spark, capsys):
    ev = [event(f"e{i}", "2025-03-02T01:00:00.000Z", f"v{i}", 0.1, country=f"C{i % 30}")
          for i in range(90)]
    top = marts.top_countries(dims.dim_visitor(silver.silver_visitor_events(events_df(spark, ev))))
    assert top.count() == 20
    top.explain()
    assert "TakeOrderedAndProject" in capsys.readouterr().out


def test_same_day_snapshot_is_replaced_by_the_last_landed(spark):
    rows = [snapshot(name="first", play_rate=0.9, ingest_seq=1), snapshot(name="second", play_rate=0.2, ingest_seq=2),
            snapshot(name="other day", load_date="2025-03-01", play_rate=0.5, ingest_seq=3)]
    for order in (rows, rows[::-1]):
        sm = silver.silver_media_stats(snapshots_df(spark, order).repartition(3))
        assert sorted(r.title for r in sm.collect()) == ["other day", "second"]
        assert dims.latest_play_rate(sm).first().play_rate == 0.2
