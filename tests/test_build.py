"""Batch builds: incremental update equals full rebuild on every table, also
when it fails after any write and is run again."""
import datetime as dt
import os
import threading
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clipstar.operators import marts
from clipstar.plans import adapters, build
from clipstar.plans.build import Curated, full_rebuild, incremental_update
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET
from clipstar.sources.landing import land_json
from clipstar.plans.ingest import ingest_run
from clipstar.sources.commits import Commits
from clipstar.sources.landing import read_media_snapshots, read_visitor_events
from clipstar.sources.runs import Runs
from clipstar.streaming.events import Sink, start_event_stream, start_snapshot_stream
from tests.helpers import event, events_df, snapshot, snapshots_df

SF = "/root/testdata/sf0.001"
TABLES = ("silver_media_stats", "silver_visitor_events", "fact_base", "dim_media", "dim_visitor",
          "fact_media_engagement")


def contents(cur, tables=TABLES):
    out = {}
    for t in tables:
        df = cur.read(t).drop("landing")
        out[t] = sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)
    return out


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables not present")
def test_incremental_tables_equal_full_rebuild(spark, tmp_root):
    ev, sn = adapters.landed_events(spark, SF), adapters.landed_snapshots(spark, SF)
    early_ev = F.col("load_date") < F.lit("2024-01-16").cast("date")
    early_sn = F.col("ingest_seq") % 2 == 0
    a, b, everything = f"{tmp_root}/a", f"{tmp_root}/b", f"{tmp_root}/all"
    land_json(sn.where(early_sn), a, MEDIA_DATASET)
    land_json(ev.where(early_ev), a, EVENT_DATASET)
    land_json(sn.where(~early_sn), b, MEDIA_DATASET)
    land_json(ev.where(~early_ev), b, EVENT_DATASET)
    land_json(sn.where(early_sn), everything, MEDIA_DATASET)
    land_json(sn.where(~early_sn), everything, MEDIA_DATASET)
    land_json(ev, everything, EVENT_DATASET)
    mapping = adapters.channel_mapping(spark, SF)
    full_rebuild(spark, a, f"{tmp_root}/inc", channel_mapping=mapping)
    inc = incremental_update(spark, b, f"{tmp_root}/inc", channel_mapping=mapping)
    full = full_rebuild(spark, everything, f"{tmp_root}/full", channel_mapping=mapping)
    assert contents(inc) == contents(full)


def first_landing(spark, root):
    land_json(snapshots_df(spark, [
        snapshot("m1", "2025-03-01", duration=100.0, play_rate=0.9, ingest_seq=1),
        snapshot("m2", "2025-03-01", duration=50.0, ingest_seq=2)]), root, MEDIA_DATASET)
    land_json(events_df(spark, [
        event("e1", "2025-03-01T01:00:00.000Z", "v1", 0.5, media_id="m1", load_date="2025-03-01"),
        event("e2", "2025-03-02T01:00:00.000Z", "v1", 0.5, media_id="m2", load_date="2025-03-02"),
        event("e3", "2025-03-02T02:00:00.000Z", None, 0.5, media_id="m2", load_date="2025-03-02"),
    ]), root, EVENT_DATASET)


def second_landing(spark, root):
    """A same-day re-run with an older update time and a lower play_rate, copies with another written date and a
    malformed one, a new event, and one on an old day."""
    land_json(snapshots_df(spark, [
        snapshot("m1", "2025-03-01", updated="2025-02-01T00:00:00+00:00", duration=200.0, play_rate=0.2, ingest_seq=5),
        snapshot("m3", "2025-03-03", duration=10.0, ingest_seq=6)]), root, MEDIA_DATASET)
    land_json(events_df(spark, [
        event("e1", "2025-03-03T01:00:00.000Z", "v9", 0.1, media_id="m1", load_date="2025-03-03"),
        event("e2", "no time", "v9", 0.1, media_id="m2", load_date="2025-03-03"),
        event("e4", "2025-03-03T05:00:00.000Z", "v2", 0.5, media_id="m3", load_date="2025-03-03"),
        event("e5", "2025-03-01T05:00:00.000Z", "v1", 0.25, media_id="m1", load_date="2025-03-03"),
        event("e6", "nonsense", "v3", 0.25, media_id="m1", load_date="2025-03-03"),
    ]), root, EVENT_DATASET)


@pytest.fixture()
def landings(spark, tmp_root):
    a, b, both = (f"{tmp_root}/{x}" for x in ("a", "b", "both"))
    first_landing(spark, a)
    second_landing(spark, b)
    first_landing(spark, both)
    second_landing(spark, both)
    return a, b, full_rebuild(spark, both, f"{tmp_root}/whole")


class Broken(Exception):
    pass


def failing_after(monkeypatch, step):
    """Let the n-th write of a table or of a run fail just after it was done."""
    done = {"n": 0}

    def breaking(kind, name):
        whole = getattr(kind, name)

        def run(*args, **kwargs):
            out = whole(*args, **kwargs)
            done["n"] += 1
            if done["n"] == step:
                raise Broken
            return out
        monkeypatch.setattr(kind, name, run)
    breaking(Curated, "write")
    breaking(Runs, "add")


def test_a_batch_that_fails_after_any_write_changes_nothing(spark, tmp_root, landings, monkeypatch):
    a, b, whole = landings
    out = f"{tmp_root}/cur"
    before = full_rebuild(spark, a, out)
    as_before = contents(before)
    for step in (3, 7, 11):
        with monkeypatch.context() as m:
            failing_after(m, step)
            with pytest.raises(Broken):
                incremental_update(spark, b, out)
        now = Curated.current(spark, out)
        assert now.version == before.version
    assert contents(now) == as_before
    cur = incremental_update(spark, b, out)
    assert contents(cur) == contents(whole)
    assert contents(incremental_update(spark, b, out)) == contents(whole)
    assert cur.read("bronze_visitor_events").count() == 8
    rate = {r.media_id: r.play_rate for r in cur.read("silver_media_stats").collect()}
    assert rate == {"m1": 0.2, "m2": 0.21, "m3": 0.21}


def test_a_reader_sees_the_commit_it_began_with(spark, tmp_root, landings, monkeypatch):
    a, b, whole = landings
    out = f"{tmp_root}/cur"
    reader = full_rebuild(spark, a, out)
    before = contents(reader)
    seen = []
    whole_write = Curated.write

    def write(self, name, *args, **kwargs):
        done = whole_write(self, name, *args, **kwargs)
        if name == "fact_base":  # half of the batch is folded in
            seen.append(contents(Curated.current(spark, out)))
        return done
    with monkeypatch.context() as m:
        m.setattr(Curated, "write", write)
        after = incremental_update(spark, b, out)
    assert seen == [before] and contents(reader) == before
    assert contents(Curated.current(spark, out, reader.version)) == before
    assert contents(after) == contents(whole)


def test_old_commits_and_their_folders_go(spark, tmp_root):
    land_json(events_df(spark, [event("e1", "2025-03-01T01:00:00.000Z", "v", 0.5, load_date="2025-03-01")]),
              f"{tmp_root}/land", EVENT_DATASET)
    for _ in range(4):
        cur = full_rebuild(spark, f"{tmp_root}/land", f"{tmp_root}/cur")
    assert Commits(spark, f"{tmp_root}/cur").versions() == [1, 2, 3] and cur.version == 3
    assert len(os.listdir(f"{tmp_root}/cur/fact_base")) == 3
    with pytest.raises(ValueError, match="no commit 0"):
        Curated.current(spark, f"{tmp_root}/cur", 0)


def test_batches_at_one_time_are_both_folded_in(spark, tmp_root, landings):
    a, b, whole = landings
    out = f"{tmp_root}/cur"
    full_rebuild(spark, a, out)
    c = f"{tmp_root}/c"
    land_json(events_df(spark, [event("e9", "2025-03-04T05:00:00.000Z", "v7", 0.5, media_id="m1",
                                      load_date="2025-03-04")]), c, EVENT_DATASET)
    errors = []

    def fold(root):
        try:
            incremental_update(spark, root, out)
        except Exception as e:  # shown by the assertion
            errors.append(e)
    threads = [threading.Thread(target=fold, args=(r,)) for r in (b, c)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not errors
    cur = Curated.current(spark, out)
    keys = {r.event_key for r in cur.read("silver_visitor_events").collect()}
    assert keys == {r.event_key for r in whole.read("silver_visitor_events").collect()} | {"e9"}
    watch = {(r.media_id, r.visitor_id, str(r.date)): r.total_watch_time
             for r in cur.read("fact_media_engagement").collect()}
    assert watch["m1", "v7", "2025-03-04"] == 100.0 and watch["m1", "v1", "2025-03-01"] == 150.0


def test_stream_batch_can_fail_after_any_write(spark, tmp_root, landings, monkeypatch):
    a, b, whole = landings
    out = f"{tmp_root}/stream"
    sink = Sink(spark, out, "bronze_visitor_events", "ck")
    read = lambda root: read_visitor_events(spark, root, audit=True)
    sink(read(a), 0)
    for step in (2, 5):
        with monkeypatch.context() as m:
            failing_after(m, step)
            with pytest.raises(Broken):
                sink(read(b), 1)
    sink(read(b), 1)
    sink(read(b), 1)  # a replay
    cur = Curated.current(spark, out)
    tables = ("silver_visitor_events", "fact_base", "dim_visitor")
    assert contents(cur, tables) == contents(whole, tables)
    assert cur.read("bronze_visitor_events").count() == 8 and cur.version == 1


def served(spark, play_rate):
    return snapshots_df(spark, [snapshot("m1", "2025-03-01", play_rate=play_rate)]).drop("load_date", "landing", "ingest_seq")


def test_the_later_of_two_runs_on_a_day_counts_in_every_build(spark, tmp_root):
    """The API gives records without any number, and ``updated`` stays as it was."""
    media = spark.createDataFrame([("m1",)], "media_id string")
    plays = events_df(spark, [event("e1", "2025-03-01T01:00:00.000Z", "v", 0.5, media_id="m1", load_date="2025-03-01")])

    def run(land, rate, at):
        ingest_run(spark, plays, media, f"{land}-cp", land, "2025-03-01", at, snapshots=served(spark, rate))

    def rate(cur):
        return [(r.media_id, r.play_rate) for r in cur.read("fact_media_engagement").collect()]
    both = f"{tmp_root}/both"
    run(both, 0.9, "2025-03-01 06:00:00")
    full_rebuild(spark, both, f"{tmp_root}/full")
    run(both, 0.2, "2025-03-01 07:00:00")
    assert rate(full_rebuild(spark, both, f"{tmp_root}/full")) == [("m1", 0.2)]
    first, second = f"{tmp_root}/first", f"{tmp_root}/second"
    run(first, 0.9, "2025-03-01 06:00:00")
    run(second, 0.2, "2025-03-01 07:00:00")
    full_rebuild(spark, first, f"{tmp_root}/inc")
    assert rate(incremental_update(spark, second, f"{tmp_root}/inc")) == [("m1", 0.2)]
    # Folding the first batch in once more doesn't bring its value back.
    assert rate(incremental_update(spark, first, f"{tmp_root}/inc")) == [("m1", 0.2)]
    start_event_stream(spark, both, f"{tmp_root}/str", f"{tmp_root}/ck1").awaitTermination()
    start_snapshot_stream(spark, both, f"{tmp_root}/str", f"{tmp_root}/ck2", max_files_per_trigger=1).awaitTermination()
    assert rate(Curated.current(spark, f"{tmp_root}/str")) == [("m1", 0.2)]


def test_files_without_a_number_count_by_their_time(spark, tmp_root):
    day = f"{tmp_root}/land/media_stats/load_date=2025-03-01"
    os.makedirs(day)
    for name, rate, at in (("z.json", 0.9, 1_000_000), ("a.json", 0.2, 2_000_000)):
        Path(f"{day}/{name}").write_text('{"media": {"hashed_id": "m1"}, "stats": {"play_rate": %s}}' % rate)
        os.utime(f"{day}/{name}", (at, at))
    cur = full_rebuild(spark, f"{tmp_root}/land", f"{tmp_root}/cur", layout="document")
    assert [r.play_rate for r in cur.read("silver_media_stats").collect()] == [0.2]
    land_json(snapshots_df(spark, [snapshot("m1", "2025-03-01", play_rate=0.5)]), f"{tmp_root}/land", MEDIA_DATASET)
    both = read_media_snapshots(spark, f"{tmp_root}/land")
    assert both.orderBy(F.desc("landing")).first().stats.play_rate == 0.5


def test_first_day_with_anonymous_events_only(spark, tmp_root):
    land_json(events_df(spark, [event("e1", "2025-03-01T01:00:00.000Z", None, 0.5, load_date="2025-03-01")]),
              f"{tmp_root}/land", EVENT_DATASET)
    cur = full_rebuild(spark, f"{tmp_root}/land", f"{tmp_root}/cur")
    assert {t: cur.read(t).count() for t in TABLES} == {
        "silver_media_stats": 0, "silver_visitor_events": 1, "fact_base": 0, "dim_media": 0, "dim_visitor": 1,
        "fact_media_engagement": 0}


def test_incremental_rewrites_only_affected_dates(spark, tmp_root):
    a, b, c = f"{tmp_root}/a", f"{tmp_root}/b", f"{tmp_root}/c"
    first_landing(spark, a)
    out = f"{tmp_root}/cur"
    cur = full_rebuild(spark, a, out)
    folders = lambda c: c.manifest.parts("fact_media_engagement")
    before = dict(folders(cur))
    # New events only, on a new day: days 1 and 2 keep their files.
    land_json(events_df(spark, [
        event("n3", "2025-03-03T01:00:00.000Z", "v2", 0.5, media_id="m1", load_date="2025-03-03"),
    ]), b, EVENT_DATASET)
    cur = incremental_update(spark, b, out)
    assert {d: folders(cur)[d] for d in before} == before
    assert cur.read("fact_media_engagement").count() == 3
    # m1 gets a newer snapshot: its days (1 and 3) are rewritten, day 2 (m2) is not.
    land_json(snapshots_df(spark, [snapshot(media_id="m1", duration=200.0, load_date="2025-03-04",
                                            updated="2025-03-04T09:00:00+00:00")]), c, MEDIA_DATASET)
    reads = []
    with pytest.MonkeyPatch.context() as m:
        read = Curated.read
        m.setattr(Curated, "read", lambda self, name, only=None: reads.append((name, only)) or read(self, name, only))
        cur = incremental_update(spark, c, out)
    # The days come from the bitmaps; of the facts only they are read.
    assert [set(only) for name, only in reads if name == "fact_base"][-1] == {"2025-03-01", "2025-03-03"}
    assert all(only is not None for name, only in reads if name.startswith("fact"))
    after = folders(cur)
    assert after["2025-03-02"] == before["2025-03-02"] and after["2025-03-01"] != before["2025-03-01"]
    watch = {(r.media_id, str(r.date)): r.total_watch_time
             for r in cur.read("fact_media_engagement").collect()}
    assert watch == {("m1", "2025-03-01"): 100.0, ("m2", "2025-03-02"): 25.0,
                     ("m1", "2025-03-03"): 100.0}
    # The marts from the kept sums equal those over the facts.
    f, dim, sums = cur.read("fact_media_engagement"), cur.read("dim_media"), cur.read("mart_days")
    assert marts.kpi_from_sums(sums, cur.fact_visitors.read()).collect() == marts.kpi_summary(f).collect()
    assert marts.engagement_from_sums(sums, dim).collect() == marts.engagement_by_media(f, dim).collect()
    assert marts.trend_from_sums(sums).collect() == marts.daily_plays_trend(f).collect()


def test_a_rebuild_that_fails_leaves_the_tables_before_it(spark, tmp_root, monkeypatch):
    first_landing(spark, f"{tmp_root}/a")
    out = f"{tmp_root}/cur"
    before = contents(full_rebuild(spark, f"{tmp_root}/a", out))
    with monkeypatch.context() as m:
        failing_after(m, 7)
        with pytest.raises(Broken):
            full_rebuild(spark, f"{tmp_root}/a", out)
    assert contents(Curated.current(spark, out)) == before


def test_malformed_records_are_counted(spark, tmp_root):
    day = f"{tmp_root}/land/visitor_stats/load_date=2025-03-02"
    os.makedirs(day)
    Path(f"{day}/a.json").write_text('{"event_key": "e1", "received_at": "2025-03-02T01:00:00Z"}\n{"event_key": \n')
    cur = full_rebuild(spark, f"{tmp_root}/land", f"{tmp_root}/cur")
    assert (cur.rows["bronze_visitor_events"], cur.malformed["bronze_visitor_events"]) == (2, 1)
    assert cur.read("silver_visitor_events").first().date == dt.date(2025, 3, 2)
    kept = build.quarantine(cur).collect()
    assert [(r.table_name, r.malformed, r.file.rsplit("/", 1)[1]) for r in kept] == [
        ("bronze_visitor_events", '{"event_key": ', "a.json")]
    assert build.batch_name("/x/") == build.batch_name("/x")
