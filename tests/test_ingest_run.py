"""The ingestion run end to end (reference cases, own data)."""
import os

import pytest

from clipstar.operators.incremental import IngestFailures
from clipstar.plans import ingest
from clipstar.plans.ingest import STATUS_DDL, ingest_run
from clipstar.sources.commits import Versions
from clipstar.sources.landing import read_visitor_events
from clipstar.sources.tables import load_checkpoint
from tests.helpers import event, events_df


def _files(path):
    return sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                  if f.endswith(".json"))


def test_run_lands_new_events_then_nothing_then_fails(spark, tmp_root):
    media = spark.createDataFrame([("m1",), ("m2",)], "media_id string")
    cp, land = f"{tmp_root}/cp", f"{tmp_root}/land"
    served = events_df(spark, [
        event("a", "2025-02-01T00:00:00.000Z", "v", 0.1, media_id="m1"),
        event("b", "2025-02-23T00:00:00.000Z", "v", 0.1, media_id="m1"),
        event("c", "2025-02-05T00:00:00.000Z", "v", 0.1, media_id="m2")])
    st = {r.media_id: r.status for r in ingest_run(
        spark, served, media, cp, land, "2025-02-24", "2025-02-24 06:00:00").collect()}
    assert st == {"m1": "new_events", "m2": "new_events"}
    assert sorted(r.event_key for r in read_visitor_events(spark, land).collect()) == ["a", "b", "c"]
    wm = {r.media_id: r.last_event_received_at for r in load_checkpoint(spark, cp).collect()}
    assert wm == {"m1": "2025-02-23T00:00:00.000Z", "m2": "2025-02-05T00:00:00.000Z"}

    # Same history served again: nothing new, nothing landed.
    before = _files(land)
    st = {r.media_id: r.status for r in ingest_run(
        spark, served, media, cp, land, "2025-02-25", "2025-02-25 06:00:00").collect()}
    assert st == {"m1": "no_new_events", "m2": "no_new_events"}
    assert _files(land) == before

    # m2 fails: m1's new event lands and its watermark moves; m2 keeps its own.
    served2 = served.unionByName(events_df(spark, [
        event("d", "2025-02-26T00:00:00.000Z", "v", 0.1, media_id="m1"),
        event("e", "2025-02-26T00:00:00.000Z", "v", 0.1, media_id="m2")]))
    failed = spark.createDataFrame([("m2",)], "media_id string")
    with pytest.raises(IngestFailures, match="1 media failed") as info:
        ingest_run(spark, served2, media, cp, land, "2025-02-26", "2025-02-26 06:00:00", failed)
    status = Versions(spark, info.value.status_path, STATUS_DDL).read()
    assert {r.media_id: r.status for r in status.collect()} == {
        "m1": "new_events", "m2": "failed"}
    wm = {r.media_id: r.last_event_received_at for r in load_checkpoint(spark, cp).collect()}
    assert wm == {"m1": "2025-02-26T00:00:00.000Z", "m2": "2025-02-05T00:00:00.000Z"}
    assert "e" not in {r.event_key for r in read_visitor_events(spark, land).collect()}


def test_runs_at_one_time_lose_no_watermark(spark, tmp_root, monkeypatch):
    """The second run reads the checkpoint, then the first one saves, then the second one saves."""
    media = spark.createDataFrame([("m1",), ("m2",)], "media_id string")
    cp, land = f"{tmp_root}/cp", f"{tmp_root}/land"
    one = events_df(spark, [event("a", "2025-02-20T00:00:00.000Z", "v", 0.1, media_id="m1")])
    two = events_df(spark, [event("b", "2025-02-10T00:00:00.000Z", "v", 0.1, media_id="m1"),
                            event("c", "2025-02-05T00:00:00.000Z", "v", 0.1, media_id="m2")])
    save, first = ingest.save_checkpoint, []

    def overtaken(*args):
        if not first:
            first.append(True)
            ingest_run(spark, one, media, cp, land, "2025-02-24", "2025-02-24 06:00:00")
        return save(*args)
    monkeypatch.setattr(ingest, "save_checkpoint", overtaken)
    ingest_run(spark, two, media, cp, land, "2025-02-24", "2025-02-24 07:00:00")
    wm = {r.media_id: r.last_event_received_at for r in load_checkpoint(spark, cp).collect()}
    assert wm == {"m1": "2025-02-20T00:00:00.000Z", "m2": "2025-02-05T00:00:00.000Z"}
    assert sorted(r.event_key for r in read_visitor_events(spark, land).collect()) == ["a", "b", "c"]
