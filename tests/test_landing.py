"""Landed JSON: document and lines layouts, malformed input (N3), partitions."""
import datetime as dt
import json
import os

from clipstar.operators import silver
from clipstar.sources.landing import land_json, read_media_snapshots, read_visitor_events
from tests.helpers import event, events_df, snapshot


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def _doc(rec):
    rec = dict(rec)
    rec.pop("load_date")
    return json.dumps(rec, default=str)


def test_document_layout_and_malformed_files(spark, tmp_root):
    day = f"{tmp_root}/visitor_stats/load_date=2025-03-02"
    evs = [event("e1", "2025-03-02T01:00:00.000Z", "v", 0.1),
           event("e2", "2025-03-02T02:00:00.000Z", "v", 0.2)]
    _write(f"{day}/m-alpha_010000.json", "[" + ",".join(_doc(e) for e in evs) + "]")
    _write(f"{day}/m-alpha_020000.json", '[{"event_key": "e3", "received_at": ')  # truncated
    _write(f"{day}/m-alpha_030000.json", "")  # empty
    _write(f"{day}/m-alpha_040000.json", '[{"event_key": "e4", "percent_viewed": "lots"}]')
    b = read_visitor_events(spark, tmp_root, layout="document")
    rows = b.collect()
    assert {r.load_date for r in rows} == {dt.date(2025, 3, 2)}
    assert sorted(r.event_key or "-" for r in rows) == ["-", "e1", "e2", "e4"]
    assert [r.percent_viewed for r in rows if r.event_key == "e4"] == [None]
    assert silver.silver_visitor_events(b).count() == 3

    snap_day = f"{tmp_root}/media_stats/load_date=2025-03-02"
    _write(f"{snap_day}/m-alpha.json", _doc(snapshot()))
    _write(f"{snap_day}/m-beta.json", '{"media": {"hashed_id": "m-beta", "name": ')
    sm = silver.silver_media_stats(read_media_snapshots(spark, tmp_root, layout="document"))
    assert [r.media_id for r in sm.collect()] == ["m-alpha"]


def test_lines_roundtrip_and_pruning(spark, tmp_root, capsys):
    evs = [event(f"e{i}", f"2025-03-0{d}T01:00:00.000Z", "v", 0.1, load_date=f"2025-03-0{d}")
           for i, d in enumerate([1, 2, 2, 3])]
    src = events_df(spark, evs)
    land_json(src, tmp_root, "visitor_stats")
    back = read_visitor_events(spark, tmp_root)
    assert back.select(*src.columns).exceptAll(src).count() == 0
    pruned = back.where("load_date >= DATE'2025-03-02'")
    assert pruned.count() == 3
    pruned.explain()
    assert "PartitionFilters: [isnotnull(load_date" in capsys.readouterr().out
