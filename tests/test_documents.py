"""Documents, a file each: put by tasks, listed and read by tasks, parsed as Spark's own reader does."""
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET, VISITOR_EVENT_DDL
from clipstar.sources import landing
from clipstar.sources.landing import land_documents, parse_landed, read_media_snapshots, read_visitor_events, with_file
from tests.helpers import event, events_df, snapshot, snapshots_df

TEXTS = {
    "object": '{"event_key":"e1","percent_viewed":0.5,"user_agent_details":{"browser":"x"}}',
    "array": '[{"event_key":"e2"},{"event_key":"e3","percent_viewed":"lots","ip":"1"}]',
    "cut array": '[{"event_key": "e3", "received_at": ', "cut later": '[{"event_key":"e11"},{"event_key":"e12"',
    "cut": '{"event_key":"e6"', "empty": "", "blank": " \n ", "odd": '{"event_key":"e5","percent_viewed":"lots","ip":"1"}',
    "no elements": "[]", "number": "5", "text": '"abc"', "null": "null", "no fields": "{}", "letters": '[{"event_key":"ué中"}]\n',
    "odd within": '{"event_key":"e7","nope":1,"thumbnail":{"url":"u","width":"z","height":3}}', "arrays": "[[1]]",
    "two": '{"event_key":"e8"} {"event_key":"e9"}', "mixed": '[{"event_key":"e10"},5]', "nulls": "[null]",
    "an array": '{"event_key":[1,2]}', "a number": '{"event_key":5}', "a b%": '{"event_key":"e15"}',
    "odd in array": '[{"thumbnail":{"url":"u","width":"z","height":3},"event_key":"e14"}]',
    "utf16": '{"event_key":"wide"}'.encode("utf-16"), "mark": b'\xef\xbb\xbf{"event_key":"mark"}',
    "bytes": b'{"event_key":"bad\xff\xfe"}', "_hidden": '{"event_key":"hidden"}', ".hidden": '{"event_key":"hidden"}',
}


def _sorted(df):
    return sorted((r.asDict(True) for r in df.collect()), key=repr)


@pytest.mark.parametrize("audit", [False, True])
def test_read_as_sparks_reader_does(spark, tmp_root, audit):
    for i, (name, text) in enumerate(TEXTS.items()):
        day = "__HIVE_DEFAULT_PARTITION__" if i == 3 else f"2025-03-0{1 + i % 3}"
        folder = f"{tmp_root}/{EVENT_DATASET}/load_date={day}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}.json", "wb") as out:
            out.write(text if isinstance(text, bytes) else text.encode())
    theirs = with_file(parse_landed(spark.read, VISITOR_EVENT_DDL, "document", audit).json(f"{tmp_root}/{EVENT_DATASET}"), audit)
    ours = read_visitor_events(spark, tmp_root, "document", audit=audit)
    assert ours.columns == theirs.columns
    assert _sorted(ours) == _sorted(theirs) and ours.count() == 24


def test_the_driver_lists_no_documents_and_tasks_open_those_of_the_days_asked_for(spark, tmp_root, capsys):
    rows = [event(f"e{i}", "2025-03-02T01:00:00.000Z", "v", 0.1, load_date=f"2025-03-0{1 + i % 2}") for i in range(20)]
    land_documents(events_df(spark, rows), tmp_root, EVENT_DATASET)
    some = read_visitor_events(spark, tmp_root, "document").where("load_date = date'2025-03-02'")
    os.remove(next(f"{d}/{f}" for d, _, fs in os.walk(tmp_root) for f in fs if d.endswith("load_date=2025-03-01")))
    assert some.count() == 10
    some.explain()
    plan = capsys.readouterr().out
    assert "FileScan" not in plan and "MapInArrow" in plan
    assert plan.index("ArrowEvalPython") < plan.index("2025-03-02") < plan.index("MapInArrow")  # filtered before read


def test_a_snapshot_without_a_number_takes_the_time_of_its_file(spark, tmp_root):
    folder = f"{tmp_root}/{MEDIA_DATASET}/load_date=2025-03-02"
    os.makedirs(folder)
    with open(f"{folder}/a.json", "w") as out:
        json.dump({"media": {"hashed_id": "m"}}, out)
    os.utime(f"{folder}/a.json", (1_700_000_000, 1_700_000_000))
    assert read_media_snapshots(spark, tmp_root, "document").first().landing == 1_700_000_000_000_000


def test_documents_are_put_whole_and_under_names_that_the_rows_decide(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(landing, "FILES_PER_TASK", 7)
    rows = snapshots_df(spark, [snapshot(media_id=f"m{i}", load_date=f"2025-03-0{1 + i % 2}") for i in range(40)])
    dayless = rows.limit(1).withColumn("load_date", F.lit(None).cast("date"))
    monkeypatch.setattr(landing, "_put_documents", lambda uri, _, put=landing._put_documents: put(uri, "same"))
    monkeypatch.setattr(landing, "landing_number", lambda *_: 5)

    def files():
        return {os.path.relpath(f"{d}/{f}", tmp_root): open(f"{d}/{f}").read() for d, _, fs in os.walk(tmp_root) for f in fs}
    land_documents(rows.unionByName(dayless), tmp_root, MEDIA_DATASET)
    once = files()
    land_documents(rows.unionByName(dayless), tmp_root, MEDIA_DATASET)  # as a task that is run again
    assert files() == once and len(once) == 41
    assert all(name.endswith(".json") and not os.path.basename(name).startswith(".") for name in once)  # and no check sums
    back = read_media_snapshots(spark, tmp_root, "document")
    assert {r.load_date for r in back.collect()} == {None, dt.date(2025, 3, 1), dt.date(2025, 3, 2)}
    assert back.select(*rows.columns).exceptAll(rows.unionByName(dayless).withColumn("landing", F.lit(5).cast("bigint"))).count() == 0


def test_no_documents_are_landed_and_read(spark, tmp_root):
    land_documents(events_df(spark, []), tmp_root, EVENT_DATASET)
    assert read_visitor_events(spark, tmp_root, "document").count() == 0
