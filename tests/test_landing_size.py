"""How landed files and Bronze are written: compressed, in bounded files, by as many tasks as there is work for."""
import os

from clipstar.plans import landed
from clipstar.plans.build import full_rebuild
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET
from clipstar.sources import landing
from clipstar.sources.landing import land_documents, land_json, read_media_snapshots, read_visitor_events
from tests.helpers import event, events_df, snapshot, snapshots_df

SF = "/root/testdata/sf0.001"


def _files(path, end):
    return [os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.endswith(end)]


def _events(spark, n):
    return events_df(spark, [event(f"e{i}", "2025-03-02T01:00:00.000Z", f"v{i % 7}", 0.1) for i in range(n)])


def test_compressed_landing_is_small_bounded_and_whole(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(landing, "RECORDS_PER_FILE", 100)
    src = _events(spark, 450).coalesce(1)
    land_json(src, f"{tmp_root}/plain", EVENT_DATASET)
    land_json(src, f"{tmp_root}/gz", EVENT_DATASET, compression="gzip")
    plain, gz = _files(f"{tmp_root}/plain", ".json"), _files(f"{tmp_root}/gz", ".json.gz")
    assert len(gz) >= 5 and not _files(f"{tmp_root}/gz", ".json")
    assert 4 * sum(map(os.path.getsize, gz)) < sum(map(os.path.getsize, plain))
    back = read_visitor_events(spark, f"{tmp_root}/gz")
    assert back.count() == 450 and back.select(*src.columns).exceptAll(src).count() == 0


def test_a_query_lands_only_the_dataset_it_reads(spark, monkeypatch):
    monkeypatch.setattr(landed, "_ROOTS", {})
    monkeypatch.setattr(landed, "_LANDED", set())
    root = landed.landing_root(spark, SF, EVENT_DATASET).removeprefix("file://")
    assert os.listdir(root) == [EVENT_DATASET] and _files(root, ".json.gz")
    assert landed.landing_root(spark, SF).removeprefix("file://") == root
    assert sorted(os.listdir(root)) == sorted([EVENT_DATASET, MEDIA_DATASET])


def test_bronze_is_written_by_the_tasks_that_parse(spark, tmp_root):
    for _ in range(3):
        land_json(_events(spark, 60).coalesce(1), f"{tmp_root}/land", EVENT_DATASET, compression="gzip")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # a task per file
    try:
        cur = full_rebuild(spark, f"{tmp_root}/land", f"{tmp_root}/out")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    folder, = cur.manifest.parts("bronze_visitor_events")["rebuild"]
    assert len(_files(f"{tmp_root}/out/{folder}", ".parquet")) == 3  # without a shuffle to one
    assert cur.rows["bronze_visitor_events"] == 180 and cur.read("silver_visitor_events").count() == 60


def test_documents_are_written_and_read_by_bounded_numbers_of_tasks(spark, tmp_root, monkeypatch):
    monkeypatch.setattr(landing, "FILES_PER_TASK", 10)
    monkeypatch.setattr(landing, "DOCUMENT_TASKS", 2)
    rows = snapshots_df(spark, [snapshot(media_id=f"m{i}") for i in range(95)]).coalesce(1)
    land_documents(rows, tmp_root, MEDIA_DATASET)
    files = _files(tmp_root, ".json")
    assert len(files) == 95
    assert len({os.path.basename(f).split("-")[1] for f in files}) == 10  # tasks
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")  # a split per file
    try:
        back = read_media_snapshots(spark, tmp_root, "document")
        assert back.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism
        assert sorted(r[0] for r in back.select("media.hashed_id").collect()) == sorted(f"m{i}" for i in range(95))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
