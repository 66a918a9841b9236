"""Builds hold no table in the driver that Spark only takes for small, and leave no shuffle files."""
import time

from pyspark.sql import functions as F

from clipstar.plans import build
from clipstar.plans.build import export, full_rebuild, incremental_update
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET
from clipstar.session import working_session
from clipstar.sources.landing import land_json
from clipstar.streaming import events as streaming
from tests.helpers import event, events_df, snapshot, snapshots_df


def _ran(df):
    """The plan that ran."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_well_compressed_side_is_not_broadcast_and_a_small_one_is(spark, tmp_root):
    """100,000 rows of 300 characters in a file of few bytes."""
    spark.range(100_000).select((F.col("id") % 7).alias("k"), F.repeat(F.lit("x"), 300).alias("text")) \
        .write.parquet(f"{tmp_root}/side")
    work = working_session(spark)
    for session, broadcast in ((spark, True), (work, False)):
        side = session.read.parquet(f"{tmp_root}/side")
        rows = session.range(10).join(side, F.col("id") == F.col("k"), "left").groupBy("id").agg(F.max("text"))
        # Of the ten rows the left side of a left join can't be broadcast.
        assert ("BroadcastHashJoin" in _ran(rows)) == broadcast
    few = work.range(10).join(work.range(5), "id", "left")
    assert "BroadcastHashJoin" in _ran(few)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") != "-1"


def _land(spark, root, first):
    keys = range(first, first + 30)
    land_json(events_df(spark, [event(f"e{i}", "2025-03-02T01:00:00.000Z", f"v{i % 5}", 0.1) for i in keys]), root, EVENT_DATASET)
    land_json(snapshots_df(spark, [snapshot(media_id=f"m{i}") for i in keys]), root, MEDIA_DATASET)


def test_batches_run_in_a_working_session_and_are_read_in_the_callers(spark, tmp_root, monkeypatch):
    used, fold = [], build._fold
    monkeypatch.setattr(build, "_fold", lambda cur, *rest: (used.append(cur.spark), fold(cur, *rest)))
    _land(spark, f"{tmp_root}/a", 0)
    _land(spark, f"{tmp_root}/b", 20)
    full_rebuild(spark, f"{tmp_root}/a", f"{tmp_root}/out")
    cur = incremental_update(spark, f"{tmp_root}/b", f"{tmp_root}/out")
    assert [s.conf.get("spark.sql.autoBroadcastJoinThreshold") for s in used] == ["-1", "-1"]
    assert cur.spark is spark and cur.read("silver_visitor_events").count() == 50


def _shuffles(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks().mkString(" ")
    return {b.split("_")[1] for b in blocks.split() if b.startswith("shuffle_")}


def test_a_build_leaves_no_shuffle_files(spark, tmp_root):
    """However long the driver collects no garbage, on which they would be kept."""
    _land(spark, f"{tmp_root}/a", 0)
    _land(spark, f"{tmp_root}/b", 20)
    before = _shuffles(spark)
    full_rebuild(spark, f"{tmp_root}/a", f"{tmp_root}/out")
    export(incremental_update(spark, f"{tmp_root}/b", f"{tmp_root}/out"), f"{tmp_root}/gold")
    for _ in range(50):  # files are removed in the background
        if not _shuffles(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffles(spark) - before


def test_streams_fold_in_a_working_session(spark, tmp_root, monkeypatch):
    used, fold = [], streaming.fold_events
    monkeypatch.setattr(streaming, "fold_events", lambda cur, rows: (used.append(cur.spark), fold(cur, rows))[1])
    _land(spark, f"{tmp_root}/land", 0)
    _land(spark, f"{tmp_root}/land", 20)
    before = _shuffles(spark)
    for start in (streaming.start_event_stream, streaming.start_snapshot_stream):
        start(spark, f"{tmp_root}/land", f"{tmp_root}/out", f"{tmp_root}/{start.__name__}", max_files_per_trigger=1).awaitTermination()
    for _ in range(50):
        if not _shuffles(spark) - before:
            break
        time.sleep(0.2)
    assert not _shuffles(spark) - before
    assert len(used) > 1 and {s.conf.get("spark.sql.autoBroadcastJoinThreshold") for s in used} == {"-1"}
    cur = build.Curated.current(spark, f"{tmp_root}/out")
    assert cur.read("silver_visitor_events").count() == 50 and cur.read("dim_visitor").count() == 5
    assert cur.read("fact_media_engagement").count() == 5
