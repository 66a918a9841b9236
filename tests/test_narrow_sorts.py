"""What a task sorts on the way to Bronze and Silver: never whole records by their folder, and one shuffle by day."""
import os
import random

import pytest

from clipstar.operators import silver
from clipstar.plans import build
from clipstar.plans.build import full_rebuild, place_by_day
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET
from clipstar.sources.landing import land_json
from tests.helpers import event, events_df, snapshot, snapshots_df


def test_bronze_is_one_folder_and_sorted_by_nothing(spark, tmp_root):
    land_json(events_df(spark, [event(f"e{i}", "2025-03-02T01:00:00.000Z", f"v{i}", 0.1) for i in range(50)]),
              f"{tmp_root}/land", EVENT_DATASET)
    land_json(snapshots_df(spark, [snapshot(media_id=f"m{i}") for i in range(20)]), f"{tmp_root}/land", MEDIA_DATASET)
    cur = full_rebuild(spark, f"{tmp_root}/land", f"{tmp_root}/out")
    for name, rows in (("bronze_visitor_events", 50), ("bronze_media_stats", 20)):
        folder, = cur.manifest.parts(name)["rebuild"]
        names = os.listdir(f"{tmp_root}/out/{folder}")
        assert any(n.endswith(".parquet") for n in names) and not any(n.startswith("_part=") for n in names)
        assert cur.read(name).count() == cur.rows[name] == rows
        assert [r[0] for r in cur.read(name).select("batch").distinct().collect()] == ["rebuild"]


def _snapshots(spark):
    rng = random.Random(5)
    rows = [snapshot(media_id=f"m{rng.randrange(40)}", load_date=f"2025-03-0{1 + i % 3}", play_rate=rng.random(),
                     name=rng.choice(["a", "b", None]), ingest_seq=rng.choice([None, *range(50)])) for i in range(400)]
    flat = silver.flat_snapshots(snapshots_df(spark, rows))
    dayless = flat.where("load_date = date'2025-03-03'").selectExpr(
        *[c if c != "load_date" else "cast(null as date) as load_date" for c in flat.columns])
    return flat.unionByName(dayless)


@pytest.mark.parametrize("rows", [7, 250_000])
def test_snapshots_placed_by_day_are_the_ones_chosen_by_key(spark, monkeypatch, rows):
    monkeypatch.setattr(build, "SNAPSHOTS_PER_BUCKET", rows)
    snapshots = _snapshots(spark)
    chosen, placed = silver.one_snapshot_per_day(snapshots), place_by_day(snapshots).drop("_part")
    assert placed.count() == chosen.count() > 100
    assert placed.exceptAll(chosen.select(placed.columns)).count() == 0


def test_silver_snapshots_are_shuffled_once_and_written_in_their_order(spark, tmp_root, monkeypatch, capsys):
    snapshots = _snapshots(spark)
    placed = place_by_day(snapshots)
    placed.explain()
    plan = capsys.readouterr().out
    wide = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x and "load_date" not in x.split("hashpartitioning")[1]]
    assert len(wide) == 1 and "REPARTITION_BY_COL" in wide[0]
    # Sorted by the folder first, so that the write has nothing to sort.
    assert "Sort [_part#" in plan and plan.index("Window [") < plan.index("Sort [_part#") < plan.index("REPARTITION_BY_COL")
    monkeypatch.setattr(build, "SNAPSHOTS_PER_BUCKET", 7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        cur = build.Curated.current(spark, tmp_root)
        days = cur.write("silver_media_stats", place_by_day(snapshots))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert days == ["2025-03-01", "2025-03-02", "2025-03-03", "__HIVE_DEFAULT_PARTITION__"]
    folder, = cur.manifest.parts("silver_media_stats")["2025-03-01"]
    assert len([f for f in os.listdir(f"{tmp_root}/{folder}") if f.endswith(".parquet")]) > 1  # by several tasks
    assert cur.read("silver_media_stats").count() == cur.rows["silver_media_stats"] == placed.count()
