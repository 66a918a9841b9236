"""Batch builds: full rebuild and incremental update of Bronze/Silver/Gold.

A batch reads the tables of one commit, writes new folders and publishes them all with the next commit
(``sources.commits``).  So it is in all tables or in none; a batch that failed is run again from the start, a batch that
is run twice changes nothing, and a batch that another one overtook begins again from what that one committed.

Each layer is written and then read back, so every raw file is parsed once per run and later layers scan columnar data.
Row counts come from ``observe`` on the writes, not extra scans.

Tables by day replace the days a batch touches.  Silver events are added to days.  What grows with every key (the index of
event keys, the states of media and visitors, the days of each media) is kept in levelled runs (``sources.runs``), so that
a small batch writes small runs; the dimensions are read from the states.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clipstar.functions.channel import DEFAULT_CHANNEL
from clipstar.operators import dims, fact, marts, silver
from clipstar.schemas import FACT_VISITORS_DDL, MEDIA_DAYS_DDL, MEDIA_STATE_DDL, QUARANTINE_COLUMNS, TABLES, VISITOR_STATE_DDL
from clipstar.session import shared_dir, working_session
from clipstar.sources.commits import NO_VALUE, Commits, Manifest, names_in, observed
from clipstar.sources.landing import read_media_snapshots, read_visitor_events
from clipstar.sources.runs import KeyIndex, Runs
from clipstar.sources.tables import write_table

#: The column that names a row's part of its table.
PARTS = {
    "bronze_media_stats": "batch",
    "bronze_visitor_events": "batch",
    "silver_media_stats": "load_date",
    "silver_visitor_events": "date",
    "fact_base": "date",
    "fact_media_engagement": "date",
    "mart_days": "date",
    "dim_media": None,
}
REBUILD = "rebuild"
#: A day's Silver events are rewritten into one folder when they are in so many.
MERGE_FOLDERS = 8
#: A task that writes Silver snapshots sorts so many rows of a day, or a little more.
SNAPSHOTS_PER_BUCKET = 250_000
BRONZE = {"bronze_media_stats": read_media_snapshots, "bronze_visitor_events": read_visitor_events}


@dataclass
class Curated:
    """The tables as one commit has them, and the changes a batch makes to them before the next one."""

    spark: SparkSession
    root: str
    manifest: Manifest
    rows: dict[str, int] = field(default_factory=dict)
    malformed: dict[str, int] = field(default_factory=dict)

    @staticmethod
    def current(spark: SparkSession, root: str, version: int | None = None) -> Curated:
        """The newest commit, or ``version`` while it is kept."""
        return Curated(spark, root, Commits(spark, root).read(version))

    @property
    def version(self) -> int:
        return self.manifest.version

    @property
    def commits(self) -> Commits:
        return Commits(self.spark, self.root)

    def read(self, name: str, only: Iterable[str] | None = None) -> DataFrame:
        """A table; with ``only``, the parts of these names."""
        if name == "dim_visitor":
            return dims.dim_visitor_from_state(self.visitor_state.read())
        parts = self.manifest.parts(name)
        chosen = sorted(parts) if only is None else sorted(set(only) & parts.keys())
        folders = sorted({f for p in chosen for f in parts[p]})
        if not folders:
            return self.spark.createDataFrame([], TABLES[name])
        return self.spark.read.schema(TABLES[name]).parquet(*[f"{self.commits.root}/{f}" for f in folders])

    def write(self, name: str, df: DataFrame, add: bool = False, batch: str | None = None) -> list[str]:
        """Replace the parts that ``df`` has rows in, or add folders to them; the parts' names.  Bronze is written with
        the ``batch`` that all rows of ``df`` are of."""
        part, columns = PARTS[name], self.spark.createDataFrame([], TABLES[name]).columns
        folder, seen = self.commits.new_folder(name), Observation()
        counts = [F.count(F.lit(1)).alias("rows")]
        if name in BRONZE:
            counts.append(F.count("malformed").alias("malformed"))
        counted = df.select(*columns, *[c for c in df.columns if c == "_part"]).observe(seen, *counts)
        at = f"{self.commits.root}/{folder}"
        if name in BRONZE:
            # Landed records are one part, written by the tasks that parse them.  Not by ``partitionBy``, which would sort
            # each task's records, whole as they are, by a column that is the same in all of them.
            if batch is None:
                raise ValueError(f"{name} is written by batch")
            counted.write.option("compression", "zstd").parquet(at)
            placed = {batch: folder} if observed(seen, "rows") else {}
        elif part:
            # Rebalanced by part: AQE sizes the write tasks and splits a hot day, so that no task writes a huge or tiny file.
            # Rows that are placed by part already have its name, and come sorted by it.
            rows = counted if "_part" in counted.columns \
                else counted.withColumn("_part", F.col(part)).hint("rebalance", "_part")
            rows.write.option("compression", "zstd").partitionBy("_part").parquet(at)
            found = [n for n in names_in(self.spark, at) if n.startswith("_part=")]
            placed = {n.removeprefix("_part="): f"{folder}/{n}" for n in found}
        else:
            counted.write.parquet(at)
            placed = {"all": folder}
        self.rows[name] = self.rows.get(name, 0) + observed(seen, "rows")
        if name in BRONZE:
            self.malformed[name] = self.malformed.get(name, 0) + observed(seen, "malformed")
        parts = self.manifest.parts(name)
        for p, f in placed.items():
            parts[p] = [*parts.get(p, []), f] if add else [f]
        return sorted(placed)

    def _runs(self, table: str, ddl: str, combine) -> Runs:
        return Runs(self.commits, self.manifest, table, ddl, combine)

    @property
    def media_state(self) -> Runs:
        return self._runs("media_state", MEDIA_STATE_DDL, dims.combine_media_state)

    @property
    def visitor_state(self) -> Runs:
        return self._runs("visitor_state", VISITOR_STATE_DDL, dims.combine_visitor_state)

    @property
    def media_days(self) -> Runs:
        return self._runs("media_days", MEDIA_DAYS_DDL, fact.combine_media_days)

    @property
    def fact_visitors(self) -> Runs:
        return self._runs("fact_visitors", FACT_VISITORS_DDL, lambda rows: rows.distinct())

    @property
    def event_index(self) -> KeyIndex:
        return KeyIndex(self.commits, self.manifest, "event_index")

    def profile(self) -> DataFrame:
        return dims.profile_from_state(self.media_state.read())


def batch_name(root: str) -> str:
    """A batch's name by its landing folder: the same folder is the same batch."""
    return "b" + hashlib.md5(root.rstrip("/").encode()).hexdigest()[:16]


def _days(df: DataFrame, column: str) -> list[str]:
    """The days of ``df`` as part names: as many as the tables have folders for them at most."""
    return [NO_VALUE if r[0] is None else str(r[0]) for r in df.select(column).distinct().collect()]


def write_bronze(cur: Curated, name: str, landed: DataFrame, batch: str, layout: str = "lines") -> DataFrame:
    """The batch's records; what a second run wrote replaces what the first did."""
    cur.manifest.parts(name).pop(batch, None)
    landed = landed.hint("rebalance") if layout == "document" else landed  # many small files become few
    cur.write(name, landed.withColumn("batch", F.lit(batch)), batch=batch)
    return cur.read(name, [batch])


def place_by_day(snapshots: DataFrame) -> DataFrame:
    """One snapshot per media and day, laid out as Silver is written: in one shuffle, by day and, where a day has many
    rows, by buckets of its media; ``_part`` names the day.

    Deduplicated by key and then rebalanced by day, all would be shuffled twice, and the scan's tasks would sort their
    rows, as many as a split of well compressed records has, only to find few of them superseded within the task."""
    days = snapshots.groupBy(F.col("load_date").alias("_part")).count() \
        .withColumn("_buckets", F.ceil(F.col("count") / SNAPSHOTS_PER_BUCKET)).drop("count")
    placed = snapshots.withColumn("_part", F.col("load_date")) \
        .join(F.broadcast(days.withColumnRenamed("_part", "_day")), F.col("_part").eqNullSafe(F.col("_day")), "left") \
        .withColumn("_bucket", F.pmod(F.xxhash64("media_id"), F.col("_buckets"))).drop("_day", "_buckets") \
        .repartition("_part", "_bucket")
    return silver.one_snapshot_per_day(placed, within=["_part", "_bucket"])


def _versioned(picks: DataFrame, version: int, anew: bool) -> DataFrame:
    return picks.select("*", F.lit(version).cast("bigint").alias("version"), F.lit(anew).alias("anew"))


def fold_media(cur: Curated, snapshots: DataFrame) -> DataFrame:
    """Fold flattened snapshots into Silver and the media state; the media whose duration or play_rate this changed.

    A snapshot replaces the one of its media and day if it was landed later, so only the days landed are read and
    rewritten.  Media without a replaced snapshot have their picks merged; those with one are picked anew from all of
    their Silver, and their earlier picks no longer count.
    """
    if not cur.manifest.parts("silver_media_stats"):
        cur.write("silver_media_stats", place_by_day(snapshots))
        first = dims.media_state(cur.read("silver_media_stats"))
        cur.media_state.add(_versioned(first, cur.version + 1, False))
        return cur.profile().select("media_id")
    shared_dir(cur.spark)  # checkpoint() below writes there
    new = place_by_day(snapshots).drop("_part").checkpoint()
    days = _days(new, "load_date")
    before = cur.read("silver_media_stats", days)
    replaced = before.join(new.select("media_id", "load_date"), ["media_id", "load_date"], "left_semi") \
        .select("media_id").distinct().checkpoint()
    measures = cur.profile().join(new.select("media_id").distinct(), "media_id", "left_semi") \
        .select("media_id", "duration_seconds", "play_rate").checkpoint()
    cur.write("silver_media_stats", place_by_day(before.unionByName(new)))
    picks = _versioned(dims.media_state(new.join(replaced, "media_id", "left_anti")), cur.version + 1, False)
    if not replaced.isEmpty():
        again = cur.read("silver_media_stats").join(replaced, "media_id", "left_semi")
        picks = picks.unionByName(_versioned(dims.media_state(again), cur.version + 1, True))
    cur.media_state.add(picks)
    old = measures.select("media_id", F.struct("duration_seconds", "play_rate").alias("old"))
    return cur.profile().join(new.select("media_id").distinct(), "media_id", "left_semi").join(old, "media_id", "left") \
        .where(~F.struct("duration_seconds", "play_rate").eqNullSafe(F.col("old"))).select("media_id")


def unseen_events(candidates: DataFrame, index: KeyIndex) -> DataFrame:
    """Candidate Silver rows whose event_key no batch has written, whatever the dates of the copies."""
    known, _ = index.known(index.keyed(candidates, "event_key"))
    return candidates.join(known.withColumnRenamed("key", "event_key"), "event_key", "left_anti")


def fold_events(cur: Curated, candidates: DataFrame) -> list[str]:
    """Fold deduplicated Silver candidates into Silver, the index, fact_base and the visitor state; the days they are on."""
    parts = cur.manifest.parts("silver_visitor_events")
    if not parts:
        cur.write("silver_visitor_events", candidates)
        return _fold_fresh(cur, cur.read("silver_visitor_events"))
    shared_dir(cur.spark)
    fresh = unseen_events(candidates.checkpoint(), cur.event_index).checkpoint()
    crowded = [d for d in _days(fresh, "date") if len(parts.get(d, [])) >= MERGE_FOLDERS - 1]
    if crowded:
        stored, own = cur.read("silver_visitor_events", crowded), F.coalesce(F.col("date").cast("string"), F.lit(NO_VALUE))
        cur.write("silver_visitor_events", stored.unionByName(fresh.where(own.isin(crowded)).select(*stored.columns)))
        cur.write("silver_visitor_events", fresh.where(~own.isin(crowded)), add=True)
    else:
        cur.write("silver_visitor_events", fresh, add=True)
    return _fold_fresh(cur, fresh)


def _fold_fresh(cur: Curated, fresh: DataFrame) -> list[str]:
    cur.event_index.add_keys(fresh, "event_key")
    daily = fact.daily_engagement(fresh)
    if not cur.manifest.parts("fact_base"):
        days = cur.write("fact_base", daily)
        daily = cur.read("fact_base")
    else:
        daily = daily.checkpoint()
        days = _days(daily, "date")
        cur.write("fact_base", fact.combine_daily(cur.read("fact_base", days).unionByName(daily)))
    cur.media_days.add(fact.media_days(daily))
    cur.fact_visitors.add(daily.select("visitor_id"))
    cur.visitor_state.add(dims.visitor_state(fresh))
    return days


def write_dim_media(cur: Curated, channel_mapping, default_channel: str) -> None:
    """A row per media; visitors, of which there are many more, are read from their state."""
    cur.write("dim_media", dims.dim_media(profile=cur.profile(), channel_mapping=channel_mapping,
                                          default_channel=default_channel))


def days_of(cur: Curated, media: DataFrame) -> list[str]:
    """Days with facts of ``media(media_id)``, from the bitmaps of days; no fact is read."""
    return _days(fact.days_in(cur.media_days.rows().join(media, "media_id", "left_semi")), "date")


def write_fact(cur: Curated, days: Iterable[str]) -> None:
    """The fact of these days, and the marts' sums of them."""
    days = set(days)
    if days:
        cur.write("fact_media_engagement", fact.attach_media_measures(cur.read("fact_base", days), cur.profile()))
        cur.write("mart_days", marts.day_sums(cur.read("fact_media_engagement", days)))


def _fold(cur: Curated, landing_root: str, batch: str, channel_mapping, default_channel: str, layout: str) -> None:
    media, events = (write_bronze(cur, name, read(cur.spark, landing_root, layout, allow_missing=True, audit=True), batch, layout)
                     for name, read in BRONZE.items())
    changed = fold_media(cur, silver.flat_snapshots(media)).checkpoint()
    days = fold_events(cur, silver.silver_visitor_events(events))
    if not changed.isEmpty():
        days += days_of(cur, changed)
    write_dim_media(cur, channel_mapping, default_channel)
    write_fact(cur, days)


def full_rebuild(spark: SparkSession, landing_root: str, curated_root: str,
                 channel_mapping: Mapping[str, str] | DataFrame | None = None,
                 default_channel: str = DEFAULT_CHANNEL, layout: str = "lines") -> Curated:
    """Rebuild every table from the whole landing zone, as one commit in place of all that was (rerunning gives the same
    tables; vanished dates disappear).  Readers use the commits before until then, and while these are kept."""
    shared_dir(spark)
    out, work = {}, working_session(spark)

    def step(now: Manifest) -> Manifest:
        cur = out["built"] = Curated(work, curated_root, Manifest(now.version, {}, now.numbers))
        _fold(cur, landing_root, REBUILD, channel_mapping, default_channel, layout)
        return cur.manifest
    built = Commits(spark, curated_root).change(step)
    return Curated(spark, curated_root, built, out["built"].rows, out["built"].malformed)


def incremental_update(spark: SparkSession, batch_root: str, curated_root: str,
                       channel_mapping: Mapping[str, str] | DataFrame | None = None,
                       default_channel: str = DEFAULT_CHANNEL, layout: str = "lines",
                       batch: str | None = None) -> Curated:
    """Fold a batch of newly landed files (``batch_root``, same layout as the landing zone) into tables built earlier.
    Matches a full rebuild when batches arrive in load_date order (the earliest landing of an event wins in both); a
    changed channel mapping needs a full rebuild.

    * Silver events: only event keys that no batch has written, by the index of keys.
    * fact_base: the batch's sums are added to those of the days it touches.
    * media and visitor state, days of media: a run of the batch's rows.
    * fact: days with new events, or with rows of a media whose duration or play_rate this batch changed.
    """
    shared_dir(spark)
    out, work = {}, working_session(spark)

    def step(now: Manifest) -> Manifest:
        cur = out["built"] = Curated(work, curated_root, now)
        _fold(cur, batch_root, batch or batch_name(batch_root), channel_mapping, default_channel, layout)
        return cur.manifest
    built = Commits(spark, curated_root).change(step)
    return Curated(spark, curated_root, built, out["built"].rows, out["built"].malformed)


def export(cur: Curated, folder: str) -> dict[str, str]:
    """The Gold tables of this commit as plain folders, as external tables need them; table -> folder."""
    out, cur = {}, Curated(working_session(cur.spark), cur.root, cur.manifest)
    for name in ("dim_media", "dim_visitor", "fact_media_engagement"):
        out[name] = f"{folder.rstrip('/')}/{name}"
        part = PARTS.get(name)
        df = cur.read(name)
        write_table(df.hint("rebalance", part) if part else df, out[name], partition_by=[part] if part else None)
    return out


def quarantine(cur: Curated) -> DataFrame:
    """Landed records that could not be read as declared, with their files."""
    kept = [cur.read(name).where("malformed is not null").select(F.lit(name).alias("table_name"), *QUARANTINE_COLUMNS)
            for name in BRONZE]
    return kept[0].unionByName(kept[1])
