"""Incremental ingestion against a per-media high watermark, as Spark joins
and aggregations over landed candidate events.

Watermark semantics (kept from the API client):
* an event is new when its media has no watermark, or it has no (or an
  empty) ``received_at``, or ``received_at`` sorts strictly after the
  watermark -- compared as text, exactly as the API writes it;
* the watermark advances to the greatest non-empty ``received_at`` among the
  new events, never backwards, and is untouched when a media has none;
* every processed media gets the run time as ``last_ingested_at``.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _blank(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) == ""


def parse_allow_list(spark: SparkSession, text: str) -> DataFrame:
    """``" a, b,,c "`` -> media_id rows a, b, c (trimmed, empties dropped),
    parsed by Spark."""
    raw = spark.createDataFrame([(text,)], "allow string")
    ids = raw.select(F.explode(F.split("allow", ",")).alias("media_id")) \
        .select(F.trim("media_id").alias("media_id")).where(F.col("media_id") != "")
    return ids.distinct()


def restrict_to(df: DataFrame, media: DataFrame) -> DataFrame:
    """Keep rows of the listed media (left semi join; the list is small)."""
    return df.join(media.select("media_id"), "media_id", "left_semi")


def _with_watermark(candidates: DataFrame, checkpoint: DataFrame) -> DataFrame:
    wm = checkpoint.select("media_id", F.col("last_event_received_at").alias("_watermark"))
    return candidates.join(wm, "media_id", "left")


def is_new(received_at: Column, watermark: Column) -> Column:
    return _blank(watermark) | _blank(received_at) | (received_at > watermark)


def new_events(candidates: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Candidates the watermark lets through (the checkpoint has one row per
    media, so the join does not multiply rows; AQE broadcasts it when small)."""
    j = _with_watermark(candidates, checkpoint)
    return j.where(is_new(F.col("received_at"), F.col("_watermark"))).drop("_watermark")


def at_or_before_watermark(candidates: DataFrame, checkpoint: DataFrame) -> DataFrame:
    j = _with_watermark(candidates, checkpoint)
    return j.where(~is_new(F.col("received_at"), F.col("_watermark"))).drop("_watermark")


def late_events(candidates: DataFrame, checkpoint: DataFrame, landed: DataFrame) -> DataFrame:
    """Events the watermark filters out that were never landed before: they
    arrived at the source after the watermark had passed their timestamp.
    (The source re-serves the whole history every run, so most filtered
    events are simply already landed.)"""
    old = at_or_before_watermark(candidates, checkpoint)
    return old.join(landed.select("event_key"), "event_key", "left_anti")


def advance_checkpoint(checkpoint: DataFrame, processed_media: DataFrame,
                       new: DataFrame, run_at: dt.datetime | str) -> DataFrame:
    """The checkpoint after a run: one row per media in the old checkpoint
    or processed by this run.  ``run_at`` is a UTC time (a literal, so reruns
    of the same run give the same checkpoint)."""
    if isinstance(run_at, dt.datetime):
        run_at = run_at.astimezone(dt.timezone.utc).replace(tzinfo=None).isoformat(" ") \
            if run_at.tzinfo else run_at.isoformat(" ")
    newest = new.where(~_blank(F.col("received_at"))).groupBy("media_id") \
        .agg(F.max("received_at").alias("_newest"))
    processed = processed_media.select("media_id").distinct() \
        .join(newest, "media_id", "left").withColumn("_processed", F.lit(True))
    old = checkpoint.select("media_id", F.col("last_event_received_at").alias("_old_wm"),
                            F.col("last_ingested_at").alias("_old_at"))
    m = old.join(processed, "media_id", "full")
    advanced = F.when(F.col("_newest").isNull(), F.col("_old_wm")).otherwise(
        F.greatest(F.nullif(F.col("_old_wm"), F.lit("")), F.col("_newest")))
    ran = F.coalesce(F.col("_processed"), F.lit(False))
    return m.select(
        "media_id",
        F.when(ran, advanced).otherwise(F.col("_old_wm")).alias("last_event_received_at"),
        F.when(ran, F.lit(run_at).cast("timestamp_ntz")).otherwise(F.col("_old_at"))
        .alias("last_ingested_at"),
    )


def ingest_status(processed_media: DataFrame, candidates: DataFrame, new: DataFrame,
                  failed_media: DataFrame | None = None) -> DataFrame:
    """Per processed media: candidate and new event counts and a status of
    ``new_events``, ``no_new_events`` (nothing is written) or ``failed``."""
    seen = candidates.groupBy("media_id").agg(F.count(F.lit(1)).alias("candidate_events"))
    fresh = new.groupBy("media_id").agg(F.count(F.lit(1)).alias("new_events"))
    s = processed_media.select("media_id").distinct().join(seen, "media_id", "left") \
        .join(fresh, "media_id", "left")
    if failed_media is not None:
        s = s.join(failed_media.select("media_id").distinct().withColumn("_failed", F.lit(True)),
                   "media_id", "left")
    else:
        s = s.withColumn("_failed", F.lit(None).cast("boolean"))
    n_new = F.coalesce(F.col("new_events"), F.lit(0))
    return s.select(
        "media_id",
        F.coalesce(F.col("candidate_events"), F.lit(0)).alias("candidate_events"),
        F.when(F.col("_failed"), F.lit(0)).otherwise(n_new).alias("new_events"),
        F.when(F.col("_failed"), F.lit("failed"))
        .when(n_new > 0, F.lit("new_events")).otherwise(F.lit("no_new_events")).alias("status"),
    )


def commit_partial(old: DataFrame, advanced: DataFrame, failed_media: DataFrame) -> DataFrame:
    """Failed media keep their previous checkpoint row (or stay absent);
    all other media take the advanced row."""
    failed = failed_media.select("media_id").distinct()
    ok = advanced.join(failed, "media_id", "left_anti")
    kept = old.join(failed, "media_id", "left_semi")
    return ok.unionByName(kept)


class IngestFailures(RuntimeError):
    """Raised after the checkpoint of the successful media was saved.  The
    failed media are the ``failed`` rows of the status table at ``status_path``."""

    def __init__(self, failed: int, status_path: str):
        super().__init__(f"{failed} media failed; see status 'failed' in the newest version of {status_path}")
        self.failed, self.status_path = failed, status_path


def raise_for_failures(status: DataFrame, status_path: str) -> None:
    """Fail the run if its written status has failed media (after the commit)."""
    failed = status.where(F.col("status") == "failed").count()
    if failed:
        raise IngestFailures(failed, status_path)
