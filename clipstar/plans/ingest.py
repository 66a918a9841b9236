"""One incremental ingestion run over landed candidate events.

The source re-serves each media's whole event history every run; the run
keeps what is newer than the media's watermark, lands it under this run's
load_date, advances and saves the checkpoint, and writes a status per media.
Media listed as failed land nothing and keep their checkpoint; the run raises,
naming the status table, after the checkpoint of the others is saved.  Runs at
one time may land an event twice (Silver keeps it once) but lose no watermark:
the checkpoint is saved by compare and set.
"""
from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstar.operators import incremental as inc
from clipstar.session import shared_dir
from clipstar.schemas import CHECKPOINT_DDL, EVENT_DATASET, MEDIA_DATASET, PARTITION_COLUMN
from clipstar.sources.landing import land_json
from clipstar.sources.commits import ATTEMPTS, Conflict, Versions
from clipstar.sources.tables import save_checkpoint

STATUS_DDL = "media_id STRING, candidate_events BIGINT, new_events BIGINT, status STRING"


def ingest_run(spark: SparkSession, candidates: DataFrame, processed_media: DataFrame,
               checkpoint_path: str, landing_root: str, load_date: str,
               run_at: dt.datetime | str, failed_media: DataFrame | None = None,
               snapshots: DataFrame | None = None) -> DataFrame:
    """Run ingestion; returns the per-media status, which is also written as
    the next version of ``<checkpoint_path>-status``.

    ``candidates``: landed-event records (VISITOR_EVENT_DDL columns) as the
    source served them; ``processed_media``: the run's media (the allow-list);
    ``snapshots``: this run's media snapshot records, landed first.
    """
    shared_dir(spark)  # checkpoint() below writes there
    day = F.lit(load_date).cast("date")
    saved = Versions(spark, checkpoint_path, CHECKPOINT_DDL)
    old, version = saved.newest()
    cands = inc.restrict_to(candidates, processed_media)
    if failed_media is not None:
        cands = cands.join(failed_media.select("media_id"), "media_id", "left_anti")
    if snapshots is not None:
        land_json(snapshots.withColumn(PARTITION_COLUMN, day), landing_root, MEDIA_DATASET)
    # Materialised once: landed, used for the watermark, and counted.
    new = inc.new_events(cands, old).checkpoint()
    # Media without new events contribute no rows, hence no files.
    land_json(new.drop(PARTITION_COLUMN).withColumn(PARTITION_COLUMN, day), landing_root,
              EVENT_DATASET)
    status = inc.ingest_status(processed_media, cands, new, failed_media).checkpoint()
    for _ in range(ATTEMPTS):
        advanced = inc.advance_checkpoint(old, processed_media, new, run_at)
        if failed_media is not None:
            advanced = inc.commit_partial(old, advanced, failed_media)
        try:
            save_checkpoint(spark, advanced, checkpoint_path, version)
            break
        except Conflict:
            # Another run saved first: advance from what it saved, so that neither run's watermarks are lost.
            old, version = saved.newest()
    else:
        raise Conflict(f"{checkpoint_path}: {ATTEMPTS} other runs saved first")
    runs = Versions(spark, f"{checkpoint_path.rstrip('/')}-status", STATUS_DDL)
    runs.write(status)
    inc.raise_for_failures(status, runs.commits.root)
    return status
