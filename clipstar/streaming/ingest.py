"""Ingestion as a stream: served histories against the per-media checkpoint.

Each micro-batch holds what the source served to one or more runs (``load_date`` is the run's day).  Its events are joined
with the checkpoint that the micro-batch before it left, those that pass the watermark are landed, and the advanced
checkpoint is committed together with the micro-batch's number.  So a micro-batch that is replayed after a failure meets
either the checkpoint it met before, or its own number, and does nothing; at worst it lands events twice, which Silver
keeps once.  A run has to be served in one micro-batch, as its events must not meet the watermark of their own run.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipstar.operators import incremental as inc
from clipstar.plans.build import batch_name
from clipstar.schemas import CHECKPOINT_DDL, EVENT_DATASET, PARTITION_COLUMN
from clipstar.session import shared_dir
from clipstar.sources.commits import Versions
from clipstar.sources.landing import land_json
from clipstar.streaming.events import event_stream


class IngestSink:
    def __init__(self, spark: SparkSession, media: DataFrame, checkpoint_path: str, landing_root: str, stream: str):
        self.spark, self.media, self.landing_root, self.stream = spark, media, landing_root, batch_name(stream)
        self.saved = Versions(spark, checkpoint_path, CHECKPOINT_DDL)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        old, version = self.saved.newest()
        if self.saved.number(self.stream) >= batch_id:
            return
        served = inc.restrict_to(batch, self.media).checkpoint()
        for day in sorted(r[0] for r in served.select(PARTITION_COLUMN).distinct().collect()):  # the runs of the batch
            new = inc.new_events(served.where(F.col(PARTITION_COLUMN) == day), old).checkpoint()
            land_json(new.drop("malformed", "file"), self.landing_root, EVENT_DATASET)
            old = inc.advance_checkpoint(old, self.media, new, f"{day} 00:00:00").checkpoint()
        self.saved.write(old, version, {self.stream: batch_id})


def start_ingest_stream(spark: SparkSession, served_root: str, media: DataFrame, checkpoint_path: str, landing_root: str,
                        checkpoint_location: str) -> StreamingQuery:
    """Ingest what was served below ``served_root`` and has not been yet, then stop."""
    shared_dir(spark)
    sink = IngestSink(spark, media, checkpoint_path, landing_root, checkpoint_location)
    return event_stream(spark, served_root).writeStream.foreachBatch(sink) \
        .option("checkpointLocation", checkpoint_location).trigger(availableNow=True).start()
