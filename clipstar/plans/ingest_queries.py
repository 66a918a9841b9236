"""Queries for the re-aimed incremental ingestion: watermark filter,
checkpoint advance and storage, late-event audit, run status, media
allow-list and a run with failures."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.operators import incremental as inc
from clipstar.plans import adapters
from clipstar.plans import sql_mirror as M
from clipstar.plans.registry import register
from clipstar.plans.star import Star
from clipstar.session import scratch_path
from clipstar.sources.tables import empty_checkpoint, load_checkpoint, save_checkpoint

ALLOW_LIST = " 1, 3 ,, 7 "

_INGEST = M.with_ctes(M.INGEST)


class Run:
    """The previous run (which left the checkpoint) and the current run."""

    def __init__(self, s: Star):
        spark, d = s.spark, s.sf_dir
        self.processed = adapters.media_catalog(spark, d)
        self.prev_candidates = self._cols(adapters.api_events(spark, d, adapters.PREVIOUS_RUN_AT))
        prev_new = inc.new_events(self.prev_candidates, empty_checkpoint(spark))
        self.prev_checkpoint = inc.advance_checkpoint(
            empty_checkpoint(spark), self.processed, prev_new, adapters.PREVIOUS_RUN_AT)
        self.candidates = self._cols(adapters.api_events(spark, d))
        self.new = inc.new_events(self.candidates, self.prev_checkpoint)

    @staticmethod
    def _cols(df: DataFrame) -> DataFrame:
        return df.select("media_id", "event_key", "received_at")

    def checkpoint(self) -> DataFrame:
        return inc.advance_checkpoint(self.prev_checkpoint, self.processed, self.new,
                                      adapters.RUN_AT)


@register("incremental_new_events", _INGEST + "SELECT media_id, event_key, received_at FROM new_ev")
def q_incremental_new_events(s: Star) -> DataFrame:
    """Events newer than their media's watermark, by text order."""
    return Run(s).new


@register("checkpoint_advance", _INGEST + "SELECT * FROM cp2")
def q_checkpoint_advance(s: Star) -> DataFrame:
    """The checkpoint after the run."""
    return Run(s).checkpoint()


@register("checkpoint_roundtrip", _INGEST + "SELECT * FROM cp2")
def q_checkpoint_roundtrip(s: Star) -> DataFrame:
    """Both runs' checkpoints saved as versions; loading returns the newest."""
    run = Run(s)
    path = scratch_path(s.spark, "checkpoint")
    if load_checkpoint(s.spark, path).count() != 0:  # a missing checkpoint loads empty
        raise RuntimeError(f"fresh checkpoint path {path} is not empty")
    save_checkpoint(s.spark, run.prev_checkpoint, path)
    save_checkpoint(s.spark, run.checkpoint(), path)
    return load_checkpoint(s.spark, path)


@register("late_events_audit", _INGEST + """
SELECT c.media_id, c.event_key, c.received_at
FROM cand c LEFT JOIN prev_cp p ON c.media_id = p.media_id
WHERE NOT (COALESCE(p.last_event_received_at, '') = '' OR COALESCE(c.received_at, '') = ''
           OR c.received_at > p.last_event_received_at)
  AND NOT EXISTS (SELECT 1 FROM prev_cand x WHERE x.event_key = c.event_key)""")
def q_late_events_audit(s: Star) -> DataFrame:
    """Events filtered by the watermark that were never landed: they reached
    the source after the previous run had moved past them (I6)."""
    run = Run(s)
    return inc.late_events(run.candidates, run.prev_checkpoint, run.prev_candidates)


@register("ingest_status", _INGEST + """
SELECT p.media_id, COALESCE(c.n, 0) AS candidate_events, COALESCE(n.n, 0) AS new_events,
       CASE WHEN COALESCE(n.n, 0) > 0 THEN 'new_events' ELSE 'no_new_events' END AS status
FROM processed p
LEFT JOIN (SELECT media_id, COUNT(*) AS n FROM cand GROUP BY media_id) c ON p.media_id = c.media_id
LEFT JOIN (SELECT media_id, COUNT(*) AS n FROM new_ev GROUP BY media_id) n ON p.media_id = n.media_id""")
def q_ingest_status(s: Star) -> DataFrame:
    """Per processed media: candidates, new events and whether anything is
    written (I3, I4)."""
    run = Run(s)
    return inc.ingest_status(run.processed, run.candidates, run.new)


@register("media_allow_list", _INGEST +
          "SELECT media_id, event_key, received_at FROM new_ev WHERE media_id IN ('1', '3', '7')")
def q_media_allow_list(s: Star) -> DataFrame:
    """The run's --media-ids list: comma separated, trimmed, empties ignored."""
    run = Run(s)
    allowed = inc.parse_allow_list(s.spark, ALLOW_LIST)
    return inc.restrict_to(run.new, allowed)


def _two_runs(s: Star, failed: DataFrame | None = None) -> tuple[DataFrame | None, str, str]:
    """The previous and the current ingestion run, end to end: candidates
    the source served to each run, landed under each run's date, with the
    checkpoint saved between them.  (status, landing, checkpoint); no status
    if media of the current run failed."""
    from clipstar.plans.ingest import ingest_run
    spark, d = s.spark, s.sf_dir
    media = adapters.media_catalog(spark, d)
    work = scratch_path(spark, "ingest")
    cp, land = f"{work}/checkpoint", f"{work}/landing"
    ingest_run(spark, adapters.api_events(spark, d, adapters.PREVIOUS_RUN_AT), media, cp, land,
               adapters.PREVIOUS_RUN_AT[:10], adapters.PREVIOUS_RUN_AT)
    try:
        status = ingest_run(spark, adapters.api_events(spark, d), media, cp, land, adapters.RUN_AT[:10],
                            adapters.RUN_AT, failed)
    except inc.IngestFailures:
        status = None
    return status, land, cp


@register("ingest_run_status", _INGEST + """
SELECT p.media_id, COALESCE(c.n, 0) AS candidate_events, COALESCE(n.n, 0) AS new_events,
       CASE WHEN COALESCE(n.n, 0) > 0 THEN 'new_events' ELSE 'no_new_events' END AS status
FROM processed p
LEFT JOIN (SELECT media_id, COUNT(*) AS n FROM cand GROUP BY media_id) c ON p.media_id = c.media_id
LEFT JOIN (SELECT media_id, COUNT(*) AS n FROM new_ev GROUP BY media_id) n ON p.media_id = n.media_id""")
def q_ingest_run_status(s: Star) -> DataFrame:
    """Status of the current run after the previous one, both run end to end
    (I1-I4, S4, S12)."""
    status, _, _ = _two_runs(s)
    return status


@register("ingest_run_landed", _INGEST + """
SELECT media_id, event_key, received_at, DATE '2024-01-15' AS load_date FROM prev_cand
WHERE media_id IN (SELECT media_id FROM processed)
UNION ALL
SELECT media_id, event_key, received_at, DATE '2024-02-01' AS load_date FROM new_ev
WHERE media_id IN (SELECT media_id FROM processed)""")
def q_ingest_run_landed(s: Star) -> DataFrame:
    """Everything the two runs landed, read back from the landing zone: the
    first run lands all it was served, the second only what passed the
    watermark (I1, I3, S4)."""
    from clipstar.sources.landing import read_visitor_events
    _, land, _ = _two_runs(s)
    return read_visitor_events(s.spark, land).select("media_id", "event_key", "received_at",
                                                     "load_date")


@register("checkpoint_partial_commit", _INGEST + """, failed AS (
  SELECT CAST(p_partkey AS VARCHAR) AS media_id FROM part WHERE p_type = 'ECONOMY'
)
SELECT * FROM cp2 WHERE media_id NOT IN (SELECT media_id FROM failed)
UNION ALL SELECT * FROM prev_cp WHERE media_id IN (SELECT media_id FROM failed)""")
def q_checkpoint_partial_commit(s: Star) -> DataFrame:
    """The checkpoint after a run with failed media: theirs stays as the
    previous run left it, the others advance (I4, N13)."""
    _, _, cp = _two_runs(s, adapters.failing_media(s.spark, s.sf_dir))
    return load_checkpoint(s.spark, cp)


@register("union_by_name", _INGEST + """
SELECT media_id, event_key, received_at, DATE '2024-01-15' AS load_date FROM prev_cand
UNION ALL SELECT media_id, event_key, received_at, DATE '2024-02-01' FROM cand""")
def q_union_by_name(s: Star) -> DataFrame:
    """What the source served to both runs, each under its run date, a
    parameter, as a constant column (O5, P12, P14)."""
    run = Run(s)
    parts = [df.withColumn("load_date", F.lit(at[:10]).cast("date"))
             for df, at in ((run.prev_candidates, adapters.PREVIOUS_RUN_AT), (run.candidates, adapters.RUN_AT))]
    return parts[0].unionByName(parts[1].select(*reversed(parts[1].columns)))
