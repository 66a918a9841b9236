"""Queries over landed JSON, curated tables and the catalog."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipstar.operators import marts, silver
from clipstar.plans import adapters, landed
from clipstar.plans import sql_mirror as M
from clipstar.plans.build import Curated, full_rebuild, quarantine
from clipstar.plans.ingest import ingest_run
from clipstar.plans.registry import register, star_sql
from clipstar.plans.star import Star
from clipstar.schemas import EVENT_DATASET, MEDIA_DATASET, VISITOR_EVENT_DDL
from clipstar.session import scratch_path
from clipstar.sources import catalog
from clipstar.sources.landing import (
    compose_snapshots, file_audit, land_arrays, land_documents, land_json, read_media_snapshots, read_visitor_events,
)

_BRONZE_EVENTS_SQL = M.with_ctes(M.GEO, M.BRONZE_EVENTS)

_BRONZE_MEDIA_SQL = """
SELECT CAST(l.l_partkey AS VARCHAR) AS media_id,
       CASE WHEN l.l_partkey % 5 IN (1, 2) THEN 'Untitled' ELSE p.p_name END AS title,
       CASE WHEN o.o_orderstatus = 'P' THEN NULL
            ELSE strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+00:00' END AS updated,
       concat_ws(',', p.p_brand, p.p_type) AS tags,
       'https://media.example.test/s/' || CAST(l.l_orderkey AS VARCHAR) || '-'
           || CAST(l.l_linenumber AS VARCHAR) AS url,
       CAST(l.l_quantity AS BIGINT) AS play_count, l.l_discount AS play_rate,
       CAST(date_trunc('month', l.l_shipdate) AS DATE) AS load_date
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey"""


@register("bronze_media_stats", _BRONZE_MEDIA_SQL)
def q_bronze_media_stats(s: Star) -> DataFrame:
    """Nested JSON snapshots landed under load_date= and read back with the
    explicit schema; partition column discovered as DATE (S1, S3, S4)."""
    b = read_media_snapshots(s.spark, landed.landing_root(s.spark, s.sf_dir, MEDIA_DATASET))
    return b.select(
        F.col("media.hashed_id").alias("media_id"), F.col("media.name").alias("title"),
        F.col("media.updated").alias("updated"), F.concat_ws(",", "media.tags").alias("tags"),
        F.col("media.share_link.url").alias("url"), F.col("stats.play_count").alias("play_count"),
        F.col("stats.play_rate").alias("play_rate"), "load_date")


@register("bronze_events", _BRONZE_EVENTS_SQL + "SELECT * FROM bronze_events")
def q_bronze_events(s: Star) -> DataFrame:
    """Landed visitor events, one row per landed record including re-landed
    copies (S2, S3, S4)."""
    b = read_visitor_events(s.spark, landed.landing_root(s.spark, s.sf_dir, EVENT_DATASET))
    return b.select("event_key", "received_at", "media_id", "visitor_key", "country",
                    "percent_viewed", F.col("user_agent_details.browser").alias("browser"),
                    "load_date")


@register("load_date_prune", _BRONZE_EVENTS_SQL +
          "SELECT event_key, load_date FROM bronze_events WHERE load_date >= DATE '2024-01-16'")
def q_load_date_prune(s: Star) -> DataFrame:
    """A load_date predicate prunes landing folders (PartitionFilters) (S3)."""
    b = read_visitor_events(s.spark, landed.landing_root(s.spark, s.sf_dir, EVENT_DATASET))
    return b.where(F.col("load_date") >= F.lit("2024-01-16").cast("date")) \
        .select("event_key", "load_date")


@register("raw_json_roundtrip", _BRONZE_EVENTS_SQL +
          "SELECT load_date, COUNT(*) AS landed_rows, COUNT(*) AS matching_rows "
          "FROM bronze_events GROUP BY load_date")
def q_raw_json_roundtrip(s: Star) -> DataFrame:
    """Per landing folder: records read back, and how many equal their
    source record field by field (S4)."""
    back = read_visitor_events(s.spark, landed.landing_root(s.spark, s.sf_dir, EVENT_DATASET))
    src = s.bronze_events
    fields = [c for c in src.columns if c not in ("event_key", "load_date")]  # nested ones as a whole
    src_sel = src.select("event_key", "load_date", *[F.col(c).alias(f"_src_{c}") for c in fields])
    j = back.join(src_sel, ["event_key", "load_date"], "left")
    same = F.lit(True)
    for c in fields:
        same = same & F.col(c).eqNullSafe(F.col(f"_src_{c}"))
    return j.groupBy("load_date").agg(
        F.count(F.lit(1)).alias("landed_rows"),
        F.sum(F.when(same, 1).otherwise(0)).alias("matching_rows"))


@register("snapshot_replace", star_sql(
    "SELECT media_id, load_date, play_rate, ingest_seq FROM silver_media"))
def q_snapshot_replace(s: Star) -> DataFrame:
    """Built from days on which a media was landed several times, with rising
    and falling play_rate: the last landed of each day stays (S5, W3)."""
    silver_media = landed.curated(s.spark, s.sf_dir).read("silver_media_stats")
    return silver_media.select("media_id", "load_date", "play_rate", "ingest_seq")


@register("bronze_media_documents", """
SELECT CAST(p_partkey AS VARCHAR) AS media_id, p_name AS title, p_retailprice AS duration_seconds,
       'https://media.example.test/s/' || CAST(p_partkey AS VARCHAR) AS url, DATE '2024-02-01' AS load_date
FROM part""")
def q_bronze_media_documents(s: Star) -> DataFrame:
    """One JSON object per file, one file per media, as the API client lands
    them; read back as documents and flattened (S1)."""
    root = scratch_path(s.spark, "documents")
    records = adapters.media_metadata(s.spark, s.sf_dir).select(
        "media", F.lit(adapters.RUN_AT[:10]).cast("date").alias("load_date"))
    land_documents(records, root, MEDIA_DATASET)
    flat = silver.silver_media_stats(read_media_snapshots(s.spark, root, "document"))
    return flat.select("media_id", "title", "duration_seconds", "url", "load_date")


@register("bronze_event_arrays", _BRONZE_EVENTS_SQL + "SELECT * FROM bronze_events")
def q_bronze_event_arrays(s: Star) -> DataFrame:
    """One JSON array per file, a page of a media's events each, read back
    one row per element (S2)."""
    root = scratch_path(s.spark, "arrays")
    # Event ids of a media run in tens, so a page has a hundred events at most.
    page = F.floor(F.col("event_key").cast("bigint") / 1000).alias("page")
    land_arrays(s.bronze_events.select("*", F.col("media_id").alias("of"), page), root, EVENT_DATASET, ["of", "page"])
    b = read_visitor_events(s.spark, root, "document")
    return b.select("event_key", "received_at", "media_id", "visitor_key", "country", "percent_viewed",
                    F.col("user_agent_details.browser").alias("browser"), "load_date")


@register("compose_snapshot", """
SELECT CAST(l.l_partkey AS VARCHAR) AS media_id, p.p_name AS title,
       'https://media.example.test/s/' || CAST(p.p_partkey AS VARCHAR) AS url,
       p.p_retailprice AS duration_seconds, CAST(date_trunc('month', l.l_shipdate) AS DATE) AS load_date,
       CAST(l.l_quantity AS BIGINT) AS play_count, l.l_discount AS play_rate
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
QUALIFY ROW_NUMBER() OVER (PARTITION BY l.l_partkey, date_trunc('month', l.l_shipdate)
                           ORDER BY l.l_orderkey * 8 + l.l_linenumber DESC) = 1""")
def q_compose_snapshot(s: Star) -> DataFrame:
    """Metadata and stats responses paired into {media, stats} records,
    landed, read back and flattened (S11)."""
    root = scratch_path(s.spark, "composed")
    records = compose_snapshots(adapters.media_metadata(s.spark, s.sf_dir),
                                adapters.media_stats_responses(s.spark, s.sf_dir))
    land_json(records, root, MEDIA_DATASET, compression="gzip")
    flat = silver.silver_media_stats(read_media_snapshots(s.spark, root))
    return flat.select("media_id", "title", "url", "duration_seconds", "load_date",
                       "play_count", "play_rate")


_FACT_SELECT = ("SELECT media_id, visitor_id, date, play_count, play_rate, "
                "ROUND(total_watch_time, 4) AS total_watch_time, watched_percent FROM fact")


def _rounded_fact(df: DataFrame) -> DataFrame:
    return df.select("media_id", "visitor_id", "date", "play_count", "play_rate",
                     F.round("total_watch_time", 4).alias("total_watch_time"), "watched_percent")


@register("full_rebuild_rerun", star_sql(_FACT_SELECT))
def q_full_rebuild_rerun(s: Star) -> DataFrame:
    """The whole batch build run twice into the same tables; the fact read
    back equals one run's (S6, I7)."""
    root = landed.landing_root(s.spark, s.sf_dir)
    out = scratch_path(s.spark, "rerun")
    mapping = adapters.channel_mapping(s.spark, s.sf_dir)
    full_rebuild(s.spark, root, out, channel_mapping=mapping)
    cur = full_rebuild(s.spark, root, out, channel_mapping=mapping)
    return _rounded_fact(cur.read("fact_media_engagement"))


@register("fact_partitioned", star_sql(_FACT_SELECT))
def q_fact_partitioned(s: Star) -> DataFrame:
    """The fact table written partitioned by date, read back whole."""
    return _rounded_fact(landed.curated(s.spark, s.sf_dir).read("fact_media_engagement"))


def _registered(s: Star) -> str:
    """The catalog database of the curated Gold tables."""
    db = "clipstar_gold"
    locations = landed.exported(s.spark, s.sf_dir)
    catalog.register_tables(s.spark, db, locations, database_location=scratch_path(s.spark, "warehouse"))
    return db


@register("catalog_gold", star_sql(
    "SELECT d.title, d.channel, COUNT(*) AS engagement_rows, "
    "CAST(SUM(f.play_count) AS BIGINT) AS total_plays, "
    "ROUND(SUM(f.total_watch_time) / 3600.0, 2) AS total_watch_hours "
    "FROM fact f JOIN dim_media d ON f.media_id = d.media_id GROUP BY d.title, d.channel"))
def q_catalog_gold(s: Star) -> DataFrame:
    """Gold tables registered in a catalog database, the example mart run
    as SQL against them (S8, S9)."""
    return catalog.mart(s.spark, "media_channel_rollup", _registered(s))


@register("sql_kpi_summary", star_sql(
    "SELECT CAST(SUM(play_count) AS BIGINT) AS total_plays, "
    "ROUND(SUM(total_watch_time) / 3600.0, 2) AS total_watch_hours, "
    "COUNT(DISTINCT visitor_id) AS unique_visitors, "
    "ROUND(AVG(watched_percent) * 100, 2) AS avg_watched_percent FROM fact"))
def q_sql_kpi_summary(s: Star) -> DataFrame:
    """The KPI mart as SQL over the catalog."""
    return catalog.mart(s.spark, "kpi_summary", _registered(s))


@register("sql_engagement_by_media", star_sql(
    "SELECT d.title, d.channel, CAST(SUM(f.play_count) AS BIGINT) AS plays, "
    "ROUND(SUM(f.total_watch_time) / 3600.0, 2) AS watch_hours "
    "FROM fact f JOIN dim_media d ON f.media_id = d.media_id GROUP BY d.title, d.channel"))
def q_sql_engagement_by_media(s: Star) -> DataFrame:
    """The media mart as SQL over the catalog."""
    return catalog.mart(s.spark, "engagement_by_media", _registered(s))


@register("sql_daily_plays_trend", star_sql(
    "SELECT date, CAST(SUM(play_count) AS BIGINT) AS plays FROM fact GROUP BY date"))
def q_sql_daily_plays_trend(s: Star) -> DataFrame:
    """The daily mart as SQL over the catalog."""
    return catalog.mart(s.spark, "daily_plays_trend", _registered(s))


@register("sql_visitor_geography", star_sql(
    "SELECT country, COUNT(*) AS visitors FROM dim_visitor WHERE country IS NOT NULL GROUP BY country"))
def q_sql_visitor_geography(s: Star) -> DataFrame:
    """The geography mart as SQL over the catalog."""
    return catalog.mart(s.spark, "visitor_geography", _registered(s))


_COUNTED = ("bronze_media_stats", "bronze_visitor_events", "dim_media", "dim_visitor", "fact_media_engagement")


@register("row_count_audit", M.with_ctes(*M.STAR, M.BRONZE_EVENTS) + """
SELECT 'bronze_media_stats' AS table_name, COUNT(*) AS row_count, 0 AS malformed FROM landed_media
UNION ALL SELECT 'bronze_visitor_events', COUNT(*), 0 FROM bronze_events
UNION ALL SELECT 'dim_media', COUNT(*), 0 FROM dim_media
UNION ALL SELECT 'dim_visitor', COUNT(*), 0 FROM dim_visitor
UNION ALL SELECT 'fact_media_engagement', COUNT(*), 0 FROM fact""")
def q_row_count_audit(s: Star) -> DataFrame:
    """Rows, and records without a key (malformed), of the two Bronze and
    three Gold tables, as observed while the build wrote them (A8, N3)."""
    cur = landed.curated(s.spark, s.sf_dir)
    rows = {**cur.rows, "dim_visitor": cur.read("dim_visitor").count()}  # read from its state, not written
    return s.spark.createDataFrame([(t, rows[t], cur.malformed.get(t, 0)) for t in _COUNTED],
                                   "table_name string, row_count long, malformed int")


# Of two landings on one day the later one counts, here that of the odd numbers.
_TWO_LANDINGS = star_sql(_FACT_SELECT).replace("ORDER BY ingest_seq DESC", "ORDER BY ingest_seq % 2 DESC, ingest_seq DESC")


@register("incremental_equals_full", _TWO_LANDINGS)
def q_incremental_equals_full(s: Star) -> DataFrame:
    """Build from the earlier landings, then fold in the later ones, twice;
    the fact equals a full rebuild over everything (I5, I7).  The later ones
    have copies of events with another written date or a malformed one, and
    snapshots that replace those of the same media and day."""
    return _rounded_fact(landed.incremental(s.spark, s.sf_dir)[-1].read("fact_media_engagement"))


@register("previous_commit", M.with_ctes(M.GEO, M.SILVER_EVENTS, M.DAILY.replace(
    "FROM silver_events\n", f"FROM (SELECT s.* FROM silver_events s JOIN events e ON s.event_key = CAST(e.event_id AS VARCHAR) "
    f"WHERE CAST(e.ts AS DATE) < DATE '{landed.EVENT_SPLIT_DATE}')\n")) + """
SELECT media_id, visitor_id, date, play_count, watched_percent, ROUND(percent_viewed_sum, 6) AS percent_viewed_sum FROM daily""")
def q_previous_commit(s: Star) -> DataFrame:
    """The daily sums as the commit before two increments has them, read
    after them: what was landed by then (S6, I7)."""
    first = landed.incremental(s.spark, s.sf_dir)[0]
    base = Curated.current(s.spark, first.root, first.version).read("fact_base")
    return base.withColumn("percent_viewed_sum", F.round("percent_viewed_sum", 6))


@register("same_day_rerun", """
SELECT CAST(p_partkey AS VARCHAR) AS media_id, DATE '2024-02-01' AS load_date,
       CASE WHEN p_partkey % 3 = 0 THEN p_retailprice / 4096 ELSE (p_partkey % 8) / 8.0 END AS play_rate
FROM part""")
def q_same_day_rerun(s: Star) -> DataFrame:
    """Two ingestion runs on one day, the second for two thirds of the media
    with higher and lower rates, the records as the API gives them; then a
    rebuild: the later run's snapshot counts (S5, W3)."""
    spark, work = s.spark, scratch_path(s.spark, "rerun-day")
    media, day = adapters.media_catalog(spark, s.sf_dir), adapters.RUN_AT[:10]
    records = adapters.media_metadata(spark, s.sf_dir)
    part = F.col("media.id")
    rates = {"06:00:00": F.col("media.duration") / 4096, "18:00:00": F.when(part % 3 != 0, (part % 8) / 8.0)}
    nothing = adapters.api_events(spark, s.sf_dir).where(F.lit(False))
    for at, rate in rates.items():
        stats = F.struct(*[F.lit(None).cast(t).alias(n) for n, t in (("load_count", "bigint"), ("play_count", "bigint"))],
                         rate.alias("play_rate"))
        ingest_run(spark, nothing, media, f"{work}/checkpoint", f"{work}/landing", day, f"{day} {at}",
                   snapshots=records.select("media", stats.alias("stats")).where("stats.play_rate is not null"))
    cur = full_rebuild(spark, f"{work}/landing", f"{work}/curated")
    return cur.read("silver_media_stats").select("media_id", "load_date", "play_rate")


# Of the lines that a media's file of a day has, some are cut short, by remainders of the event's number, and some have
# text for a number.  Files of media 7 are empty.
_LINES = """lines AS (
  SELECT CAST(ts AS DATE) AS load_date, event_id % 10 AS media, event_id % 23 = 5 AS cut, event_id % 29 = 7 AS odd
  FROM events)"""


def _landed_lines(s: Star) -> str:
    """Events as JSON lines by rule, a file for each media and day; its folder says which."""
    root = scratch_path(s.spark, "malformed")
    ev = adapters.table(s.spark, s.sf_dir, "events")
    key, percent = F.col("event_id").cast("string").alias("event_key"), F.lit(0.5).alias("percent_viewed")
    good = F.to_json(F.struct(key, F.lit("2024-01-01T00:00:00.000Z").alias("received_at"), percent))
    odd = F.to_json(F.struct(key, F.lit("2024-01-01T00:00:00.000Z").alias("received_at"), F.lit("half").alias("percent_viewed")))
    line = F.when(F.col("event_id") % 23 == 5, F.substring(good, 1, 20)).when(F.col("event_id") % 29 == 7, odd).otherwise(good)
    rows = ev.select(F.when(F.col("event_id") % 10 == 7, "").otherwise(line).alias("value"),
                     F.to_date("ts").alias("load_date"), (F.col("event_id") % 10).alias("media"))
    rows.repartition("load_date", "media").write.partitionBy("load_date", "media").text(f"{root}/{EVENT_DATASET}")
    return root


@register("malformed_by_file", "WITH " + _LINES + """
SELECT load_date, media, SUM(CASE WHEN media = 7 THEN 0 ELSE 1 END) AS records,
       SUM(CASE WHEN media <> 7 AND (cut OR odd) THEN 1 ELSE 0 END) AS malformed
FROM lines GROUP BY load_date, media""")
def q_malformed_by_file(s: Star) -> DataFrame:
    """Landed files with lines cut short, numbers written as text, and
    nothing in them: records and malformed ones of each file (A8, N3)."""
    audit = file_audit(s.spark, _landed_lines(s), EVENT_DATASET, VISITOR_EVENT_DDL)
    folder = lambda name: F.regexp_extract("file", f"/{name}=([^/]+)/", 1)
    return audit.groupBy(folder("load_date").cast("date").alias("load_date"), folder("media").cast("long").alias("media")) \
        .agg(F.sum("records").alias("records"), F.sum("malformed").alias("malformed"))


@register("quarantined_records", "WITH " + _LINES + """
SELECT CASE WHEN cut THEN 'cut' ELSE 'odd' END AS kind, COUNT(*) AS records, COUNT(DISTINCT (load_date, media)) AS files
FROM lines WHERE media <> 7 AND (cut OR odd) GROUP BY kind""")
def q_quarantined_records(s: Star) -> DataFrame:
    """What a build over such files kept aside, with text and file (N3).  A
    record with one odd field keeps its other fields and is an event."""
    cur = full_rebuild(s.spark, _landed_lines(s), scratch_path(s.spark, "quarantine"))
    kind = F.when(F.length("malformed") == 20, "cut").otherwise("odd").alias("kind")
    return quarantine(cur).groupBy(kind).agg(F.count(F.lit(1)).alias("records"), F.count_distinct("file").alias("files"))


@register("plays_between", star_sql("""
SELECT date, CAST(SUM(play_count) AS BIGINT) AS plays FROM fact
WHERE date BETWEEN DATE '2024-01-08' AND DATE '2024-01-21' GROUP BY date"""))
def q_plays_between(s: Star) -> DataFrame:
    """The daily mart for a range of days, as a SQL table function over the
    catalog called with named arguments (S9, P14)."""
    return catalog.call(s.spark, "plays_between", _registered(s), {"first": "2024-01-08", "last": "2024-01-21"})


@register("kept_kpi_summary", _TWO_LANDINGS.split("SELECT media_id, visitor_id, date, play_count, play_rate, ROUND")[0] +
          "SELECT CAST(SUM(play_count) AS BIGINT) AS total_plays, ROUND(SUM(total_watch_time) / 3600.0, 2) AS total_watch_hours, "
          "COUNT(DISTINCT visitor_id) AS unique_visitors, ROUND(AVG(watched_percent) * 100, 2) AS avg_watched_percent FROM fact")
def q_kept_kpi_summary(s: Star) -> DataFrame:
    """The KPIs after two increments, from the kept sums by day and the kept
    set of visitors; no fact is read (A3)."""
    cur = landed.incremental(s.spark, s.sf_dir)[-1]
    return marts.kpi_from_sums(cur.read("mart_days"), cur.fact_visitors.read())


@register("kept_engagement_by_media", _TWO_LANDINGS.split("SELECT media_id, visitor_id, date, play_count, play_rate, ROUND")[0] +
          "SELECT d.title, d.channel, CAST(SUM(f.play_count) AS BIGINT) AS plays, "
          "ROUND(SUM(f.total_watch_time) / 3600.0, 2) AS watch_hours "
          "FROM fact f JOIN dim_media d ON f.media_id = d.media_id GROUP BY d.title, d.channel")
def q_kept_engagement_by_media(s: Star) -> DataFrame:
    """Plays and hours by title and channel after two increments, from the
    kept sums (A4, O1)."""
    cur = landed.incremental(s.spark, s.sf_dir)[-1]
    return marts.engagement_from_sums(cur.read("mart_days"), cur.read("dim_media"))


@register("kept_daily_plays", star_sql("SELECT date, CAST(SUM(play_count) AS BIGINT) AS plays FROM fact GROUP BY date"))
def q_kept_daily_plays(s: Star) -> DataFrame:
    """Plays by date after two increments, from the kept sums (A5, O2)."""
    return marts.trend_from_sums(landed.incremental(s.spark, s.sf_dir)[-1].read("mart_days"))
