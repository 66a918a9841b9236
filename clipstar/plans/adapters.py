"""Turn the driver's generic test tables into the landed record shapes.

Roles (every table is read whole; the mapping is a rule, never an id list):

* visitor events <- ``events``: event_key = event_id, media_id = event_id mod 10,
  visitor_key = user_id (``error`` events are anonymous: NULL visitor_key, one
  hot group of about a fifth of all rows), received_at = ts written as the API
  writes it, percent_viewed = props.k / 100, country = the customer's nation.
* odd events, by remainders of event_id: no media, a media that no snapshot
  was ever landed for, no percent_viewed, a malformed timestamp, a timestamp
  written with an offset (whose written date can be the next day's).
* re-landed copies: events in the last two hours of a day are landed again
  with the next day's load_date (overlapping ingestion windows): a third of
  them unchanged, a third with a received_at one day later, a third with a
  malformed one.
* media snapshots <- ``lineitem`` x ``orders`` x ``part``: one snapshot per
  line, landed monthly; media_id = l_partkey, load_date = first day of the
  l_shipdate month (several snapshots of a media share a load_date: the last
  landed, by ingest_seq from the line's key, replaces the others), updated =
  o_orderdate (missing while the order is pending), duration =
  l_extendedprice, play_rate = l_discount, title = p_name, or one title for
  all of UNTITLED_REMAINDERS.
* ingestion: an event reaches the source ``value`` hours after ``ts`` (its
  delivery delay).  A previous ingestion run at PREVIOUS_RUN_AT landed what
  had arrived by then and left the checkpoint; the current run, dated RUN_AT,
  is served every event.  Late events are those that arrived after the
  previous run although their timestamp is at or before the watermark it left.
  In a run with failures, the media of economy parts fail.
* channel mapping <- ``part``: p_brand, except economy parts and untitled
  media, which stand in for media nobody has mapped yet (they get the default
  channel, so untitled media merge in the marts).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipstar.functions.timeparse import iso_millis, iso_seconds_offset
from clipstar.sources.landing import by_day

MEDIA_FAN_OUT = 10
ANONYMOUS_EVENT_TYPE = "error"
RELAND_FROM_HOUR = 22
SHARE_URL_PREFIX = "https://media.example.test/s/"
UNMAPPED_PART_TYPE = "ECONOMY"
UNTITLED = "Untitled"
UNTITLED_REMAINDERS = (1, 2)  # of part keys by 5
# (divisor, remainder) of event ids
NO_MEDIA, UNKNOWN_MEDIA, NO_PERCENT, MALFORMED, OFFSET = (50, 9), (50, 19), (20, 4), (101, 5), (103, 6)
UNKNOWN_MEDIA_PREFIX = "unlisted-"  # no part has such a key, so no snapshot is ever landed for the media
PREVIOUS_RUN_AT = "2024-01-15 00:00:00"
RUN_AT = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def visitor_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey) \
        .select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("country"))


def epoch_seconds(ts: str) -> float:
    import datetime as dt
    return dt.datetime.fromisoformat(ts).replace(tzinfo=dt.timezone.utc).timestamp()


def arrived_by(at: str):
    """Predicate on ``events``: the event had reached the source by ``at`` (UTC)."""
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) / 1e6 + F.col("value") * 3600
    return arrival <= F.lit(epoch_seconds(at))


def _odd(rule: tuple[int, int]):
    return F.col("event_id") % rule[0] == rule[1]


def media_of_event():
    listed = (F.col("event_id") % MEDIA_FAN_OUT).cast("string")
    return F.when(_odd(UNKNOWN_MEDIA), F.concat(F.lit(UNKNOWN_MEDIA_PREFIX), listed)).when(~_odd(NO_MEDIA), listed)


def received_text():
    """``ts`` as the API writes it: mostly in UTC, by rule with an offset, or malformed."""
    local = F.concat(F.date_format(F.col("ts") + F.expr("INTERVAL '05:30' HOUR TO MINUTE"),
                                   "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+05:30"))
    return F.when(_odd(MALFORMED), F.concat(F.lit("0-"), iso_millis("ts"))).when(_odd(OFFSET), local) \
        .otherwise(iso_millis("ts"))


def recopied_text():
    """The timestamp that a re-landed copy has."""
    later = iso_millis(F.col("ts") + F.expr("INTERVAL '1' DAY"))
    return F.when(F.col("event_id") % 3 == 0, later) \
        .when(F.col("event_id") % 3 == 1, F.concat(F.lit("0-"), iso_millis("ts"))).otherwise(received_text())


def api_events(spark: SparkSession, sf_dir: str, arrived_at: str | None = None) -> DataFrame:
    """Bronze-shaped events as the source serves them (each event once),
    optionally only those that had arrived by ``arrived_at``."""
    ev = table(spark, sf_dir, "events")
    if arrived_at is not None:
        ev = ev.where(arrived_by(arrived_at))
    e = ev.join(visitor_country(spark, sf_dir), "user_id", "left").withColumn("load_date", F.to_date("ts"))
    return _records(e, received_text())


def landed_events(spark: SparkSession, sf_dir: str, placed: bool = False, where: Column | None = None) -> DataFrame:
    """Bronze visitor events (VISITOR_EVENT_DDL columns + load_date), with
    the re-landed copies; those ``where`` a condition on load_date holds.
    ``placed``: by load_date, before the record is built, to be written."""
    e = table(spark, sf_dir, "events").join(visitor_country(spark, sf_dir), "user_id", "left")
    # One scan: each event yields its landing, plus the next day's copy if re-landed.
    first, copy = (F.struct(F.date_add(F.to_date("ts"), days).alias("load_date"), F.lit(days == 1).alias("_copied"))
                   for days in (0, 1))
    landings = F.when(F.hour("ts") >= RELAND_FROM_HOUR, F.array(first, copy)).otherwise(F.array(first))
    e = e.select("event_id", "ts", "user_id", "event_type", "props", "country", F.inline(landings))
    e = e if where is None else e.where(where)
    received = F.when(F.col("_copied"), recopied_text()).otherwise(received_text())
    return _records(by_day(e) if placed else e, received)


def _records(e: DataFrame, received_at: Column) -> DataFrame:
    """Bronze-shaped events of ``events`` rows with their country and load_date."""
    no_str, no_dbl = F.lit(None).cast("string"), F.lit(None).cast("double")
    return e.select(
        received_at.alias("received_at"),
        F.col("event_id").cast("string").alias("event_key"),
        F.concat(F.lit("192.0.2."), (F.col("event_id") % 256).cast("string")).alias("ip"),
        "country",
        no_str.alias("region"), no_str.alias("city"), no_dbl.alias("lat"),
        no_dbl.alias("lon"), no_str.alias("org"),
        F.when(~_odd(NO_PERCENT), F.get_json_object("props", "$.k").try_cast("double") / 100.0)
        .alias("percent_viewed"),
        F.when(F.col("event_type") == ANONYMOUS_EVENT_TYPE, F.lit(None).cast("string"))
        .otherwise(F.col("user_id").cast("string")).alias("visitor_key"),
        F.struct(F.col("event_type").alias("browser"), no_str.alias("browser_version"),
                 no_str.alias("platform"),
                 (F.col("user_id") % 2 == 0).alias("mobile")).alias("user_agent_details"),
        media_of_event().alias("media_id"),
        no_str.alias("media_name"), no_str.alias("media_url"),
        F.lit(None).cast("struct<url:string,width:bigint,height:bigint>").alias("thumbnail"),
        "load_date",
    )


def snapshot_load_date():
    return F.trunc(F.to_date("l_shipdate"), "month").alias("load_date")


def ingest_seq():
    """Order in which the lines' snapshots were landed."""
    return (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("bigint").alias("ingest_seq")


def landed_snapshots(spark: SparkSession, sf_dir: str, placed: bool = False, where: Column | None = None) -> DataFrame:
    """Bronze media snapshots (``media`` and ``stats`` structs + load_date);
    those ``where`` a condition on ingest_seq holds.  ``placed``: by
    load_date, before the record is built, to be written."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", snapshot_load_date())
    li = li if where is None else li.withColumn("ingest_seq", ingest_seq()).where(where).drop("ingest_seq")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    j = li.join(orders, li.l_orderkey == orders.o_orderkey) \
        .join(part, li.l_partkey == part.p_partkey, "left").drop("o_orderkey", "p_partkey")
    j = by_day(j) if placed else j
    link = F.concat_ws("-", F.col("l_orderkey").cast("string"),
                       F.col("l_linenumber").cast("string"))
    media = F.struct(
        F.col("l_partkey").alias("id"),
        F.col("l_partkey").cast("string").alias("hashed_id"),
        F.lit("Video").alias("type"),
        (F.col("o_orderstatus") == "F").alias("archived"),
        F.when((F.col("l_partkey") % 5).isin(*UNTITLED_REMAINDERS), UNTITLED).otherwise(F.col("p_name")).alias("name"),
        F.col("l_extendedprice").alias("duration"),
        iso_seconds_offset("o_orderdate").alias("created"),
        F.when(F.col("o_orderstatus") == "P", F.lit(None).cast("string"))
        .otherwise(iso_seconds_offset("o_orderdate")).alias("updated"),
        F.lit("ready").alias("status"),
        F.array("p_brand", "p_type").alias("tags"),
        F.struct(F.col("l_orderkey").alias("id"), F.col("p_brand").alias("hashed_id"),
                 F.col("p_type").alias("name")).alias("project"),
        F.struct(link.alias("hashed_id"), F.concat(F.lit(SHARE_URL_PREFIX), link).alias("url"),
                 F.lit("public").alias("visibility")).alias("share_link"),
    )
    stats = F.struct(
        (F.col("l_quantity") * 10).cast("bigint").alias("load_count"),
        F.col("l_quantity").cast("bigint").alias("play_count"),
        F.col("l_discount").alias("play_rate"),
        (F.col("l_tax") * 100).alias("hours_watched"),
        F.col("l_tax").alias("engagement"),
        F.col("l_linenumber").cast("bigint").alias("visitors"),
    )
    return j.select(media.alias("media"), stats.alias("stats"), F.lit(None).cast("bigint").alias("landing"),
                    ingest_seq(), "load_date")


def channel_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    named = ~(F.col("p_partkey") % 5).isin(*UNTITLED_REMAINDERS)
    return part.where((F.col("p_type") != UNMAPPED_PART_TYPE) & named).select(
        F.col("p_partkey").cast("string").alias("media_id"), F.col("p_brand").alias("channel"))


def media_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media an ingestion run processes: every part is a media."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("media_id"))


def failing_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The media whose fetch fails in a run with failures."""
    return table(spark, sf_dir, "part").where(F.col("p_type") == UNMAPPED_PART_TYPE) \
        .select(F.col("p_partkey").cast("string").alias("media_id"))


def media_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The metadata endpoint's answer per media (one record per part)."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").cast("string").alias("media_id"),
        F.struct(
            F.col("p_partkey").alias("id"),
            F.col("p_partkey").cast("string").alias("hashed_id"),
            F.lit("Video").alias("type"), F.lit(False).alias("archived"),
            F.col("p_name").alias("name"), F.col("p_retailprice").alias("duration"),
            F.lit(None).cast("string").alias("created"), F.lit(None).cast("string").alias("updated"),
            F.lit("ready").alias("status"), F.array("p_brand").alias("tags"),
            F.lit(None).cast("struct<id:bigint,hashed_id:string,name:string>").alias("project"),
            F.struct(F.lit(None).cast("string").alias("hashed_id"),
                     F.concat(F.lit(SHARE_URL_PREFIX), F.col("p_partkey").cast("string")).alias("url"),
                     F.lit("public").alias("visibility")).alias("share_link"),
        ).alias("media"))


def media_stats_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stats endpoint's answer per media per day (one per line item)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").cast("string").alias("media_id"),
        snapshot_load_date(), ingest_seq(),
        F.struct(
            (F.col("l_quantity") * 10).cast("bigint").alias("load_count"),
            F.col("l_quantity").cast("bigint").alias("play_count"),
            F.col("l_discount").alias("play_rate"),
            (F.col("l_tax") * 100).alias("hours_watched"),
            F.col("l_tax").alias("engagement"),
            F.col("l_linenumber").cast("bigint").alias("visitors"),
        ).alias("stats"))
