"""Catalog registration of the Gold tables and SQL over them.

The dashboard marts are plain SQL over the registered tables; ``run_query``
hands the text to Spark SQL (parser -> Catalyst -> AQE)."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

# FIXED VALUES: the names of tables and columns, and what each mart reports.  As in operators.marts, the fact is
# summed to one row per media before it meets the dimension.
_BY_MEDIA = """
    WITH media_sums AS (
      SELECT media_id, COUNT(*) AS n, SUM(play_count) AS p, SUM(total_watch_time) / 3600.0 AS h
      FROM {db}.fact_media_engagement GROUP BY media_id
    ), labelled AS (
      SELECT title, channel, SUM(n) AS n, SUM(p) AS p, SUM(h) AS h
      FROM media_sums JOIN {db}.dim_media USING (media_id) GROUP BY title, channel
    ) """

MART_SQL = {
    "kpi_summary": """
    SELECT SUM(play_count) AS total_plays, ROUND(SUM(total_watch_time) / 3600.0, 2) AS total_watch_hours,
           COUNT(DISTINCT visitor_id) AS unique_visitors, ROUND(AVG(watched_percent) * 100, 2) AS avg_watched_percent
    FROM {db}.fact_media_engagement""",
    "engagement_by_media": _BY_MEDIA + """
    SELECT title, channel, p AS plays, ROUND(h, 2) AS watch_hours FROM labelled
    ORDER BY plays DESC NULLS LAST, title, channel""",
    "media_channel_rollup": _BY_MEDIA + """
    SELECT title, channel, n AS engagement_rows, p AS total_plays, ROUND(h, 2) AS total_watch_hours FROM labelled
    ORDER BY total_plays DESC NULLS LAST, title, channel""",
    "daily_plays_trend": """
    SELECT date, SUM(play_count) AS plays FROM {db}.fact_media_engagement
    GROUP BY date ORDER BY date NULLS LAST""",
    "visitor_geography": """
    SELECT country, COUNT(*) AS visitors FROM {db}.dim_visitor
    WHERE country IS NOT NULL GROUP BY country ORDER BY visitors DESC, country""",
}


# Marts with parameters: name -> (parameters, columns, query).
TABLE_FUNCTIONS = {
    "plays_between": ("first DATE, last DATE", "date DATE, plays BIGINT", """
    SELECT f.date, SUM(f.play_count) FROM {db}.fact_media_engagement f
    WHERE f.date BETWEEN plays_between.first AND plays_between.last GROUP BY f.date"""),
}


def register_tables(spark: SparkSession, database: str, locations: Mapping[str, str],
                    fmt: str = "parquet", database_location: str | None = None,
                    comment: str = "video engagement gold layer") -> None:
    """CREATE DATABASE IF NOT EXISTS + one external table per location.

    Re-registering points the name at the new location; dropping an
    external table removes only the catalog entry, never the data."""
    where = f" LOCATION '{database_location}'" if database_location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} COMMENT '{comment}'{where}")
    for name, path in locations.items():
        spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
        spark.sql(f"CREATE TABLE {database}.{name} USING {fmt} LOCATION '{path}'")
        if spark.table(f"{database}.{name}").columns and _is_partitioned(spark, database, name):
            spark.sql(f"ALTER TABLE {database}.{name} RECOVER PARTITIONS")


def _is_partitioned(spark: SparkSession, database: str, name: str) -> bool:
    cols = spark.catalog.listColumns(f"{database}.{name}")
    return any(c.isPartition for c in cols)


def run_query(spark: SparkSession, sql: str, database: str | None = None) -> DataFrame:
    return spark.sql(sql.format(db=database) if database else sql)


def mart(spark: SparkSession, name: str, database: str) -> DataFrame:
    return run_query(spark, MART_SQL[name], database)


def call(spark: SparkSession, name: str, database: str, arguments: Mapping[str, object]) -> DataFrame:
    """A mart with parameters: a SQL table function over the catalog, called with named arguments, which are bound as
    values and never become part of the text."""
    parameters, columns, query = TABLE_FUNCTIONS[name]
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE({columns}) "
              f"RETURN {query.format(db=database)}")
    kinds = dict(p.split(" ") for p in parameters.split(", "))
    given = ", ".join(f"{p} => CAST(:{p} AS {kinds[p]})" for p in arguments)
    return spark.sql(f"SELECT * FROM {name}({given})", args=dict(arguments))
