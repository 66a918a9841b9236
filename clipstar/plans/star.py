"""The Silver -> Gold star schema over the test-table adapter, as lazy plans."""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from clipstar.operators import dims, fact, silver
from clipstar.plans import adapters


@dataclass
class Star:
    spark: SparkSession
    sf_dir: str

    @cached_property
    def bronze_events(self) -> DataFrame:
        return adapters.landed_events(self.spark, self.sf_dir)

    @cached_property
    def bronze_media(self) -> DataFrame:
        return adapters.landed_snapshots(self.spark, self.sf_dir)

    @cached_property
    def silver_events(self) -> DataFrame:
        return silver.silver_visitor_events(self.bronze_events)

    @cached_property
    def fact_events(self) -> DataFrame:
        """Silver events narrowed to the fact's columns (smaller dedup shuffle)."""
        return silver.silver_visitor_events(self.bronze_events, silver.FACT_EVENT_PAYLOAD)

    @cached_property
    def silver_media(self) -> DataFrame:
        return silver.silver_media_stats(self.bronze_media)

    @cached_property
    def profile(self) -> DataFrame:
        return dims.media_profile(self.silver_media)

    @cached_property
    def measures(self) -> DataFrame:
        """Duration and play_rate per media; the snapshots carry nothing else through the shuffle."""
        return dims.media_measures(silver.silver_media_stats(self.bronze_media, silver.MEASURE_PAYLOAD))

    @cached_property
    def channel_mapping(self) -> DataFrame:
        return adapters.channel_mapping(self.spark, self.sf_dir)

    @cached_property
    def dim_media(self) -> DataFrame:
        return dims.dim_media(profile=self.profile, channel_mapping=self.channel_mapping)

    @cached_property
    def dim_visitor(self) -> DataFrame:
        return dims.dim_visitor(self.silver_events)

    @cached_property
    def fact_base(self) -> DataFrame:
        return fact.daily_engagement(self.fact_events)

    @cached_property
    def fact_for_marts(self) -> DataFrame:
        """The fact built from the same media profile as dim_media: in a plan
        that joins both, the profile aggregation's exchange is reused, so the
        snapshots are aggregated once."""
        return fact.attach_media_measures(self.fact_base, self.profile)

    @cached_property
    def fact(self) -> DataFrame:
        return fact.attach_media_measures(self.fact_base, self.measures)
